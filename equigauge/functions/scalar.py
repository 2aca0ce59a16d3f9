"""Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int = 4) -> Column:
    """Round a DOUBLE; written with floor so that every engine agrees on ties."""
    scale = F.lit(float(10**digits))
    return F.floor(as_col(c).cast("double") * scale + F.lit(0.5)) / scale


def ratio(num: Column, den: Column) -> Column:
    """num / den as DOUBLE, 0 where the denominator is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def to_number(c: Column | str) -> Column:
    """Text to DOUBLE, NULL when it is no number; never NaN."""
    text = as_col(c).cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def canonical_code(c: Column | str) -> Column:
    """One text form per code: 20, 20.0 and "20" meet, "0010" keeps its zeros."""
    return F.regexp_replace(as_col(c).cast("string"), r"^(-?[0-9]+)\.0+$", "$1")


def slug(c: Column | str) -> Column:
    """Metric key of a group name: no dimension prefix, spaces and slashes to _."""
    bare = F.regexp_replace(as_col(c), "^[a-z_]+: ", "")
    return F.lower(F.translate(bare, " /", "__"))


def literal_map(mapping: dict) -> Column:
    """A map literal; meant for code tables with a known, small size."""
    return F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])


def at_least(c: Column | str, cut: float) -> Column:
    return (as_col(c) >= F.lit(cut)).cast("int")
