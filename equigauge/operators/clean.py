"""Row and column rules: rename, coerce, filter, label, separate, check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigauge.functions.scalar import (
    as_col,
    at_least,
    canonical_code,
    literal_map,
    ratio,
    to_number,
)
from equigauge.operators.joins import lookup_join
from equigauge.roles import LIMITS, ROLES, Roles


@dataclass(frozen=True)
class Rule:
    """A named row condition; a row passes only where it is true."""

    name: str
    condition: str


def validity_rules(min_age: int = LIMITS.min_age) -> tuple[Rule, ...]:
    return (
        Rule("income_present", "wage_income IS NOT NULL"),
        Rule("income_not_negative", "wage_income >= 0"),
        Rule("age_present", "age IS NOT NULL"),
        Rule("age_minimum", f"age >= {min_age}"),
    )


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def drop_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to DOUBLE; what is no number becomes NULL."""
    return df.withColumns({c: to_number(c) for c in columns if c in df.columns})


def coercion_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many texts per column could not be read as a number."""
    present = [c for c in columns if c in df.columns]
    counts = df.agg(
        *[F.count_if(F.col(c).isNotNull() & to_number(c).isNull()).alias(c) for c in present]
    )
    return counts.unpivot([], present, "feature", "unparseable")


def drop_invalid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    for rule in rules:
        df = df.where(rule.condition)
    return df


def row_audit(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows before, after and dropped, in total and per rule, in one pass.

    A rule's ``dropped`` counts the rows that pass all earlier rules but not
    this one, so the rules sum up to the total.
    """
    aggs = []
    so_far = F.lit(True)
    for i, rule in enumerate(rules):
        ok = F.coalesce(F.expr(rule.condition), F.lit(False))
        aggs.append(F.count_if(so_far).alias(f"b{i}"))
        aggs.append(F.count_if(so_far & ok).alias(f"a{i}"))
        so_far = so_far & ok
    counts = df.agg(F.count(F.lit(1)).alias("b"), F.count_if(so_far).alias("a"), *aggs)
    rows = [F.struct(F.lit("total").alias("rule"), F.col("b").alias("before"), F.col("a").alias("after"))]
    rows += [
        F.struct(
            F.lit(r.name).alias("rule"), F.col(f"b{i}").alias("before"), F.col(f"a{i}").alias("after")
        )
        for i, r in enumerate(rules)
    ]
    dropped = F.col("before") - F.col("after")
    return (
        counts.select(F.inline(F.array(*rows)))
        .withColumn("dropped", dropped)
        .withColumn("dropped_share", ratio(dropped, F.col("before")))
    )


def label(df: DataFrame, source: str, cut: float, out: str) -> DataFrame:
    return df.withColumn(out, at_least(source, cut))


def separate(df: DataFrame, roles: Roles = ROLES) -> tuple[DataFrame, DataFrame]:
    """Model table and sensitive table; only key and label are in both.

    The label source leaves both: as a feature it would give the label away.
    """
    secret = [c for c in roles.sensitive if c in df.columns]
    sensitive = df.select(roles.key, *secret, roles.label)
    model = df.drop(*roles.sensitive, roles.label_source)
    shared = set(model.columns) & set(sensitive.columns)
    if shared - {roles.key, roles.label}:
        raise ValueError(f"columns in both tables: {sorted(shared)}")
    return model, sensitive


def pop_weight(df: DataFrame, roles: Roles = ROLES) -> tuple[DataFrame, DataFrame]:
    """Features without the record weight, and the weight by key."""
    return df.drop(roles.weight), df.select(roles.key, roles.weight)


def select_features(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    return df.select(roles.key, *[c for c in roles.feature_order if c in df.columns])


def classify(df: DataFrame, score: str = "score", cut: float = LIMITS.score_cut) -> DataFrame:
    return df.withColumn("pred", at_least(score, cut))


def decode(
    df: DataFrame, column: str, labels: Mapping[str, str] | DataFrame, out: str | None = None
) -> DataFrame:
    """Label of a code; NULL for a code without one.

    A code book in the program is a literal; a table (code, label) is joined.
    """
    out = out or f"{column}_label"
    if isinstance(labels, DataFrame):
        table = labels.select(F.col("code").alias("_code"), F.col("label").alias(out))
        return lookup_join(df.withColumn("_code", canonical_code(column)), table, ["_code"]).drop(
            "_code"
        )
    return df.withColumn(out, literal_map(dict(labels))[canonical_code(column)])


def canonical_codes(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Raw record in its one agreed form: codes as text, numbers as DOUBLE."""
    codes = {c: canonical_code(c) for c in roles.categorical if c in df.columns}
    numbers = {c: F.col(c).cast("double") for c in roles.numeric if c in df.columns}
    return df.withColumns({**codes, **numbers})


@dataclass(frozen=True)
class Domain:
    """Allowed range or allowed codes of one column."""

    column: str
    low: float | None = None
    high: float | None = None
    codes: tuple[str, ...] | None = None

    def violated(self) -> Column:
        c = F.col(self.column)
        if self.codes is not None:
            ok = canonical_code(self.column).isin(*self.codes)
        else:
            ok = as_col(c).between(F.lit(self.low), F.lit(self.high))
        return ~F.coalesce(ok, F.lit(False))


def check_domain(df: DataFrame, domains: Sequence[Domain]) -> DataFrame:
    """Adds ``violations``, the columns out of their domain, and ``valid``."""
    found = F.array_compact(
        F.array(*[F.when(d.violated(), F.lit(d.column)) for d in domains])
    )
    return df.withColumn("violations", found).withColumn("valid", F.size("violations") == 0)


def check_contract(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Compare column names, types and order with a stored schema.

    Reads schemas only, never rows; the result has one row per column.
    """
    actual = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(df.schema)}
    rows = []
    for i, f in enumerate(expected):
        want = f.dataType.simpleString()
        pos, have = actual.pop(f.name, (None, None))
        if have is None:
            status = "missing"
        elif have != want:
            status = "type_differs"
        elif pos != i:
            status = "order_differs"
        else:
            status = "ok"
        rows.append((i, f.name, want, have, status))
    rows += [(pos, name, None, have, "unexpected") for name, (pos, have) in actual.items()]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, expected string, actual string, status string"
    )
