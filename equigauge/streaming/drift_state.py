"""Drift of a stream against a stored reference profile, from counts kept in state.

The reference is read once, to make its profile: per feature the values and how
often each occurs. A number with more than ``max_values`` of them is rounded down
to that many quantile borders, for the reference and the stream alike, so a
profile is bounded by features x ``max_values`` rows; scores of such a feature are
those of the rounded values.

On the stream, rows of a period are first counted by feature and value, so a busy
feature brings no more rows than its values. State per feature holds the counts of
the last ``span`` periods; older ones expire. When a period closes, its score is
that of all rows of the span, the same as :func:`column_drift` on them. A batch
reads only its own rows. Missing values are left out, as there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from equigauge.functions.scalar import canonical_code
from equigauge.operators.drift import FEW_VALUES, JENSEN_SHANNON, NORM_FLOOR, WASSERSTEIN
from equigauge.operators.prefix import add_bucket, cut_points
from equigauge.roles import LIMITS
from equigauge.session import materialize

MAX_VALUES = 2048
PROFILE = "feature string, is_numeric boolean, is_rounded boolean, value string, n bigint, std double"
RESULT = "feature string, window_end timestamp, rows bigint, stattest string, score double, score_kind string, drift_detected boolean"
COUNTS = T.StructType(
    [T.StructField(name, T.ArrayType(kind)) for name, kind in (("periods", T.LongType()), ("keys", T.StringType()), ("n", T.LongType()))]
)


@dataclass(frozen=True)
class FeatureProfile:
    """Values of one feature in the reference, with their numbers. Numbers are written as texts."""

    is_numeric: bool
    is_rounded: bool
    n: dict[str, int]
    std: float | None

    def test(self) -> str:
        return WASSERSTEIN if self.is_numeric and len(self.n) > FEW_VALUES else JENSEN_SHANNON

    def score(self, now: dict[str, int]) -> float | None:
        """Distance between the reference and counted values; None if either is empty."""
        total_ref, total_now = sum(self.n.values()), sum(now.values())
        if not total_ref or not total_now:
            return None
        if self.test() == WASSERSTEIN:
            both: dict[float, list[int]] = {}
            for side, counts in enumerate((self.n, now)):
                for value, n in counts.items():
                    both.setdefault(float(value), [0, 0])[side] += n
            area = ref = cur = 0.0
            places = sorted(both)
            for x, following in zip(places, places[1:], strict=False):
                ref += both[x][0]
                cur += both[x][1]
                area += abs(ref / total_ref - cur / total_now) * (following - x)
            return area / max(self.std or 0.0, NORM_FLOOR)
        total = 0.0
        for value in self.n.keys() | now.keys():
            p, q = self.n.get(value, 0) / total_ref, now.get(value, 0) / total_now
            m = (p + q) / 2
            total += sum(x * math.log2(x / m) for x in (p, q) if x > 0) / 2
        return math.sqrt(max(total, 0.0))


def _text(column: str, numeric: bool) -> Column:
    """One text form per value; numbers keep their full precision."""
    return F.col(column).cast("double").cast("string") if numeric else canonical_code(column)


def _rounded(df: DataFrame, column: str, borders: Sequence[float]) -> DataFrame:
    """Numbers rounded down to a border; those below the first one go up to it."""
    place = F.greatest(F.col("_place"), F.lit(1))
    levels = F.array(*[F.lit(float(b)) for b in borders])
    placed = add_bucket(df, column, borders, "_place")
    value = F.when(F.col(column).isNotNull(), F.element_at(levels, place))
    return placed.withColumn(column, value).drop("_place")


def reference_profile(reference: DataFrame, columns: Sequence[str], max_values: int = MAX_VALUES) -> DataFrame:
    """The profile of a reference table, written once. Rows: ``PROFILE``."""
    numeric = {c for c in columns if isinstance(reference.schema[c].dataType, T.NumericType)}
    sizes = reference.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    wide = [c for c in columns if c in numeric and sizes[c] > 0.9 * max_values]
    too_long = [c for c in columns if c not in numeric and sizes[c] > max_values]
    if too_long:
        raise ValueError(f"more than {max_values} codes: {too_long}")
    spread = reference.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in numeric]).first() if numeric else {}
    borders = cut_points(reference, wide, max_values) if wide else {}
    rows = reference.select(*columns)
    for c in wide:
        rows = _rounded(rows, c, borders[c])
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit(c in numeric).alias("is_numeric"),
            F.lit(c in borders).alias("is_rounded"),
            _text(c, c in numeric).alias("value"),
            F.lit(spread[c] if c in numeric else None).cast("double").alias("std"),
        )
        for c in columns
    ]
    long = rows.select(F.inline(F.array(*cells))).where("value is not null")
    counts = long.groupBy("feature", "is_numeric", "is_rounded", "value", "std").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counts.select(*[p.split()[0] for p in PROFILE.split(", ")]), "drift-profile")


def write_profile(profile: DataFrame, path: str) -> None:
    profile.write.mode("overwrite").parquet(path)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROFILE).parquet(path)


def load_profile(profile: DataFrame) -> dict[str, FeatureProfile]:
    """The bounded profile on the driver, by feature."""
    found: dict[str, FeatureProfile] = {}
    for r in profile.toLocalIterator():
        known = found.setdefault(r.feature, FeatureProfile(r.is_numeric, r.is_rounded, {}, r.std))
        known.n[r.value] = r.n
    return found


class _Drift(StatefulProcessor):
    """Counts of the last periods of one feature."""

    def __init__(self, profiles: dict[str, FeatureProfile], kept_seconds: int, cut: float):
        self.profiles, self.kept_seconds, self.cut = profiles, kept_seconds, cut

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getValueState("counts", COUNTS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        feature = key[0]
        profile = self.profiles[feature]
        kept: dict[int, dict[str, int]] = {}
        if self.counts.exists():
            for period, value, n in zip(*self.counts.get(), strict=True):
                kept.setdefault(period, {})[value] = n
        fresh: set[int] = set()
        for batch in rows:
            for period, value, n in zip(batch["period"].tolist(), batch["value"].tolist(), batch["n"].tolist(), strict=True):
                fresh.add(period)
                counts = kept.setdefault(period, {})
                counts[value] = counts.get(value, 0) + n
        out = []
        for end in sorted(fresh):
            span: dict[str, int] = {}
            for period, counts in kept.items():
                if end - self.kept_seconds < period <= end:
                    for value, n in counts.items():
                        span[value] = span.get(value, 0) + n
            raw = profile.score(span)
            score = None if raw is None else math.floor(raw * 1e4 + 0.5) / 1e4
            stamp = pd.Timestamp(end, unit="s", tz="UTC")
            out.append((feature, stamp, sum(span.values()), profile.test(), score, "distance", raw is not None and raw >= self.cut))
        newest = max(kept)
        flat = [(p, v, n) for p, counts in sorted(kept.items()) if p > newest - self.kept_seconds for v, n in counts.items()]
        self.counts.update(tuple(map(list, zip(*flat, strict=True))))
        yield pd.DataFrame(out, columns=["feature", "window_end", "rows", "stattest", "score", "score_kind", "drift_detected"])

    def close(self) -> None:
        pass


def stream_drift(
    stream: DataFrame,
    profile: DataFrame,
    ts: str,
    period_seconds: int,
    span: int = 1,
    lateness: str = "1 day",
    limits=LIMITS,
) -> DataFrame:
    """A row per feature and closed period with rows: drift of the last ``span`` periods. Needs the RocksDB state store.

    ``profile`` comes from :func:`reference_profile` or :func:`read_profile` and is
    all that is read of the reference.
    """
    profiles = load_profile(profile)
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    for c, p in profiles.items():
        if p.is_rounded:
            timed = _rounded(timed, c, sorted(float(v) for v in p.n))
    cells = [F.struct(F.lit(c).alias("feature"), _text(c, p.is_numeric).alias("value")) for c, p in profiles.items()]
    long = timed.select(ts, F.inline(F.array(*cells))).where("value is not null")
    counted = long.groupBy(F.window(ts, f"{period_seconds} seconds").alias("w"), "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.select(
        "feature", F.window_time("w").alias("event_time"), F.unix_seconds(F.col("w.end")).alias("period"), "value", "n"
    )
    return rows.groupBy("feature").transformWithStateInPandas(
        statefulProcessor=_Drift(profiles, span * period_seconds, limits.distance_cut),
        outputStructType=RESULT,
        outputMode="Append",
        timeMode="EventTime",
    )
