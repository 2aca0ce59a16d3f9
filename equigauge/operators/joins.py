"""Keyed joins: lookups, alignment, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.functions.scalar import as_col

BROADCAST_ROWS = 100_000
SALTS = 64


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    on: list[str],
    known_rows: int | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join to a lookup table with unique keys.

    The table is broadcast only if it has at most ``max_rows`` rows
    (``known_rows`` saves the check when the caller built it). A larger table
    is joined by shuffle, with every key spread over ``SALTS`` partitions so
    that one hot key does not end in one task.
    """
    if known_rows is None:
        known_rows = table.limit(max_rows + 1).count()
    if known_rows <= max_rows:
        return df.join(F.broadcast(table), on, "left")
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int")
    spread = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return df.withColumn("_salt", salt).join(spread, [*on, "_salt"], "left").drop("_salt")


def align(sensitive: DataFrame, split: DataFrame, key: str) -> DataFrame:
    """Sensitive rows of one split (unique key on both sides)."""
    return sensitive.join(split.select(key), key, "left_semi")


def attach_groups(scored: DataFrame, sensitive: DataFrame, key: str) -> DataFrame:
    """Bring the sensitive attributes to the scored rows."""
    extra = [c for c in sensitive.columns if c == key or c not in scored.columns]
    return scored.join(sensitive.select(*extra), key, "inner")


def attach_report(scored: DataFrame, sensitive: DataFrame, key: str) -> DataFrame:
    """Row counts that prove the join lost and doubled nothing."""
    keys = scored.select(key, F.lit(1).alias("s"), F.lit(0).alias("a")).unionAll(
        sensitive.select(key, F.lit(0).alias("s"), F.lit(1).alias("a"))
    )
    per_key = keys.groupBy(key).agg(F.sum("s").alias("s"), F.sum("a").alias("a"))
    totals = per_key.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("scored_rows"),
        F.coalesce(F.sum(F.col("s") * F.col("a")), F.lit(0)).alias("joined_rows"),
        F.count_if((F.col("s") > 0) & (F.col("a") == 0)).alias("without_group"),
        F.count_if((F.col("s") > 1) | (F.col("a") > 1)).alias("repeated_keys"),
    )
    complete = (F.col("scored_rows") == F.col("joined_rows")) & (F.col("repeated_keys") == 0)
    return totals.withColumn("complete", complete)


def reconcile(a: DataFrame, b: DataFrame, key: str, score: str, tolerance: float) -> DataFrame:
    """Compare two scorers per record: match, differ, or missing on one side."""
    left = a.select(key, F.col(score).alias("score_a"), F.lit(True).alias("in_a"))
    right = b.select(key, F.col(score).alias("score_b"), F.lit(True).alias("in_b"))
    both = left.join(right, key, "full_outer")
    diff = F.abs(F.col("score_a") - F.col("score_b"))
    status = (
        F.when(F.col("in_a").isNull(), "missing_in_a")
        .when(F.col("in_b").isNull(), "missing_in_b")
        .when(diff < F.lit(tolerance), "match")
        .otherwise("differ")
    )
    return both.select(key, "score_a", "score_b", diff.alias("diff"), status.alias("status"))


def reconcile_summary(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.max("diff").alias("max_diff")
    )


def unseen(df: DataFrame, codes: DataFrame, columns: list[str]) -> DataFrame:
    """Codes of the current table that the fitted code table does not hold."""
    from equigauge.operators.encode import long_codes

    current = long_codes(df, columns).where("code is not null").groupBy("feature", "code")
    return current.agg(F.count(F.lit(1)).alias("n")).join(
        codes.select("feature", "code"), ["feature", "code"], "left_anti"
    )


def histogram_pair(
    ref: DataFrame, cur: DataFrame, by: list, counted: str | None = None
) -> DataFrame:
    """Counts of both tables per key, 0 where a side lacks the key.

    The union with one grouped sum gives what a full outer join of two
    histograms gives, with one shuffle of pre-aggregated rows.
    """
    n = F.lit(1) if counted is None else F.col(counted)
    cols = [as_col(c) for c in by]
    sides = ref.select(*cols, n.cast("long").alias("n_ref"), F.lit(0).cast("long").alias("n_cur"))
    sides = sides.unionAll(
        cur.select(*cols, F.lit(0).cast("long").alias("n_ref"), n.cast("long").alias("n_cur"))
    )
    names = sides.columns[: len(by)]
    return sides.groupBy(*names).agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
