"""Reproducible stratified splits and folds by hashed key.

A record's place depends only on its key, its class and the seed, never on
partitioning or row order. Keys must be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from equigauge.functions.scalar import literal_map
from equigauge.roles import LIMITS

PREFIX = 4
MAX_CLASSES = 1000


def key_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")).cast("binary"))


def _hashed(df: DataFrame, y: str, key: str, seed: int) -> DataFrame:
    return df.select(F.col(y).alias("y"), key_hash(key, seed).alias("h")).withColumn(
        "b", F.substring("h", 1, PREFIX)
    )


def rank_in_class(df: DataFrame, y: str, key: str, seed: int) -> DataFrame:
    """Adds ``rank`` (from 1) in hash order inside the class.

    Rows are ranked in 16^4 hash ranges per class; range totals, at most 65,536
    per class, give the offsets.
    """
    rows = df.withColumn("_h", key_hash(key, seed)).withColumn("_b", F.substring("_h", 1, PREFIX))
    before = Window.partitionBy(y).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(y, "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(y, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy(y, "_b").orderBy("_h"))
    ranked = rows.withColumn("_in", inside).join(offsets, [y, "_b"])
    return ranked.withColumn("rank", F.col("_offset") + F.col("_in")).drop(
        "_h", "_b", "_in", "_offset"
    )


def hash_borders(df: DataFrame, y: str, key: str, seed: int, shares: list[float]) -> DataFrame:
    """Per class, the hash of the last record within each cumulative share.

    Counts per hash range find the range of each border; only the rows of that
    range are ranked. Columns: y, borders (ascending hashes; a share that rounds to
    no record has none).
    """
    rows = _hashed(df, y, key, seed)
    counts = rows.groupBy("y", "b").agg(F.count(F.lit(1)).alias("n"))
    by_class = Window.partitionBy("y")
    before = by_class.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn(
        "total", F.sum("n").over(by_class)
    )
    share = F.explode(
        F.array(
            *[F.struct(F.lit(i).alias("i"), F.lit(float(s)).alias("s")) for i, s in enumerate(shares)]
        )
    )
    targets = (
        placed.withColumn("w", share)
        .withColumn("m", F.floor(F.col("w.s") * F.col("total") + F.lit(0.5)))
        .select("y", "b", F.col("w.i").alias("i"), (F.col("m") - F.col("before")).alias("r"), "n")
        .where(F.col("r").between(1, F.col("n")))
    )
    wanted = targets.groupBy("y", "b").agg(F.collect_list(F.struct("i", "r")).alias("wanted"))
    spots = wanted.agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.struct(F.col("y").cast("string"), "b"), "wanted"))
        )
    )
    hit = F.element_at(spots.scalar(), F.struct(F.col("y").cast("string"), "b"))
    inside = F.row_number().over(Window.partitionBy("y", "b").orderBy("h"))
    found = (
        rows.withColumn("wanted", hit)
        .where(F.col("wanted").isNotNull())
        .withColumn("r_in", inside)
        .select("y", "h", "r_in", F.inline("wanted"))
        .where(F.col("r_in") == F.col("r"))
    )
    return found.groupBy("y").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("i", "h"))), lambda e: e["h"]
        ).alias("borders")
    )


def _fitted_borders(borders: DataFrame) -> dict[str, list[str]]:
    """Borders per class, a few hashes; later uses of the split are then plain columns."""
    rows = borders.limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes; is this a label?")
    return {str(r["y"]): list(r["borders"]) for r in rows}


def _of_class(y: str, found: dict[str, list[str]], place: int) -> Column:
    """The row's own border, NULL where its class has none at this place."""
    own = {c: b[place] for c, b in found.items() if len(b) > place}
    if not own:
        return F.lit(None).cast("string")
    return literal_map(own)[F.col(y).cast("string")]


def stratified_split(
    df: DataFrame,
    y: str,
    key: str,
    share: float = LIMITS.test_share,
    seed: int = LIMITS.seed,
) -> DataFrame:
    """Adds ``is_test``: exactly round(share * n) records of every class."""
    found = _fitted_borders(hash_borders(df, y, key, seed, [share]))
    inside = key_hash(key, seed) <= _of_class(y, found, 0)
    return df.withColumn("is_test", F.coalesce(inside, F.lit(False)))


def stratified_folds(
    df: DataFrame,
    y: str,
    key: str,
    folds: int = LIMITS.folds,
    seed: int = LIMITS.seed,
) -> DataFrame:
    """Adds ``fold`` 0..folds-1; fold sizes per class differ by at most one."""
    shares = [j / folds for j in range(1, folds)]
    found = _fitted_borders(hash_borders(df, y, key, seed, shares))
    h = key_hash(key, seed)
    passed = [F.when(h > _of_class(y, found, j), 1).otherwise(0) for j in range(folds - 1)]
    return df.withColumn("fold", sum(passed, F.lit(0)))
