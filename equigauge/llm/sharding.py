"""Shards that all have the mixture of the whole: proportional stratified interleaving.

Rows of a stratum are put in a seeded random order. The row of rank r (from 0) of
a stratum with n rows stands at the fractional rank (r + phase) / n, where the
phase of the stratum is a hash between 0 and 1. All rows sorted by fractional
rank interleave the strata in proportion, and equal cuts of that order are the
shards: row counts are at most one apart, and so are, up to rounding, the counts
of every stratum.

Ranks need no sort of a whole stratum: rows fall into buckets by their hash (or
fractional rank), buckets are counted, a window sorts inside one bucket, and the
sums of the counts before it give its offset. A stratum with a third of all rows
has buckets like any other, and all that is shuffled are keys, not texts.

Defined results: a null stratum is a stratum of its own; null doc_ids and equal
rows are ranked like others (equal rows in any order, so the result is the same).
An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equigauge.llm.common import unused
from equigauge.session import materialize

ROWS_PER_BUCKET = 1000
MAX_BUCKETS = 1 << 16


def offsets(counts: DataFrame, within: list[str]) -> DataFrame:
    """Rows in earlier buckets of the same group, for each row of group columns, bucket, n.

    Sums over at most 256 buckets at a time: first over blocks, then inside one.
    """
    blocks = counts.withColumn("block", F.col("bucket").bitwiseAND(~255))
    sums = blocks.groupBy(*within, "block").agg(F.sum("n").alias("n_block"))
    before = Window.partitionBy(*within).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n_block").over(before), F.lit(0))).drop("n_block")
    inside = Window.partitionBy(*within, "block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    own = blocks.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return own.join(sums, [*within, "block"]).select(*within, "bucket", (F.col("before") + F.col("inside")).alias("earlier"))


def interleave(rows: DataFrame, stratum: str, order: list[str], shards: int, seed: int = 7, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``rows`` with shard (from 0) and slot (from 0, gapless in the shard).

    ``rows`` is read twice, so it should be a written table of keys. ``order``:
    the columns that make rows differ; they and the seed fix the result.
    """
    columns = rows.columns
    n = rows.count()
    buckets = min(MAX_BUCKETS, math.ceil(n / rows_per_bucket) or 1)
    draw = F.xxhash64(F.lit(seed), *order)

    def unit(c: Column) -> Column:
        # 53 bits of the hash as a number from 0 up to 1
        return F.shiftrightunsigned(c, 11).cast("double") / float(1 << 53)

    def bucket_of(c: Column) -> Column:
        return F.least(F.floor(c * buckets), F.lit(buckets - 1)).cast("int")

    # never null, so that joins keep the partitioning of the windows
    stratum_key = F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit(""))
    drawn = rows.select(F.struct(*columns).alias("row"), stratum_key.alias("stratum"), draw.alias("draw"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(order)])
    keys = [f"k{i}" for i in range(len(order))]
    drawn = drawn.withColumn("bucket", bucket_of(unit(F.col("draw"))))
    counts = drawn.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    totals = counts.groupBy("stratum").agg(F.sum("n").alias("total"))
    at = offsets(counts, ["stratum"]).join(totals, "stratum")
    # a few numbers per stratum and bucket; the size is the join's to judge
    at = materialize(at, "stratum-offsets")
    # buckets are dealt out by number alone: each has as many rows, however large a stratum is
    drawn = drawn.repartition("bucket")
    inside = Window.partitionBy("stratum", "bucket").orderBy(F.shiftrightunsigned("draw", 1), "draw", *keys)
    numbered = drawn.withColumn("inside", F.row_number().over(inside) - 1)
    placed = numbered.join(at, ["stratum", "bucket"])
    phase = unit(F.xxhash64(F.lit(seed + 1), F.col("stratum")))
    ranked = placed.select(
        "row",
        "draw",
        *keys,
        ((F.col("earlier") + F.col("inside") + phase) / F.col("total")).alias("fraction"),
    ).withColumn("bucket", bucket_of(F.col("fraction")))
    ranked = materialize(ranked, "fractional-ranks")
    before = materialize(offsets(ranked.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("all", F.lit(0)), ["all"]).drop("all"), "rank-offsets")
    order_all = Window.partitionBy("bucket").orderBy("fraction", "draw", *keys)
    place = ranked.withColumn("inside", F.row_number().over(order_all) - 1).join(before, "bucket")
    place = place.withColumn("place", F.col("earlier") + F.col("inside"))
    shard = F.expr(f"(place * {shards}L) div {max(n, 1)}L")
    # the first place of a shard
    first = F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")
    return place.withColumn("shard", shard).select("row.*", F.col("shard").cast("int").alias("shard"), (F.col("place") - first).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 7) -> DataFrame:
    """Keys, sizes and places of all documents: doc_id, size, text_crc32, source, shard, slot.

    A null text counts as empty. Size: UTF-8 bytes of the text and 8 for the id.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.col("source").cast("string").alias("source"),
    )
    rows = materialize(rows, "shard-rows")
    return interleave(rows, "source", ["doc_id", "size", "text_crc32"], shards, seed)


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write the documents themselves in their shards, each in slot order.

    ``placed`` as from ``shard_documents``; doc_id must be unique for this. Columns of
    the documents that are named shard or slot are written as own_shard and own_slot.
    """
    docs = docs.withColumnsRenamed({c: unused(docs, f"own_{c}") for c in docs.columns if c.lower() in ("shard", "slot")})
    key = unused(docs, "placed_id")
    where = placed.select(F.col("doc_id").alias(key), "shard", "slot")
    rows = docs.join(where, F.col("doc_id") == F.col(key)).drop(key)
    rows.repartition("shard", F.expr("slot div 100000")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
