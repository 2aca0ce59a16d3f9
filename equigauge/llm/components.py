"""Connected components of a table of links, in rounds of grouping and joining."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.session import materialize

MAX_ROUNDS = 100


def smallest_labels(links: DataFrame) -> DataFrame:
    """Smallest key that each linked key reaches. ``links``: a, b (any sortable type).

    Every round links a key's neighbours to the smallest of them, first over the
    larger ones, then over the smaller ones, until all links end in the smallest
    key of their component. Rounds grow with the logarithm of the longest path;
    each is written to the shared folder. Sums are combined before the shuffle,
    and a key with very many links is a skewed join that adaptive execution deals
    anew. Returns key, label for every key with a link to another one.
    """
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(edges.distinct(), "links")
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # larger neighbours of a key go to the smallest of its neighbourhood
        large = both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.distinct(), "links")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        # now every link points down: the other smaller neighbours go there as well
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
        small = small.unionByName(low.select("a", F.col("m").alias("b")))
        small = materialize(small.distinct(), "links")
        edges = small
        several = edges.groupBy("a").count().where("count > 1").limit(1)
        chained = edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1)
        if not several.count() and not chained.count():
            return edges.select(F.col("a").alias("key"), F.col("b").alias("label"))
    raise RuntimeError("components did not settle")
