"""Ordered cumulative sums and exact quantiles without a one-task sort.

Values are put into ordered buckets of about equal size. A window sorts only
inside one bucket; bucket totals give the offset of every later bucket. Cut
points decide only how even the buckets are: any cut points give exact sums.
Borders are found on two levels, so buckets stay of one size on any table.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKET = "_bucket"
VALUES_PER_BUCKET = 500_000
MAX_BUCKETS = 2048
CHUNKS = 512


def _merged_sketches(
    rows: DataFrame, columns: Sequence[str], by: Sequence[str], fractions: int
) -> DataFrame:
    """Rows (i, *by, n, q): values and ``fractions`` - 1 quantiles of column number i, per ``by``.

    Sketches of the map tasks merge in ``CHUNKS`` reducers first, then their
    quantiles merge once more, so no task takes the sketches of all tasks.
    """
    # one literal instead of one per fraction keeps the plan small
    text = ",".join(str(j / fractions) for j in range(1, fractions))
    wanted = F.split(F.lit(text), ",").cast("array<double>")

    def sketch(c: str) -> Column:
        return F.percentile_approx(F.col(c).cast("double"), wanted, 2 * fractions)

    ids = range(len(columns))
    chunks = rows.select(*columns, *by, (F.spark_partition_id() % CHUNKS).alias("_chunk"))
    chunks = chunks.groupBy("_chunk", *by).agg(
        *[F.count(columns[i]).alias(f"n{i}") for i in ids],
        *[sketch(columns[i]).alias(f"q{i}") for i in ids],
    )
    cells = [
        F.struct(F.lit(i).alias("i"), F.col(f"n{i}").alias("n"), F.col(f"q{i}").alias("q"))
        for i in ids
    ]
    per_column = chunks.select(*by, F.inline(F.array(*cells))).select(
        *by, "i", "n", F.posexplode("q").alias("pos", "x")
    )
    return per_column.groupBy("i", *by).agg(
        F.sum(F.when(F.col("pos") == 0, F.col("n"))).alias("n"), sketch("x").alias("q")
    )


def _picked(quantiles: Sequence[float], wanted: int) -> list[float]:
    """``wanted`` - 1 of evenly spaced quantiles, without repeats."""
    have = len(quantiles) + 1
    return sorted({quantiles[j * have // wanted - 1] for j in range(1, min(wanted, have))})


def cut_points(
    df: DataFrame, columns: Sequence[str], buckets: int | None = None
) -> dict[str, list[float]]:
    """Bucket borders per column, from quantile sketches.

    Without ``buckets`` their number follows the number of rows, so that a bucket
    stays near ``VALUES_PER_BUCKET`` rows whatever the table. One pass gives up to
    ``MAX_BUCKETS`` of them. If a column needs more, a second pass sketches inside
    each of these, which is enough for ``MAX_BUCKETS`` squared. What comes to the
    driver is a number per bucket.
    """
    columns = list(columns)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts: dict[str, list[float]] = {c: [] for c in columns}
    inner: dict[str, int] = {}
    for row in _merged_sketches(df, columns, [], MAX_BUCKETS).collect():
        wanted = buckets or max(least, row["n"] // VALUES_PER_BUCKET + 1)
        if row["q"]:
            name = columns[row["i"]]
            cuts[name] = _picked(row["q"], min(wanted, MAX_BUCKETS))
            if wanted > MAX_BUCKETS:
                inner[name] = min(MAX_BUCKETS, -(-wanted // MAX_BUCKETS))
    for name, parts in inner.items():
        cuts[name] = _refined(df.select(name), name, cuts[name], parts)
    return cuts


def _refined(rows: DataFrame, column: str, cuts: Sequence[float], parts: int) -> list[float]:
    """More borders, by a sketch inside each bucket; a bucket with more rows gets more of them."""
    placed = add_bucket(rows.where(F.col(column).isNotNull()), column, cuts)
    # twice as many quantiles as asked for, so that a heavy bucket can use more than its share
    found = _merged_sketches(placed, [column], [BUCKET], 2 * parts).collect()
    share = sum(r["n"] for r in found) / max(1, len(found) * parts)
    more = set(cuts)
    for r in found:
        more.update(_picked(r["q"], min(2 * parts, max(1, round(r["n"] / share)))))
    return sorted(more)


def add_bucket(df: DataFrame, column: str, cuts: Sequence[float], out: str = BUCKET) -> DataFrame:
    """Bucket number of a numeric column; grows with the value."""
    borders = [-float("inf"), *cuts, float("inf")]
    borders = [borders[0]] + [b for a, b in pairwise(borders) if b > a]
    if len(borders) < 3:
        return df.withColumn(out, F.lit(0))
    source = f"{out}_in"
    sized = Bucketizer(
        splits=borders, inputCol=source, outputCol=out, handleInvalid="keep"
    ).transform(df.withColumn(source, F.col(column).cast("double")))
    return sized.withColumn(out, F.col(out).cast("int")).drop(source)


def histogram(df: DataFrame, group: Sequence[str], order: str, **aggs: Column) -> DataFrame:
    """One row per (group, bucket, value); partial aggregation shrinks hot values."""
    return df.groupBy(*group, BUCKET, order).agg(*[c.alias(n) for n, c in aggs.items()])


def before_in_bucket(group: Sequence[str], order: str):
    return (
        Window.partitionBy(*group, BUCKET)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def before_bucket(group: Sequence[str]):
    """Window over bucket totals: a row per bucket and group, one for ``VALUES_PER_BUCKET`` values."""
    return (
        Window.partitionBy(*(group or [F.lit(0)]))
        .orderBy(BUCKET)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def bucket_totals(hist: DataFrame, group: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Totals per bucket plus the running totals of all earlier buckets."""
    totals = hist.groupBy(*group, BUCKET).agg(*[F.sum(v).alias(f"{v}_total") for v in values])
    w = before_bucket(group)
    for v in values:
        totals = totals.withColumn(
            f"{v}_offset", F.coalesce(F.sum(f"{v}_total").over(w), F.lit(0))
        )
    return totals.drop(*[f"{v}_total" for v in values])


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join that also pairs NULL keys."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        part = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = part if cond is None else cond & part
    return left.join(renamed, cond).drop(*[f"_r_{k}" for k in keys])


def prefix_sum(
    hist: DataFrame, group: Sequence[str], order: str, values: Sequence[str]
) -> DataFrame:
    """Exclusive running sum ``<value>_before`` per group, in ``order``.

    ``hist`` comes from :func:`histogram`. Offsets join back on (group, bucket),
    a key by which the rows are already spread out.
    """
    w = before_in_bucket(group, order)
    inside = hist
    for v in values:
        inside = inside.withColumn(f"{v}_inside", F.coalesce(F.sum(v).over(w), F.lit(0)))
    joined = null_safe_join(inside, bucket_totals(hist, group, values), [*group, BUCKET])
    for v in values:
        joined = joined.withColumn(f"{v}_before", F.col(f"{v}_inside") + F.col(f"{v}_offset"))
    return joined.drop(*[f"{v}_{s}" for v in values for s in ("inside", "offset")])


def running_counts(df: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """Rows per distinct value and rows before it."""
    rows = df.where(F.col(order).isNotNull())
    cuts = cut_points(rows, [order])[order]
    hist = histogram(add_bucket(rows, order, cuts), group, order, n=F.count(F.lit(1)))
    return prefix_sum(hist, group, order, ["n"]).drop(BUCKET)


def quantiles_of(hist: DataFrame, group: Sequence[str], order: str, probs: Sequence[float]):
    """Exact linear-interpolated quantiles from a histogram with counts ``n``.

    Wanted ranks are placed by bucket totals first; only the buckets that hold
    one are sorted.
    """
    totals = hist.groupBy(*group, BUCKET).agg(F.sum("n").alias("bucket_n"))
    totals = totals.withColumn(
        "bucket_before", F.coalesce(F.sum("bucket_n").over(before_bucket(group)), F.lit(0))
    ).withColumn(
        "group_n", F.sum("bucket_n").over(Window.partitionBy(*(group or [F.lit(0)])))
    )
    position = F.col("p") * (F.col("group_n") - 1).cast("double")
    ranks = (
        totals.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("lo", F.floor(position))
        .withColumn("hi", F.ceil(position))
        .withColumn("frac", position - F.floor(position))
    )
    first, last = F.col("bucket_before"), F.col("bucket_before") + F.col("bucket_n") - 1
    holds = ranks.where(
        F.col("lo").between(first, last) | F.col("hi").between(first, last)
    ).select(*group, BUCKET, "bucket_before", "p", "lo", "hi", "frac")
    wanted = holds.groupBy(*group, BUCKET).agg(
        F.first("bucket_before").alias("bucket_before"),
        F.collect_list(F.struct("p", "lo", "hi", "frac")).alias("wanted"),
    )
    picked = null_safe_join(hist, wanted, [*group, BUCKET])
    start = F.col("bucket_before") + F.coalesce(
        F.sum("n").over(before_in_bucket(group, order)), F.lit(0)
    )
    hits = (
        picked.withColumn("start", start)
        .withColumn("end", F.col("start") + F.col("n") - 1)
        .select(*group, order, "start", "end", F.inline("wanted"))
        .where(
            F.col("lo").between(F.col("start"), F.col("end"))
            | F.col("hi").between(F.col("start"), F.col("end"))
        )
    )
    x = F.col(order).cast("double")
    lo = F.max(F.when(F.col("lo").between(F.col("start"), F.col("end")), x))
    hi = F.max(F.when(F.col("hi").between(F.col("start"), F.col("end")), x))
    return hits.groupBy(*group, "p").agg(
        (lo + F.max("frac") * (hi - lo)).alias("value")
    )


def quantiles(df: DataFrame, group: Sequence[str], column: str, probs: Sequence[float]):
    """Exact quantiles of one column per group: columns (group…, p, value)."""
    rows = df.where(F.col(column).isNotNull())
    cuts = cut_points(rows, [column])[column]
    hist = histogram(add_bucket(rows, column, cuts), group, column, n=F.count(F.lit(1)))
    return quantiles_of(hist, group, column, probs)
