"""SimHash fingerprints, and near-duplicates by pivot distance tables.

Fingerprints within ``max_bits`` differing bits are linked; documents that reach
each other over links share a component. Work is done on distinct fingerprints,
so a group of copies counts once.

Search. The 64 bits are cut into blocks. Two fingerprints that differ in at most
``max_bits`` bits agree in all blocks but ``max_bits`` at most, so they meet in a
bucket of some choice of equal blocks (exact; nothing is approximated). The
blocks are more the more fingerprints there are, so that buckets stay small
however large the table. Inside a bucket a pivot distance table holds the Hamming
distances to many reference fingerprints. By the triangle inequality a pair is
discarded if any coordinate differs by more than ``max_bits``: members are sorted
by the pivot that spreads them most, which leaves a window of partners, and the
other pivots thin that out. The exact distance verifies the survivors.
(Pivots alone make no join key for this: distances of unrelated fingerprints lie
at 32 +- 4, and a pivot lets nearly half of all pairs pass.)

A bucket with more than ``CROWD`` members is many texts in a few bits. There,
members meet in smaller buckets instead, one for each choice of ``max_bits`` bits
that may differ: members of one such bucket are linked, all of them, so a star
replaces the pairs, and work grows with the members and not with their square.

Defined results: a null text is empty; a text without words has fingerprint zero,
linked like any other. Null doc_ids are ignored for the smallest doc_id; a
component of null doc_ids only has a null component_id. Rows with the same
doc_id stay rows of their own. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.llm.common import arrow_schema, text_bytes, unused
from equigauge.llm.components import smallest_labels
from equigauge.session import materialize

FINGERPRINTS = "doc_id bigint, text_hash bigint, fp bigint"
LINKS = "a bigint, b bigint"
PIVOTS = 32
CROWD = 4096
HASHES = 1 << 16


def reference_fingerprints(n: int = PIVOTS) -> np.ndarray:
    """Pivots: fixed pseudo-random fingerprints, whatever the table."""
    return np.random.default_rng(64).integers(0, 2**64, n, dtype=np.uint64)


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash over word shingles; ``bytes.lower`` and ``bytes.split`` know ASCII only, as asked for."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    line = b" ".join(words)
    # a shingle is the stretch from the start of one word to the end of another
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    stops = ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), HASHES):
        pairs = zip(starts[at : at + HASHES], stops[at : at + HASHES], strict=True)
        h = np.fromiter((digest(line[a:b], 42) for a, b in pairs), np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    # place k holds bit k, as the hashes lie in memory with the lowest byte first
    set_bits = np.packbits((2 * ones > len(starts)).astype(np.uint8), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row per document: doc_id, text_hash (tells rows without a doc_id apart), fp (the 64 bits as a signed number)."""
    schema = arrow_schema(FINGERPRINTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in batch["text"].to_pylist()]
            columns = [batch["doc_id"], batch["text_hash"], pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_bytes()).alias("text_hash"), text_bytes().alias("text"))
    return source.mapInArrow(run, FINGERPRINTS)


def block_masks(blocks: int) -> list[int]:
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def blocks_for(n: int, max_bits: int) -> int:
    """Fewest blocks at which a fingerprint meets less than one unrelated one on average."""
    for blocks in range(max_bits + 1, 33):
        key_bits = 64 * (blocks - max_bits) // blocks
        if n * comb(blocks, max_bits) < 2.0 ** (key_bits + 1):
            return blocks
    return 32


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def linked_pairs(members: np.ndarray, max_bits: int, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of members within ``max_bits``, by the pivot distance table of a bucket."""
    table = np.bitwise_count(members[:, None] ^ pivots[None, :]).astype(np.int8)
    spread = np.argsort(-table.std(axis=0))
    table = table[:, spread]
    order = np.argsort(table[:, 0], kind="stable")
    members, table = members[order], table[order]
    stop = np.searchsorted(table[:, 0], table[:, 0] + max_bits, side="right")
    n = len(members)
    found_a, found_b = [], []
    step = max(1, 1_000_000 // n)
    for at in range(0, n, step):
        rows = np.arange(at, min(at + step, n))
        counts = stop[rows] - rows - 1
        a = np.repeat(rows, counts)
        b = np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts) + a + 1
        for k in range(1, table.shape[1]):
            near = np.abs(table[a, k] - table[b, k]) <= max_bits
            if near.all() and k >= 4:
                break
            a, b = a[near], b[near]
        close = np.bitwise_count(members[a] ^ members[b]) <= max_bits
        found_a.append(members[a[close]])
        found_b.append(members[b[close]])
    return np.concatenate(found_a), np.concatenate(found_b)


def forest(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that keep the connections of the pairs without a ring: fewer than the members."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        top_x, top_y = root(x), root(y)
        if top_x != top_y:
            parent[top_x] = top_y
            yield x, y


def links(distinct: DataFrame, max_bits: int = 3, crowd: int = CROWD, blocks: int | None = None) -> DataFrame:
    """Links between distinct fingerprints (column fp): a, b, enough to connect every pair within ``max_bits``."""
    n = distinct.count()
    masks = block_masks(blocks or blocks_for(n, max_bits))
    chosen = [sum(masks) - sum(out) for out in combinations(masks, max_bits)]
    keyed = distinct.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m)).cast("bigint")) for m in chosen])).alias("choice", "bucket"),
    )
    sizes = keyed.groupBy("choice", "bucket").count().where("count > 1")
    # most fingerprints are alone in all their buckets and go no further
    met = materialize(keyed.join(sizes, ["choice", "bucket"]), "buckets")
    schema = arrow_schema(LINKS)
    pivots = reference_fingerprints()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int]] = []
            for members in batch["members"]:
                fps = members.values.to_numpy().astype(np.int64).view(np.uint64)
                a, b = linked_pairs(np.unique(fps), max_bits, pivots)
                rows += forest(a.view(np.int64), b.view(np.int64))
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    # a stated number of partitions: few bytes are much work here, and by bytes they would meet in one task
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = met.where(F.col("count") <= crowd).repartition(tasks, "choice", "bucket")
    buckets = small.groupBy("choice", "bucket").agg(F.collect_list("fp").alias("members"))
    found = buckets.select("members").mapInArrow(search, LINKS)
    crowded = met.where(F.col("count") > crowd)
    if crowded.head(1):
        # the bits outside the equal blocks, max_bits of them left open at a time: a fixed small table
        open_masks = [
            (choice, opened, signed(~sum(1 << i for i in bits) & (2**64 - 1)))
            for choice, m in enumerate(chosen)
            for opened, bits in enumerate(combinations([i for i in range(64) if not m >> i & 1], max_bits))
        ]
        masks_table = distinct.sparkSession.createDataFrame(open_masks, "choice int, opened int, mask bigint")
        smaller = crowded.select("choice", "fp").join(F.broadcast(masks_table), "choice")
        smaller = smaller.withColumn("bucket", F.col("fp").bitwiseAND(F.col("mask")))
        centre = smaller.groupBy("choice", "opened", "bucket").agg(F.min("fp").alias("centre"), F.count("*").alias("n"))
        stars = smaller.join(centre.where("n > 1"), ["choice", "opened", "bucket"]).select(
            F.col("fp").alias("a"), F.col("centre").alias("b")
        )
        found = found.unionByName(stars.where("a != b").distinct())
    return found


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, text_hash, fp, component_id (smallest doc_id reachable, itself included), label.

    ``label``, the smallest fingerprint of the component, names it also where all doc_ids are null.
    """
    found = materialize(fingerprints(docs, shingle), "fingerprints")
    distinct = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    labels = smallest_labels(links(distinct.select("fp"), max_bits, crowd))
    # every fingerprint with the label of its component, or its own
    labelled = distinct.join(labels.withColumnRenamed("key", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_fp = materialize(labelled.join(smallest, "label").select("fp", "component_id", "label"), "components")
    # a group of copies is one hot key of the left side, which adaptive execution splits
    return found.join(of_fp, "fp").select("doc_id", "text_hash", "fp", "component_id", "label")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """Rows of ``docs`` that stay: of each component the one with the smallest doc_id (null if it has no other)."""
    columns = docs.columns
    found = near_duplicates(docs, shingle, max_bits)
    # struct order: a doc_id before none, then the smallest, then the smallest hash of the text; n: rows that are equal to it
    rows = found.groupBy("label", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n")
    kept_id, kept_hash = unused(docs, "kept_id"), unused(docs, "kept_hash")
    kept = rows.groupBy("label").agg(F.min(row).alias("row"))
    kept = materialize(kept.select(F.col("row.doc_id").alias(kept_id), F.col("row.text_hash").alias(kept_hash), "row.n"), "kept-rows")
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.xxhash64(text_bytes()) == F.col(kept_hash))
    out = docs.join(kept.select(kept_id, kept_hash), same, "left_semi")
    # a row that is there several times is more rows than components
    if kept.where("n > 1").head(1):
        out = out.dropDuplicates(["doc_id", "text"])
    return out.select(*columns)
