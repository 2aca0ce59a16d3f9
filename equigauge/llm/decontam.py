"""Benchmark decontamination by size-partitioned MinHash containment search.

A document is contaminated by a test item if it holds at least ``threshold`` of
the item's distinct word shingles. Items are short and documents may be long, so
the likeness of the two sets says nothing; the search is for containment.

Items are partitioned by size (powers of two of their shingles). The sketch of an
item holds the smallest values of a min-wise hash over its shingles; its length
is fixed by the partition. Of an item with q shingles, a document above the
threshold lacks at most m = floor((1 - threshold) q). A sketch of k values has
hits in the document for at least k - m of them, so every contaminated document
has that many hits: nothing is missed, and k = 2 m + 1 asks for more than half of
the sketch. Partitions whose smallest item needs more shingles than a document
has are skipped for it. Candidates are verified by counting the item's shingles
in the document exactly, as texts.

The items are the stated query set: they go to the executors in blocks of at most
``BLOCK_BYTES`` of text each, one pass over the documents per block, whatever the
number of items. Documents never leave their partition.

Words are runs of letters and digits of the lower-cased text. Defined results: an
item with fewer words than a shingle has one shingle, all its words, and is looked
for among the stretches of as many words of every document. A text without words
matches nothing. Null texts are empty. Rows with the same id are judged each on its own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.llm.common import arrow_schema, text_bytes

SHINGLE = 5
THRESHOLD = 0.8
BLOCK_BYTES = 16_000_000
WORD = re.compile(r"[^\W_]+")
LEAKS = "doc_id bigint, item_id bigint, n_shingles bigint, n_found bigint, first_word bigint, last_word bigint"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def shingles_of(words: list[str], size: int) -> list[tuple[str, ...]]:
    if not words:
        return []
    size = min(size, len(words))
    return list(zip(*(words[k:] for k in range(size)), strict=False))


class WordNumbers:
    """Min-wise hash values of shingles from hashes of their words; the words' are remembered for a while."""

    def __init__(self, limit: int = 1 << 18):
        self.known: dict[str, int] = {}
        self.limit = limit

    def hashes(self, words: list[str], size: int) -> np.ndarray:
        """One value per shingle, in order; equal shingles have equal values."""
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > self.limit:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        numbers = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(size, len(words))
        n = len(words) - size + 1
        mixed = np.full(n, size, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                mixed = (mixed ^ numbers[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
        return mixed


class SizePartition:
    """Items of similar size, with an inverted index of their sketches."""

    def __init__(self, items: list[tuple[int, int]], hashes: dict[int, np.ndarray], threshold: Fraction):
        # items: (index, distinct shingles)
        largest = max(q for _, q in items)
        self.least_shingles = min(-(-threshold * q // 1) for _, q in items)
        misses = int((1 - threshold) * largest)
        self.sketch_length = 2 * misses + 1
        values, owners, self.need = [], [], {}
        for index, q in items:
            sketch = np.sort(hashes[index])[: self.sketch_length]
            values.append(sketch)
            owners.append(np.full(len(sketch), index))
            self.need[index] = max(1, len(sketch) - int((1 - threshold) * q))
        value, owner = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(value, kind="stable")
        self.value, self.owner = value[order], owner[order]

    def candidates(self, hashes: np.ndarray, hashed: int) -> list[int]:
        """Items with enough sketch values among the document's sorted distinct hashes."""
        if hashed < self.least_shingles:
            return []
        at = np.searchsorted(hashes, self.value)
        at[at == len(hashes)] = 0
        hit = hashes[at] == self.value
        counts = Counter(self.owner[hit].tolist())
        return [i for i, n in counts.items() if n >= self.need[i]]


class ContainmentIndex:
    """Size partitions over a bounded block of items."""

    def __init__(self, items: list[tuple[int, str]], size: int = SHINGLE, threshold: float = THRESHOLD):
        self.size, self.threshold = size, Fraction(str(threshold))
        self.numbers = WordNumbers()
        self.items = []
        parts: dict[int, list[tuple[int, int]]] = {}
        hashes = {}
        for item_id, text in items:
            words = words_of(text)
            found = set(shingles_of(words, size))
            if not found:
                continue
            index = len(self.items)
            words_each = min(size, len(words))
            self.items.append((item_id, found, words_each))
            hashes[index] = np.unique(self.numbers.hashes(words, size))
            parts.setdefault((words_each, len(found).bit_length()), []).append((index, len(found)))
        # by the words of a shingle: items shorter than one have shingles of their own length
        self.partitions: dict[int, list[SizePartition]] = {}
        for (words_each, _), p in sorted(parts.items()):
            self.partitions.setdefault(words_each, []).append(SizePartition(p, hashes, self.threshold))

    def find(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item_id, shingles, found, first word, last word) of every contained item."""
        words = words_of(text)
        found = []
        for words_each, partitions in self.partitions.items():
            if words_each > len(words):
                continue
            hashes = np.unique(self.numbers.hashes(words, words_each))
            wanted = [i for p in partitions for i in p.candidates(hashes, len(hashes))]
            if wanted:
                found += self.verified(words, words_each, wanted)
        return found

    def verified(self, words: list[str], words_each: int, wanted: list[int]) -> list[tuple[int, int, int, int, int]]:
        found = []
        where: dict[tuple[str, ...], tuple[int, int]] = {}
        for at, shingle in enumerate(shingles_of(words, words_each)):
            where[shingle] = (where.get(shingle, (at, at))[0], at)
        for i in sorted(wanted):
            item_id, shingles, _ = self.items[i]
            both = [where[s] for s in shingles if s in where]
            if len(both) >= self.threshold * len(shingles):
                end = max(b for _, b in both) + words_each - 1
                found.append((item_id, len(shingles), len(both), min(a for a, _ in both), end))
        return found


def blocks_of(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded text, one block at a time on the driver."""
    block, held = [], 0
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    for row in rows.toLocalIterator():
        if block and held + len(row.text) > block_bytes:
            yield block
            block, held = [], 0
        block.append((row.item_id, row.text))
        held += len(row.text)
    if block:
        yield block


def leaks(docs: DataFrame, items: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every pair of document and contained item; columns LEAKS. ``first_word`` and ``last_word`` span the matches."""
    spark = docs.sparkSession
    schema = arrow_schema(LEAKS)
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    out = spark.createDataFrame([], LEAKS)
    for block in blocks_of(items, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = ContainmentIndex(shared.value, size, threshold)
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                    rows += [(doc_id, *x) for x in index.find(text.decode("utf-8", "replace"))]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

        out = out.unionByName(source.mapInArrow(run, LEAKS))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of ``docs`` that hold no item; each block of items passes over what the one before kept."""
    columns = docs.columns
    out = docs
    for block in blocks_of(items, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = ContainmentIndex(shared.value, size, threshold)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                clean = pa.array([not (t and index.find(t)) for t in texts], pa.bool_())
                yield batch.filter(clean)

        out = out.mapInArrow(run, out.schema)
    return out.select(*columns)
