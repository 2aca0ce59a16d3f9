"""Alignment of two tokenizers: which tokens of one stand where tokens of the other do.

Tokens of both cover the same bytes. Every token points to the token that
overlaps it and reaches farthest to the right: a token of A to the token of B that
holds its last byte, and the other way round; where both end together, B's points
to A's and A's to itself. Pointer jumping, all tokens at once, replaces each
pointer by its target's until none moves. A token then points to the last one of
its component, which names its group. Groups are therefore the texts between
places where tokens of both end. The number of rounds is the logarithm of the
longest group.

Counts of linked id pairs need two passes over what the tokenizers gave; each
text is tokenized once. Its links are written as sorted distinct pairs with their
numbers. Pair counts are summed per task and then by pair. Up to ``LOOKUP_ROWS``
of them are sent to all tasks; more are joined by shuffle.

Texts are taken in segments of bounded size, cut before a single space, where
both tokenizers begin a new token. Defined results: texts that are null, empty or
not given back by the tokens have no tokens; a null doc_id and repeated rows are
rows of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.llm.tokens import BYTE_CHARS, CUT, PieceEncoder
from equigauge.session import materialize

#: Pair counts sent to every task: three numbers each, 70 MB at most.
LOOKUP_ROWS = 4_000_000
SEGMENT = 1 << 20
PAIRS_AT_ONCE = 2_000_000
GENERATION = 1 << 18
LONGEST_KEPT = 64

ALIGNED = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs binary, times binary"
ALIGNED_ARROW = pa.schema(
    [
        *[(c, pa.int64()) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links")],
        ("groups_sha256", pa.string()),
        ("pairs", pa.binary()),
        ("times", pa.binary()),
    ]
)
PAIRS_ARROW = pa.schema([("row", pa.int64()), ("pair", pa.int64()), ("times", pa.int64())])
COUNTS_ARROW = pa.schema([("pair", pa.int64()), ("n", pa.int64())])
SHOWN = ("doc_id", "n_a", "n_b", "n_groups", "n_links")
SUMS_ARROW = pa.schema([*[(c, pa.int64()) for c in (*SHOWN, "n_best", "count_sum")], ("groups_sha256", pa.string())])
SUMS = f"{', '.join(f'{c} bigint' for c in (*SHOWN, 'n_best', 'count_sum'))}, groups_sha256 string"

# a run of spaces, or a line feed, begins a chunk; no piece holds a space behind another character, or a line feed
CHUNK = re.compile(r"(?: +|\n)[^ \n]*")


class ByteTokens(PieceEncoder):
    """Ids by a byte-level vocabulary; strings of special tokens are plain text."""

    def __init__(self, path: str):
        super().__init__(path, spaced=True)
        self.tokenizer.encode_special_tokens = True
        self.specials = []
        byte = {c: b for b, c in BYTE_CHARS.items()}
        vocab = self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()


class SpacedPieces:
    """Ids by a sentence-piece vocabulary that puts a space before the text, with a bounded memory of chunks."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.bytes = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
            raise ValueError("pieces hold a space inside or a line feed: chunks cannot be cut there")
        self.letter = len(self.model.encode("a"))
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, missing: set[str]) -> None:
        if len(self.young) + len(missing) > GENERATION:
            self.old, self.young = self.young, {}
        fresh = []
        for c in missing:
            if (known := self.old.get(c)) is not None:
                self.young[c] = known
            else:
                fresh.append(c)
        # the model adds a space itself: take it off a chunk, or off the ids
        blank = [not c.strip(" ") for c in fresh]
        asked = [f"a{c}" if b else c if c[0] == "\n" else c[1:] for c, b in zip(fresh, blank, strict=True)]
        for c, b, ids in zip(fresh, blank, self.model.encode(asked, num_threads=1), strict=True):
            self.young[c] = np.array(ids[self.letter if b else c[0] == "\n" :], "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that begin with the space that the model would add."""
        cut = [CHUNK.findall(t) for t in texts]
        needed = set(chain.from_iterable(cut))
        missing = needed.difference(self.young)
        if len(self.young) + len(missing) > GENERATION:
            missing = set(needed)
        self.learn(missing)
        out = [b"".join(map(self.young.__getitem__, c)) for c in cut]
        for c in missing:
            if len(c) > LONGEST_KEPT:
                del self.young[c]
        return out


@dataclass(frozen=True)
class Groups:
    """Group numbers of the tokens, in order and from 0, and all overlapping pairs as places of tokens."""

    a: np.ndarray
    b: np.ndarray
    linked_a: np.ndarray
    linked_b: np.ndarray


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> Groups:
    """Components of overlap between two coverings of the same bytes, by pointer jumping. ``ends``: rising, with the same last value."""
    n = len(ends_a)
    holds_a = np.searchsorted(ends_b, ends_a)  # the token of B with the last byte of each of A
    holds_b = np.searchsorted(ends_a, ends_b)
    own = np.arange(n)
    together = ends_b[holds_a] == ends_a if n else np.zeros(0, bool)
    to = np.concatenate([np.where(together, own, n + holds_a), holds_b])
    while not np.array_equal(further := to[to], to):
        to = further
    last = np.flatnonzero(to[:n] == own)
    group = np.searchsorted(last, to)
    starts_a = np.concatenate([[0], ends_a[:-1]])[:n]
    first = np.searchsorted(ends_b, starts_a, side="right")
    each = holds_a - first + 1
    linked_a = np.repeat(own, each)
    behind = np.arange(len(linked_a)) - np.repeat(np.cumsum(each) - each, each)
    return Groups(group[:n], group[n:], linked_a, np.repeat(first, each) + behind)


class Aligner:
    """Both tokenizers, and what is looked up by id."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), SpacedPieces(path_b)
        self.size_a, self.size_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        # an id with what follows it: another token of the side, or the end of the side's part of a group
        words_a, words_b = ([f"{i}" for i in range(len(t.bytes))] for t in (self.a, self.b))
        self.written = [*[f"{w}," for w in words_a], *[f"{w}|" for w in words_a], *[f"{w}," for w in words_b], *[f"{w};" for w in words_b]]

    def code(self, ids: np.ndarray, group: np.ndarray, second: bool) -> np.ndarray:
        ends = np.ones(len(ids), np.int64)
        ends[:-1] = group[1:] != group[:-1]
        width = len(self.b.bytes if second else self.a.bytes)
        return ids + ends * width + 2 * len(self.a.bytes) * second

    def segments(self, texts: list[str]) -> list["Segment | None"]:
        """What each segment holds; None where the tokens do not give it back."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        sides = []
        for encoder in (self.a, self.b):
            ids = [np.frombuffer(x, "<u4").astype(np.int64) for x in encoder.encode(texts)]
            sides.append((ids, [b"".join(map(encoder.bytes.__getitem__, i.tolist())) for i in ids]))
        (ids_a, back_a), (ids_b, back_b) = sides
        good = [k for k, r in enumerate(raw) if back_a[k] == r == back_b[k]]
        out: list[Segment | None] = [None] * len(texts)
        if not good:
            return out
        ids_a, ids_b = ([ids[k] for k in good] for ids in (ids_a, ids_b))
        all_a, all_b = np.concatenate(ids_a), np.concatenate(ids_b)
        upto_a, upto_b = (np.cumsum([0, *map(len, ids)]) for ids in (ids_a, ids_b))
        groups = align(np.cumsum(self.size_a[all_a]), np.cumsum(self.size_b[all_b]))
        # written in the order of groups, A's part first
        per_a, per_b = np.bincount(groups.a), np.bincount(groups.b)
        codes = np.empty(len(all_a) + len(all_b), np.int64)
        codes[np.arange(len(all_a)) + (np.cumsum(per_b) - per_b)[groups.a]] = self.code(all_a, groups.a, False)
        codes[np.arange(len(all_b)) + np.cumsum(per_a)[groups.b]] = self.code(all_b, groups.b, True)
        pairs = all_a[groups.linked_a] * len(self.b.bytes) + all_b[groups.linked_b]
        upto_links = np.searchsorted(groups.linked_a, upto_a)
        owner = np.repeat(np.arange(len(good)), np.diff(upto_links))
        space = len(self.a.bytes) * len(self.b.bytes)
        distinct, times = np.unique(pairs + owner * space, return_counts=True)
        upto_distinct = np.searchsorted(distinct, np.arange(len(good) + 1) * space)
        for n, k in enumerate(good):
            (a, a2), (b, b2), (p, p2) = ((upto[n], upto[n + 1]) for upto in (upto_a, upto_b, upto_distinct))
            out[k] = Segment(
                int(a2 - a),
                int(b2 - b),
                int(groups.a[a2 - 1] - groups.a[a] + 1),
                int(upto_links[n + 1] - upto_links[n]),
                "".join(map(self.written.__getitem__, codes[a + b : a2 + b2].tolist())),
                distinct[p:p2] - n * space,
                times[p:p2],
            )
        return out


@dataclass(frozen=True)
class Segment:
    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    written: str  # every group ends in ';'
    pairs: np.ndarray
    times: np.ndarray


def cut_text(text: str) -> list[str]:
    """Segments of a text after a space, cut before single spaces."""
    text = " " + text
    out, at = [], 0
    while len(text) - at > SEGMENT and (m := CUT.search(text, at + SEGMENT)):
        out.append(text[at : m.start()])
        at = m.start()
    return [*out, text[at:]]


def summary(parts: list[Segment | None]) -> tuple:
    """n_a, n_b, n_groups, n_links, groups_sha256, pairs, times of a text from its segments."""
    if not parts or any(p is None for p in parts):
        return 0, 0, 0, 0, "", b"", b""
    digest = hashlib.sha256()
    for k, p in enumerate(parts):
        digest.update((p.written if k < len(parts) - 1 else p.written[:-1]).encode())
    pairs, times = (np.concatenate(x) for x in ([p.pairs for p in parts], [p.times for p in parts]))
    numbers = [sum(getattr(p, f) for p in parts) for f in ("n_a", "n_b", "n_groups", "n_links")]
    return *numbers, digest.hexdigest(), pairs.astype("<i8").tobytes(), times.astype("<i8").tobytes()


ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per Python worker and pair of files."""
    if (path_a, path_b) not in ALIGNERS:
        ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return ALIGNERS[path_a, path_b]


def aligned(path_a: str, path_b: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            at = 0
            while at < len(texts):  # rows of about a segment's size at once
                cut, size, begin = [], 0, at
                while at < len(texts) and size < SEGMENT:
                    cut.append(cut_text(texts[at]) if texts[at] else [])
                    size += len(texts[at] or "")
                    at += 1
                found = iter(chain.from_iterable(both.segments(s) for s in portions(list(chain.from_iterable(cut)))))
                rows = [summary([next(found) for _ in c]) for c in cut]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ALIGNED_ARROW.types[2:], strict=True)]
                own = batch.slice(begin, at - begin)
                yield pa.record_batch([own.column(0), own.column(1), *columns], schema=ALIGNED_ARROW)

    return run


def portions(segments: list[str]) -> Iterator[list[str]]:
    """Segments in lists of bounded size."""
    some: list[str] = []
    size = 0
    for s in segments:
        some.append(s)
        size += len(s)
        if size >= SEGMENT:
            yield some
            some, size = [], 0
    if some:
        yield some


def align_texts(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document with its groups and links (``ALIGNED``), written once."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return materialize(rows.mapInArrow(aligned(path_a, path_b), ALIGNED), "aligned")


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pair, n of the task's documents, added up in portions of bounded size."""

    def add(waiting: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        pairs, times = (np.concatenate([w[k] for w in waiting]) for k in (0, 1))
        distinct, place = np.unique(pairs, return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, place, times)
        return distinct, total

    waiting, size = [], 0
    for batch in batches:
        for pairs, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            waiting.append((np.frombuffer(pairs, "<i8"), np.frombuffer(times, "<i8")))
            size += len(waiting[-1][0])
            if size >= PAIRS_AT_ONCE:
                waiting = [add(waiting)]
                size = len(waiting[0][0])
                if size >= PAIRS_AT_ONCE // 2:
                    yield pa.record_batch([pa.array(c) for c in waiting[0]], schema=COUNTS_ARROW)
                    waiting, size = [], 0
    if waiting:
        yield pa.record_batch([pa.array(c) for c in add(waiting)], schema=COUNTS_ARROW)


def pair_counts(found: DataFrame, width_b: int) -> DataFrame:
    """pair, n, best (whether no other pair with this id of B has more), written once. A pair is id of A times ``width_b``, plus id of B."""
    counts = found.select("pairs", "times").mapInArrow(summed, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "pair-counts")
    b = (F.col("pair") % width_b).alias("b")
    most = counts.groupBy(b).agg(F.max("n").alias("most"))  # a row per id of B
    return materialize(counts.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def looked_up(lookup) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = lookup.value
        for batch in batches:
            n_best, total = [], []
            for pairs, times in zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist(), strict=True):
                at = np.searchsorted(keys, np.frombuffer(pairs, "<i8"))
                times = np.frombuffer(times, "<i8")
                n_best.append(int(times @ best[at]))
                total.append(int(times @ counts[at]))
            columns = [*[batch.column(c) for c in SHOWN], pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), batch.column("groups_sha256")]
            yield pa.record_batch(columns, schema=SUMS_ARROW)

    return run


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, pairs, times in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            pairs, times = np.frombuffer(pairs, "<i8"), np.frombuffer(times, "<i8")
            yield pa.record_batch([pa.array(np.full(len(pairs), row)), pa.array(pairs), pa.array(times)], schema=PAIRS_ARROW)


def with_counts(found: DataFrame, counts: DataFrame, lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """Adds n_best and count_sum to every document."""
    if counts.count() <= lookup_rows:
        spark = found.sparkSession
        table = counts.toArrow()
        keys, n, best = (table.column(k).to_numpy() for k in range(3))
        order = np.argsort(keys)
        lookup = spark.sparkContext.broadcast((keys[order], n[order], best[order].astype(np.int64)))
        return found.select(*SHOWN, "groups_sha256", "pairs", "times").mapInArrow(looked_up(lookup), SUMS)
    links = found.select("row", "pairs", "times").mapInArrow(unpacked, "row bigint, pair bigint, times bigint").join(counts, "pair")
    sums = links.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    joined = found.select("row", *SHOWN, "groups_sha256").join(sums, "row", "left")
    return joined.select(*SHOWN, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_best", "count_sum")], "groups_sha256")


def cross_tokenizer(
    docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", lookup_rows: int = LOOKUP_ROWS
) -> DataFrame:
    """Groups, links and link counts of every document. ``path_a``: byte-level file; ``path_b``: sentence-piece file; both on every executor."""
    found = align_texts(docs, path_a, path_b, key, text)
    return with_counts(found, pair_counts(found, len(SpacedPieces(path_b).bytes)), lookup_rows)
