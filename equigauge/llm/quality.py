"""Quality rules: document statistics, base rules, and boosted trees over the statistics.

The trees are fitted on at most ``SAMPLE`` labelled documents, chosen by the
smallest hash of their doc_id; everything else reads all documents. Features that
can only speak against a text are constrained to lower its score. A fifth of the
sample is held back to set the cut: between ``LEAST_CUT`` and ``CUT``, the score
with the smallest balanced error, so that a few wrong labels cannot switch the
trees off.

Words are runs of anything but ASCII white space. Defined results: a null or
empty text has all counts zero and fails the base rules (too few words). Without
labels of both kinds there are no trees and the base rules alone decide. Rows
with the same doc_id are judged each on its own; labels that are null or belong
to no document are ignored, and of several labels of a document the best counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.llm import boosting
from equigauge.llm.common import arrow_schema, text_bytes

SAMPLE = 20_000
LEAST_CUT = 0.05
CUT = 0.3
GOOD_WEIGHT = 2.0
SYMBOLS = [b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"]
SPACES = [b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = {
    # name: 1 or -1 if the score may only rise or fall with it
    "log_words": 0,
    "mean_word": 0,
    "symbol_share": -1,
    "pipe_share": -1,
    "exclamation_share": -1,
    "upper_share": -1,
    "digit_share": 0,
    "dup_line_share": -1,
    "repeat_share": -1,
    "distinct_share": 0,
    "top_word_share": -1,
    "mark_share": 0,
    "mean_line": 0,
    "short_lines": 0,
}
SIGNS = list(FEATURES.values())
SCORES = ", ".join(["doc_id bigint", *[f"{c} bigint" for c in COUNTS], "base_failed boolean", "score double", "kept boolean"])
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
MARKS = b".,;:?"
CONTINUATION = bytes(range(0x80, 0xC0))


def n_repeated(numbers: np.ndarray, distinct: int) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(numbers) < 4:
        return 0
    pair = numbers[:-2] * distinct + numbers[1:-1]
    if distinct >= 1 << 21:  # keep the product below 2**63
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    windows = pair * distinct + numbers[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(windows), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(numbers), bool)
    for k in range(3):
        covered[k : k + len(windows)] |= again
    return int(covered.sum())


def statistics(raw: bytes) -> tuple[list[int], list[float]]:
    """Counts of the base rules, and the features, of one text."""
    words = raw.split()
    n = len(words)
    index: dict[bytes, int] = {}
    numbers = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    size = len(raw)
    # continuation bytes are no code points of their own
    word_chars = len(raw.translate(None, CONTINUATION)) - sum(map(raw.count, SPACES))
    symbols = sum(map(raw.count, SYMBOLS))
    seen: set[bytes] = set()
    dup = lines = short = 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            short += len(line) < 30
            dup += line in seen
            seen.add(line)
    repeated = n_repeated(numbers, len(index))
    letters = max(1, word_chars)
    features = [
        float(np.log1p(n)),
        word_chars / max(1, n),
        symbols / letters,
        raw.count(b"|") / max(1, n),
        raw.count(b"!") / max(1, n),
        (size - len(raw.translate(None, UPPER))) / letters,
        (size - len(raw.translate(None, DIGITS))) / letters,
        dup / max(1, lines),
        repeated / max(1, n),
        len(index) / max(1, n),
        float(np.bincount(numbers).max()) / n if n else 0.0,
        (size - len(raw.translate(None, MARKS))) / max(1, n),
        n / max(1, lines),
        short / max(1, lines),
    ]
    return [n, word_chars, symbols, dup, repeated], features


def base_failed(counts: list[int]) -> bool:
    n, repeated = counts[0], counts[4]
    return n < 50 or 100 * repeated > 50 * n


@dataclass(frozen=True)
class QualityModel:
    trees: boosting.FlatTrees | None
    cut: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.trees.probability(features) if self.trees else np.ones(len(features))


def labelled_texts(docs: DataFrame, labels: DataFrame, column: str, sample: int) -> DataFrame:
    """Documents of at most ``sample`` labelled ids: doc_id, label, text as bytes. An id may have several."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    best = usable.groupBy(F.col("doc_id").cast("bigint").alias("labelled_id")).agg(F.max(column).cast("int").alias("label"))
    chosen = best.orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    # the sample is bounded by its limit
    return texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id")).select("doc_id", "label", "text")


def chosen_cut(scores: np.ndarray, good: np.ndarray, least: float = LEAST_CUT, most: float = CUT, good_weight: float = GOOD_WEIGHT) -> float:
    """The cut between ``least`` and ``most`` with the smallest balanced error on labelled scores.

    Balanced error: the share of junk that stays, plus ``good_weight`` times the
    share of good rows that go. Both are shares, so a few wrong labels on either
    side move every cut's error alike. Among equals the middle one counts.
    """
    tried = np.unique(np.concatenate([[least, most], scores[(scores > least) & (scores < most)]]))
    kept_junk, kept_good = np.sort(scores[~good]), np.sort(scores[good])
    stays = 1 - np.searchsorted(kept_junk, tried) / max(1, len(kept_junk))
    goes = np.searchsorted(kept_good, tried) / max(1, len(kept_good))
    error = stays + good_weight * goes
    best = tried[error <= error.min() + 1e-12]
    return float(best[(len(best) - 1) // 2])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float = CUT) -> QualityModel:
    """Fit trees for ``labels.quality`` on a bounded sample."""
    names = [f"f{k}" for k in range(len(FEATURES))]
    fields = "doc_id bigint, label int, " + ", ".join(f"{n} double" for n in names)
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t)[1] for t in batch["text"].to_pylist()]
            columns = [pa.array(c, pa.float64()) for c in zip(*found, strict=True)] if found else [pa.array([], pa.float64())] * len(names)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], *columns], schema=schema)

    found = labelled_texts(docs, labels, "quality", sample).mapInArrow(run, fields)
    # one row per id, so that what comes to the driver is bounded even if an id is repeated
    rows = found.groupBy("doc_id").agg(F.min(F.struct("label", *names)).alias("row")).select("doc_id", "row.*").toArrow()
    y = rows["label"].to_numpy().astype(np.float64)
    if len(np.unique(y)) < 2:
        return QualityModel(None, 0.0)
    # rows come in any order; a fixed one makes the same model every time
    x = np.stack([rows[n].to_numpy() for n in names], axis=1)
    order = np.lexsort((*x.T, rows["doc_id"].to_numpy()))
    x, y = x[order], y[order]
    held = np.arange(len(y)) % 5 == 0
    if len(np.unique(y[~held])) < 2:
        return QualityModel(None, 0.0)
    trees = boosting.fit(x[~held], y[~held], SIGNS)
    if len(np.unique(y[held])) < 2:
        return QualityModel(trees, cut)
    return QualityModel(trees, chosen_cut(trees.probability(x[held]), y[held] == 1, most=cut))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Counts, base verdict, score and final verdict of every document."""
    schema = arrow_schema(SCORES)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [statistics(t) for t in batch["text"].to_pylist()]
            scores = shared.value.scores(np.asarray([f for _, f in found]))
            failed = np.asarray([base_failed(c) for c, _ in found])
            counts = [pa.array(c, pa.int64()) for c in zip(*(c for c, _ in found), strict=True)]
            kept = ~failed & (scores >= shared.value.cut)
            columns = [batch["doc_id"], *counts, pa.array(failed), pa.array(scores), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    return source.mapInArrow(run, SCORES)


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Rows of ``docs`` that the base rules and the model keep."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            found = [statistics((t or "").encode()) for t in texts]
            scores = shared.value.scores(np.asarray([f for _, f in found]))
            failed = np.asarray([base_failed(c) for c, _ in found])
            yield batch.filter(pa.array(~failed & (scores >= shared.value.cut)))

    return docs.mapInArrow(run, docs.schema)
