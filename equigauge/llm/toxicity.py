"""Toxicity: Levenshtein automata over a lexicon trie, and context windows around the hits.

The lexicon holds a few hand-written terms and what the labels teach: words and
word stems (written with a star at the end) that stand in toxic documents and
hardly in others. A word of the text hits a term if the Levenshtein automaton of
the word's letters, run against the trie of all terms, ends at a term within the
edits that its length allows, the first letter like any other. The product of trie
and automaton is made into a deterministic one state by state, as words need it.
Words joined by marks without a space ("id!ot") that hit nothing on their own are
also looked up together, the marks as letters.

Every hit gets a weight from the window of words around it: less between
quotation marks, after verbs of reporting or after a negation, more next to a
second person. The sums for abuse and for quotation, spelling, density and
variety go into a logistic model.

Lexicon and model are fitted on at most ``SAMPLE`` labelled documents that are not
held out (smallest hash of doc_id); scoring reads every whole text and nothing
but the text. Defined results: a null text is empty; texts without a hit all get
the same low score. Without labels of both kinds a fixed model over the
hand-written terms is used. Labels that are null or belong to no document are
ignored. Rows with the same doc_id are scored each on its own.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equigauge.llm.common import arrow_schema, text_bytes
from equigauge.session import materialize

SAMPLE = 20_000
MAX_TERMS = 3000
LEAST_DOCS = 3
SEED_TERMS = (
    "idiot idiots moron morons imbecile stupid dumbass scum scumbag trash worthless pathetic loser losers "
    "disgusting vermin filth clown degenerate retard bastard asshole"
).split()
REPORTING = set("said says wrote writes called calls quote quoted quotes according reported claims claimed term word".split())
NEGATION = set("not never no isn't wasn't don't cannot without".split())
SECOND_PERSON = set("you your yours youre yourself u ur".split())
QUOTES = "\"“”«»„‟"
WINDOW = 6
WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)*")
#: Words with nothing but marks between them; quotation marks divide.
RUN = re.compile(rf"{WORD.pattern}(?:(?:[^\w\s{QUOTES}]|_)++{WORD.pattern})*")
LEET = str.maketrans("0134578", "oieastb")
SCORES = "doc_id bigint, score double, n_hits int, n_misspelled int"


def normal_word(word: str) -> str:
    """Letters for the digits that stand for them, if the word has letters as well."""
    if word.isalpha() or word.isdecimal():
        return word
    return word.translate(LEET)


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class LexiconAutomaton:
    """Trie of terms crossed with Levenshtein automata, determinised as needed.

    A state is the set of (trie node, edits so far) that the letters read may have
    reached, with the fewest edits per node. With ``fixed_first`` the first letter
    must be right. A stem accepts whatever follows it and takes no edits.
    """

    LIMIT = 200_000
    PAIRS = 2_000_000  # in all states together

    def __init__(self, terms: Iterable[str], fixed_first: bool = True):
        self.fixed_first = fixed_first
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.stem: list[bool] = [False]
        self.reach = [0]  # most edits that any term below allows
        for term in sorted(set(terms)):
            stem = term.endswith("*")
            word = term.rstrip("*")
            if not word:
                continue
            allowed = 0 if stem else edits_allowed(word)
            node = 0
            for c in word:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.stem.append(False)
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], allowed)
            if stem:
                self.stem[node] = True
            else:
                self.term[node] = word
        if not fixed_first:
            self.reach[0] = max(self.reach)
        self.letters = {c for kids in self.children for c in kids}
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = [()]
        self.ids: dict[tuple, int] = {(): 0}
        self.steps: list[dict[str, int]] = [{}]
        self.first: dict[str, int] = {}
        self.pairs = 0
        if not self.fixed_first:
            self.begin = self.state(self.closed({0: 0}), None)

    def state(self, reached: dict[int, int], stem: tuple | None) -> int:
        key = (stem, tuple(sorted(reached.items()))) if reached or stem else ()
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            self.pairs += len(reached)
        return self.ids[key]

    def closed(self, reached: dict[int, int]) -> dict[int, int]:
        """With the nodes that a missing letter leads to."""
        todo = list(reached.items())
        while todo:
            node, e = todo.pop()
            if e > reached[node]:
                continue
            for child in self.children[node].values():
                if e + 1 <= self.reach[child] and e + 1 < reached.get(child, 9):
                    reached[child] = e + 1
                    todo.append((child, e + 1))
        return reached

    def advance(self, key: tuple, c: str) -> int:
        stem, nodes = key
        reached: dict[int, int] = {}
        for node, e in nodes:
            if e + 1 <= self.reach[node]:  # a letter too many
                reached[node] = min(reached.get(node, 9), e + 1)
            for letter, child in self.children[node].items():
                cost = e + (letter != c)
                if cost <= self.reach[child]:
                    reached[child] = min(reached.get(child, 9), cost)
                    if self.stem[child] and cost == 0:
                        stem = stem or (child,)
        # an exact path stays, whatever edits lie below it
        return self.state(self.closed(reached), stem)

    def start(self, c: str) -> int:
        child = self.children[0].get(c)
        if child is None:
            return 0
        return self.state(self.closed({child: 0}), (child,) if self.stem[child] else None)

    def lookup(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its edits; of equally near ones the first in order."""
        if not word:
            return None
        if len(self.states) > self.LIMIT or self.pairs > self.PAIRS:
            self.reset()
        if self.fixed_first:
            at = self.first.get(word[0])
            if at is None:
                at = self.first[word[0]] = self.start(word[0])
            word = word[1:]
        else:
            at = self.begin
        steps, letters = self.steps, self.letters
        for c in word:
            if not at:
                return None
            c = c if c in letters else ""
            to = steps[at].get(c)
            if to is None:
                to = steps[at][c] = self.advance(self.states[at], c)
            at = to
        if not at:
            return None
        stem, nodes = self.states[at]
        ends = [(e, self.term[n]) for n, e in nodes if self.term[n] and e <= edits_allowed(self.term[n])]
        if ends and min(ends)[0] == 0:
            return min(ends)[1], 0
        if stem:
            return f"{self.path(stem[0])}*", 0
        return (min(ends)[1], min(ends)[0]) if ends else None

    def path(self, node: int) -> str:
        if not hasattr(self, "names"):
            self.names = {0: ""}
            for parent, kids in enumerate(self.children):
                for c, child in kids.items():
                    self.names[child] = self.names[parent] + c
        return self.names[node]


@dataclass
class ToxicityModel:
    """What scoring needs: bounded, whatever the corpus."""

    terms: list[str]
    harmless: frozenset[str] = frozenset()  # correct words that look like misspelled terms
    weights: np.ndarray = field(default_factory=lambda: np.array([-4.0, 4.0, 0.5, 1.0, 2.0, 1.0]))

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = self.weights[0] + features @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Scanner:
    """Finds hits; remembers words for a while."""

    def __init__(self, terms: list[str], harmless: Iterable[str] = (), limit: int = 1 << 18):
        self.automaton = LexiconAutomaton(terms, fixed_first=False)
        self.most_edits = max(self.automaton.reach)
        self.longest = max(map(len, terms), default=0) + self.most_edits
        self.harmless = set(harmless)
        self.known: dict[str, tuple[str, int] | None] = {}
        self.limit = limit

    def hit(self, word: str) -> tuple[str, int] | None:
        if word in self.known:
            return self.known[word]
        if len(self.known) >= self.limit:
            self.known.clear()
        found = None if word in self.harmless else self.automaton.lookup(normal_word(word))
        self.known[word] = found
        return found

    def hits(self, words: list[str]) -> dict[str, tuple[str, int]]:
        return {w: found for w in set(words) if (found := self.hit(w))}

    def joined(self, run: str) -> list[tuple[int, str, tuple[str, int]]]:
        """Hits of neighbouring words of a run together: number of the first word, text, hit. Words with a hit of their own stay apart."""
        pieces = list(WORD.finditer(run))
        free = [not self.hit(m[0]) for m in pieces]
        out, at = [], 0
        while at < len(pieces):
            best, marks = None, 0
            for to in range(at + 1, len(pieces)):
                marks += sum(c not in self.automaton.letters for c in run[pieces[to - 1].end() : pieces[to].start()])
                text = run[pieces[at].start() : pieces[to].end()]
                if not (free[at] and free[to]) or marks > self.most_edits or len(text) > self.longest:
                    break
                found = self.hit(text)
                if found and (best is None or found[1] < best[2][1]):
                    best = to, text, found
            if best:
                out.append((at, *best[1:]))
                at = best[0]
            at += 1
        return out

    def find(self, lowered: str) -> tuple[list[str], dict[int, tuple[str, tuple[str, int]]]]:
        """The words of a text; by number of the (first) word, what hits and the hit."""
        words, joined = [], {}
        for run in RUN.findall(lowered):
            if run.isalnum():
                words.append(run)
                continue
            pieces = WORD.findall(run)
            if len(pieces) > 1:
                joined |= {len(words) + at: (text, found) for at, text, found in self.joined(run)}
            words += pieces
        hits = self.hits(words)
        found = {at: (w, hits[w]) for at, w in enumerate(words) if w in hits} if hits else {}
        return words, found | joined

    def features(self, text: str) -> tuple[list[float], int, int]:
        """Abuse sum, quotation sum, misspelled hits, density, variety (logarithms but for density); hits."""
        lowered = text.lower()
        words, found = self.find(lowered)
        if not found:
            return [0.0] * 5, 0, 0
        abuse = quotation = 0.0
        n = misspelled = 0
        quoted = quoted_words(lowered) if any(q in lowered for q in QUOTES) else ()
        for at in sorted(found):
            n += 1
            edits = found[at][1][1]
            misspelled += edits > 0
            strength = 1.0 / (1 + edits)
            window = words[max(0, at - WINDOW) : at + WINDOW + 1]
            before = words[max(0, at - WINDOW) : at]
            near = any(w in SECOND_PERSON for w in window)
            distance = (at in quoted) + 0.5 * any(w in REPORTING for w in before) + 0.5 * any(w in NEGATION for w in before[-2:])
            share = min(1.0, distance) * (0.5 if near else 1.0)
            quotation += strength * share
            abuse += strength * (1 - share) * (1.5 if near else 1.0)
        variety = len({t for _, (t, _) in found.values()})
        features = [math.log1p(abuse), math.log1p(quotation), math.log1p(misspelled), min(1.0, 20 * n / len(words)), math.log1p(variety)]
        return features, n, misspelled


def quoted_words(text: str) -> set[int]:
    """Numbers of the words between a pair of quotation marks in one line."""
    out, number = set(), 0
    for line in text.split("\n"):
        pieces = re.split(f"[{QUOTES}]", line)
        for k, piece in enumerate(pieces):
            n = len(WORD.findall(piece))
            if k % 2 and k < len(pieces) - 1:
                out.update(range(number, number + n))
            number += n
    return out


def held_out() -> Column:
    """Rows never learned from: crc32 of doc_id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def keys_of(words: set[str]) -> set[str]:
    """Words and their stems, as lexicon entries."""
    keys = {w for w in words if 3 <= len(w) <= 40}
    for size in (4, 5, 6):
        keys |= {w[:size] + "*" for w in words if len(w) > size}
    return keys


def training_table(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` labelled rows that are not held out: doc_id, label, text; one per id, and equal texts once per label.

    What is learned from them (entries, look-alikes, weights) is bounded by their number and nothing else.
    """
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("label")).dropna()
    usable = usable.where(~held_out()).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumnRenamed("doc_id", "labelled_id")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id")).select("doc_id", "label", "text")
    rows = rows.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("own"))
    rows = rows.select("doc_id", "label", "own.text")
    rows = rows.groupBy("label", F.xxhash64("text").alias("h"), F.length("text").alias("size")).agg(
        F.min("doc_id").alias("doc_id"), F.first("text").alias("text")
    )
    return materialize(rows.select("doc_id", "label", "text"), "toxicity-sample")


def count_keys(rows: DataFrame, wanted: set[str] | None, scanner_terms: list[str] | None = None) -> DataFrame:
    """Documents per key: key, n. Keys are entries, or with terms the misspelled words that hit one."""
    shared = rows.sparkSession.sparkContext.broadcast((wanted, scanner_terms))
    schema = arrow_schema("key string, n bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, terms = shared.value
        scanner = Scanner(terms) if terms else None
        for batch in batches:
            counts: Counter[str] = Counter()
            for raw in batch["text"].to_pylist():
                lowered = raw.decode("utf-8", "replace").lower()
                if scanner:
                    counts.update({w for w, (_, e) in scanner.find(lowered)[1].values() if e})
                else:
                    keys = keys_of(set(WORD.findall(lowered)))
                    counts.update(keys if wanted is None else keys & wanted)
            yield pa.RecordBatch.from_pydict({"key": list(counts), "n": list(counts.values())}, schema=schema)

    return rows.select("text").mapInArrow(run, "key string, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def learn_terms(rows: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """Entries that mark toxic documents, the strongest first.

    At most MAX_TERMS of them have no shorter stem among the others. Words that a
    chosen stem covers stand beside it and take edits, which the stem does not.
    """
    toxic = count_keys(rows.where("label = 1"), None).where(F.col("n") >= LEAST_DOCS)
    common = {r.key: r.n for r in toxic.toLocalIterator()}
    clean = {r.key: r.n for r in count_keys(rows.where("label = 0"), set(common)).toLocalIterator()}
    # a stem that stands for one word only is left to that word
    of_stem: dict[str, int] = {}
    for key, t in common.items():
        if not key.endswith("*"):
            for size in (4, 5, 6):
                of_stem[key[:size] + "*"] = max(of_stem.get(key[:size] + "*", 0), t)
    # the more candidates, the more of them stand in toxic documents only by chance
    least = math.log(len(common) + 1)
    scored = []
    for key, t in common.items():
        c = clean.get(key, 0)
        odds = math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))
        surprise = t * math.log((n_toxic + n_clean) / n_toxic)
        if t >= 20 * c and odds > 2 and surprise > least and of_stem.get(key, 0) < 0.9 * t:
            scored.append((-t * odds, key))
    chosen: dict[str, None] = {}
    uncovered = 0
    for _, key in sorted(scored):
        covered = any(key[:k] + "*" in chosen for k in (4, 5, 6) if key[:k] + "*" != key)
        if not covered or not key.endswith("*"):
            chosen[key] = None
        uncovered += not covered
        if uncovered == MAX_TERMS:
            break
    return list(chosen)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 100) -> np.ndarray:
    """Weights, the constant first, by Newton's method; the constant is not held down."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    hold = np.diag([1e-6, *[ridge * len(x) / 100] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + hold @ w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + hold
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    rows = training_table(docs, labels, sample)
    n = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return ToxicityModel(list(SEED_TERMS))
    terms = sorted({*SEED_TERMS, *learn_terms(rows, n[1], n[0])})
    look_alikes = count_keys(rows.where("label = 0"), None, terms).where("n >= 2")
    toxic_alikes = {r.key: r.n for r in count_keys(rows.where("label = 1"), None, terms).toLocalIterator()}
    harmless = frozenset(r.key for r in look_alikes.toLocalIterator() if r.n > toxic_alikes.get(r.key, 0))
    model = ToxicityModel(terms, harmless)
    found = scan(rows, model, "label").toArrow()
    x = np.asarray(found["features"].to_pylist(), dtype=np.float64)
    y = found["label"].to_numpy().astype(np.float64)
    order = np.lexsort((*x.T, y))
    model.weights = fit_logistic(x[order], y[order])
    return model


def scan(docs: DataFrame, model: ToxicityModel, *carried: str) -> DataFrame:
    """Features of the hits: the carried columns, features, n_hits, n_misspelled."""
    fields = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in carried)
    fields += ", features array<double>, n_hits int, n_misspelled int"
    schema = arrow_schema(fields)
    shared = docs.sparkSession.sparkContext.broadcast((model.terms, model.harmless))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(*shared.value)
        for batch in batches:
            found = [scanner.features(t.decode("utf-8", "replace")) for t in batch["text"].to_pylist()]
            columns = [batch[c] for c in carried]
            columns += [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), list(schema)[-3:], strict=True)] if found else [pa.array([], f.type) for f in list(schema)[-3:]]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.select(*carried, F.col("text")).mapInArrow(run, fields)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score, n_hits, n_misspelled of every document."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    found = scan(source, model, "doc_id")
    z = F.lit(float(model.weights[0]))
    for k, w in enumerate(model.weights[1:]):
        z = z + F.col("features")[k] * float(w)
    z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))
    return found.select("doc_id", (1 / (1 + F.exp(-z))).alias("score"), "n_hits", "n_misspelled")


def keep_clean(docs: DataFrame, model: ToxicityModel, cut: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score below the cut."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scanner = Scanner(model.terms, model.harmless)
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            scores = model.scores(np.asarray([scanner.features(t or "")[0] for t in texts]))
            yield batch.filter(pa.array(scores < cut))

    return docs.mapInArrow(run, docs.schema)
