"""Secret scans with an incremental blob ledger.

A version of a file is named by the SHA-256 of its text, its blob. The ledger is a
folder of Parquet runs; a row says which rules, each with its version, have read
a blob and what they found. A scan

1. names the blobs of all versions and looks up which (blob, rule version) pairs
   the ledger lacks; only names are shuffled for that,
2. reads one text of every blob that lacks some, with just those rules,
3. appends the run to the ledger, and
4. joins the findings back to every version that holds the blob.

A row of the ledger is complete in itself, so a lost executor or a run that ends
half-way leaves nothing to undo: what was written counts, the rest is scanned
next time. Two runs that scan the same blob write the same findings twice, and
reading the ledger takes them once. Raising a rule's version lets only that
rule read everything anew; findings of its older versions are no longer shown.

Defined results: a null text is an empty one; versions without a key are kept;
equal rows stay separate rows; an empty table gives no rows; columns besides key
and text are not read, so their names cannot clash.

Rules run on bytes with one byte per code point ('?' for those beyond ASCII, which
no rule accepts), so places are code points; whole texts are read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.llm.common import text_bytes
from equigauge.session import materialize, new_path

LEDGER = "blob binary, rules array<string>, spans array<struct<rule:string,start:int,end:int>>"
SPANS_ARROW = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
LEDGER_ARROW = pa.schema([("blob", pa.binary()), ("rules", pa.list_(pa.string())), ("spans", SPANS_ARROW)])


@dataclass(frozen=True)
class Rule:
    """A kind of secret.

    The pattern is searched only in texts that hold one of ``keywords`` (lower
    case) or, if ``run`` is given, ``least`` of its characters in a row. A match
    counts if its ``group`` has ``least`` characters or more.
    """

    kind: str
    version: int
    pattern: bytes
    keywords: tuple[bytes, ...] = ()
    run: bytes = b""
    group: int = 0
    least: int = 0
    any_case: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


HEX = b"0123456789abcdef"

#: The kinds that the contract fixes (fixed values).
BASE = (
    Rule(
        "assign",
        1,
        rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        (b"passw", b"secret", b"token", b"api"),
        group=2,
        least=6,
        any_case=True,
    ),
    Rule("access", 1, rb"AKIA[A-Z0-9]+", (b"akia",), least=20),
    Rule("hex", 1, rb"[0-9a-f]+", run=HEX, least=24),
)

MORE = (
    Rule(
        "private_key",
        1,
        rb"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----(?:[A-Za-z0-9+/=:,.\s-]*?-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----)?",
        (b"private key-----",),
    ),
    Rule("jwt", 1, rb"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*", (b"eyj",)),
    Rule("code_host", 1, rb"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_-]{20,})", (b"gh", b"glpat-")),
    Rule("chat_token", 1, rb"\bxox[abeoprs]-[A-Za-z0-9-]{10,}", (b"xox",)),
    Rule("chat_hook", 1, rb"https://hooks\.slack\.com/services/[A-Za-z0-9/]{20,}", (b"hooks.slack.com",)),
    Rule("api_key", 1, rb"\bAIza[A-Za-z0-9_-]{35}", (b"aiza",)),
    Rule("payment", 1, rb"\b[rs]k_(?:live|test)_[A-Za-z0-9]{16,}", (b"k_live_", b"k_test_")),
    Rule("mail_key", 1, rb"\bSG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}", (b"sg.",)),
    Rule("package_token", 1, rb"\b(?:npm_[A-Za-z0-9]{36}|pypi-[A-Za-z0-9_-]{50,})", (b"npm_", b"pypi-")),
    Rule("url_login", 1, rb"\b[A-Za-z][A-Za-z0-9+.-]{1,30}://[^\s:/@?#\"'<>]+:[^\s/@?#\"'<>]{3,}@", (b"://",)),
    Rule("bearer", 1, rb"\bbearer\x20+([A-Za-z0-9._~+/-]{16,}=*)", (b"bearer",), any_case=True),
)

RULES = BASE + MORE


class Scanner:
    """Compiled rules by name."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = {r.name: (r, re.compile(r.pattern, re.IGNORECASE if r.any_case else 0)) for r in rules}
        self.runs = {r.run: bytes.maketrans(bytes(range(256)), bytes(ord("x") if b in r.run else ord(" ") for b in range(256))) for r in rules}

    def spans(self, text: str, names: Sequence[str]) -> list[dict]:
        raw = text.encode("ascii", "replace")
        low = raw.lower()
        out = []
        for name in names:
            rule, pattern = self.rules[name]
            if rule.run:
                if b"x" * rule.least not in raw.translate(self.runs[rule.run]):
                    continue
            elif not any(k in low for k in rule.keywords):
                continue
            for m in pattern.finditer(raw):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    out.append({"rule": name, "start": m.start(), "end": m.end()})
        return out


def scanned(rules: Sequence[Rule]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        last, spans = None, []
        for batch in batches:
            blobs, texts, todo = (batch.column(k).to_pylist() for k in range(3))
            found = []
            for blob, text, names in zip(blobs, texts, todo, strict=True):
                if blob != last:  # equal rows come one after another
                    last, spans = blob, scanner.spans(text or "", names)
                found.append(spans)
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(found, SPANS_ARROW)], schema=LEDGER_ARROW)

    return scan


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """blob, rules, spans of all runs; no rows if there was none."""
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path).select("blob", "rules", "spans")


def by_blob(ledger: DataFrame) -> DataFrame:
    """One row per blob: what has been read and found. Equal rows of a blob melt before the shuffle."""
    both = ledger.groupBy("blob").agg(F.collect_set("rules").alias("rules"), F.collect_set("spans").alias("spans"))
    return both.select("blob", F.array_distinct(F.flatten("rules")).alias("rules"), F.array_distinct(F.flatten("spans")).alias("spans"))


def blob_of(text: str = "text") -> Column:
    return F.unhex(F.sha2(text_bytes(text), 256))


def versions_of(table: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, blob of every version."""
    return table.select(F.col(key).alias("key"), blob_of(text).alias("blob"))


def unseen(versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """blob, holder, todo: names of rules that have not read the blob, and the smallest key that holds it."""
    wanted = F.array(*[F.lit(r.name) for r in rules])
    blobs = versions.groupBy("blob").agg(F.min(F.coalesce(F.col("key").cast("string"), F.lit(""))).alias("holder"))
    seen = by_blob(ledger).select("blob", "rules")
    todo = F.array_except(wanted, F.coalesce("rules", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "holder", todo.alias("todo")).where(F.size("todo") > 0)


def scan(table: DataFrame, path: str, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scan what the ledger at ``path`` lacks and append it there. Returns key, blob of all versions, written once."""
    spark = table.sparkSession
    versions = materialize(versions_of(table, key, text), "versions")
    todo = unseen(versions, read_ledger(spark, path), rules)
    texts = table.select(
        blob_of(text).alias("blob"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("holder"), F.coalesce(text, F.lit("")).alias("text")
    )
    run = texts.join(todo, ["blob", "holder"]).select("blob", "text", "todo").mapInArrow(scanned(rules), LEDGER)
    run.write.parquet(f"{path}/run={uuid.uuid4().hex}")
    return versions


def findings(versions: DataFrame, path: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """key, blob, spans (kind, start, end by start, then rule order) of every version, by the rules' present versions."""
    order = F.create_map(*[x for n, r in enumerate(rules) for x in (F.lit(r.name), F.struct(F.lit(n).alias("place"), F.lit(r.kind).alias("kind")))])
    found = by_blob(read_ledger(versions.sparkSession, path).where(F.size("spans") > 0)).select("blob", "spans")
    known = F.filter("spans", lambda s: s["rule"].isin([r.name for r in rules]))
    sortable = F.transform(
        known, lambda s: F.struct(s["start"].alias("start"), order[s["rule"]]["place"].alias("place"), order[s["rule"]]["kind"].alias("kind"), s["end"].alias("end"))
    )
    spans = F.transform(F.array_sort(sortable), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    joined = versions.join(found.select("blob", spans.alias("spans")), "blob", "left")
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return joined.select("key", "blob", F.coalesce("spans", none).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(table: DataFrame, path: str | None = None, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scan with the ledger at ``path`` (a new one if none is given) and give the findings of all versions."""
    path = path or new_path(table.sparkSession, "secret-ledger")
    return findings(scan(table, path, rules, key, text), path, rules)


def of_kinds(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, SHA-256 of the base spans, all spans as text."""
    kinds = [r.kind for r in BASE]
    n = [F.size(of_kinds(k)).cast("bigint").alias(f"n_{k}") for k in kinds]
    base = of_kinds(*kinds)
    return found.select(
        F.col("key").alias("doc_id"), *n, F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )
