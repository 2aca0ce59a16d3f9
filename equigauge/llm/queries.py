"""The registered queries of the corpus operators, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.llm import align, blob_ledger, chat, decontam, licenses, packing, quality, sharding, simhash, spelling, token_files, toxicity, urls
from equigauge.llm.common import prepare_session, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_session(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op2_sharding")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


@query(
    "op3_chat_tool_calls",
    """
    with calls as (select conv_id, turn, text, count(*) as call_rows, turn - 2 * row_number() over (partition by conv_id order by turn) as island
                   from conversations where role = 'user' group by conv_id, turn, text),
    ranked as (select *, row_number() over (partition by conv_id, island order by turn) - 1 as depth from calls),
    answers as (select conv_id, turn, text, count(*) as result_rows from conversations where role = 'assistant' group by conv_id, turn, text),
    linked as (select coalesce(c.conv_id, a.conv_id) as conv_id, c.turn as place, a.turn as result_place, c.depth, c.text, a.text as answer,
                 coalesce(c.turn, a.turn - 1) as id_turn, call_rows, result_rows
               from ranked c full join answers a on c.conv_id = a.conv_id and a.turn = c.turn + 1)
    select conv_id || ':' || id_turn as call_id, cast(place as bigint) as place, cast(result_place as bigint) as result_place,
      case when place is not null then 'reply' end as name,
      case when place >= 2 then conv_id || ':' || (place - 2) end as parent_id,
      depth,
      case when place is null then 'orphan' when result_place is null then 'unanswered' else 'linked' end as status,
      call_rows, result_rows,
      case when place is not null and length(text) < 1 then 'arguments.prompt: shorter than 1'
           when place is not null and length(text) > 1000 then 'arguments.prompt: longer than 1000' end as errors,
      case when place is null then '{"id":"' || conv_id || ':' || id_turn || '","result":' || cast(to_json(answer) as varchar) || '}'
           else '{"arguments":{"prompt":' || cast(to_json(text) as varchar) || ',"turn":' || place || '},"id":"' || conv_id || ':' || id_turn
                || '","name":"reply","result":' || coalesce(cast(to_json(answer) as varchar), 'null') || '}' end as record
    from linked
    union all
    select conv_id || ':' || turn, cast(turn as bigint), null, null, null, null,
      case when role in ('system', 'tool') then role when role is null then 'no_role' else 'other_role' end, null, null, null,
      '{"content":' || coalesce(cast(to_json(text) as varchar), 'null') || ',"id":"' || conv_id || ':' || turn
        || '","role":' || coalesce(cast(to_json(role) as varchar), 'null') || ',"turn":' || turn || '}'
    from conversations where role is null or role not in ('user', 'assistant')
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.all_turns(table(spark, sf_dir, "conversations"))


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


DECONTAM_SQL = r"""
    with item_words as (select item_id, regexp_extract_all(lower(coalesce(text, '')), '[\pL\pN]+') as w from benchmark),
    item_shingles as (
      select distinct item_id, least(len(w), 5) as k, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') as s
      from (select item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from item_words where len(w) > 0)),
    sizes as (select item_id, k, count(*) as n_shingles from item_shingles group by item_id, k),
    doc_words as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\pL\pN]+') as w from documents),
    doc_shingles as (
      select doc_id, i - 1 as pos, k, array_to_string(w[i : i + k - 1], ' ') as s
      from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from doc_words, (select distinct k from sizes) where len(w) >= k)),
    hits as (select doc_id, item_id, count(distinct d.s) as n_found, min(pos) as first_word, max(pos) + min(d.k) - 1 as last_word
             from doc_shingles d join item_shingles i on d.s = i.s and d.k = i.k group by doc_id, item_id)
    select doc_id, item_id, n_shingles, n_found, cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word
    from hits join sizes using (item_id) where 10 * n_found >= 8 * n_shingles
"""


@query("op5_benchmark_decontamination", DECONTAM_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("detections")


@query("op7_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query("op9_url_filter")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits", "n_misspelled"
    )


@query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


@query("op12_secret_scan")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blob_ledger.digest(blob_ledger.find_secrets(table(spark, sf_dir, "documents")))


@query("op13_cross_tokenizer")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.cross_tokenizer(table(spark, sf_dir, "documents"), a, b)


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
