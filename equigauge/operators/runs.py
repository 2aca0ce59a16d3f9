"""Run log in long form: tags, parameters, metrics, versions and aliases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from urllib.parse import quote
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.sources.commits import FOLDER, CommitLog

SCHEMAS = {
    "versions": "model string, version int, run_id string, ts timestamp",
    "tags": "run_id string, model string, version int, key string, value string",
    "params": "run_id string, model string, version int, key string, value string",
    "metrics": "run_id string, model string, version int, key string, value double",
    "aliases": "model string, alias string, version int, ts timestamp",
}
#: what is stored per run, in a folder of the attempt that wrote it; the commits say which version that is
STORED = {
    "tags": "attempt string, key string, value string",
    "params": "attempt string, key string, value string",
    "metrics": "attempt string, key string, value double",
}
COMMIT = "model string, version int, run_id string, ts timestamp, attempt string"


def _read(reader, schema: str, path: str) -> DataFrame:
    try:
        return reader(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return SparkSession.active().createDataFrame([], schema)


def _commits(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark.read.schema(COMMIT).json, COMMIT, f"{path}/models/*/{FOLDER}/*.json")


def read_log(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One table of the run log; empty if nothing was logged yet.

    Rows of a run that was not committed are in no table.
    """
    if table == "aliases":
        return _read(spark.read.schema(SCHEMAS[table]).parquet, SCHEMAS[table], f"{path}/{table}")
    commits = _commits(spark, path)
    if table == "versions":
        return commits.select("model", "version", "run_id", "ts")
    rows = _read(spark.read.schema(STORED[table]).parquet, STORED[table], f"{path}/{table}")
    return rows.join(commits, "attempt").select("run_id", "model", "version", "key", "value")


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    model: str,
    ts: datetime,
    tags: Mapping[str, str],
    params: Mapping[str, object],
    metrics: DataFrame,
) -> int:
    """Append one run; ``metrics`` has (key, value). Returns the new version.

    Any number of writers may log at once: the rows are written first, and the
    commit that follows takes the model's next free version. A run that failed half
    way takes no number.
    """
    attempt = uuid4().hex

    def store(df: DataFrame, table: str) -> None:
        # a folder of its own: two jobs that write to one folder share their temporary files
        df.write.parquet(f"{path}/{table}/attempt={attempt}")

    for table, values in (("tags", tags), ("params", params)):
        rows = [(k, str(v)) for k, v in values.items()]
        store(spark.createDataFrame(rows, "key string, value string").coalesce(1), table)
    store(metrics.select("key", F.col("value").cast("double").alias("value")), "metrics")
    log = CommitLog(spark, f"{path}/models/m-{quote(model, safe='')}")
    entry = {"model": model, "run_id": run_id, "ts": ts.isoformat(), "attempt": attempt}
    return log.commit(lambda newest: {**entry, "version": newest["version"] + 1 if newest else 1})[0]


def set_alias(
    spark: SparkSession, path: str, model: str, alias: str, version: int, ts: datetime
) -> None:
    row = [(model, alias, version, ts)]
    spark.createDataFrame(row, SCHEMAS["aliases"]).coalesce(1).write.mode("append").parquet(
        f"{path}/aliases"
    )


def current_aliases(aliases: DataFrame) -> DataFrame:
    """The version each alias points to: the one set last."""
    return aliases.groupBy("model", "alias").agg(
        F.max_by("version", F.struct("ts", "version")).alias("version")
    )


def assign_versions(runs: DataFrame, model: str, order: Sequence[str]) -> DataFrame:
    """Version numbers of a run list that was logged in ``order``."""
    from pyspark.sql.window import Window

    w = Window.partitionBy(model).orderBy(*order)
    return runs.withColumn("version", F.row_number().over(w))


def wide_to_log(
    runs: DataFrame, ids: Sequence[str], metrics: Sequence[str]
) -> DataFrame:
    """Metric columns to (ids…, key, value); NULL values left out."""
    wide = runs.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(list(ids), list(metrics), "key", "value").where(F.col("value").isNotNull())
