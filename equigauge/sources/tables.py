"""Stored tables: snapshots, split tables, metrics, reports, CSV lines."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigauge.roles import ROLES, Roles
from equigauge.sources.commits import CommitLog

#: folder of rows without a date, as Spark names it
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def write_snapshot(
    df: DataFrame, path: str, day: date, partitions: Sequence[str] = ()
) -> None:
    """Store a dated snapshot; a second run on the same day replaces the first.

    Rows go to a folder of this run (column ``snapshot_run``), which the commit log
    then names as the day's, and the folder it replaces is deleted. A run that fails
    changes nothing for ``read_latest``, and runs at the same time do not disturb
    each other: the later commit of a day wins. With further partitions the rows are
    rebalanced first: even files, a large partition in several of them, instead of
    one per task and partition.
    """
    log, today = CommitLog(df.sparkSession, path), day.isoformat()
    folder = f"snapshot_date={today}/snapshot_run={uuid.uuid4().hex}"
    rows = df.hint("rebalance", *partitions) if partitions else df
    rows.write.partitionBy(*partitions).parquet(f"{path}/{folder}")
    schema = df.withColumns({"snapshot_date": F.lit(day), "snapshot_run": F.lit("")}).schema.jsonValue()
    replaced: list[str] = []

    def entry(newest: dict | None) -> dict:
        days = newest["days"] if newest else {}
        replaced[:] = [days[today]] if today in days else []
        latest = today >= max(days, default=today)
        return {"days": {**days, today: folder}, "schema": schema if latest else newest["schema"]}

    log.commit(entry)
    for old in replaced:
        log.delete(old)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot; only its folder is listed and opened.

    The newest commit names it. A table without a log (written by other means) is
    listed by its ``snapshot_date`` folders; no data file is opened to find the day.
    """
    log = CommitLog(spark, path)
    newest, reader = log.newest(), spark.read.option("basePath", path)
    if newest:
        folder = newest["days"][max(newest["days"])]
        reader = reader.schema(T.StructType.fromJson(newest["schema"]))
    else:
        days = [d for d in log.partitions("snapshot_date") if d != NO_DAY]
        if not days:
            raise FileNotFoundError(f"no snapshot below {path}")
        folder = f"snapshot_date={max(days)}"
    rows = reader.parquet(f"{path}/{folder}")
    return rows.drop("snapshot_run")


def read_days(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The committed snapshots of a span of days, both ends included; only their folders are opened."""
    newest = CommitLog(spark, path).newest()
    if not newest:
        raise FileNotFoundError(f"no snapshot below {path}")
    low, high = (d.isoformat() if d else None for d in (first, last))
    folders = [f for d, f in newest["days"].items() if (low is None or d >= low) and (high is None or d <= high)]
    schema = T.StructType.fromJson(newest["schema"])
    if not folders:
        return spark.createDataFrame([], schema).drop("snapshot_run")
    rows = spark.read.option("basePath", path).schema(schema).parquet(*[f"{path}/{f}" for f in folders])
    return rows.drop("snapshot_run")


def write_splits(
    df: DataFrame, path: str, sensitive_path: str, roles: Roles = ROLES, split: str = "is_test"
) -> None:
    """Feature, label and sensitive tables by key; the sensitive one has its own path."""
    secret = [c for c in roles.sensitive if c in df.columns]
    features = [c for c in (*roles.feature_order, roles.weight) if c in df.columns]
    parts = {
        f"{path}/features": df.select(roles.key, *features, split),
        f"{path}/labels": df.select(roles.key, roles.label, split),
        sensitive_path: df.select(roles.key, *secret, roles.label, split),
    }
    for target, part in parts.items():
        part.write.mode("overwrite").partitionBy(split).parquet(target)


def read_splits(
    spark: SparkSession,
    path: str,
    test: bool,
    roles: Roles = ROLES,
    split: str = "is_test",
    keep_weight: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Features and labels of one side of the split."""
    features, labels = (
        spark.read.parquet(f"{path}/{name}").where(F.col(split) == F.lit(test)).drop(split)
        for name in ("features", "labels")
    )
    return (features if keep_weight else features.drop(roles.weight)), labels


def to_csv_lines(df: DataFrame, columns: Sequence[str], key: str = ROLES.key) -> DataFrame:
    """One comma-separated line per record, columns in the given order."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in columns]
    return df.select(key, F.concat_ws(",", *cells).alias("line"))


def metric_rows(metrics: DataFrame, namespace: str, ts: datetime) -> DataFrame:
    """(name, value, unit) to stored metric rows with namespace and time."""
    return metrics.select(
        F.lit(namespace).alias("namespace"),
        "name",
        F.col("value").cast("double").alias("value"),
        "unit",
        F.lit(ts).cast("timestamp").alias("ts"),
    )


def write_metrics(rows: DataFrame, path: str) -> None:
    """Append metric rows, partitioned by day."""
    rows.withColumn("day", F.to_date("ts")).write.mode("append").partitionBy("day").parquet(path)


def write_report(df: DataFrame, path: str, name: str, run_ts: datetime) -> str:
    """Store one report table of a run; returns where."""
    target = f"{path}/run={run_ts:%Y%m%d_%H%M%S}/{name}"
    df.write.mode("overwrite").parquet(target)
    return target
