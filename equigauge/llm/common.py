"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
import shutil
import site
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_ROWS = 1000


SHIPPED = "equigauge.zip"


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it is neither installed nor on their path."""
    root = Path(__file__).resolve().parents[2]
    there = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd(), *site.getsitepackages()]
    if any(p and Path(p).resolve() == root for p in there):
        return
    if any(f.endswith(SHIPPED) for f in spark.sparkContext.listFiles):
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{Path(SHIPPED).stem}", "zip", root, root.joinpath("equigauge").name)
    spark.sparkContext.addPyFile(archive)


def prepare_session(spark: SparkSession) -> None:
    """Small Arrow batches: a batch of long texts must fit a Python worker."""
    ship_package(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text; a null text counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def schema_of(fields: str) -> T.StructType:
    return T._parse_datatype_string(fields)


def arrow_schema(fields: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema_of(fields))


def unused(df: DataFrame, stem: str) -> str:
    """A column name that clashes with none of the table's."""
    taken = {c.lower() for c in df.columns}
    return stem if stem.lower() not in taken else f"{stem}_{uuid.uuid4().hex[:8]}"


def slices(items: list, size: int) -> Iterator[list]:
    for at in range(0, len(items), size):
        yield items[at : at + size]
