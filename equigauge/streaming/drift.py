"""Drift of arriving data against a fixed reference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from equigauge.operators.drift import column_drift, drift_summary


def drift_stream(
    stream: DataFrame, reference: DataFrame, columns: Sequence[str], path: str
) -> DataStreamWriter:
    """Compare every micro-batch with the reference and append both result tables.

    A batch writes below its own number and replaces what it wrote before, so a
    repeated batch leaves no second copy.
    """

    def compare(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            rows = F.lit(batch.count())
            found = column_drift(reference, batch, columns).withColumn("rows", rows)
            found.write.mode("overwrite").parquet(f"{path}/columns/batch={number}")
            stored = batch.sparkSession.read.schema(found.schema).parquet(
                f"{path}/columns/batch={number}"
            )
            summary = drift_summary(stored).withColumn("rows", rows)
            summary.write.mode("overwrite").parquet(f"{path}/summary/batch={number}")
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(compare)
