"""Category codes, fill values, scaling, and the preprocessing estimator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from equigauge.functions.scalar import canonical_code
from equigauge.operators.joins import BROADCAST_ROWS, lookup_join
from equigauge.roles import ROLES
from equigauge.session import materialize

CODE_SCHEMA = "feature string, code string, idx int, is_fill boolean"
STATS_SCHEMA = "feature string, mean double, std_pop double"


def long_codes(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """All categorical columns under each other: (keep…, feature, code)."""
    wide = df.select(*keep, *[canonical_code(c).alias(c) for c in columns])
    return wide.unpivot(list(keep), list(columns), "feature", "code")


def code_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (feature, code), all features in one pass; NULLs left out."""
    return (
        long_codes(df, columns)
        .where(F.col("code").isNotNull())
        .groupBy("feature", "code")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(counts: DataFrame) -> DataFrame:
    """Most common code per feature, the smallest one on ties."""
    best = F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("code").alias("code")))
    return counts.groupBy("feature").agg(best.alias("b")).select(
        "feature", F.col("b.code").alias("code"), (-F.col("b.neg_n")).alias("n")
    )


def mode_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace NULLs by the mode of their own column."""
    best = modes(code_counts(df, columns)).agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "code")))
    )
    fills = {}
    for c in columns:
        filled = F.coalesce(canonical_code(c), F.element_at(best.scalar(), F.lit(c)))
        fills[c] = filled
    return df.withColumns(fills)


def _small(table: DataFrame, max_rows: int) -> DataFrame | None:
    """The table as local rows if it has at most ``max_rows``; reads its input once."""
    rows = table.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return table.sparkSession.createDataFrame(rows, table.schema)


def _ranked(counts: DataFrame) -> DataFrame:
    w = Window.partitionBy("feature").orderBy("code")
    return counts.select("feature", "code", (F.row_number().over(w) - 1).alias("idx"))


def fit_codes(df: DataFrame, columns: Sequence[str], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Position of every code in the code-point order of its feature, from 0."""
    counts = code_counts(df, columns)
    small = _small(counts, max_rows)
    if small is not None:
        return _ranked(small)
    return rank_in_ranges(counts.select("feature", "code"), "feature", "code")


def rank_in_ranges(codes: DataFrame, group: str, value: str) -> DataFrame:
    """Same ranks for a very long code list, sorted in many ranges.

    The list is written once with its range number, so both uses of it see the
    same ranges.
    """
    parts = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = codes.repartitionByRange(parts, group, value)
    ranged = materialize(ranged.withColumn("_range", F.spark_partition_id()), "code-ranges")
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(group, "_range")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(group, "_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy(group, "_range").orderBy(value))
    ranked = ranged.withColumn("_in", inside).join(offsets, [group, "_range"])
    return ranked.select(group, value, (F.col("_offset") + F.col("_in") - 1).cast("int").alias("idx"))


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation per column, NULLs ignored."""
    stats = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns],
    )
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"m_{c}").alias("mean"),
            F.col(f"s_{c}").alias("std_pop"),
        )
        for c in columns
    ]
    return stats.select(F.inline(F.array(*rows)))


def scale(df: DataFrame, stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / std; a constant column is divided by 1."""
    by_feature = {r["feature"]: r for r in stats.where(F.col("feature").isin(*columns)).collect()}
    return df.withColumns({c: _scaled(c, by_feature[c]) for c in columns if c in by_feature})


def _scaled(column: str, row):
    std = row["std_pop"] or 1.0
    mean = 0.0 if row["mean"] is None else row["mean"]
    return (F.col(column).cast("double") - F.lit(mean)) / F.lit(std)


def encode(
    df: DataFrame,
    codes: DataFrame,
    columns: Sequence[str],
    keep_known: bool = False,
    known_rows: int | None = None,
) -> DataFrame:
    """Replace codes by their position; unknown and NULL codes become 0.

    With ``keep_known`` a flag ``<column>_known`` tells which rows fell back.
    """
    for c in columns:
        table = codes.where(F.col("feature") == c).select(
            F.col("code").alias("_code"), F.col("idx").alias("_idx")
        )
        df = lookup_join(df.withColumn("_code", canonical_code(c)), table, ["_code"], known_rows)
        if keep_known:
            df = df.withColumn(f"{c}_known", F.col("_idx").isNotNull())
        df = df.withColumn(c, F.coalesce("_idx", F.lit(0))).drop("_code", "_idx")
    return df


def fallback_report(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per feature: rows whose code is unknown or missing, and their share."""
    counted = long_codes(df, columns).groupBy("feature", "code").agg(F.count(F.lit(1)).alias("n"))
    known = codes.select("feature", "code", F.lit(True).alias("known"))
    joined = counted.join(known, ["feature", "code"], "left")
    unknown = F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0))
    return joined.groupBy("feature").agg(
        F.sum("n").alias("rows"),
        unknown.alias("fallback_rows"),
        (unknown.cast("double") / F.sum("n")).alias("fallback_share"),
    )


class _PrepParams(Params):
    key = Param(Params._dummy(), "key", "record key", TypeConverters.toString)
    weight = Param(Params._dummy(), "weight", "record weight", TypeConverters.toString)
    label = Param(Params._dummy(), "label", "label column", TypeConverters.toString)
    categorical = Param(
        Params._dummy(), "categorical", "coded columns", TypeConverters.toListString
    )
    numeric = Param(Params._dummy(), "numeric", "scaled columns", TypeConverters.toListString)
    order = Param(Params._dummy(), "order", "feature order", TypeConverters.toListString)

    def _names(self, df: DataFrame, param: Param) -> list[str]:
        return [c for c in self.getOrDefault(param) if c in df.columns]


class Preprocessor(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fill, encode, scale and order the features.

    Everything is learned from the table given to ``fit``; the mode that fills
    NULLs is stored too, so scoring a batch never depends on that batch.
    """

    @keyword_only
    def __init__(
        self,
        *,
        key=ROLES.key,
        weight=ROLES.weight,
        label=ROLES.label,
        categorical=ROLES.categorical,
        numeric=ROLES.numeric,
        order=ROLES.feature_order,
    ):
        super().__init__()
        self._set(
            **{k: list(v) if isinstance(v, tuple) else v for k, v in self._input_kwargs.items()}
        )
        for name, default in (
            ("key", ROLES.key),
            ("weight", ROLES.weight),
            ("label", ROLES.label),
            ("categorical", list(ROLES.categorical)),
            ("numeric", list(ROLES.numeric)),
            ("order", list(ROLES.feature_order)),
        ):
            self._setDefault(**{name: default})

    def _fit(self, dataset: DataFrame) -> PreprocessorModel:
        spark = dataset.sparkSession
        counts = code_counts(dataset, self._names(dataset, self.categorical))
        small = _small(counts, BROADCAST_ROWS)
        if small is None:
            counts = materialize(counts, "code-counts")
            codes = rank_in_ranges(counts.select("feature", "code"), "feature", "code")
        else:
            counts, codes = small, _ranked(small)
        fill = modes(counts).select("feature", "code", F.lit(True).alias("is_fill"))
        table = codes.join(fill, ["feature", "code"], "left").select(
            "feature", "code", "idx", F.coalesce("is_fill", F.lit(False)).alias("is_fill")
        )
        rows = None
        if small is None:
            table = materialize(table, "codes")
        else:
            local = table.collect()
            rows, table = len(local), spark.createDataFrame(local, CODE_SCHEMA)
        stats = fit_scaler(dataset, self._names(dataset, self.numeric)).collect()
        model = PreprocessorModel(table, spark.createDataFrame(stats, STATS_SCHEMA), rows)
        return self._copyValues(model)


class PreprocessorModel(Model, _PrepParams, MLWritable, MLReadable):
    """Fitted preprocessing: a code table and a statistics table."""

    def __init__(self, codes: DataFrame, stats: DataFrame, code_rows: int | None = None):
        super().__init__()
        self.codes, self.stats, self.code_rows = codes, stats, code_rows

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = self._names(dataset, self.categorical)
        numeric = self._names(dataset, self.numeric)
        fills = {r["feature"]: r["code"] for r in self.codes.where("is_fill").collect()}
        df = dataset.withColumns(
            {c: F.coalesce(canonical_code(c), F.lit(fills.get(c))) for c in columns}
        )
        df = scale(encode(df, self.codes, columns, known_rows=self.code_rows), self.stats, numeric)
        ordered = [c for c in self.getOrDefault(self.order) if c in df.columns]
        carried = [self.getOrDefault(p) for p in (self.weight, self.label)]
        return df.select(
            self.getOrDefault(self.key), *ordered, *[c for c in carried if c in df.columns]
        )

    def write(self) -> MLWriter:
        return _PrepWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _PrepReader()


class _PrepWriter(MLWriter):
    """Parameters as metadata, the two fitted tables as parquet."""

    def __init__(self, model: PreprocessorModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.codes.write.parquet(f"{path}/codes")
        self.model.stats.write.parquet(f"{path}/stats")


class _PrepReader(MLReader):
    def load(self, path: str) -> PreprocessorModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        codes = spark.read.schema(CODE_SCHEMA).parquet(f"{path}/codes")
        n = codes.limit(BROADCAST_ROWS + 1).count()
        stats = spark.read.schema(STATS_SCHEMA).parquet(f"{path}/stats")
        model = PreprocessorModel(codes, stats, n if n <= BROADCAST_ROWS else None)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def save_prep(model: PreprocessorModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_prep(path: str) -> PreprocessorModel:
    return PreprocessorModel.load(path)
