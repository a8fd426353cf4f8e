"""Targets, weights, group-aware splits and the preparation stages of a training pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuekit.operators.schema import numeric_columns, text_columns
from valuekit.scale import attach, col, medians, null_safe_join, positions, settle, settled_size


def features_target(df: DataFrame, target: str, drop: Sequence[str]) -> DataFrame:
    """Rows with a target, without the columns that are not trained on."""
    if target not in df.columns:
        raise ValueError(f"no column {target!r} to train on")
    return df.filter(col(target).isNotNull()).drop(*[c for c in drop if c != target])


def mad_weights(df: DataFrame, target: str, factor: float = 1.5, by: Sequence[str] = (), name: str = "weight") -> DataFrame:
    """Weight 1 at the median, falling with the distance in units of the median absolute deviation."""
    y = col(target).cast("double")
    if not by:
        middle = medians(df, [target]).first()[target]
        if middle is None:
            return df.withColumn(name, F.lit(None).cast("double"))
        away = F.abs(y - F.lit(middle))
        mad = medians(df.select(away.alias("away")), ["away"]).first().away
        return df.withColumn(name, 1 / (1 + away / F.lit(mad * factor + 1e-6)))
    centre = settle(medians(df, [target], by).withColumnRenamed(target, "__median"))
    away = F.abs(y - F.col("__median"))
    spread = medians(attach(df, centre, by).withColumn("__mad", away), ["__mad"], by)
    centred = attach(df, null_safe_join(centre, settle(spread), by, "left"), by)
    return centred.withColumn(name, 1 / (1 + away / (F.col("__mad") * factor + 1e-6))).drop("__median", "__mad")


def group_hash(group: Column, seed: int) -> Column:
    """Eight hex digits that depend on the group and the seed only."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), group.cast("string"))), 1, 8)


def hash_bound(share: float) -> str:
    return format(min(int(share * 2**32), 2**32 - 1), "08x")


def group_split(df: DataFrame, group: str, seed: int = 42, test: float = 0.2, validation: float = 0.25, name: str = "split") -> DataFrame:
    """Whole groups to test, then of the rest to validation, else train; no shuffle, repeatable."""
    to_test = group_hash(col(group), seed) < hash_bound(test)
    to_validation = group_hash(col(group), seed + 1) < hash_bound(validation)
    return df.withColumn(name, F.when(to_test, "test").when(to_validation, "validation").otherwise("train"))


def group_folds(df: DataFrame, group: str, n: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold 0..n-1 per group."""
    key = group_hash(col(group), seed + 2)
    passed = [F.when(key >= hash_bound(i / n), 1).otherwise(0) for i in range(1, n)]
    return df.withColumn(name, sum(passed, F.lit(0)).cast("int"))


def scaling(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float, float]]:
    """(median, mean, spread) per column: population deviation after filling, 1 for constant columns."""
    middle = medians(df, columns).first()
    filled = {c: F.coalesce(col(c).cast("double"), F.lit(middle[c]).cast("double")) for c in columns}
    sums = [F.avg(v).alias(f"m{i}") for i, v in enumerate(filled.values())]
    sums += [F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(filled.values())]
    row = df.agg(*sums).first()
    return {c: (middle[c] or 0.0, row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Median fill, then zero mean and unit population deviation."""
    scales = scaling(df, columns)
    return df.withColumns(
        {c: (F.coalesce(col(c).cast("double"), F.lit(m)) - F.lit(mean)) / F.lit(spread) for c, (m, mean, spread) in scales.items()}
    )


class NumericPrep(Estimator):
    """Learns the fill and scale of numeric columns; the fitted stage is one SQL projection."""

    def __init__(self, columns: Sequence[str], prefix: str = "__num_"):
        super().__init__()
        self.columns, self.prefix = list(columns), prefix

    def outputs(self) -> list[str]:
        return [f"{self.prefix}{i}" for i in range(len(self.columns))]

    def _fit(self, dataset: DataFrame) -> Transformer:
        scales = scaling(dataset, self.columns)
        cells = [
            f"(coalesce(CAST(`{c}` AS DOUBLE), {scales[c][0]!r}D) - {scales[c][1]!r}D) / {scales[c][2]!r}D AS {out}"
            for c, out in zip(self.columns, self.outputs())
        ]
        return SQLTransformer(statement=f"SELECT *, {', '.join(cells)} FROM __THIS__")


# Texts with more levels than this are numbered by a join instead of lists that the driver holds.
LISTED_LEVELS = 100_000


class LevelIndexer(Estimator):
    """Codes 0, 1, ... for the levels of text columns in order; a value that wasn't there takes the code behind the last one.

    Few levels become a ``StringIndexerModel``. Beyond ``LISTED_LEVELS`` the dictionary of a column is a table, numbered by range partitions and attached by a join.
    """

    def __init__(self, inputs: Sequence[str], outputs: Sequence[str]):
        super().__init__()
        self.inputs, self.outputs = list(inputs), list(outputs)

    def _fit(self, dataset: DataFrame) -> Transformer:
        counts = dataset.agg(*[F.approx_count_distinct(col(c)) for c in self.inputs]).first()
        if max(counts) <= LISTED_LEVELS:
            # An unseen value takes the extra last code, which the encoder drops: all zeros.
            return StringIndexer(inputCols=self.inputs, outputCols=self.outputs, handleInvalid="keep", stringOrderType="alphabetAsc").fit(dataset)
        levels = [dataset.select(col(c).alias("level")).filter("level IS NOT NULL").distinct() for c in self.inputs]
        tables = [settle(positions(table, [], [F.col("level")], "code").select("level", (F.col("code") - 1).cast("double").alias("code"))) for table in levels]
        return LevelDictionary(self.inputs, self.outputs, tables, [settled_size(table)[0] for table in tables])


class LevelDictionary(Transformer, MLWritable, MLReadable):
    """Levels and codes as one table per column."""

    def __init__(self, inputs: Sequence[str] = (), outputs: Sequence[str] = (), tables: Sequence[DataFrame] = (), sizes: Sequence[int] = ()):
        super().__init__()
        self.inputs, self.outputs, self.tables, self.sizes = list(inputs), list(outputs), list(tables), list(sizes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for name, output, table, size in zip(self.inputs, self.outputs, self.tables, self.sizes):
            coded = attach(dataset, table.withColumnRenamed("level", name).withColumnRenamed("code", output), [name])
            nominal = {"ml_attr": {"type": "nominal", "name": output, "num_vals": size + 1}}
            dataset = coded.withColumn(output, F.coalesce(col(output), F.lit(float(size))).alias(output, metadata=nominal))
        return dataset

    def write(self) -> MLWriter:
        return _DictionaryWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _DictionaryReader()


class _DictionaryWriter(MLWriter):
    def __init__(self, model: LevelDictionary):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        held = {"inputs": self.model.inputs, "outputs": self.model.outputs, "sizes": self.model.sizes}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, held)
        for k, table in enumerate(self.model.tables):
            table.write.parquet(f"{path}/levels-{k}")


class _DictionaryReader(MLReader):
    def load(self, path: str) -> LevelDictionary:
        held = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        tables = [self.sparkSession.read.parquet(f"{path}/levels-{k}") for k in range(len(held["inputs"]))]
        model = LevelDictionary(held["inputs"], held["outputs"], tables, held["sizes"])
        model._resetUid(held["uid"])
        return model


def prep_stages(df: DataFrame, skip: Sequence[str], features: str = "features", hash_width: int | None = None) -> list:
    """Stages from raw columns to one feature vector; columns in ``skip`` take no part.

    Texts get an indicator per level, in order of the levels. With ``hash_width`` indicators are hashed into that many places instead, and nothing is counted.
    """
    numeric, text = numeric_columns(df, skip), text_columns(df, skip)
    stages, inputs = [], []
    if numeric:
        prep = NumericPrep(numeric)
        stages.append(prep)
        inputs += prep.outputs()
    if text:
        filled = ", ".join(f"coalesce(`{c}`, 'missing') AS __cat_{i}" for i, c in enumerate(text))
        names, codes, hot = ([f"{p}{i}" for i in range(len(text))] for p in ("__cat_", "__code_", "__hot_"))
        stages.append(SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"))
        if hash_width:
            stages.append(FeatureHasher(inputCols=names, outputCol="__hashed", numFeatures=hash_width))
            inputs.append("__hashed")
        else:
            stages += [
                LevelIndexer(names, codes),
                OneHotEncoder(inputCols=codes, outputCols=hot, dropLast=True),
            ]
            inputs += hot
    stages.append(VectorAssembler(inputCols=inputs, outputCol=features))
    return stages
