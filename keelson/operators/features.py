"""Imputation, categorical encoding and feature assembly as Spark ML stages.

The whole preprocessing is part of the fitted model, so the statistics
fitted on the training split travel with it and raw rows can be scored later:

    FillMissing(mean|median) -> FillMissing(mode) -> StringIndexer
        -> [OneHotEncoder] -> VectorAssembler -> classifier

``TablePrep`` fits the first four in one scan and returns them as a
``PipelineModel``; ``separate_stages`` gives the same as standard stages.

``FillMissing`` is a small Spark ML estimator: its fit is one aggregation
(mean: one ``agg`` for all columns; median: the bounded exact order
statistic; mode: one grouped count for all columns) and its model is a
column expression (``coalesce`` with a literal), saved and loaded with the
pipeline.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.operators.aggregate import long_form, mean_values, median_values, mode_values, number
from keelson.operators.quantiles import quantile_summary

STRATEGIES = ("mean", "median", "mode")
OTHER = "__other__"


class _FillParams(HasInputCols):
    strategy = Param(Params._dummy(), "strategy", "mean, median or mode",
                     typeConverter=TypeConverters.toString)
    fallback = Param(Params._dummy(), "fallback",
                     "fill value (JSON) when a column has no values at all",
                     typeConverter=TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(strategy="mean", fallback="null")

    def getStrategy(self) -> str:
        return self.getOrDefault(self.strategy)

    def getFallback(self):
        return json.loads(self.getOrDefault(self.fallback))


class FillMissing(Estimator, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fill nulls per column with its mean, median or most frequent value."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, strategy: str = "mean",
                 fallback: str | None = None):
        super().__init__()
        kwargs = dict(self._input_kwargs)
        if kwargs.get("fallback") is None:
            kwargs.pop("fallback", None)
        self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> "FillMissingModel":
        cols = self.getInputCols()
        strategy = self.getStrategy()
        fallback = self.getFallback()
        if strategy == "mean":
            values = mean_values(dataset, cols, default=0.0 if fallback is None else fallback)
        elif strategy == "median":
            values = median_values(dataset, cols, default=0.0 if fallback is None else fallback)
        elif strategy == "mode":
            values = mode_values(dataset, cols, default=fallback)
        else:
            raise ValueError(f"unknown strategy {strategy!r}; use one of {STRATEGIES}")
        return FillMissingModel(inputCols=cols, strategy=strategy, fillValues=json.dumps(values))


class FillMissingModel(Model, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    fillValues = Param(Params._dummy(), "fillValues", "column -> fill value (JSON)",
                       typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, strategy: str = "mean",
                 fillValues: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def values(self) -> dict:
        return json.loads(self.getOrDefault(self.fillValues))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        numeric = self.getStrategy() in ("mean", "median")
        out = {}
        for c, v in self.values().items():
            col = number(c) if numeric else F.col(c)
            out[c] = col if v is None else F.coalesce(col, F.lit(v))
        return dataset.withColumns(out)


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean", fallback=None) -> DataFrame:
    """Fit and apply in one call (the full-table form)."""
    fb = None if fallback is None else json.dumps(fallback)
    return FillMissing(inputCols=list(cols), strategy=strategy, fallback=fb).fit(df).transform(df)


def string_indexer(cols: Sequence[str], suffix: str = "_index") -> StringIndexer:
    """Frequency-descending index (ties alphabetical); unseen and null → n."""
    return StringIndexer(inputCols=list(cols), outputCols=[f"{c}{suffix}" for c in cols],
                         handleInvalid="keep", stringOrderType="frequencyDesc")


def string_index(df: DataFrame, cols: Sequence[str], suffix: str = "_index") -> DataFrame:
    return string_indexer(cols, suffix).fit(df).transform(df)


def cap_categories(df: DataFrame, col: str, max_categories: int, other: str = OTHER) -> DataFrame:
    """Keep the ``max_categories`` most frequent values of ``col`` (ties by
    value) and map the rest to ``other``. The kept list is bounded by the
    cap; nulls stay null."""
    top = [r[col] for r in (df.where(F.col(col).isNotNull()).groupBy(col).count()
                            .orderBy(F.desc("count"), F.asc(col)).limit(max_categories).collect())]
    keep = F.col(col).isNull() | F.col(col).isin(top)
    return df.withColumn(col, F.when(keep, F.col(col)).otherwise(F.lit(other)))


def one_hot_encoder(index_cols: Sequence[str], suffix: str = "_vec") -> OneHotEncoder:
    """One slot per index value, none dropped. The indexer's ``keep`` gives
    unseen and null values an index, and so one slot, of their own."""
    return OneHotEncoder(inputCols=list(index_cols), outputCols=[f"{c}{suffix}" for c in index_cols],
                         dropLast=False, handleInvalid="error")


def one_hot(df: DataFrame, cols: Sequence[str], max_categories: int | None = None) -> DataFrame:
    """Index then one-hot encode ``cols`` (vector column ``<col>_index_vec``).

    All categories have a slot unless the caller asks for the ``max_categories``
    most frequent ones."""
    for c in cols:
        if max_categories is not None:
            df = cap_categories(df, c, max_categories)
    indexed = string_index(df, cols)
    idx = [f"{c}_index" for c in cols]
    return one_hot_encoder(idx).fit(indexed).transform(indexed)


def assembler(cols: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=output, handleInvalid="keep")


def assemble_features(df: DataFrame, cols: Sequence[str], output: str = "features") -> DataFrame:
    return assembler(cols, output).transform(df)


def vector_slots(df: DataFrame, vector_col: str, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Expand a vector into one double column per slot (for SQL and reports)."""
    arr = vector_to_array(F.col(vector_col))
    return df.select(*keep, *[arr[i].alias(n) for i, n in enumerate(names)])


class _PrepParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric inputs", typeConverter=TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical inputs",
                            typeConverter=TypeConverters.toListString)
    featureCols = Param(Params._dummy(), "featureCols", "vector slot order", typeConverter=TypeConverters.toListString)
    numericStrategy = Param(Params._dummy(), "numericStrategy", "mean or median",
                            typeConverter=TypeConverters.toString)
    categoricalFallback = Param(Params._dummy(), "categoricalFallback",
                                "fill for an all-null categorical column (JSON)", typeConverter=TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", typeConverter=TypeConverters.toString)
    oneHotCols = Param(Params._dummy(), "oneHotCols", "categorical columns to one-hot encode",
                       typeConverter=TypeConverters.toListString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(numericStrategy="mean", categoricalFallback="null", outputCol="features",
                         oneHotCols=[])


class TablePrep(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Impute, index and assemble, fitted in one scan.

    One unpivot + grouped count gives, per numeric column, the count and sum
    of its values and, per categorical column, the count of every value
    (nulls included). From that small table come the means, the modes
    (count desc, then smallest value) and the index labels of the mode-filled
    columns (frequency desc, ties alphabetical) — what separate imputer and
    ``StringIndexer`` fits compute in three scans. With ``median`` the
    quantiles' two scans (sketch, exact) follow.
    """

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, featureCols=None,
                 numericStrategy="mean", categoricalFallback=None, outputCol="features",
                 oneHotCols=()):
        super().__init__()
        kwargs = dict(self._input_kwargs)
        if kwargs.get("categoricalFallback") is None:
            kwargs.pop("categoricalFallback", None)
        else:
            kwargs["categoricalFallback"] = json.dumps(kwargs["categoricalFallback"])
        kwargs["oneHotCols"] = list(kwargs.get("oneHotCols") or ())
        self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        numeric = self.getOrDefault(self.numericCols)
        categorical = self.getOrDefault(self.categoricalCols)
        strategy = self.getOrDefault(self.numericStrategy)
        fallback = json.loads(self.getOrDefault(self.categoricalFallback))
        if strategy not in ("mean", "median"):
            raise ValueError(f"unknown numeric strategy {strategy!r}")
        stats = _table_stats(dataset, numeric, categorical)
        if strategy == "mean":
            fills = {c: (stats["sum"][c] / stats["count"][c] if stats["count"].get(c) else 0.0) for c in numeric}
        else:
            res = quantile_summary(long_form(dataset, numeric), [0.5])
            fills = {c: (res[c].values[0] if c in res and res[c].n > 0 else 0.0) for c in numeric}
        modes, labels = {}, []
        for c in categorical:
            counts = stats["values"].get(c, {})
            nulls = counts.pop(None, 0)
            mode = min(counts.items(), key=lambda kv: (-kv[1], kv[0]))[0] if counts else fallback
            modes[c] = mode
            if mode is not None and nulls:
                counts[mode] = counts.get(mode, 0) + nulls
            labels.append([v for v, _ in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))])
        stages = [
            FillMissingModel(inputCols=list(numeric), strategy=strategy, fillValues=json.dumps(fills)),
            FillMissingModel(inputCols=list(categorical), strategy="mode", fillValues=json.dumps(modes)),
        ]
        feats = list(self.getOrDefault(self.featureCols))
        # One indexer per column: building a multi-column model from ragged
        # label lists would pad the shorter lists with null labels.
        indexers = [StringIndexerModel.from_labels(lab, inputCol=c, outputCol=f"{c}_index", handleInvalid="keep")
                    for c, lab in zip(categorical, labels)]
        stages += indexers
        small = [f"{c}_index" for c in self.getOrDefault(self.oneHotCols)]
        if small:
            # Sizes come from the indexers' column metadata: fitting on an
            # empty frame reads no data.
            sample = PipelineModel(stages=list(stages)).transform(dataset.limit(0))
            stages.append(one_hot_encoder(small).fit(sample))
            feats = [f"{f}_vec" if f in small else f for f in feats]
        stages.append(assembler(feats, self.getOrDefault(self.outputCol)))
        return PipelineModel(stages=stages)


def _table_stats(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> dict:
    """One scan: per numeric column (count, sum; NaN is missing); per
    categorical column the count of every value. The result holds numeric
    columns + categories, what a fitted ``StringIndexer`` keeps on the driver
    anyway."""
    cols = {c: F.struct(F.lit(None).cast("string").alias("v"), number(c).alias("x"))
            for c in numeric}
    cols.update({c: F.struct(F.col(c).cast("string").alias("v"), F.lit(None).cast("double").alias("x"))
                 for c in categorical})
    out = {"count": {}, "sum": {}, "values": {}}
    if not cols:
        return out
    long = df.select(*[e.alias(c) for c, e in cols.items()]).unpivot([], list(cols), "feature", "val")
    # Numeric columns are one group each (v is null).
    grouped = (long.groupBy("feature", F.col("val.v").alias("v"))
               .agg(F.count("val.x").alias("nx"), F.sum("val.x").alias("sx"), F.count(F.lit(1)).alias("n_rows")))
    num = set(numeric)
    rows = grouped.collect()
    for r in rows:
        if r["feature"] in num:
            out["count"][r["feature"]] = r["nx"]
            out["sum"][r["feature"]] = r["sx"]
        else:
            out["values"].setdefault(r["feature"], {})[r["v"]] = r["n_rows"]
    return out


def prep_stages(numeric: Sequence[str], categorical: Sequence[str], features: Sequence[str],
                numeric_strategy: str = "mean", categorical_fallback: str | None = None,
                output: str = "features", one_hot_cols: Sequence[str] = ()) -> list:
    """The single-pass preprocessing estimator as a pipeline stage list."""
    return [TablePrep(numericCols=list(numeric), categoricalCols=list(categorical), featureCols=list(features),
                      numericStrategy=numeric_strategy, categoricalFallback=categorical_fallback,
                      outputCol=output, oneHotCols=list(one_hot_cols))]


def separate_stages(numeric: Sequence[str], categorical: Sequence[str], features: Sequence[str],
                    numeric_strategy: str = "mean", one_hot_cols: Sequence[str] = (),
                    categorical_fallback: str | None = None, output: str = "features") -> list:
    """The same preprocessing as separate standard stages (one scan per
    fitted stage); ``one_hot_cols`` names the categorical columns whose slots
    are one-hot vectors (for linear models) instead of index values."""
    fb = None if categorical_fallback is None else json.dumps(categorical_fallback)
    stages = [
        FillMissing(inputCols=list(numeric), strategy=numeric_strategy),
        FillMissing(inputCols=list(categorical), strategy="mode", fallback=fb),
        string_indexer(categorical),
    ]
    feats = list(features)
    if one_hot_cols:
        idx = [f"{c}_index" for c in one_hot_cols]
        stages.append(one_hot_encoder(idx))
        feats = [f"{f}_vec" if f in idx else f for f in feats]
    stages.append(assembler(feats, output))
    return stages


def feature_pipeline(numeric: Sequence[str], categorical: Sequence[str], features: Sequence[str],
                     numeric_strategy: str = "mean", **kw) -> Pipeline:
    return Pipeline(stages=prep_stages(numeric, categorical, features, numeric_strategy, **kw))
