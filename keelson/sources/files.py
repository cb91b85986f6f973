"""File sources and sinks: CSV, Parquet, JSON reports, fitted models.

Writers never force one output file unless asked: ``coalesce(1)`` would pull
the whole upstream stage into a single task. When one file is requested we
``repartition(1)`` so the upstream work keeps its parallelism and only the
final write is serial.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer: bool = False) -> DataFrame:
    """CSV with a header. An explicit schema is the default; inference (an
    extra full pass over the input) only when asked."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _files(df: DataFrame, n_files: int | None) -> DataFrame:
    return df if n_files is None else df.repartition(n_files)


def write_parquet(df: DataFrame, path: str, n_files: int | None = None,
                  partition_by: list[str] | None = None) -> str:
    writer = _files(df, n_files).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv_predictions(pred: DataFrame, path: str, id_col: str = "id",
                          prediction_col: str = "prediction", out_id: str | None = None,
                          out_label: str = "prediction", n_files: int | None = None) -> str:
    """Submission file: id and a 0/1 integer label, with a header."""
    out = pred.select(F.col(id_col).alias(out_id or id_col),
                      F.col(prediction_col).cast("int").alias(out_label))
    _files(out, n_files).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_report_json(report: DataFrame, path: str, n_files: int | None = 1) -> str:
    """Metrics or drift rows as JSON lines (reports are a handful of rows)."""
    _files(report, n_files).write.mode("overwrite").json(path)
    return path


def save_model(model: PipelineModel, path: str) -> str:
    """Persist a fitted pipeline; overwrites an existing path."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Restore a fitted pipeline. The saved metadata names every stage's
    class, so no probing of model types is needed and errors propagate."""
    return PipelineModel.load(path)
