"""Serving the Production model: requests are scored with whatever version is promoted when they arrive.

Every micro-batch reads the registry's Production version and takes its
model, loaded once a version; a promotion needs no restart. A request that is
sent again (same key, within the watermark's delay of its time) is scored once:
its key is kept as state until the watermark passes. The rows of a batch go to
a folder named after the batch, which is overwritten if the batch runs again
after a failure, so a request has one score and a batch one model.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from keelson.operators import registry, score


def serve_production(spark: SparkSession, versions_path: str, runs_path: str, model_name: str, source_dir: str,
                     schema: StructType, sink_dir: str, checkpoint_dir: str, id_col: str = "id",
                     time_col: str = "sent_at", delay: str = "1 hour", available_now: bool = True,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the query over Parquet files of requests; ``<sink>/batch=n`` holds ``id, version, prediction,
    probability``. Without a Production version the query fails and its requests stay unread."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    sent = reader.parquet(source_dir).withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])
    loaded: dict[str, PipelineModel] = {}

    def score_batch(batch: DataFrame, number: int) -> None:
        version, path = registry.production_model(batch.sparkSession, versions_path, runs_path, model_name)
        if path not in loaded:
            loaded.clear()  # one model at a time
            loaded[path] = PipelineModel.load(path)
        out = score.score_batch(loaded[path], batch, id_col).withColumn("version", F.lit(version))
        out.write.mode("overwrite").parquet(f"{sink_dir}/batch={number}")

    writer = sent.writeStream.option("checkpointLocation", checkpoint_dir).foreachBatch(score_batch)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
