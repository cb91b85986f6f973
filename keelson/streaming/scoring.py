"""Continuous scoring of arriving rows with Structured Streaming.

New raw rows land as files; a stateless streaming query applies the same
fitted pipeline used in batch (imputation, indexing, assembly, classifier)
and appends ``id, prediction, probability`` to a Parquet sink. The
checkpoint makes the query restartable exactly-once after a driver or
executor failure; no watermark is needed because nothing is aggregated.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from keelson.operators.clean import contract_errors


def scored_stream(spark: SparkSession, model, source_dir: str, schema: StructType,
                  id_col: str = "id", max_files_per_trigger: int | None = None):
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(source_dir)
    return model.transform(raw).select(
        id_col, F.col("prediction"), vector_to_array(F.col("probability"))[1].alias("probability"))


def score_stream(spark: SparkSession, model, source_dir: str, schema: StructType, sink_dir: str,
                 checkpoint_dir: str, id_col: str = "id", available_now: bool = True,
                 processing_time: str | None = None,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the scoring query. ``available_now`` drains what is there and
    stops (batch-like runs, tests); otherwise a processing-time trigger."""
    scored = scored_stream(spark, model, source_dir, schema, id_col, max_files_per_trigger)
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", sink_dir).option("checkpointLocation", checkpoint_dir))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def score_requests(spark: SparkSession, model, source_dir: str, contract: StructType, sink_dir: str,
                   checkpoint_dir: str, id_col: str = "id", available_now: bool = True) -> StreamingQuery:
    """Validate request records against ``contract`` and score the valid ones.

    Records arrive as JSON lines and are read as text, so a malformed value
    is a contract error rather than a read failure. One pass per micro-batch:
    every row is cast with ``try_cast`` (bad values become null, which the
    fitted pipeline imputes or indexes as unseen, so no row can fail the
    transform), scored once, and the prediction is kept only where the
    contract held; rejected rows keep their list of errors instead. Written
    to one Parquet sink partitioned by ``status`` — one checkpointed,
    exactly-once query that reads each file once.
    """
    text_schema = StructType([StructField(f.name, StringType(), True) for f in contract.fields])
    raw = spark.readStream.schema(text_schema).json(source_dir)
    checked = raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in contract.fields],
                         contract_errors(raw, contract).alias("_errors"))
    ok = F.size("_errors") == 0
    out = model.transform(checked).select(
        F.col(id_col).cast("long").alias(id_col),
        F.when(ok, F.lit("scored")).otherwise(F.lit("rejected")).alias("status"),
        F.when(ok, F.col("prediction")).alias("prediction"),
        F.when(ok, vector_to_array(F.col("probability"))[1]).alias("probability"),
        F.when(~ok, F.col("_errors")).alias("errors"))
    writer = (out.writeStream.format("parquet").outputMode("append")
              .partitionBy("status").option("path", sink_dir).option("checkpointLocation", checkpoint_dir))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
