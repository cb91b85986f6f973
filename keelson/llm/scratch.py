"""Tables written to the shared folder, to cut a lineage and to be read more than once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

from keelson.llm.textbytes import give_back
from keelson.session import scratch_path


#: Lets Spark delete an execution's shuffle files when it ends, not when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, compression: str | None = None, clean: bool = False) -> DataFrame:
    """``df`` written as Parquet below the cluster's ``spark.checkpoint.dir`` and read back.

    Unlike a cached or locally checkpointed frame it survives the loss of any executor.
    With ``clean`` the shuffle files of the writing are gone afterwards.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffles_cleaned(spark) if clean else nullcontext():
        df.write.parquet(path, compression=compression)
    give_back()
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
