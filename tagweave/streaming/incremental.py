"""Annotation of files as they arrive; the checkpoint tells which are done, so a run that stops goes on where it was."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagweave.session import ship


def new_texts(spark: SparkSession, base: str, pattern: str = "*", files_a_batch: int = 1000) -> DataFrame:
    """path and text of each file that arrives in a folder."""
    reader = ship(spark).readStream.format("text").option("wholetext", True).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_a_batch)
    return reader.load(base).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def annotate_new(spark: SparkSession, base: str, out: str, checkpoint: str, annotate: Callable[[DataFrame], DataFrame], pattern: str = "*") -> StreamingQuery:
    """Annotate all files that aren't done; a batch that runs again overwrites its own folder, so each file is written once."""

    def batch(df: DataFrame, number: int) -> None:
        annotate(df).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return new_texts(spark, base, pattern).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
