"""Streaming re-ingest: documents that arrive in a folder are classified once and kept apart from low content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.text import is_low_content


def arriving_documents(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Documents of new Parquet files with whether their content is low."""
    docs = spark.readStream.schema(schema).parquet(folder)
    return docs.withColumn("low_content", is_low_content(F.col("text")))


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append what is there, remember it in the checkpoint and stop; a rerun takes up what came since."""
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
