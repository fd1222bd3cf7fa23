"""Incremental indexing of a growing folder (an extension: the batch store functions applied per micro-batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions.text import title_of
from corpuskiln.operators.ranking import first_per_key

SCHEMA = "collection string, path string, body string, modified_at timestamp"


def changes(stream: DataFrame) -> DataFrame:
    """Documents of a stream of (collection, path, body, modified_at) as index rows; blank bodies drop out."""
    return stream.where(F.trim("body") != "").select("collection", "path", title_of(F.col("body"), F.col("path")).alias("title"), F.sha2("body", 256).alias("hash"), "modified_at", F.col("body"))


def follow(spark: SparkSession, source: str, index: str, checkpoint: str):
    """Start a query that appends each micro-batch's latest row per document to ``index`` (parquet). With ``availableNow`` it
    ends when the folder is read. A batch's folder is overwritten if the batch is run again, so each row counts once."""
    stream = changes(spark.readStream.schema(SCHEMA).json(source))

    def write(batch: DataFrame, number: int) -> None:
        latest = first_per_key(batch, ["collection", "path"], [-F.unix_micros("modified_at"), F.col("hash")])
        latest.write.mode("overwrite").parquet(f"{index}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, index: str) -> DataFrame:
    """The newest row of each document over all batches."""
    rows = spark.read.parquet(index)
    return first_per_key(rows, ["collection", "path"], [-F.col("batch"), F.col("hash")]).drop("batch")


def windowed_counts(events: DataFrame, time: str, by: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per window and group; rows later than the watermark drop out when streaming."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), by, "n")
