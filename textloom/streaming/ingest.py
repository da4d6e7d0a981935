"""Streaming ingest: cleaning as rows arrive, exact dedup of each micro-batch against what is already kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.functions import text as T
from textloom.functions.udfs import nfc
from textloom.operators.clean import clean_text
from textloom.schema import RAW


def cleaned_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(text, source, content_hash) of the JSONL files that land in ``folder``; stateless."""
    raw = spark.readStream.schema(RAW).json(folder).where(~T.is_blank(F.col("text")))
    c = raw.withColumn("text", clean_text(F.col("text"))).where("text <> ''")
    return c.withColumn("content_hash", T.content_hash(nfc(F.col("text"))))


def ingest(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Appends what is new to the Parquet table; run until what is there is read.

    Each batch is reduced to its first row per hash and anti-joined with the hashes of earlier
    batches. Rows are written under their batch's number, so a repeated batch replaces itself:
    every row once, and no state that grows without bound in memory.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        w = W.partitionBy("content_hash").orderBy("source", "text")
        first = df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
        try:
            old = spark.read.schema("content_hash string, batch long").parquet(table).where(F.col("batch") < number).select("content_hash")
            first = first.join(old, "content_hash", "left_anti")
        except Exception as e:  # the first batch has no table yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        first.write.mode("overwrite").parquet(f"{table}/batch={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
