"""Ordered concatenation of sources and first-wins exact dedup with provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions.udfs import nfc
from textloom.operators.skew import is_first, with_first


def _place(df: DataFrame) -> Column:
    """Where a row stands: by the frame's own ordinal, by file and place in it, or by the order of partitions."""
    if "ordinal" in df.columns:
        file, block, row = F.lit(""), F.lit(0), F.col("ordinal")
    else:
        row = F.monotonically_increasing_id()
        try:
            df.select("_metadata.file_path")
            file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
        except AnalysisException:  # not a file scan
            file, block = F.lit(""), F.lit(0)
    return F.struct(file.alias("file"), block.cast("long").alias("block"), row.cast("long").alias("row"))


def concat_in_order(frames: list[tuple[str, DataFrame]]) -> DataFrame:
    """``(source, rank, ordinal, text)``: sources in list order, lines in theirs; blank texts are left out.

    ``ordinal`` is the frame's own, if all have one. Else it is (file, block, row): files go by path, their
    blocks by offset, rows by place in the block, however the scan packs blocks into partitions.
    """
    own = all("ordinal" in df.columns for _, df in frames)
    parts = []
    for rank, (key, df) in enumerate(frames):
        ordinal = F.col("ordinal").cast("long") if own else _place(df)
        parts.append(df.select(F.lit(key).alias("source"), F.lit(rank).alias("rank"), ordinal.alias("ordinal"), T.trim_white(F.col("text")).alias("text")))
    return reduce(DataFrame.unionByName, parts).where(~T.is_blank(F.col("text")))


def mark_first_wins(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` (source, rank, ordinal, text) with content_hash, kept_source, reason.

    The first row of equal folded text, by (rank, ordinal), has a null reason.
    """
    marked = with_first(df.withColumn("content_hash", T.content_hash(nfc(F.col(text)))), "content_hash", "source")
    marked = marked.withColumn("kept_source", F.when(F.col("_first").isNull(), F.col("source")).otherwise(F.col("_first.source")))
    reason = F.when(is_first(), F.lit(None).cast("string")).when(F.col("kept_source").eqNullSafe(F.col("source")), "within_source_dup").otherwise("cross_source_dup")
    return marked.withColumn("reason", reason).select(*df.columns, "content_hash", "kept_source", "reason")


def kept(marked: DataFrame, limit: int | None = None) -> DataFrame:
    """Kept rows; ``limit`` counts them in merge order."""
    out = marked.where("reason is null").drop("reason", "kept_source")
    return out.orderBy("rank", "ordinal").limit(limit) if limit else out


def dropped(marked: DataFrame) -> DataFrame:
    cross = F.when(F.col("reason") == "cross_source_dup", F.col("kept_source"))
    return marked.where("reason is not null").select("text", "source", "reason", cross.alias("kept_source"))


def counters(marked: DataFrame) -> DataFrame:
    """Input, kept, dropped by reason and drop rate of each source and, with null source, of all."""
    within, cross = (F.count_if(F.col("reason") == r) for r in ("within_source_dup", "cross_source_dup"))
    return (
        marked.rollup("source")
        .agg(F.count("*").alias("input"), F.count_if(F.col("reason").isNull()).alias("kept"), within.alias("within_dups"), cross.alias("cross_dups"))
        .withColumn("drop_rate", F.round((F.col("input") - F.col("kept")) / F.col("input"), 6))
    )
