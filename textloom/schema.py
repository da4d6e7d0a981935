"""Record types of the curation pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA_VERSION = 1
DISPOSITIONS = ("kept", "review", "rejected")
FLAGS = (
    "boilerplate", "corrupted", "not_somali", "repeated_ngrams", "mostly_numbers", "html_remnant", "low_lang_score",
    "high_symbol_ratio", "too_long", "too_short",
)

RAW = T.StructType([T.StructField("text", T.StringType()), T.StructField("source", T.StringType())])
DROPPED = T.StructType([T.StructField(c, T.StringType()) for c in ("text", "source", "reason", "kept_source")])
PROVENANCE = T.StructType(
    [
        T.StructField("source", T.StringType()), T.StructField("collected_at", T.TimestampType()), T.StructField("lang", T.StringType()),
        *(T.StructField(c, T.StringType()) for c in ("source_url", "title", "author")),
        T.StructField("published_at", T.TimestampType()), T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("subsource", T.StringType()),
    ]
)
DEDUP = T.StructType([T.StructField("is_duplicate", T.BooleanType()), *(T.StructField(c, T.StringType()) for c in ("duplicate_of", "near_duplicate_of", "content_hash"))])
QUALITY = T.StructType(
    [T.StructField("disposition", T.StringType()), T.StructField("flags", T.ArrayType(T.StringType())), T.StructField("lang_score", T.FloatType()), T.StructField("symbol_ratio", T.FloatType())]
)
RECORD = T.StructType(
    [
        T.StructField("id", T.StringType()), T.StructField("text", T.StringType()), T.StructField("provenance", PROVENANCE),
        T.StructField("license", T.StringType()), T.StructField("content_hash", T.StringType()), T.StructField("dedup", DEDUP),
        T.StructField("quality", QUALITY), T.StructField("schema_version", T.IntegerType()), T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
    ]
)


def reject(disposition: Column, reason: Column) -> Column:
    """Rejection wins over every other disposition."""
    return F.when(reason.isNotNull(), F.lit("rejected")).otherwise(disposition)


def flag_for_review(disposition: Column, flags: Column) -> Column:
    return F.when((disposition == "kept") & (F.size(flags) > 0), F.lit("review")).otherwise(disposition)


def add_flags(flags: Column, more: Column) -> Column:
    """Flags in the order they came, each once; null entries of ``more`` don't count."""
    return F.array_distinct(F.concat(F.coalesce(flags, F.array().cast("array<string>")), F.array_compact(more)))


def as_records(df: DataFrame) -> DataFrame:
    """Flat stage rows (id, text, source, lang, license_id, content_hash, disposition, flags, ...) as nested records.

    ``collected_at`` is one value for the run.
    """
    has = lambda c, t: F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)
    void = lambda *cs: [F.lit(None).cast("string").alias(c) for c in cs]
    dup, near = has("duplicate_of", "string"), has("near_duplicate_of", "string")
    return df.select(
        "id",
        "text",
        F.struct(
            F.col("source"), F.current_timestamp().alias("collected_at"), F.coalesce(has("lang", "string"), F.lit("und")).alias("lang"),
            *void("source_url", "title", "author"), F.lit(None).cast("timestamp").alias("published_at"), F.array().cast("array<string>").alias("tags"), *void("subsource"),
        ).alias("provenance"),
        has("license_id", "string").alias("license"),
        "content_hash",
        F.struct((dup.isNotNull() | near.isNotNull()).alias("is_duplicate"), dup.alias("duplicate_of"), near.alias("near_duplicate_of"), F.col("content_hash")).alias("dedup"),
        F.struct(has("disposition", "string").alias("disposition"), has("flags", "array<string>").alias("flags"), has("lang_score", "float").alias("lang_score"), has("symbol_ratio", "float").alias("symbol_ratio")).alias("quality"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.create_map().cast("map<string,string>").alias("meta"),
    )
