"""First cleaning: repair, gates, review flags, exact dedup of what came out equal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom import registry
from textloom.config import Clean
from textloom.functions import text as T
from textloom.functions.udfs import repair
from textloom.operators.skew import is_first, with_first
from textloom.schema import add_flags, flag_for_review, reject


def tidy(c: Column, max_run: int = 3) -> Column:
    return T.normalize_whitespace(T.collapse_repeats(T.strip_invisibles(c), max_run))


def clean_text(c: Column, max_run: int = 3, passes: int = 3) -> Column:
    """Entities, mojibake, NFC (one Arrow pass), then invisible characters, repeats and white space."""
    return tidy(repair(c, passes), max_run)


def gate(text: Column, floor: Column, ufffd_most: float) -> Column:
    """First reason that holds: empty, corrupted, below the floor of words; null if none."""
    return (
        F.when(T.is_blank(text), "too_short")
        .when(T.ufffd_ratio(text) > ufffd_most, "corrupted")
        .when(T.word_count(text) < floor, "too_short")
    )


def review_flags(text: Column, symbols: Column, symbol_most: float) -> Column:
    return F.array_compact(
        F.array(
            F.when(symbols > symbol_most, F.lit("high_symbol_ratio")),
            F.when(T.has_html_remnant(text), F.lit("html_remnant")),
            F.when(T.mostly_numbers(text), F.lit("mostly_numbers")),
        )
    )


def clean(raw: DataFrame, sources: list[registry.Source], cfg: Clean = Clean()) -> DataFrame:
    """Rows (source, ordinal, text) of known sources with clean text, id, content_hash, symbol_ratio, flags,
    disposition and reason. Rows of unknown sources are skipped: ``unknown_sources`` has them.

    After the gates, of rows with equal content_hash that aren't rejected only the first by
    (rank, ordinal) stays; others are rejected as exact_duplicate_after_clean with ``duplicate_of``.
    """
    known = registry.look_up(raw.drop("rank"), sources).where("kind is not null")
    floor = F.when(F.col("kind") == registry.DOCUMENT, cfg.document_min_words).otherwise(cfg.sentence_min_words)
    df = known.withColumn("text", clean_text(F.col("text"), cfg.max_repeated_run))
    df = df.withColumn("content_hash", T.content_hash(F.col("text"))).withColumn("id", T.make_doc_id(F.col("source"), F.col("content_hash")))
    df = df.withColumn("reason", gate(F.col("text"), floor, cfg.ufffd_reject_ratio)).withColumn("symbol_ratio", T.symbol_ratio(F.col("text")).cast("float"))
    flags = F.when(F.col("reason").isNull(), review_flags(F.col("text"), F.col("symbol_ratio"), cfg.symbol_ratio_review)).otherwise(F.array(F.col("reason")))
    df = df.withColumn("flags", flags)
    df = df.withColumn("disposition", flag_for_review(reject(F.lit("kept"), F.col("reason")), F.col("flags")))
    return mark_exact_duplicates(df)


def mark_exact_duplicates(df: DataFrame) -> DataFrame:
    """Of rows with equal content_hash and no reason, those after the first get one; rejected rows meet no one."""
    names = df.columns
    d = with_first(df.withColumn("_key", F.when(F.col("reason").isNull(), F.col("content_hash"))), "_key", "id")
    d = d.withColumn("_again", ~is_first()).withColumn("duplicate_of", F.when(F.col("_again"), F.col("_first.id")))
    d = d.withColumn("reason", F.when(F.col("_again"), "exact_duplicate_after_clean").otherwise(F.col("reason")))
    return d.withColumn("disposition", reject(F.col("disposition"), F.col("reason"))).select(*names, "duplicate_of")


def unknown_sources(raw: DataFrame, sources: list[registry.Source]) -> DataFrame:
    return registry.look_up(raw.drop("rank"), sources).where("kind is null").select(*raw.columns)


__all__ = ["add_flags", "clean", "clean_text", "gate", "mark_exact_duplicates", "review_flags", "tidy", "unknown_sources"]
