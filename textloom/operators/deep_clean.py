"""Second cleaning: markup, boilerplate lines, contacts, repeated paragraphs, language of segments, heuristics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.config import DeepClean
from textloom.functions import text as T
from textloom.functions.udfs import Detector, source_repair, target_share
from textloom.operators.clean import tidy
from textloom.operators.lid import WRONG
from textloom.registry import DOCUMENT
from textloom.schema import add_flags, flag_for_review, reject


def html_policy(c: Column, reject_active: bool = True, strip_benign: bool = True) -> tuple[Column, Column]:
    """(text, reason)."""
    reason = F.when(T.has_active_html(c), "html_remnant") if reject_active else F.lit(None).cast("string")
    return (T.strip_benign_tags(c) if strip_benign else c), reason


def heuristics(c: Column, is_document: Column, symbols: Column, cfg: DeepClean) -> Column:
    """First reason that holds for the finished text; null if none."""
    return (
        F.when(is_document & (T.word_count(c) > cfg.max_document_words), "too_long")
        .when(symbols > cfg.symbol_ratio_reject, "high_symbol_ratio")
        .when(is_document & T.mostly_numbers(c), "mostly_numbers")
        .when(T.has_html_remnant(c), "html_remnant")
    )


def deep_clean(df: DataFrame, cfg: DeepClean = DeepClean(), detector: Detector | None = None, target: str = "so", max_run: int = 3) -> DataFrame:
    """Rows (source, kind, lid_policy, text, content_hash, flags, disposition) with the cleaned text and ``deep_reason``.

    Rows rejected before pass through untouched. The first step that fails rejects. Rejects for
    markup, boilerplate or language keep the text they came with; those of the final heuristics
    carry the new one. The content hash follows the text, the id stays. Unknown kinds count as documents.
    """
    old = df.where("disposition = 'rejected'").withColumn("deep_reason", F.lit(None).cast("string"))
    d = df.where("disposition <> 'rejected'")
    fixed = source_repair(F.col("text"), F.col("source"), cfg.unescape_sources, cfg.strip_fragment_sources, cfg.mojibake_max_passes)
    d = d.withColumn("_t", fixed)
    stripped = T.strip_stray_ufffd(T.strip_invisibles(F.col("_t"))) if cfg.strip_stray_ufffd else T.strip_invisibles(F.col("_t"))
    d = d.withColumn("_t", tidy(stripped, max_run))
    text, bad = html_policy(F.col("_t"), cfg.reject_script_html, cfg.strip_benign_html)
    d = d.withColumn("_r", bad).withColumn("_t", T.normalize_whitespace(text))
    if cfg.boilerplate_line_drop:
        text, share = T.boilerplate_lines(F.col("_t"), cfg.function_words)
        d = d.withColumn("_r", F.coalesce("_r", F.when(share > cfg.boilerplate_reject_ratio, "boilerplate"))).withColumn("_t", text)
    d = d.withColumn("_t", T.mask_contacts(F.col("_t"), cfg.mask_urls, cfg.mask_emails))
    if cfg.paragraph_dedup:
        d = d.withColumn("_t", T.dedup_paragraphs(F.col("_t"), cfg.paragraph_jaccard_tau, cfg.paragraph_separator))
    d = d.withColumn("_t", T.normalize_whitespace(F.col("_t")))
    is_document = F.coalesce(F.col("kind"), F.lit(DOCUMENT)) == DOCUMENT
    if cfg.segment_lid and detector is not None:
        gated = F.col("_r").isNull() & is_document & (F.coalesce("lid_policy", F.lit("gate")) == "gate")
        # Only rows that still stand go through Python. A filter on them would be pushed below, and every step with it.
        share = target_share(F.when(gated, F.col("_t")), detector, target, cfg.segment_min_confidence, cfg.segment_clip_bytes, cfg.paragraph_separator)
        d = d.withColumn("_s", share).withColumn("_r", F.coalesce("_r", F.when(F.col("_s") < cfg.min_target_char_frac, WRONG))).drop("_s")
    early = F.col("_r").isNotNull()
    symbols = T.symbol_ratio(F.col("_t"))
    d = d.withColumn("_symbols", symbols)
    d = d.withColumn("deep_reason", F.coalesce(F.col("_r"), heuristics(F.col("_t"), is_document, F.col("_symbols"), cfg)))
    d = d.withColumn("text", F.when(early, F.col("text")).otherwise(F.col("_t")))
    d = d.withColumn("content_hash", F.when(early, F.col("content_hash")).otherwise(T.content_hash(F.col("text"))))
    review = F.when(F.col("deep_reason").isNull() & (F.col("_symbols") > cfg.symbol_ratio_review), F.lit("high_symbol_ratio"))
    d = d.withColumn("flags", add_flags(F.col("flags"), F.array(F.col("deep_reason"), review)))
    d = d.withColumn("disposition", flag_for_review(reject(F.col("disposition"), F.col("deep_reason")), F.col("flags")))
    return d.drop("_t", "_r", "_symbols").unionByName(old)
