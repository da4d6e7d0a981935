"""Counts of what each stage took, kept and dropped, as long tables and as text."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Audit signs: name -> pattern (of Java and RE2 alike) in the raw text.
AUDIT = {
    "url": r"https?://|www\.", "escaped_newline": r"\\n", "url_mark": "⟨url⟩", "foreign_en": r"(?i)\b(the|and|with)\b", "boilerplate": r"(?i)click here|read more|all rights reserved",
    "pipe_nav": r" \| ", "ellipsis": r"\[(…|\.\.\.)\]", "wordpress": r"(?i)wp-content|wordpress", "arabic": "[؀-ۿ]{3,}", "html_tag": r"</?[A-Za-z][A-Za-z0-9]*[^>]*>",
    "mojibake": "Ã|â€", "nbsp": " ", "php": r"<\?php", "smart_quotes": "[“”‘’]",
}


def audit(df: DataFrame, text: str = "text") -> DataFrame:
    """One wide aggregation: documents that show each sign, then (sign, docs, share)."""
    n = df.agg(F.count("*").alias("total"), *[F.count_if(F.col(text).rlike(p)).alias(k) for k, p in AUDIT.items()])
    return n.selectExpr(f"stack({len(AUDIT)}, {', '.join(f'{k!r}, {k}' for k in AUDIT)}) as (sign, docs)", "total").select("sign", "docs", F.round(F.col("docs") / F.col("total"), 6).alias("share"))


def audit_repeated_sentences(df: DataFrame, text: str = "text") -> DataFrame:
    """Documents in which some sentence of five words or more stands twice."""
    s = F.filter(F.transform(F.split(text, r"[.!?\n]+"), F.trim), lambda x: F.size(F.split(x, " ")) >= 5)
    return df.agg(F.count_if(F.size(s) > F.size(F.array_distinct(s))).alias("docs"))


def by_source_and_reason(df: DataFrame, reason: str = "reason") -> DataFrame:
    """Rows of each source, each reason, both, and all (nulls where a column is rolled up)."""
    out = df.groupingSets([["source", reason], ["source"], [reason], []], "source", reason).agg(F.count("*").alias("n"), F.grouping_id().alias("level"))
    return out.select("source", F.col(reason).alias("reason"), "level", "n")


def flow(taken: DataFrame, kept: DataFrame, source: str = "source") -> DataFrame:
    """Per source: input, kept and dropped (never below 0), for sources of either side."""
    a = taken.groupBy(source).agg(F.count("*").alias("input"))
    b = kept.groupBy(source).agg(F.count("*").alias("kept"))
    both = a.join(b, source, "full").select(source, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("input", "kept")])
    return both.withColumn("dropped", F.greatest(F.col("input") - F.col("kept"), F.lit(0)))


def funnel(stages: list[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """(stage, input, kept, dropped, drop_rate) in order, and a last row overall from first input to last kept."""
    spark = stages[0][1].sparkSession
    rows = [(name, a.count(), b.count()) for name, a, b in stages]
    rows.append(("overall", rows[0][1], rows[-1][2]))
    out = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "step int, stage string, input long, kept long")
    return out.withColumn("dropped", F.col("input") - F.col("kept")).withColumn("drop_rate", F.round(F.coalesce(F.col("dropped") / F.nullif(F.col("input"), F.lit(0)), F.lit(0.0)), 6))


def flags(df: DataFrame, column: str = "flags") -> DataFrame:
    return df.select(F.explode(column).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def corpus_stats(df: DataFrame, words: Column, text: str = "text", source: str = "source") -> DataFrame:
    """Documents, words, characters and mean length per source and (null source) over all."""
    return df.rollup(source).agg(F.count("*").alias("docs"), F.sum(words).alias("words"), F.sum(F.length(text)).alias("chars"), F.round(F.avg(F.length(text)), 6).alias("mean_chars"))


def thousands(n: int) -> str:
    return f"{n:,}"


def percent(part: float, whole: float) -> str:
    return f"{100 * part / whole if whole else 0:.1f}%"


def as_markdown(df: DataFrame, title: str) -> str:
    """A small report table as markdown."""
    rows = df.collect()
    show = lambda v: "" if v is None else thousands(v) if isinstance(v, int) else str(v)
    lines = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(map(show, r)) + " |" for r in rows)]) + "\n"


def as_json(df: DataFrame) -> str:
    return json.dumps([r.asDict(recursive=True) for r in df.collect()], indent=2, ensure_ascii=False, default=str)


def preview(df: DataFrame, reason: str, n: int = 10, seed: int = 0, column: str = "reason") -> DataFrame:
    """``n`` dropped rows of one reason, drawn by hash."""
    return df.where(F.col(column) == reason).orderBy(F.xxhash64(F.lit(seed), "text"), "text").limit(n)
