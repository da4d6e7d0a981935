"""Deterministic samples, threshold sweeps and what they recommend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.storage import written

THRESHOLDS = (10, 20, 25, 50, 75)


def reservoir(df: DataFrame, n: int, key: str, seed: int = 42, by: str | None = None) -> DataFrame:
    """``n`` rows (of each group) with the least hash of seed and key: uniform, and the same wherever it runs."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    if by is None:
        return df.orderBy(h, key).limit(n)
    return df.withColumn("_r", F.row_number().over(W.partitionBy(by).orderBy(h, key))).where(F.col("_r") <= n).drop("_r")


def min_word_sweep(df: DataFrame, thresholds: tuple[int, ...] = THRESHOLDS, text: str = "text") -> DataFrame:
    """(threshold, source, total, rejects, reject_pct) and, with null source, over all: one pass for every threshold."""
    w = df.select("source", T.word_count(F.col(text)).alias("w"))
    sums = w.rollup("source").agg(F.count("*").alias("total"), *[F.count_if(F.col("w") < t).alias(f"t{t}") for t in thresholds])
    stack = ", ".join(f"{t}, t{t}" for t in thresholds)
    return sums.selectExpr("source", "total", f"stack({len(thresholds)}, {stack}) as (threshold, rejects)").select(
        "threshold", "source", "total", "rejects", F.round(100 * F.col("rejects") / F.col("total"), 6).alias("reject_pct")
    )


def recommend(df: DataFrame, thresholds: tuple[int, ...] = THRESHOLDS, sample: int = 100, text: str = "text", key: str = "doc_id", seed: int = 0) -> DataFrame:
    """Scores each threshold: a share of rejects near 5-15 %, noise among a sample of them, no heavy loss; the best is marked.

    Ties go to the lower threshold.
    """
    overall = min_word_sweep(df, thresholds, text).where("source is null").select("threshold", "reject_pct")
    short = df.select(key, text, T.word_count(F.col(text)).alias("w")).withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds)))).where("w < threshold")
    drawn = reservoir(short, sample, key, seed, by="threshold")
    noise = drawn.groupBy("threshold").agg(F.round(100 * F.count_if(T.noise_score(F.col(text))["score"] >= 2) / F.count("*"), 6).alias("noise_pct"))
    p = F.col("reject_pct")
    score = F.when(p.between(5, 15), F.lit(3.0)).otherwise(-F.abs(p - 9)) + F.coalesce("noise_pct", F.lit(0.0)) / 25 + F.when(p > 20, -5.0).otherwise(0.0)
    out = overall.join(noise, "threshold", "left").withColumn("noise_pct", F.coalesce("noise_pct", F.lit(0.0))).withColumn("score", F.round(score, 6))
    return out.withColumn("best", F.row_number().over(W.orderBy(F.desc("score"), "threshold")) == 1)  # one row a threshold


def at_ranks(df: DataFrame, value: str, ranks: list[int]) -> list[float]:
    """The values at the given places, from 0, of the sorted non-null ``value``.

    Equal values are counted first, then dealt out by range: a place is found by the counts of the
    ranges, and looked up in the one range that holds it. No task holds all values.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    ranged = written(counts.repartitionByRange(value).withColumn("part", F.spark_partition_id()), "ranged-values")
    sizes = [(r["part"], r["n"]) for r in ranged.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()]
    out = []
    for rank in ranks:
        for part, n in sizes:
            if rank < n:
                break
            rank -= n
        upto = ranged.where(F.col("part") == part).select(value, F.sum("n").over(W.partitionBy("part").orderBy(value)).alias("upto"))
        out.append(upto.where(F.col("upto") > rank).agg(F.min(value)).first()[0])
    return out


def ratio_summary(df: DataFrame, ratio: str) -> DataFrame:
    """n, mean, median and the 95th of the sorted ratios at place round(0.95 (n-1)), halves to even."""
    r = df.where(F.col(ratio).isNotNull()).select(ratio)
    n = r.count()
    low, high, p95 = at_ranks(r, ratio, [(n - 1) // 2, n // 2, round(0.95 * (n - 1))]) if n else (None, None, None)  # Python rounds halves to even
    middle = F.lit(None if n == 0 else low + (high - low) / 2).cast("double")
    return r.agg(F.count("*").alias("n"), F.round(F.avg(ratio), 6).alias("mean"), F.round(middle, 6).alias("median"), F.round(F.lit(p95).cast("double"), 6).alias("p95"))
