"""Language gate and its benchmark."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions.udfs import BACKENDS, Detector, detect, grams
from textloom.schema import reject

WRONG, UNSURE = "not_somali", "low_lang_score"


def gate_reason(code: Column, conf: Column, policy: Column, target: str, least: float) -> Column:
    """Null where a row stays. Only the policy tag_only never rejects; an unknown policy gates."""
    gated = F.coalesce(policy, F.lit("gate")) != "tag_only"
    right = code.eqNullSafe(F.lit(target))
    return F.when(gated & ~right, WRONG).when(gated & (conf < least), UNSURE)


def apply_gate(df: DataFrame, detector: Detector, target: str, least: float = 0.5, clip_bytes: int = 2000, policy: str = "lid_policy") -> DataFrame:
    """Rows with lang, lang_score, lid_reason, and disposition by them."""
    d = df.withColumn("_d", detect(F.col("text"), detector, clip_bytes))
    d = d.withColumn("lang", F.coalesce("_d.code", F.lit("und"))).withColumn("lang_score", F.coalesce("_d.conf", F.lit(0.0)).cast("float"))
    d = d.withColumn("lid_reason", gate_reason(F.col("_d.code"), F.col("_d.conf"), F.col(policy), target, least)).drop("_d")
    return d.withColumn("disposition", reject(F.col("disposition"), F.col("lid_reason"))) if "disposition" in df.columns else d


def dropped_languages(gated: DataFrame, target: str) -> DataFrame:
    name = F.when(F.col("lid_reason") == UNSURE, f"{target}_low_conf").otherwise(F.col("lang"))
    return gated.where("lid_reason is not null").groupBy(name.alias("lang")).agg(F.count("*").alias("n"))


def train(df: DataFrame, backend: str = "ngram_bayes", text: str = "text", lang: str = "lang", most: int = 5000) -> Detector:
    """A detector from all rows with a language: trigrams are counted per partition and summed in the
    cluster; the ``most`` commonest of each language reach the driver."""

    def count(batches):
        sums: dict[str, Counter] = {}
        for b in batches:
            for code, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums.setdefault(code, Counter()).update(grams(t))
        rows = [(code, g, n) for code, c in sums.items() for g, n in c.items()]
        cols = list(zip(*rows)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], names=["lang", "g", "n"])

    rows = df.select(F.col(lang).alias("lang"), F.col(text).alias("t")).where("lang is not null and t is not null")
    sums = rows.mapInArrow(count, "lang string, g string, n long").groupBy("lang", "g").agg(F.sum("n").alias("n"))
    top = sums.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "g"))).where(F.col("r") <= most)
    counts: dict[str, Counter] = {}
    for r in top.collect():
        counts.setdefault(r["lang"], Counter())[r["g"]] = r["n"]
    return BACKENDS[backend](counts)


def evaluate(df: DataFrame, said: str, truth: str, target: str, text: str = "text") -> DataFrame:
    """TP, FP, FN, precision and recall for the target language, by length bucket and (null bucket) over all."""
    is_, says = F.col(truth).eqNullSafe(F.lit(target)), F.col(said).eqNullSafe(F.lit(target))
    tp, fp, fn = F.count_if(is_ & says), F.count_if(~is_ & says), F.count_if(is_ & ~says)
    ratio = lambda a, b: F.round(F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0)), 6)
    out = df.withColumn("bucket", T.length_bucket(T.word_count(F.col(text)))).rollup("bucket").agg(F.count("*").alias("n"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    return out.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
