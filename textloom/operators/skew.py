"""Joins and first-wins choices that no hot key overloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.storage import written


def hot_keys(counts: DataFrame, key: str, n: str, total: int, share: float = 1 / 2000, least: int = 100_000) -> DataFrame:
    """``(key, salts)`` of the keys with more than ``share`` of ``total`` rows and than ``least``: 1 / share of them at most, so it is broadcast."""
    most = max(least, int(total * share))
    hot = counts.where(F.col(n) > most).select(key, F.ceil(F.col(n) / most).cast("int").alias("salts"))
    return F.broadcast(written(hot, "hot-keys"))


def dealt(df: DataFrame, hot: DataFrame, key: str, by: Column, salt: str = "salt") -> DataFrame:
    """``df`` with a ``salt``: for hot keys by the hash ``by``, else 0."""
    return df.join(hot, key, "left").withColumn(salt, F.coalesce(F.pmod(by, F.col("salts")), F.lit(0)).cast("int")).drop("salts")


def repeated(df: DataFrame, hot: DataFrame, key: str, salt: str = "salt") -> DataFrame:
    """``df`` once for every ``salt`` of its key."""
    return df.join(hot, key, "left").withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")


def with_first(df: DataFrame, key: str, take: str, least: int = 100_000) -> DataFrame:
    """``df`` (rank, ordinal, ...) with ``_first``: struct(rank, ordinal, ``take``) of the first row of its key, null where the key is there once or null.

    ``df`` is written once. The first rows come from an aggregation of narrow rows, combined where they
    are read; only keys that repeat are joined back, hot ones dealt out by place. Places are unique.
    """
    df = written(df, "keyed-rows")
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"), F.min(F.struct("rank", "ordinal", take)).alias("_first"))
    firsts = written(counts.where("_n > 1"), "first-rows")
    hot = hot_keys(firsts, key, "_n", firsts.agg(F.sum("_n")).first()[0] or 0, least=least)
    once = repeated(firsts.drop("_n"), hot, key, "_salt")
    return dealt(df, hot, key, F.xxhash64("ordinal"), "_salt").join(once, [key, "_salt"], "left").drop("_salt")


def is_first() -> Column:
    """Whether a row of ``with_first`` is the first of its key."""
    return F.col("_first").isNull() | ((F.col("_first.rank") == F.col("rank")) & (F.col("_first.ordinal") == F.col("ordinal")))
