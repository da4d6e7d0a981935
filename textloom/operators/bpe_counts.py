"""Counts for subword vocabularies, and token/word ratios of a given tokenizer."""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.batches import in_parts

SPECIALS = ("<pad>", "<unk>", "<s>", "</s>", "<mask>")


def word_counts(df: DataFrame, text: str = "text", min_freq: int = 2) -> DataFrame:
    """``(word, n)`` of runs of word characters and runs of other signs, as white-space pre-tokenizers split them."""
    ws = F.regexp_extract_all(F.col(text), F.lit(r"(?U)(\w+|[^\w\s]+)"), F.lit(1))
    return df.select(F.explode(ws).alias("word")).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_freq)


def pair_counts(words: DataFrame) -> DataFrame:
    """``(left, right, n)`` of neighbouring characters, weighted by word counts: the first step of merging."""
    chars = words.where(F.length("word") > 1).select("n", F.expr("transform(sequence(1, length(word) - 1), i -> struct(substring(word, i, 1) as left, substring(word, i + 1, 1) as right))").alias("ps"))
    return chars.select("n", F.explode("ps").alias("p")).groupBy("p.left", "p.right").agg(F.sum("n").alias("n"))


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def _encoded(path: str, take, kind: pa.DataType, c: Column, ddl: str, most: int = 1 << 17) -> Column:
    """``take`` of the ids of each text. An encoding takes some hundred times its text's bytes, so only ``most`` bytes of texts are encoded at a time."""

    @F.arrow_udf(ddl)
    def run(a: pa.Array) -> pa.Array:
        def make(texts: list) -> pa.Array:
            got = _tokenizer(path).encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
            return pa.array([None if t is None else take(g) for t, g in zip(texts, got)], kind)

        return in_parts(make, kind, a, most=most)

    return run(c)


def encode(c: Column, path: str) -> Column:
    """Ids by a tokenizer file, a small part of a batch at a time."""
    return _encoded(path, lambda g: g.ids, pa.list_(pa.int32()), c, "array<int>")


def token_count(c: Column, path: str) -> Column:
    """How many ids ``encode`` gives, without them."""
    return _encoded(path, len, pa.int32(), c, "int")


def token_word_ratio(tokens: Column, words: Column) -> Column:
    """Null where either is 0."""
    return F.when((tokens > 0) & (words > 0), tokens / words)
