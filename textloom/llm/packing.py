"""Packing of documents along a space-filling curve."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.llm.common import VOCAB, lean, pieces, text_key, tiktoken_encoding, whole_tokens
from textloom.storage import written

DIMS, BITS, SCALE = 4, 12, 4096  # curve dimensions; bits of each; fixed point of coordinates, so that sums are exact
BUCKETS = 1 << 16


@functools.cache
def _directions(seed: int = 7) -> np.ndarray:
    """A random direction for each of the hashed vector's places."""
    return np.random.default_rng(seed).standard_normal((BUCKETS, DIMS)).astype(np.float32)


class Looks(dict):
    """Pre-token to (its tokens) * 2^17 + (its place in the hashed vector, or BUCKETS for one that is no word)."""

    def __init__(self, path: str, whole: frozenset[str], most: int = 300_000):
        super().__init__()
        self.enc, self.whole, self.most = tiktoken_encoding(path), whole, most

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.most:
            self.clear()
        word = piece.strip().lower()
        tokens = 1 if piece in self.whole else len(self.enc.encode_ordinary(piece))
        made = self[piece] = tokens << 17 | (crc32(word.encode()) % BUCKETS if word else BUCKETS)
        return made

    def of(self, texts: list[str]) -> np.ndarray:
        """Rows (tokens, x0, x1, ...) of ``texts``, each cut once: the count, and the hashed vector of the pre-tokens
        in lower case without spaces (counts damped by a root, length 1) projected, in fixed-point numbers."""
        codes: list[int] = []
        times: list[int] = []
        sizes = []
        for t in texts:
            found = Counter(pieces(t))
            codes += map(self.__getitem__, found)
            times += found.values()
            sizes.append(len(found))
        code, n = np.array(codes, np.int64), np.array(times, np.int64)
        doc = np.repeat(np.arange(len(texts)), sizes)
        out = np.zeros((len(texts), 1 + DIMS), np.int64)
        np.add.at(out[:, 0], doc, (code >> 17) * n)
        place = code & (1 << 17) - 1
        spot, at = np.unique((doc * (BUCKETS + 1) + place)[place < BUCKETS], return_inverse=True)
        v = np.sqrt(np.bincount(at, n[place < BUCKETS], len(spot)))
        doc, place = np.divmod(spot, BUCKETS + 1)
        long = np.sqrt(np.bincount(doc, v * v, len(texts)))
        v /= long[doc]
        for d, way in enumerate(_directions().T):
            out[:, 1 + d] = np.rint(np.bincount(doc, v * way[place], len(texts)) * SCALE)
        return out


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of rows of ``bits``-bit cell numbers (Skilling's transposition, all rows at once)."""
    x = [c.astype(np.int64) for c in cells.T]
    n = len(x)
    q = 1 << bits - 1
    while q > 1:
        p = q - 1
        for i in range(n):
            up = (x[i] & q) != 0
            t = (x[0] ^ x[i]) & p
            x[0] = np.where(up, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] = np.where(up, x[i], x[i] ^ t)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << bits - 1
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x = [c ^ t for c in x]
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | (c >> b & 1)
    return key


def cells(coords: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """Coordinates to cell numbers: through the logistic curve next to the normal distribution, so that cells fill evenly."""
    u = 1 / (1 + np.exp(-1.702 * (coords - mean) / np.where(sd > 0, sd, 1)))
    return np.clip((u * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)


def pack(docs: DataFrame, capacity: int = 2048, id_col: str = "doc_id", text: str = "text", vocab: str = VOCAB) -> DataFrame:
    """``(pack_id, place, doc_id, doc_from, doc_to, pack_from)``: which tokens of which document stand where.

    Documents are ordered along the Hilbert curve (ties by id, null last, then by content, then by place) and
    laid end to end; pack p holds tokens p*capacity up to (p+1)*capacity of that run, so every pack but
    the last is full, and a document that crosses a border goes on in the next pack. ``place`` numbers
    the pieces in a pack from 0.

    Only (id, content key, token count, coordinates) leave the first pass; they are written to the
    shared folder, ranged by key and numbered there, so texts are never shuffled. Mean and spread
    of the coordinates come from all documents, summed as whole numbers. Null and empty texts have
    no tokens and are in no pack; repeated rows are packed as often as they occur; very long texts are
    cut whole and cross as many packs as they need; other columns are not read; an empty table gives no packs.
    """
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t")).where("t is not null and t <> ''")
    fields = "n long, " + ", ".join(f"x{i} long" for i in range(DIMS))

    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(vocab))

    @F.arrow_udf(f"struct<{', '.join(f.replace(' ', ': ') for f in fields.split(', '))}>")
    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lean()
        own = Looks(vocab, whole.value)  # one for each task: workers outlive it and serve other operators
        for a in batches:
            rows = np.concatenate([np.zeros((0, 1 + DIMS), np.int64), *(own.of(a.slice(i, 256).to_pylist()) for i in range(0, len(a), 256))])
            yield pa.StructArray.from_arrays([pa.array(x) for x in rows.T], ["n", *(f"x{i}" for i in range(DIMS))])

    light = written(src.select("id", text_key("t").alias("k"), look("t").alias("s")).select("id", "k", "s.*"), "pack-documents")
    xs = [f"x{i}" for i in range(DIMS)]
    sums = light.agg(F.count("*").alias("m"), *[F.sum(x).alias(x) for x in xs], *[F.sum(F.col(x).cast("decimal(38,0)") * F.col(x)).alias(x + "2") for x in xs]).first()
    m = max(1, sums["m"])
    mean = np.array([(sums[x] or 0) / m for x in xs])
    sd = np.sqrt(np.maximum(np.array([float(sums[x + "2"] or 0) / m for x in xs]) - mean**2, 0))

    @F.arrow_udf("long")
    def curve(*cols: pa.Array) -> pa.Array:
        return pa.array(hilbert(cells(np.stack([c.to_numpy(zero_copy_only=False) for c in cols], axis=1), mean, sd)), pa.int64())

    # the place in the table is last, so that equal rows, however many, fall into several ranges
    order = [F.col("h").asc(), F.col("id").asc_nulls_last(), F.col("k").asc(), F.col("seq").asc()]
    keyed = light.select("id", "k", "n", curve(*xs).alias("h"), F.monotonically_increasing_id().alias("seq"))
    ranged = written(keyed.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "pack-ranges")
    parts = sorted((r["part"], r["n"]) for r in ranged.groupBy("part").agg(F.sum("n").alias("n")).collect())
    before, at = [], 0
    for p, n in parts:
        before.append((p, at))
        at += n
    starts = docs.sparkSession.createDataFrame(before, "part int, base long")
    w = W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    laid = (
        ranged.join(F.broadcast(starts), "part")  # one row per range partition
        .withColumn("end", F.col("base") + F.sum("n").over(w))
        .withColumn("start", F.col("end") - F.col("n"))
        .where("n > 0")
    )
    cap = F.lit(capacity).cast("long")
    pieces = laid.withColumn("pack_id", F.explode(F.sequence(F.expr(f"start div {capacity}"), F.expr(f"(end - 1) div {capacity}"))))
    pieces = pieces.select(
        "pack_id",
        F.col("id").alias("doc_id"),
        (F.greatest("start", F.col("pack_id") * cap) - F.col("start")).alias("doc_from"),
        (F.least("end", (F.col("pack_id") + 1) * cap) - F.col("start")).alias("doc_to"),
        (F.greatest("start", F.col("pack_id") * cap) - F.col("pack_id") * cap).alias("pack_from"),
    )
    place = F.row_number().over(W.partitionBy("pack_id").orderBy("pack_from")) - 1
    return pieces.withColumn("place", place).select("pack_id", "place", "doc_id", "doc_from", "doc_to", "pack_from")
