"""Exact dedup of incoming documents against immutable snapshots, screened by binary-fuse filters."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.llm.common import packed, row_hash, text_key
from textloom.operators.skew import dealt, hot_keys, repeated
from textloom.storage import work_path, written

_HEAD = struct.Struct("<QII")
_U = np.uint64


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys ^ _U(seed)
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


class BinaryFuse:
    """A static filter of 64-bit keys: three places and an 8-bit fingerprint each, about 9 bits a key.

    It never misses a key and says yes to about 1 in 256 others.
    """

    def __init__(self, seed: int, length: int, segments: int, prints: np.ndarray):
        self.seed, self.length, self.segments, self.prints = seed, length, segments, prints

    def _places(self, h: np.ndarray) -> np.ndarray:
        span, low = _U(self.segments * self.length), _U(self.length - 1)
        first = ((h >> _U(32)) * span) >> _U(32)
        second = (first + _U(self.length)) ^ ((h >> _U(18)) & low)
        third = (first + _U(2 * self.length)) ^ (h & low)
        return np.stack([first, second, third]).astype(np.int64)

    @staticmethod
    def _print(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> _U(32))) & _U(255)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> "BinaryFuse":
        keys = np.unique(np.asarray(keys, np.uint64))
        n = len(keys)
        if n < 2:
            length, segments = 4, 1
        else:
            length = 1 << min(18, int(np.log(n) / np.log(3.33) + 2.25))
            size = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n)))
            segments = max(1, -(-size // length) - 2)
        for seed in range(1, 200):
            f = cls(seed * 0x9E3779B97F4A7C15 % 2**64, length, segments, np.zeros((segments + 2) * length, np.uint8))
            if f._fill(keys):
                return f
        raise RuntimeError("no seed peels these keys")

    def _fill(self, keys: np.ndarray) -> bool:
        """Peels keys that are alone at a place, all such keys at once a round, then assigns in reverse."""
        h = _mix(keys, self.seed)
        places, prints = self._places(h), self._print(h)
        size, ids = len(self.prints), np.arange(len(keys))
        count = np.bincount(places.ravel(), minlength=size)
        held = np.zeros(size, np.int64)
        for p in places:
            np.bitwise_xor.at(held, p, ids)
        rounds, left = [], len(keys)
        alone = np.flatnonzero(count == 1)
        while len(alone):
            own, first = np.unique(held[alone], return_index=True)
            at = alone[first]
            rounds.append((own, at))
            left -= len(own)
            around = places[:, own]
            for p in around:
                np.subtract.at(count, p, 1)
                np.bitwise_xor.at(held, p, own)
            near = np.unique(around)
            alone = near[count[near] == 1]
        if left:
            return False
        for own, at in reversed(rounds):
            a, b, c = self.prints[places[:, own]]
            self.prints[at] = prints[own] ^ a ^ b ^ c ^ self.prints[at]
        return True

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        h = _mix(np.asarray(keys, np.uint64), self.seed)
        a, b, c = self.prints[self._places(h)]
        return a ^ b ^ c == self._print(h)

    def dump(self) -> bytes:
        return _HEAD.pack(self.seed, self.length, self.segments) + self.prints.tobytes()

    @classmethod
    def load(cls, data: bytes) -> "BinaryFuse":
        seed, length, segments = _HEAD.unpack_from(data)
        return cls(seed, length, segments, np.frombuffer(data, np.uint8, offset=_HEAD.size))


def _low64(digests: pa.ChunkedArray) -> np.ndarray:
    return np.array([int.from_bytes(d[:8], "little") for d in digests.to_pylist()], np.uint64)


def build_filters(digests: DataFrame, path: str, per_filter: int = 500_000) -> None:
    """Writes the filters of an immutable snapshot's distinct digests ``k`` at ``path``, once: (bucket, buckets, filter).

    A path that is taken is an error, since filters never change; new rows make a new snapshot.
    """
    buckets = max(1, -(-digests.count() // per_filter))

    def make(t: pa.Table) -> pa.Table:
        f = BinaryFuse.build(_low64(t["k"]))
        return pa.table({"bucket": pa.array([t["bucket"][0].as_py()], pa.int32()), "buckets": pa.array([buckets], pa.int32()), "filter": pa.array([f.dump()], pa.binary())})

    rows = digests.select("k", _bucket(buckets).alias("bucket"))
    rows.groupBy("bucket").applyInArrow(make, "bucket int, buckets int, filter binary").write.mode("error").parquet(path)


def load_filters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("k"), F.lit(buckets)).cast("int")


def screen(incoming: DataFrame, snapshots: list[DataFrame], per_task: int = 500_000) -> DataFrame:
    """The distinct incoming digests ``k`` that some snapshot's filters don't rule out.

    A snapshot's filters go where their bucket's digests are. However many more digests come in than a
    snapshot has, no task gets more than about ``per_task``: a bucket is dealt out in turns, its filter to each.
    """
    n, out = incoming.count(), None

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"k": pa.array([], pa.binary())})
        yes = BinaryFuse.load(right["filter"][0].as_py()).may_hold(_low64(left["k"]))
        return pa.table({"k": left["k"].combine_chunks().cast(pa.binary()).filter(pa.array(yes))})

    for filters in snapshots:
        first = filters.select("buckets").first()
        if first is None:
            continue
        buckets = first["buckets"]
        turns = max(1, -(-n // (buckets * per_task)))
        rows = incoming.select("k", _bucket(buckets).alias("bucket"), F.pmod(F.hash("k"), F.lit(turns)).alias("turn"))
        each = filters.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
        part = rows.groupBy("bucket", "turn").cogroup(each.groupBy("bucket", "turn")).applyInArrow(probe, "k binary")
        out = part if out is None else out.union(part)
    return incoming.select("k").limit(0) if out is None else out if len(snapshots) == 1 else out.distinct()


def _suspects(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Digests ``k`` that more than one document may share, found without moving any text; and those of them that are hot.

    The snapshot's filters are built from its digests; the batch's digests, once each, are screened by
    them, and only what passes is joined with the snapshot's digests.
    """
    spark = keyed.sparkSession
    light = keyed.where("t is not null")
    tally = lambda side: written(light.where(side).groupBy("k").agg(F.count("*").alias("n")), "digests")
    snapshot, batch = tally("not incoming"), tally("incoming")
    path = work_path(spark, "fuse-filters")
    build_filters(snapshot.select("k"), path)
    positives = screen(batch.select("k"), [load_filters(spark, path)])
    known = positives.join(snapshot.select("k"), "k", "left_semi")  # exact buckets
    within = snapshot.where("n > 1").select("k").union(batch.where("n > 1").select("k"))
    total = snapshot.union(batch).agg(F.sum("n")).first()[0] or 0
    counts = snapshot.union(batch).where("n > 1").groupBy("k").agg(F.sum("n").alias("n"))
    return written(known.union(within).distinct(), "suspect-digests"), hot_keys(counts, "k", "n", total)


def _shared(keyed: DataFrame, suspects: DataFrame, hot: DataFrame) -> DataFrame:
    """The rows of suspect digests: all columns, where they are met by a join that no hot digest overloads."""
    return dealt(keyed.where("t is not null"), hot, "k", F.col("h")).join(repeated(suspects, hot, "k").hint("shuffle_hash"), ["k", "salt"], "left_semi")


def _order(*more: Column) -> Column:
    """Snapshot before batch, then the least id, null last."""
    return F.struct(F.col("incoming"), F.col("id").isNull().alias("void"), F.col("id"), *more)


def mark_duplicates(docs: DataFrame, incoming: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, kept_id, is_duplicate)`` for every row.

    Rows where ``incoming`` is not true are the snapshot, the rest the new batch. The snapshot's
    digests get static filters; the batch's digests, once each, are screened by them; what passes is
    joined with the snapshot's exact digests; duplicates within the batch are grouped by themselves.
    Only texts of suspect digests are compared, byte by byte, as keys of an aggregation that combines
    copies where they are read, so a hot text leaves each task once. Rows then meet the first row of
    their digest, hot digests dealt out over tasks; digests that different texts share, if any, are
    decided by text.

    The first of equal texts stays: snapshot before batch, then the least id (null ids last). Null texts
    are never duplicates; empty texts equal each other; of rows that are wholly equal all but one are
    duplicates. Very long texts are compared whole. Other columns don't matter, whatever their names
    and types. An empty table gives no rows.
    """
    keyed = _keyed(docs, incoming, id_col, text)[0].drop("r")
    suspects, hot = _suspects(keyed)
    same = _shared(keyed, suspects, hot).groupBy("k", "t").agg(F.min(_order()).alias("first"))
    firsts = written(same.groupBy("k").agg(F.count("*").alias("texts"), F.min("first").alias("first")), "exact-groups")
    rows = keyed.select("k", "incoming", "id", "h", F.col("t").isNull().alias("void"))
    met = dealt(rows.where("not void"), hot, "k", F.col("h")).join(repeated(firsts, hot, "k"), ["k", "salt"], "left")
    plain = met.where("texts is null or texts = 1").select("k", "id", "first", (F.col("first").isNull() | (_order() == F.col("first"))).alias("best"))
    # of rows equal in all that decides, one stays: their number is enough to make them again
    ties = written(plain.where("best and first is not null").groupBy("k").agg(F.count("*").alias("n"), F.any_value("first").alias("first")).where("n > 1"), "exact-ties")
    step = 1_000_000
    again = ties.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(step).cast("long")))).repartition("k", "lo")
    again = again.select("first.id", F.explode(F.sequence(F.col("lo"), F.least(F.col("lo") + step, "n") - 1)).alias("i"))
    single = plain.where("not best or first is null").select("id", F.coalesce(F.col("first.id"), F.when(F.col("first").isNull(), F.col("id"))).alias("kept_id"), (~F.col("best")).alias("is_duplicate"))
    one = plain.where("best and first is not null").join(ties.select("k"), "k", "left_anti").select("id", F.col("id").alias("kept_id"), F.lit(False).alias("is_duplicate"))
    out = single.unionByName(one).unionByName(again.select("id", F.col("id").alias("kept_id"), (F.col("i") > 0).alias("is_duplicate")))
    out = out.unionByName(rows.where("void").select("id", F.col("id").alias("kept_id"), F.lit(False).alias("is_duplicate")))
    clash = firsts.where("texts > 1").select("k")
    if not clash.isEmpty():  # different texts of one digest
        w = W.partitionBy("k", "t").orderBy("incoming", F.col("id").asc_nulls_last())
        apart = keyed.join(clash, "k", "left_semi").select("id", F.first("id").over(w).alias("kept_id"), (F.row_number().over(w) > 1).alias("is_duplicate"))
        out = out.unionByName(apart)
    return out.withColumnRenamed("id", "doc_id")


def drop_duplicates(docs: DataFrame, incoming: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that ``mark_duplicates`` doesn't call duplicates, all columns.

    Of each text, the first row is found by an aggregation that combines copies where they are; of rows
    that are equal in what decides, the one with the least hash of its other columns stays.
    """
    keyed, unpack = _keyed(docs, incoming, id_col, text)
    suspects, hot = _suspects(keyed)
    first = F.min_by("r", _order(F.col("h"))).alias("r")
    checked = _shared(keyed, suspects, hot).groupBy("k", "t").agg(first)
    alone = dealt(keyed.where("t is not null"), hot, "k", F.col("h")).join(repeated(suspects, hot, "k").hint("shuffle_hash"), ["k", "salt"], "left_anti")
    parts = [checked, alone, keyed.where("t is null")]
    return parts[0].select(*unpack).unionByName(parts[1].select(*unpack)).unionByName(parts[2].select(*unpack))


def _keyed(docs: DataFrame, incoming: Column, id_col: str, text: str) -> tuple[DataFrame, list[Column]]:
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("none")]
    df = docs.select(
        F.col(f"`{text}`").cast("string").alias("t"),
        F.coalesce(incoming, F.lit(False)).alias("incoming"),
        F.col(f"`{id_col}`").alias("id"),
        row_hash(docs, text).alias("h"),
        F.struct(*rest).alias("r"),
    )
    return df.select(text_key("t").alias("k"), "*"), packed(docs, text)[1]
