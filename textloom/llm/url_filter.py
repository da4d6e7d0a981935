"""URL filters over a sorted array of 64-bit digests, memory-mapped by the executors."""

from __future__ import annotations

import functools
import os
import re
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.storage import mounted, work_path

SEED = 42  # that of Spark's xxhash64, so digests can be made on either side
#: Hosts that are blocked unless a list is given: gambling, spam, pills, adult content, trackers.
BLOCKED_HOSTS = ["casino-win.example.com", "free-bets.example.com", "spam-farm.example.com", "cheap-pills.example.com", "adult-x.example.net", "ads-track.example.com"]
_SCHEME = re.compile(r"[a-z][a-z0-9+.\-]*:", re.I)
_URL = re.compile(r"(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^:/?#]*)(?::\d*)?([^?#]*)(\?[^#]*)?", re.S)
_PORT = re.compile(r"\d+(?:[/?#]|\Z)")


def digest(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "replace"), SEED)


def candidates(url: str) -> list[str]:
    """The entries that would block ``url``, the most special first: host/path?query, host and each path
    above it, the host, each domain above it (of two labels or more). Hosts are lower case, without user,
    port, final dot; the scheme, if any, and the fragment don't count, backslashes are slashes."""
    rest = url.strip()
    scheme = _SCHEME.match(rest)
    if scheme and not ("." in scheme[0] and _PORT.match(rest, scheme.end())):  # host:port has no scheme
        rest = rest[scheme.end() :]
    cut = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    rest = rest[:cut].replace("\\", "/").lstrip("/") + rest[cut:]  # browsers take these for slashes, and any number of them
    host, path, query = _URL.match(rest).groups()
    host = host.lower().rstrip(".")
    if not host:
        return []
    path, out = path.rstrip("/"), []
    if query:
        out.append(host + path + query)
    while path:
        out.append(host + path)
        path = path[: path.rfind("/")]
    out.append(host)
    labels = host.split(".")
    if not host.startswith("[") and not host.replace(".", "").isdigit():
        out += [".".join(labels[i:]) for i in range(1, len(labels) - 1)]
    return out


def build(entries: DataFrame, path: str, column: str = "entry", per_shard: int = 2_000_000) -> str:
    """Writes the filter of ``entries`` (hosts, host/path prefixes, or URLs) under ``path``, a shared folder.

    Entries are range-sorted by digest in the cluster; each partition is a shard of three files (sorted
    digests, offsets, full strings), renamed into place when whole. Null and empty entries are left
    out, repeated ones kept once.
    """
    os.makedirs(mounted(path), exist_ok=True)
    folder = mounted(path)

    @F.arrow_udf("string")
    def normal(a: pa.Array) -> pa.Array:
        return pa.array([(candidates(x) or [None])[0] for x in a.to_pylist()], pa.string())

    rows = entries.select(F.col(column).cast("string").alias("e")).where("e is not null").select(normal("e").alias("e")).where("e <> ''").distinct()
    n = rows.count()
    # Signed order: the range partitioner sorts longs, and so does the probe.
    spread = rows.select(F.xxhash64("e").alias("h"), "e").repartitionByRange(max(1, -(-n // per_shard)), "h").sortWithinPartitions("h", "e")

    def shard(batches):
        keys, texts = [], []
        for b in batches:
            keys += b.column(0).to_pylist()
            texts += [x.encode("utf-8", "replace") for x in b.column(1).to_pylist()]
        name = f"{TaskContext.get().partitionId():06d}"
        if keys:
            ends = np.cumsum([0, *map(len, texts)], dtype=np.int64)
            for kind, data in (("strings", b"".join(texts)), ("ends", ends.tobytes()), ("keys", np.array(keys, np.int64).tobytes())):
                temp = os.path.join(folder, f"{uuid.uuid4().hex}.tmp")
                with open(temp, "wb") as f:
                    f.write(data)
                os.replace(temp, os.path.join(folder, f"{name}.{kind}"))
        yield pa.RecordBatch.from_arrays([pa.array([len(keys)], pa.int64())], names=["n"])

    spread.mapInArrow(shard, "n long").agg(F.sum("n")).collect()
    return path


class Probe:
    """The shards of one filter, memory-mapped."""

    def __init__(self, folder: str):
        names = sorted(f[:-5] for f in os.listdir(folder) if f.endswith(".keys"))
        self.shards = []
        for n in names:
            keys = np.memmap(os.path.join(folder, f"{n}.keys"), np.int64, "r")
            self.shards.append((keys, np.memmap(os.path.join(folder, f"{n}.ends"), np.int64, "r"), np.memmap(os.path.join(folder, f"{n}.strings"), np.uint8, "r")))
        self.shards.sort(key=lambda s: int(s[0][0]))
        self.firsts = np.array([int(s[0][0]) for s in self.shards], np.int64)

    def holds(self, texts: list[str], hashes: np.ndarray | None = None) -> np.ndarray:
        """Which of ``texts`` are entries: one binary search for all, then full strings are compared."""
        found = np.zeros(len(texts), bool)
        if not self.shards or not texts:
            return found
        h = np.array([digest(t) for t in texts], np.uint64).view(np.int64) if hashes is None else hashes
        home = np.searchsorted(self.firsts, h, "right") - 1
        for s in np.unique(home[home >= 0]):
            keys, ends, strings = self.shards[s]
            mine = np.flatnonzero(home == s)
            at = np.searchsorted(keys, h[mine], "left")
            ok = at < len(keys)
            ok[ok] = keys[at[ok]] == h[mine][ok]
            for i, k in zip(mine[ok].tolist(), at[ok].tolist()):
                want = texts[i].encode("utf-8", "replace")
                while k < len(keys) and keys[k] == h[i]:  # entries that share a digest stand side by side
                    if strings[ends[k] : ends[k + 1]].tobytes() == want:
                        found[i] = True
                        break
                    k += 1
        return found


@functools.lru_cache(maxsize=4)
def _probe(folder: str) -> Probe:
    return Probe(folder)


def match_urls(df: DataFrame, path: str, url: str = "url", out: str = "matched") -> DataFrame:
    """``df`` with ``out``: the most special entry of the filter under ``path`` that covers the URL, else null.

    A map over the rows, no shuffle. Null, empty and unparsable URLs match nothing; repeated rows
    match alike; other columns are kept, one named ``out`` is replaced.
    """
    folder = mounted(path)

    @F.arrow_udf("string")
    def probe(a: pa.Array) -> pa.Array:
        p, texts, rows = _probe(folder), [], []
        urls = a.to_pylist()
        for i, u in enumerate(urls):
            if u:
                c = candidates(u)
                texts += c
                rows += [i] * len(c)
        got: list[str | None] = [None] * len(urls)
        for j in reversed(np.flatnonzero(p.holds(texts)).tolist()):
            got[rows[j]] = texts[j]
        return pa.array(got, pa.string())

    return df.withColumn(out, probe(F.col(f"`{url}`").cast("string")))


def block_hosts(spark: SparkSession, df: DataFrame, entries: list[str] = BLOCKED_HOSTS, url: str = "url", out: str = "matched") -> DataFrame:
    """``match_urls`` with a filter built from a list of entries."""
    path = build(spark.createDataFrame([(e,) for e in entries], "entry string"), work_path(spark, "urls"))
    return match_urls(df, path, url, out)
