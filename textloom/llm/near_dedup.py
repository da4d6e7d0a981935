"""Near-duplicate documents by Order MinHash, verified by banded alignment."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.llm.common import packed, slices, text_key
from textloom.operators.components import connected_components
from textloom.storage import written

K, SKETCHES, PICKED = 3, 32, 2
FLAGS, BLOCK = 1024, 4000
WINDOWED = 4096  # words from which on alignment makes bits for one band at a time
PART, PARTS = 100_000, 100_000  # a bucket with more rows than PART, and than one in PARTS of all rows, is split
TINY, SHORT = 8, 31  # most words of texts with keys by deletion, and of those with a key for each k-mer
THRESHOLD = 0.75
_RNG = np.random.default_rng(20_24)
_MUL = _RNG.integers(1, 2**63, SKETCHES, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(1, 2**63, SKETCHES, np.uint64)
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def words(text: str) -> list[str]:
    return text.lower().split()


class _Hashes(dict):
    def __missing__(self, w: str) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        return h


_hashes = _Hashes()


def _forget() -> None:
    """Empties the worker's cache once a task is done, since workers outlive it and serve other operators."""
    _hashes.clear()  # here, as a nested function that is sent to workers would clear a copy of it


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _C2
    h = (h ^ (h >> np.uint64(27))) * _C3
    return h ^ (h >> np.uint64(31))


def kmers(ws: list[str], k: int = K) -> np.ndarray:
    """Hashes of the word k-mers in text order, each labelled with how often it has occurred before."""
    n = len(ws)
    k = min(k, n)
    h = np.fromiter(map(_hashes.__getitem__, ws), np.uint64, n)
    g = h[: n - k + 1].copy()
    for j in range(1, k):
        g = _mix(g) * _C1 + h[j : n - k + 1 + j]
    g = _mix(g)
    order = np.argsort(g, kind="stable")
    s = g[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    run = np.arange(len(s)) - np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    seen = np.empty(len(s), np.uint64)
    seen[order] = run
    return _mix(g + seen * _C1)


def sketch(ws: list[str]) -> np.ndarray:
    """SKETCHES bucket keys: for each hash function, the PICKED least labelled k-mers in their text order."""
    g = kmers(ws)
    out = np.empty(SKETCHES, np.uint64)
    step = max(1, 2_000_000 // len(g))
    for lo in range(0, SKETCHES, step):
        v = g[None, :] * _MUL[lo : lo + step, None] + _ADD[lo : lo + step, None]
        v ^= v >> np.uint64(32)
        rows = np.arange(len(v))
        at = []
        for _ in range(min(PICKED, len(g))):
            a = v.argmin(axis=1)
            at.append(a)
            v[rows, a] = np.uint64(2**64 - 1)
        key = np.arange(lo, lo + len(v)).astype(np.uint64)
        for a in np.sort(np.stack(at), axis=0):
            key = _mix(key * _C1 + g[a])
        out[lo : lo + step] = key
    return out


class _Whole:
    """Where words stand in a text, as one integer a word; for short texts."""

    def __init__(self, ws: list[str], width: int):
        self.full, self.where = (1 << width) - 1, {}
        for i, w in enumerate(ws):
            self.where[w] = self.where.get(w, 0) | 1 << i

    def at(self, w: str, start: int) -> int:
        """The bits of the places from ``start`` on, as many as the band is wide."""
        x = self.where.get(w, 0)
        return (x >> start if start >= 0 else x << -start) & self.full


class _Places:
    """The same from lists of places: bits are made for one band at a time, so memory follows the text's length."""

    def __init__(self, ws: list[str], width: int):
        self.width, self.where = width, {}
        for i, w in enumerate(ws):
            self.where.setdefault(w, []).append(i)

    def at(self, w: str, start: int) -> int:
        places = self.where.get(w)
        if not places:
            return 0
        lo, hi = bisect_left(places, start), bisect_left(places, start + self.width)
        if hi - lo <= 12:
            x = 0
            for p in places[lo:hi]:
                x |= 1 << p - start
            return x
        on = np.zeros(self.width, bool)
        on[np.array(places[lo:hi]) - start] = True
        return int.from_bytes(np.packbits(on, bitorder="little").tobytes(), "little")


def banded_distance(a: list[str], b: list[str], most: int) -> int:
    """Word edit distance of ``a`` and ``b`` if it is at most ``most``, else ``most + 1``.

    Bit-parallel alignment in a band: the column of vertical differences is kept as the bits of one
    integer that slides along the diagonal, ``most`` cells to either side.
    """
    if len(a) < len(b):
        a, b = b, a
    lo = 0
    while lo < len(b) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < len(b) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    m, n = len(a), len(b)
    if m - n > most:
        return most + 1
    if not n or most >= m:
        most_here = min(most, m)
        if not n:
            return m if m <= most else most + 1
        if most_here == m:
            return min(_distance(a, b), most + 1)
    width = 2 * most + 2
    full, top = (1 << width) - 1, 1 << width - 1
    vp, vn = full << width - most - 1 & full, 0
    dist, start = most, most + 1 - width
    low = 1 << width - 2
    seen = _Places(a, width) if m > WINDOWED else _Whole(a, width)
    for i, w in enumerate(b):
        x = seen.at(w, start)
        d0 = ((((x & vp) + vp) ^ vp) | x | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        if i < m - most:
            dist += not d0 & top
        else:
            dist += bool(hp & low)
            dist -= bool(hn & low)
            low >>= 1
        vp = (hn | ~((d0 >> 1) | hp)) & full
        vn = (d0 >> 1) & hp
        start += 1
    return dist if dist <= most else most + 1


def _distance(a: list[str], b: list[str]) -> int:
    """The same without a band, for short texts."""
    where: dict[str, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    m = len(a)
    full, top = (1 << m) - 1, 1 << m - 1
    vp, vn, dist = full, 0, m
    for w in b:
        x = where.get(w, 0) | vn
        d0 = ((((x & vp) + vp) ^ vp) | x) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        dist += bool(hp & top) - bool(hn & top)
        hp = (hp << 1 | 1) & full
        vn = d0 & hp
        vp = (hn << 1 | ~(d0 | hp)) & full
    return dist


def similar(a: list[str], b: list[str], threshold: float) -> bool:
    """Whether 1 - edit distance / longer length reaches ``threshold``. Bands are tried from narrow to wide."""
    n = max(len(a), len(b))
    most = int((1 - threshold) * n + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    band = 128
    while band < most:
        if band >= abs(len(a) - len(b)) and banded_distance(a, b, band) <= band:
            return True
        band *= 6
    return banded_distance(a, b, most) <= most


def short_keys(ws: list[str], threshold: float) -> np.ndarray:
    """More bucket keys for texts of up to SHORT words, whose sketches may share nothing with a near text's.

    Two texts of up to TINY words within the edit budget agree after deleting as many words as the budget
    from each. If the longer has more than TINY words, d <= n / 4 edits leave at least n - d words in at
    most d + 1 runs, thus a run of K words: at thresholds from 0.75 on, no pair up to SHORT words is missed.
    """
    n, keys = len(ws), []
    if n <= TINY:
        kept = {c for d in range(int((1 - threshold) * n + 1e-9) + 1) for c in combinations(ws, n - d)}
        keys.append(np.array([xxhash.xxh64_intdigest(" ".join(c).encode("utf-8", "surrogatepass"), 1) for c in sorted(kept)], np.uint64))
    if threshold * (TINY + 1) - 1e-9 <= n <= SHORT:
        keys.append(np.unique(kmers(ws)))
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def _flags(ws: list[str]) -> bytes:
    """FLAGS bits: those that a text's words, each labelled by occurrence, are hashed to."""
    on = np.zeros(FLAGS, bool)
    on[(kmers(ws, 1) % np.uint64(FLAGS)).astype(np.int64)] = True
    return np.packbits(on).tobytes()


def _met(keys: pa.Array, n: np.ndarray, group: np.ndarray, flags: np.ndarray, side: np.ndarray, threshold: float, most: int | None):
    """Batches of the pairs of one block that neither lengths nor words rule out and that are in two groups.

    ``side`` is 0 and 1 where two blocks are compared with each other, all 0 for a block with itself.
    An edit takes away one labelled word at most, so texts are at least as far apart as the flags that
    one has and the other lacks. ``most`` bounds the pairs of any two groups in a strip; None: all pairs.
    """
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == side.max())
    on = np.unpackbits(flags, axis=1).astype(np.float32)
    count, other = on.sum(axis=1), on[right].T
    for lo in range(0, len(left), 256):
        l = left[lo : lo + 256]
        far = np.maximum.outer(count[l], count[right]) - on[l] @ other
        edits = np.floor((1 - threshold) * np.maximum.outer(n[l], n[right]) + 1e-9)
        ok = (far <= edits + 0.5) & (np.abs(np.subtract.outer(n[l], n[right])) <= edits) & (group[l][:, None] != group[right][None, :])
        if not side.any():
            ok &= l[:, None] < right[None, :]
        a, b = np.nonzero(ok)
        a, b = l[a], right[b]
        if most is not None and len(a):
            both = np.minimum(group[a], group[b]) * (group.max() + 1) + np.maximum(group[a], group[b])
            order = np.argsort(both, kind="stable")
            s = both[order]
            start = np.maximum.accumulate(np.where(np.concatenate([[True], s[1:] != s[:-1]]), np.arange(len(s)), 0))
            order = order[np.arange(len(s)) - start < most]
            a, b = a[order], b[order]
        if len(a):
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(a)), keys.take(pa.array(b))], names=["a", "b"])


def _apart(shared: DataFrame, hot: DataFrame, groups: DataFrame, marks: DataFrame, threshold: float, most: int | None) -> DataFrame:
    """Pairs ``(src, dst)`` that share a bucket and aren't in one group, from all pairs of each bucket.

    Buckets whose texts are all in one group are done, and so are those of up to three texts, which
    have met already (``size`` is that of the whole bucket). The rest are cut into blocks of BLOCK texts by length, and each block meets each.
    """
    placed = shared.where("size > 3").join(groups, "k", "left").select("band", "part", "k", "n", "size", "rank", F.coalesce("g", "k").alias("g"))
    mixed = _spread(placed.groupBy("band").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo <> hi").select("band"), hot)
    a_part = F.ceil(F.lit(PART) / BLOCK).cast("int")  # blocks of a part of a split bucket
    own = F.when(F.col("size") > PART, F.col("part") * a_part).otherwise(0) + F.least(F.floor(F.col("rank") / BLOCK).cast("int"), a_part - 1)
    # a part may be somewhat over PART, since rows are dealt out by hash: its last block takes the rest
    last = F.when(F.col("size") > PART, F.ceil(F.col("size") / PART).cast("int") * a_part).otherwise(F.ceil(F.col("size") / BLOCK).cast("int")) - 1
    rows = (
        placed.join(mixed, ["band", "part"], "left_semi")
        .join(marks.select("k", "flags"), "k")
        .select("band", "k", "n", "g", "flags", own.alias("own"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
        .select("band", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "k", "n", "g", "flags")
    )

    def meet(batches):
        held: list[pa.RecordBatch] = []

        def done(parts):
            t = pa.Table.from_batches(parts)
            flags = np.frombuffer(b"".join(t["flags"].to_pylist()), np.uint8).reshape(len(t), FLAGS // 8)
            group = t["g"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            side = (t["own"].to_numpy() != t["lo"].to_numpy()).astype(np.int8)
            return _met(t["k"].combine_chunks(), t["n"].to_numpy().astype(np.int64), group, flags, side, threshold, most)

        for b in batches:
            band, lo, hi = (b.column(i).to_numpy() for i in range(3))
            new = (band[1:] != band[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(b)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if held and any(held[0].column(c)[0].as_py() != b.column(c)[i].as_py() for c in range(3)):
                    yield from done(held)
                    held = []
                held.append(b.slice(i, j - i))
        if held:
            yield from done(held)

    sorted_rows = rows.repartition("band", "lo", "hi").sortWithinPartitions("band", "lo", "hi")
    return sorted_rows.mapInArrow(meet, "a binary, b binary").select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct()


def _spread(bands: DataFrame, hot: DataFrame) -> DataFrame:
    """``bands`` once for each part of a split bucket."""
    parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    return bands.join(hot, "band", "left").withColumn("part", F.explode(parts)).drop("parts", "rows")


def _aligned(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs`` (src, dst) whose texts reach ``threshold``."""

    def align(batches):
        own, bag, last = [], Counter(), None
        for b in batches:
            src, dst = [], []
            for part in slices(b, 64):
                for s, d, x, y in zip(*(part.column(i).to_pylist() for i in range(4))):
                    if s != last:
                        own, last = words(x), s
                        bag = Counter(own)
                    other = words(y)
                    n = max(len(own), len(other))
                    # words that the other lacks cost an edit each
                    if n - (bag & Counter(other)).total() <= (1 - threshold) * n + 1e-9 and similar(own, other, threshold):
                        src.append(s)
                        dst.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(src, pa.binary()), pa.array(dst, pa.binary())], names=["src", "dst"])

    one = pairs.join(texts.select(F.col("k").alias("dst"), F.col("t").alias("y")), "dst")
    both = one.join(texts.select(F.col("k").alias("src"), F.col("t").alias("x")), "src").select("src", "dst", "x", "y")
    return both.mapInArrow(align, "src binary, dst binary")


def _components(edges: DataFrame) -> DataFrame:
    return written(connected_components(edges).select(F.col("node").alias("k"), F.col("component").alias("g")), "near-groups")


def _groups(keyed: DataFrame, threshold: float) -> DataFrame:
    """``(k, g)``: content key and group of the texts that have near duplicates; exact copies share k.

    Every text with words is in SKETCHES buckets, short ones in those of ``short_keys`` too, and all texts of a bucket are compared, but for pairs
    that lengths or words rule out and those already in one group. First each text meets the first of
    its bucket and the one before it by length and key, which joins most families at a cost linear in
    the bucket. Then the groups that still share a bucket meet: by a few pairs each, then by all pairs.
    Buckets of more than PART rows are dealt out in parts by a hash of the key, for the first step too.
    """

    def mark(batches):
        for b in batches:
            seen = set()
            for part in slices(b):
                keys, sizes, flags, marks = [], [], [], []
                for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if t is None or k in seen:
                        continue
                    seen.add(k)
                    ws = words(t)
                    if ws:
                        marks.append(np.unique(np.concatenate([sketch(ws), short_keys(ws, threshold)])))
                        keys.append(k)
                        sizes.append(len(ws))
                        flags.append(_flags(ws))
                ends = np.cumsum([0, *map(len, marks)]).astype(np.int32)
                band = np.concatenate(marks).view(np.int64) if marks else np.zeros(0, np.int64)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(band))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(flags, pa.binary()), bands], names=["k", "n", "flags", "bands"])
        _forget()

    marks = written(keyed.select("k", "t").mapInArrow(mark, "k binary, n int, flags binary, bands array<long>").dropDuplicates(["k"]), "near-marks")
    rows = marks.select(F.explode("bands").alias("band"), "k", "n")
    counts = rows.groupBy("band").agg(F.count("*").alias("rows"))
    total = marks.agg(F.sum(F.size("bands"))).first()[0] or 0
    # at most PARTS rows, since each stands for that share of all
    hot = F.broadcast(written(counts.where(F.col("rows") > max(PART, total // PARTS)).select("band", "rows", F.ceil(F.col("rows") / PART).cast("int").alias("parts")), "near-hot"))
    dealt = rows.join(hot, "band", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("k"), F.col("parts")), F.lit(0)).cast("int"))
    w = W.partitionBy("band", "part")
    met = dealt.select(
        "band", "part", "k", "n", F.coalesce("rows", F.count("*").over(w)).alias("size"), (F.row_number().over(w.orderBy("n", "k")) - 1).alias("rank"),
        *[f(c).over(w.orderBy("n", "k")).alias(p + c) for p, f in (("f", F.first), ("p", F.lag)) for c in ("k", "n")],
    )
    shared = written(met.where("size > 1"), "near-buckets")
    # n is the longer of the two, since the bucket is ordered by length
    ok = lambda p: F.col(p + "k").isNotNull() & (F.col(p + "k") != F.col("k")) & (F.col(p + "n") >= F.lit(threshold) * F.col("n") - 1e-6)
    pairs = (
        shared.select("k", F.explode(F.array_distinct(F.array_compact(F.array(*[F.when(ok(p), F.col(p + "k")) for p in "fp"])))).alias("o"))
        .select(F.least("k", "o").alias("src"), F.greatest("k", "o").alias("dst"))
        .distinct()
    )
    tried = written(pairs, "near-candidates")
    needed = shared.select("k").distinct()
    texts = written(keyed.select("k", "t").join(needed.hint("shuffle_hash"), "k", "left_semi").dropDuplicates(["k"]), "near-texts")
    groups = _components(_aligned(tried, texts, threshold))
    for most in (4, None):
        found = written(_apart(shared, hot, groups, marks, threshold, most), "near-candidates")
        if found.isEmpty():
            break
        edges = written(_aligned(found.join(tried, ["src", "dst"], "left_anti"), texts, threshold), "near-edges")
        if not edges.isEmpty():
            groups = _components(edges.union(groups.select("k", "g")))
        tried = tried.union(found)
    return groups


def _order() -> list[Column]:
    """The longest text of a group stays; of equal length, the least id (null last), then the least key."""
    return [F.col("size").desc(), F.col("id").asc_nulls_last(), F.col("k").asc()]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, kept_id)`` for every row that is in a group of two or more; the row with ``kept_id`` as its own id stays.

    Similarity is that of word sequences in lower case: 1 - edit distance / longer length, at least
    ``threshold``; groups are the connected components of such pairs, exact copies included. Texts
    without words (null, empty) are in no group. Repeated rows are copies of each other, each listed.
    At thresholds from 0.75 on, pairs of texts of up to SHORT words are all found; longer ones are found if
    their sketches meet. Very long texts are sketched and aligned whole. Ties: see ``_order``. Other columns are not read;
    an empty table has no groups.
    """
    keyed = _keyed(docs, id_col, text)
    groups = _groups(keyed, threshold)
    light = keyed.select("k", "id", F.length("t").alias("size"), F.trim(F.regexp_replace("t", r"(?U)\s+", " ")).alias("w")).where("w <> ''").drop("w")
    all_rows = light.join(groups, "k", "left").select("k", "id", "size", F.coalesce("g", "k").alias("g"))
    w = W.partitionBy("g")
    first = F.first("id").over(w.orderBy(*_order()))
    return (
        all_rows.select("id", first.alias("kept_id"), F.count("*").over(w).alias("members"))
        .where("members > 1")
        .select(F.col("id").alias("doc_id"), "kept_id")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that stay: one of each group, and all rows in no group; all columns. Texts are shuffled once more."""
    _, unpack = packed(docs, text)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("none")]
    keyed = _keyed(docs, id_col, text, F.struct(*rest).alias("r"))
    groups = _groups(keyed.select("k", "id", "t"), threshold)
    sized = keyed.select("*", F.length("t").alias("size"))
    # who stays is decided on light rows; texts then meet the decision by content key
    light = sized.where(F.col("t").rlike(r"(?U)\S")).select("k", "id", "size").groupBy("k", "size").agg(F.min("id").alias("id"))
    decided = light.join(groups, "k", "left").select("k", "size", "id", F.coalesce("g", "k").alias("g"))
    best = decided.withColumn("rank", F.row_number().over(W.partitionBy("g").orderBy(*_order()))).where("rank = 1").select("k", F.col("id").alias("best"))
    there = sized.where(F.col("t").rlike(r"(?U)\S")).join(best.hint("shuffle_hash"), "k").where(F.col("id").eqNullSafe(F.col("best")))
    kept = there.dropDuplicates(["k"])
    return kept.select(*unpack).unionByName(sized.where(F.col("t").isNull() | ~F.col("t").rlike(r"(?U)\S")).select(*unpack))


def _keyed(docs: DataFrame, id_col: str, text: str, *more: Column) -> DataFrame:
    t = F.col(f"`{text}`").cast("string")
    return docs.select(text_key(t).alias("k"), F.col(f"`{id_col}`").alias("id"), t.alias("t"), *more)
