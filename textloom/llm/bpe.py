"""BPE encoding and decoding with content-defined chunk reuse."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import _L, _N, _UNKNOWN, _WHITE, VOCAB, Encoder, encoder, packed, ranks, row_hash, slices
from textloom.operators.skew import dealt, hot_keys, repeated
from textloom.storage import written

#: Chunks are cut where a rolling hash of 32 bytes has MASK_BITS low zeros, within these sizes.
LEAST, MOST, MASK_BITS = 256, 8192, 9
_GEAR = np.array([(lambda z: (z ^ (z >> 29)) & 0xFFFFFFFF)((i + 1) * 0x9E3779B97F4A7C15 * (2 * i + 1) >> 13) for i in range(256)], np.uint32)
_O = rf"^{_L}{_N}{_WHITE}{_UNKNOWN}\U00010000-\U0010ffff"  # other signs that are known
#: A place where a pre-token ends whatever stands around it: before white space after anything else, and
#: between letters, digits and other signs, but not after an apostrophe, which may begin a contraction.
_SAFE = re.compile(rf"(?<=[{_L}{_N}])[{_WHITE}]|(?<=[{_O}])[{_WHITE}{_N}]|(?<=[{_L}{_N}])[{_O}]|(?<=[{_L}])[{_N}]|(?<=[{_N}])[{_L}]|(?<=[{_O}'])(?<!')[{_L}]")


def _rolled(b: np.ndarray) -> np.ndarray:
    """The places after which the rolling hash of the last 32 bytes has MASK_BITS low zeros."""
    h = _GEAR[b]
    for s in (1, 2, 4, 8, 16):
        h[s:] += h[:-s] << np.uint32(s)
    return np.flatnonzero(h & np.uint32((1 << MASK_BITS) - 1) == 0) + 1


def _ends(b: np.ndarray, marks: list[int], lo: int, hi: int) -> list[int]:
    """Ends of the chunks of the text at b[lo:hi], which has ``marks``."""
    ends, at = [], lo

    def cut(c: int) -> int:
        while c < hi and b[c] & 0xC0 == 0x80:
            c += 1
        if c < hi:
            ends.append(c)
        return c

    for m in [*marks, hi]:
        while m - at > MOST:
            at = cut(at + MOST)
        if m - at >= LEAST and m < hi:
            at = cut(m)
    return [*ends, hi] if at < hi else ends


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of UTF-8 ``data``; they depend on nearby content alone and split no character."""
    b = np.frombuffer(data, np.uint8)
    return _ends(b, _rolled(b).tolist(), 0, len(b))


def chunks(text: str) -> list[bytes]:
    data, at, out = text.encode("utf-8"), 0, []
    for c in cuts(data):
        out.append(data[at:c])
        at = c
    return out


def _first_agreed(e: Encoder, part: str, ids: bytes) -> tuple[int, int] | None:
    """The first safe place of ``part``, and how many bytes of its ``ids`` spell what is before it."""
    for m in _SAFE.finditer(part):
        head = e.raw(part[: m.start()])
        if ids.startswith(head):
            return m.start(), len(head)
    return None


def _last_agreed(e: Encoder, part: str, ids: bytes) -> tuple[int, int] | None:
    """The last safe place of ``part``, and how many bytes of its ``ids`` spell what is after it."""
    start = len(part)
    for back in (48, 1024, len(part)):
        stop, start = start, max(0, len(part) - back)
        for m in reversed([*_SAFE.finditer(part, start, stop)]):
            tail = e.raw(part[m.start() :])
            if ids.endswith(tail):
                return m.start(), len(tail)
    return None


def join_spans(e: Encoder, spans: list[tuple[str, bytes | None]]) -> bytes:
    """Ids of the spans' joined text, from the ids that each has by itself (None: it has none yet).

    At a join, the text from the last safe place of the left side to the first safe place of the
    right side is encoded anew. The places hold only if the ids that each side has there are exactly
    those of its tail and head; else the next place is tried. A side without a place becomes part of
    the window, and windows that meet are one, so no character is encoded more than three times.
    """
    out: list[bytes] = []
    window: list[str] = []
    for k, (part, ids) in enumerate(spans):
        first = (0, 0) if k == 0 else ids is not None and _first_agreed(e, part, ids)
        last = (len(part), 0) if k == len(spans) - 1 else ids is not None and _last_agreed(e, part, ids)
        if ids is None or not first or not last or first[0] > last[0]:
            window.append(part)
            continue
        window.append(part[: first[0]])
        out += [e.raw("".join(window)), ids[first[1] : len(ids) - last[1]]]
        window = [part[last[0] :]]
    return b"".join([*out, e.raw("".join(window))])


def encode_with(e: Encoder, data: bytes, known: list[tuple[int, int, bytes]]) -> bytes:
    """Ids of UTF-8 ``data``; ``known`` has (place, length, ids) of chunks, in any order, repeated or not."""
    spans: list[tuple[str, bytes | None]] = []
    at = 0
    for lo, n, ids in sorted(known):
        if lo >= at:
            if lo > at:
                spans.append((data[at:lo].decode(), None))
            spans.append((data[lo : lo + n].decode(), ids))
            at = lo + n
    if at < len(data) or not spans:
        spans.append((data[at:].decode(), None))
    return join_spans(e, spans)


def _flat(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes behind an array of strings, and where each one ends (one more than there are)."""
    a = a.cast(pa.large_binary())
    _, off, data = a.buffers()
    ends = np.frombuffer(off, np.int64)[a.offset : a.offset + len(a) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), ends


def bpe_encode(docs: DataFrame, text: str = "text", out: str = "token_ids", vocab: str = VOCAB, hot_share: float = 1 / 2000, hot_least: int = 1000) -> DataFrame:
    """``docs`` with ``out``, the ids of each whole text (array<int>), equal to encoding it in one go.

    1. Texts are cut into content-defined chunks; rows (text key, place, length, chunk key, copies) are
       shuffled by content key, so copies of a text count but are kept once, then by chunk key: chunks
       that occur more than once, in copies of one text too, are shared. No text moves here.
    2. Each shared chunk is encoded once, in one text that holds it.
    3. Every text gets the ids of its shared chunks, encodes what isn't shared and repairs the joins.

    Texts are shuffled once (both uses share the exchange) by a 128-bit content key and a salt. What is
    hot, by ``hot_share`` of all rows and at least ``hot_least``, is salted, so no task gets much more: texts
    that hold such a chunk are dealt out by their keys, copies of such a text by a hash of their other
    columns, and the ids are repeated for every salt. Of the keys that are hot, at most 1 / hot_share, a
    table (key, salts) is broadcast.

    Null text gives null ids, empty text an empty array, an empty table an empty result; nulls
    elsewhere are kept, repeated rows and other columns too. Very long texts are whole, in time linear in
    their length. A column named ``out`` (in any case) is replaced, at the end.
    """
    keyed, unpack = packed(docs, text, drop=tuple(c for c in docs.columns if c.lower() == out.lower()), more=[row_hash(docs, text).alias("h")])

    def mark(batches):
        for b in batches:
            keys = b.column(0).to_pylist()
            copies = Counter(keys)
            for lo in range(0, len(b), 512):
                part = b.column(1).slice(lo, 512)
                data, ends = _flat(part)
                base, rows = int(ends[0]), []
                data, ends = data[base : int(ends[-1])], (ends - base).tolist()
                marks = _rolled(data)
                held = memoryview(data)
                for i, (p, q) in enumerate(zip(ends, ends[1:])):
                    if p < q and (m := copies.pop(keys[lo + i], 0)):
                        at = p
                        for c in _ends(data, marks[slice(*np.searchsorted(marks, (p + 32, q)))].tolist(), p, q):
                            rows.append((keys[lo + i], at - p, c - at, xxhash.xxh3_128_digest(held[at:c]), m))
                            at = c
                cols = list(zip(*rows)) if rows else [[]] * 5
                kinds = (pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["k", "at", "n", "ck", "m"])

    found = keyed.where("t is not null").select("k", "t").mapInArrow(mark, "k binary, at int, n int, ck binary, m long")
    rows = written(found.groupBy("k", "at", "n", "ck").agg(F.sum("m").alias("m")), "chunks")
    holders = rows.groupBy("ck").agg(F.sum("m").alias("times"), F.count("*").alias("texts"), F.min(F.struct("k", "at", "n")).alias("first"))
    shared = written(holders.where("times > 1").select("ck", "texts", "first.*"), "shared-chunks")

    size = rows.agg(F.count("*").alias("rows"), F.sum(F.when(F.col("at") == 0, F.col("m"))).alias("texts")).first()
    many = hot_keys(rows.where("at = 0"), "k", "m", size["texts"] or 0, hot_share, hot_least)
    salted = dealt(keyed, many, "k", F.col("h")).drop("h")

    # of a hot text that isn't dealt to salt 0 no chunk is encoded here: step 3 does without
    owners = shared.groupBy("k").agg(F.collect_list(F.struct("at", "n", "ck")).alias("own")).withColumn("salt", F.least(F.size("own"), F.lit(0)))  # 0, in a way that keeps it a key of the join
    owning = salted.join(owners.hint("shuffle_hash"), ["k", "salt"])  # all columns, else the exchange isn't the one of step 3
    key_at, text_at, own_at = map(owning.columns.index, ("k", "t", "own"))

    kind = "<u2" if max(ranks(vocab).values()) < 1 << 16 else "<u4"  # how shared ids travel

    def once(batches):
        e, seen = encoder(vocab), set()
        for b in batches:
            for s in slices(b, 64):
                cks, ids = [], []
                for k, t, own in zip(s.column(key_at).to_pylist(), s.column(text_at).cast(pa.large_binary()).to_pylist(), s.column(own_at).to_pylist()):
                    if k not in seen:
                        seen.add(k)
                        for o in own:
                            cks.append(o["ck"])
                            ids.append(np.frombuffer(e.raw(t[o["at"] : o["at"] + o["n"]].decode()), "<u4").astype(kind).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(cks, pa.binary()), pa.array(ids, pa.binary())], names=["ck", "ids"])

    encoded = owning.mapInArrow(once, "ck binary, ids binary")
    wide = hot_keys(shared, "ck", "texts", size["rows"], hot_share, hot_least)
    each = repeated(encoded, wide, "ck", "turn")
    place = dealt(rows, wide, "ck", F.xxhash64("k"), "turn")
    place = repeated(place.select("ck", "turn", "k", "at", "n"), many, "k")
    known = place.join(each, ["ck", "turn"]).groupBy("k", "salt").agg(F.collect_list(F.struct("at", "n", "ids")).alias("known"))

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array, known: pa.Array) -> pa.Array:
        e, made = encoder(vocab), []
        for lo in range(0, max(1, len(texts)), 256):
            got = []
            for t, ks in zip(texts.slice(lo, 256).cast(pa.large_binary()).to_pylist(), known.slice(lo, 256).to_pylist()):
                got.append(None if t is None else encode_with(e, t, [(x["at"], x["n"], np.frombuffer(x["ids"], kind).astype("<u4").tobytes()) for x in ks or ()]))
            ends = np.cumsum([0, *(len(g) // 4 if g else 0 for g in got)])
            flat = pa.array(np.frombuffer(b"".join(filter(None, got)), "<i4"))
            made.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=pa.array([g is None for g in got], pa.bool_())))
        return pa.concat_arrays(made)

    full = salted.join(known.hint("shuffle_hash"), ["k", "salt"], "left")
    return full.select(*unpack, encode("t", "known").alias(out))


def bpe_decode(df: DataFrame, ids: str = "token_ids", out: str = "decoded", vocab: str = VOCAB) -> DataFrame:
    """``df`` with ``out``, the text that the ids spell. Null ids give null, no ids the empty text, ids outside the vocabulary U+FFFD."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        e, got = encoder(vocab), []
        for lo in range(0, max(1, len(lists)), 256):
            part = lists.slice(lo, 256)
            at = part.offsets.to_numpy()
            flat = part.values.slice(at[0], at[-1] - at[0])
            flat = flat.to_numpy(zero_copy_only=False) if not flat.null_count else np.nan_to_num(flat.to_numpy(zero_copy_only=False), nan=-1)
            flat = np.where((flat < 0) | (flat > 2**32 - 1), 2**32 - 1, flat).astype("<u4")
            at = (at - at[0]).tolist()
            got.append(pa.array([e.decode(flat[p:q].tobytes()) if v else None for p, q, v in zip(at, at[1:], part.is_valid().to_pylist())], pa.string()))
        return pa.concat_arrays(got)

    kind = df.schema[ids].dataType.simpleString()
    return df.withColumn(out, decode(F.col(f"`{ids}`") if kind in ("array<int>", "array<bigint>") else F.col(f"`{ids}`").cast("array<bigint>")))
