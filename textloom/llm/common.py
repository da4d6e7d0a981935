"""The tokenizer that the operators share, and small helpers."""

from __future__ import annotations

import base64
import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.batches import lean

VOCAB = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Pre-tokens of byte-level BPE as tiktoken wants them.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same pre-tokens for the standard library, with the classes spelled out for the first 65,536 code points.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _spelled(kinds: tuple[str, ...], but: str = "") -> str:
    """A character class (without brackets) of the code points below 65,536 whose category starts with one of ``kinds``."""
    out, start = [], None
    for i in range(0x10001):
        c = chr(i)
        if i < 0x10000 and unicodedata.category(c).startswith(kinds) and c not in but:
            start = i if start is None else start
        elif start is not None:
            out.append(f"\\u{start:04x}" + (f"-\\u{i - 1:04x}" if i - 1 > start else ""))
            start = None
    return "".join(out)


_L, _N, _UNKNOWN = _spelled(("L",)), _spelled(("N",)), _spelled(("Cn", "Cs"))
_PRE = re.compile(rf" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[{_N}]+| ?[^{_WHITE}{_L}{_N}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
#: Code points that _PRE can't place: those beyond its classes, and those that this Python doesn't know.
_RARE = re.compile(rf"[{_UNKNOWN}\U00010000-\U0010ffff]")
#: Where a pre-token ends whatever stands around: white space after anything else.
_BORDER = re.compile(rf"(?<=[^{_WHITE}{_UNKNOWN}\U00010000-\U0010ffff])(?=[{_WHITE}])")


def pieces(text: str) -> list[str]:
    """The pre-tokens of ``text``; a word with a character unknown to this Python comes whole, for the encoder to cut."""
    if text.isascii() or not (rare := set(_RARE.findall(text))):
        return _PRE.findall(text)
    kinds = {c: unicodedata.category(c) for c in rare}
    unknown = [c for c, k in kinds.items() if k in ("Cn", "Cs")]
    if unknown:
        out: list[str] = []
        for part in _BORDER.split(text):
            out += [part] if any(c in part for c in unknown) else pieces(part)
        return out
    # stand-ins of the same kind, one for one
    proxy = text.translate({ord(c): "A" if k[0] == "L" else "0" if k[0] == "N" else "!" for c, k in kinds.items()})
    return [text[m.start() : m.end()] for m in _PRE.finditer(proxy)]


@functools.cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.cache
def tiktoken_encoding(path: str):
    import tiktoken

    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={})


@functools.cache
def whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings that are proved to encode, alone, as the one token that spells them.

    A string that is one pre-token and one token counts 1 wherever it is a pre-token, since merges
    never cross pre-tokens. The driver proves them once and broadcasts them; their number is bounded
    by the vocabulary's.
    """
    enc, proved = tiktoken_encoding(path), set()
    for raw, i in ranks(path).items():
        try:
            s = raw.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if not _RARE.search(s) and pieces(s) == [s] and enc.encode_ordinary(s) == [i]:
            proved.add(s)
    return frozenset(proved)


class _Pieces(dict):
    """Pre-token to what ``of`` makes of its ids, kept for at most ``most`` pre-tokens at a time."""

    def __init__(self, path: str, of, most: int):
        super().__init__()
        self.enc, self.of, self.most = tiktoken_encoding(path), of, most

    def __missing__(self, piece: str):
        if len(self) >= self.most:
            self.clear()
        made = self[piece] = self.of(self.enc.encode_ordinary(piece))
        return made


class Encoder:
    """Byte-level BPE of one vocabulary. Ids come as little-endian uint32 bytes, the quickest thing to join."""

    def __init__(self, path: str = VOCAB, most: int = 300_000):
        self.path, self.enc = path, tiktoken_encoding(path)
        self._ids = _Pieces(path, lambda ids: np.array(ids, "<u4").tobytes(), most)

    def raw(self, text: str) -> bytes:
        """Ids of ``text``: equal to encoding it whole."""
        return b"".join(map(self._ids.__getitem__, pieces(text)))

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.raw(text), "<u4")

    def decode(self, ids: bytes) -> str:
        """Text of ids; ids outside the vocabulary and broken UTF-8 become U+FFFD."""
        table, n = _spelling(self.path)
        found = np.minimum(np.frombuffer(ids, "<u4"), n).tolist()
        return b"".join(map(table.__getitem__, found)).decode("utf-8", "replace")


@functools.cache
def _spelling(path: str) -> tuple[list[bytes], int]:
    back = {i: b for b, i in ranks(path).items()}
    n = max(back) + 1
    return [back.get(i, b"\xef\xbf\xbd") for i in range(n + 1)], n


@functools.cache
def encoder(path: str = VOCAB) -> Encoder:
    """One encoder, with its cache, for each Python worker."""
    return Encoder(path)


class Counter9(_Pieces):
    """Pre-token to its number of tokens: proved whole tokens from the start, the rest merged when met."""

    def __init__(self, path: str, whole: frozenset[str], most: int = 400_000):
        super().__init__(path, len, most)
        self.whole = whole
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.update(dict.fromkeys(self.whole, 1))

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, pieces(text)))


_counters: dict[str, Counter9] = {}


def counter(path: str, whole: frozenset[str]) -> Counter9:
    """One counter, with its cache, for each Python worker."""
    if path not in _counters:
        _counters[path] = Counter9(path, whole)
    return _counters[path]


def slices(b: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in slices, so that what Python makes of it at a time stays small whatever its texts' lengths."""
    lean()
    for i in range(0, len(b), rows):
        yield b.slice(i, rows)


def few(a: pa.Array, rows: int = 256) -> Iterator:
    """The items of an array, of which no more than ``rows`` are Python objects at a time."""
    lean()
    for i in range(0, len(a), rows):
        yield from a.slice(i, rows).to_pylist()


def text_key(text: str | Column) -> Column:
    """128-bit key of a text's content, never null (a null text has the key of no text)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.unhex(F.md5(c.cast("string"))), F.lit(bytearray(b"\0" * 16)))


def packed(docs: DataFrame, text: str, drop: tuple[str, ...] = (), more: list[Column] = []) -> tuple[DataFrame, list[Column]]:
    """``(k, t, r)`` and ``more``: content key, text as string, and all other columns in one struct, so no name can clash.

    Also the columns that give the input's own columns back, in order, without those in ``drop``.
    """
    names = [c for c in docs.columns if c not in drop]
    rest = [F.col(f"`{c}`") for c in names if c != text] or [F.lit(0).alias("none")]
    t = F.col(f"`{text}`").cast("string")
    df = docs.select(text_key(t).alias("k"), t.alias("t"), F.struct(*rest).alias("r"), *more)
    return df, [F.col("t").alias(c) if c == text else F.col(f"r.`{c}`").alias(c) for c in names]


def row_hash(docs: DataFrame, but: str) -> Column:
    """A hash of a row's plain columns but one, to deal rows out by; types that have no hash don't count."""
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.name != but and not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType))]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("long")


def free_name(taken: list[str], wish: str) -> str:
    """``wish``, or a name made from it that no column has (names are compared without case)."""
    low = {c.lower() for c in taken}
    while wish.lower() in low:
        wish = "_" + wish
    return wish

