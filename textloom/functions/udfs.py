"""Text functions that Spark SQL lacks, as Arrow UDFs."""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.batches import in_parts
from textloom.functions.text import SIGNS

_ENTITY = re.compile(r"&(?:#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z][A-Za-z0-9]*);")
_ESCAPE = re.compile(r"\\([ntr\"/\\])")
_PLAIN = {"n": "\n", "t": "\t", "r": "\r"}
#: Windows-1252 as the web reads it: the five bytes without a sign stand for C1 controls.
_BYTE = {bytes([b]).decode("cp1252", "ignore") or chr(b): b for b in range(0x80, 0x100)}
_FRAGMENT_ENDS = ("\\/p>", "\\/div>", "</p>")


def _mapped(f: Callable[[str], str | None], kind: str = "string"):
    types = {"string": pa.string(), "int": pa.int32()}

    @F.arrow_udf(kind)
    def run(a: pa.Array) -> pa.Array:
        return in_parts(lambda ts: pa.array([None if x is None else f(x) for x in ts], types[kind]), types[kind], a)

    return run


def to_nfc(t: str) -> str:
    return t if t.isascii() else unicodedata.normalize("NFC", t)


def _entity(m: re.Match) -> str:
    whole = m.group()
    if whole[1] == "#":
        n = int(whole[3:-1], 16) if whole[2] in "xX" else int(whole[2:-1])
        return chr(n) if 0 < n < 0xD800 or 0xDFFF < n < 0x110000 else whole
    return html.entities.html5.get(whole[1:], whole)


def decode_once(t: str) -> str:
    """HTML entities with their semicolon, once; unknown ones stay."""
    return _ENTITY.sub(_entity, t) if "&" in t else t


def sign_total(t: str) -> int:
    return sum(map(t.count, SIGNS))


def reread(t: str) -> str | None:
    """Characters back to Windows-1252 bytes (others as their UTF-8) and read as UTF-8; None if that can't be."""
    out = bytearray()
    for ch in t:
        b = _BYTE.get(ch)
        out += ch.encode("utf-8", "surrogatepass") if b is None else bytes((b,))
    try:
        return out.decode("utf-8")
    except UnicodeDecodeError:
        return None


def repair_mojibake(t: str, passes: int = 3) -> str:
    """Rereads while signs of mojibake get strictly fewer and no U+FFFD appears."""
    for mark in "¤©¨¶¼":
        t = t.replace("Ã " + mark, "Ã" + mark)
    t = t.replace("â€ ™", "â€™").replace("â€ \x9d", "â€\x9d").replace("ÃƒÂ¢", "Ã¢")
    for _ in range(passes):
        n = sign_total(t)
        new = reread(t) if n else None
        if new is None or sign_total(new) >= n or new.count("\ufffd") > t.count("\ufffd"):
            break
        t = new
    return t


def unescape_literals(t: str) -> str:
    return _ESCAPE.sub(lambda m: _PLAIN.get(m[1], m[1]), t) if "\\" in t else t


def strip_fragments(t: str) -> str:
    """Cuts trailing pieces of markup: ended ones, and short ones from the last '<' on."""
    while True:
        s = t.rstrip()
        cut = s.rfind("<")
        ended = s.endswith(_FRAGMENT_ENDS)
        if cut >= 0 and (ended or (">" in s[cut:] and len(s[cut:].encode()) < 48)):
            t = s[:cut]
        else:
            return s


def clip(t: str, most: int) -> str:
    """At most ``most`` bytes of UTF-8, whole characters."""
    return t if len(t) * 4 <= most else t.encode("utf-8", "surrogatepass")[:most].decode("utf-8", "ignore")


#: Texts without these are in NFC: below U+0300 nothing combines, and nothing has another form.
_COMBINES = r"[^\x{0}-\x{2ff}]"
#: Texts without these have no entity and no sign of mojibake either.
_BROKEN = rf"[&ÃÂ]| Å|{_COMBINES}"


def _where(pattern: str, f: Callable[[str], str], c: Column) -> Column:
    """``f`` of texts that hold ``pattern``; others are left as they are, and never go to Python."""
    return F.coalesce(_mapped(f)(F.when(c.rlike(pattern), c)), c)


def nfc(c: Column) -> Column:
    return _where(_COMBINES, to_nfc, c)


def decode_entities(c: Column) -> Column:
    return _mapped(decode_once)(c)


def fix_mojibake(c: Column, passes: int = 3) -> Column:
    return _mapped(lambda t: repair_mojibake(t, passes))(c)


def unescape(c: Column) -> Column:
    return _mapped(unescape_literals)(c)


def strip_markup_fragments(c: Column) -> Column:
    return _mapped(strip_fragments)(c)


def repair(c: Column, passes: int = 3) -> Column:
    """Entities, mojibake and NFC in one pass through Python."""
    return _where(_BROKEN, lambda t: to_nfc(repair_mojibake(decode_once(t), passes)), c)


def source_repair(c: Column, source: Column, unescape_sources: tuple[str, ...], fragment_sources: tuple[str, ...], passes: int = 5) -> Column:
    """What a source needs first (unescaping, cutting fragments), then ``repair``."""

    @F.arrow_udf("string")
    def run(a: pa.Array, s: pa.Array) -> pa.Array:
        def fixed(t: str | None, src: str | None) -> str | None:
            if t is None:
                return None
            if src in unescape_sources:
                t = unescape_literals(t)
            if src in fragment_sources:
                t = strip_fragments(t)
            return to_nfc(repair_mojibake(decode_once(t), passes))

        return in_parts(lambda ts, ss: pa.array(map(fixed, ts, ss), pa.string()), pa.string(), a, s)

    special = F.coalesce(source.isin(*unescape_sources, *fragment_sources), F.lit(False))
    return F.coalesce(run(F.when(special | c.rlike(_BROKEN), c), source), c)


class Detector:
    """A language detector: ``detect`` gives (code, confidence) or None."""

    name = ""

    def detect(self, text: str) -> tuple[str, float] | None:
        raise NotImplementedError


def grams(text: str, n: int = 3) -> Counter:
    t = " " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
    return Counter(t[i : i + n] for i in range(len(t) - n + 1)) if t.strip() else Counter()


class NgramBayes(Detector):
    """Naive Bayes over counts of character trigrams."""

    name = "ngram_bayes"

    def __init__(self, counts: dict[str, Counter], most: int = 5000):
        self.size = len({g for c in counts.values() for g in c}) or 1
        self.models = {k: (dict(Counter(c).most_common(most)), math.log(sum(c.values()) + self.size)) for k, c in counts.items()}

    def detect(self, text: str) -> tuple[str, float] | None:
        own = grams(text)
        if not own or not self.models:
            return None
        z = {k: sum(n * (math.log(c.get(g, 0) + 1) - total) for g, n in own.items()) for k, (c, total) in self.models.items()}
        best = min(sorted(z), key=lambda k: -z[k])
        return best, 1 / sum(math.exp(max(-700.0, v - z[best])) for v in z.values())


class RankProfile(Detector):
    """Out-of-place distance between trigram rankings."""

    name = "rank_profile"

    def __init__(self, counts: dict[str, Counter], most: int = 400):
        rank = lambda c: {g: i for i, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:most])}
        self.most, self.models = most, {k: rank(v) for k, v in counts.items()}
        self._rank = rank

    def detect(self, text: str) -> tuple[str, float] | None:
        own = self._rank(grams(text))
        if not own or not self.models:
            return None
        far = {k: sum(abs(i - m.get(g, self.most)) for g, i in own.items()) / (self.most * len(own)) for k, m in self.models.items()}
        near = sorted(far, key=lambda k: (far[k], k))
        return near[0], 1.0 if len(near) == 1 else 1 - far[near[0]] / max(1e-9, far[near[0]] + far[near[1]])


def from_samples(backend: str, samples: dict[str, list[str]]) -> Detector:
    return BACKENDS[backend]({k: grams(" ".join(v)) for k, v in samples.items()})


BACKENDS = {d.name: d for d in (NgramBayes, RankProfile)}


def detect(c: Column, detector: Detector, clip_bytes: int = 2000) -> Column:
    """``struct<code, conf>`` of the text's first ``clip_bytes`` bytes; null code where nothing is detected."""

    @F.arrow_udf("struct<code: string, conf: double>")
    def run(a: pa.Array) -> pa.Array:
        def make(texts: list) -> pa.Array:
            got = [detector.detect(clip(t, clip_bytes)) if t else None for t in texts]
            code, conf = pa.array([g and g[0] for g in got], pa.string()), pa.array([g and round(g[1], 6) for g in got], pa.float64())
            return pa.StructArray.from_arrays([code, conf], ["code", "conf"])

        return in_parts(make, pa.struct([("code", pa.string()), ("conf", pa.float64())]), a)

    return run(c)


def target_share(c: Column, detector: Detector, target: str, min_confidence: float, clip_bytes: int, separator: str = "\n\n") -> Column:
    """Share of the characters in paragraphs that are in the target language; 1 without paragraphs."""

    @F.arrow_udf("double")
    def run(a: pa.Array) -> pa.Array:
        def share(t: str | None) -> float | None:
            if t is None:
                return None
            parts = [p for p in map(str.strip, t.split(separator)) if p]
            ok = sum(len(p) for p in parts if (g := detector.detect(clip(p, clip_bytes))) and g[0] == target and g[1] >= min_confidence)
            return ok / sum(map(len, parts)) if parts else 1.0

        return in_parts(lambda ts: pa.array(map(share, ts), pa.float64()), pa.float64(), a)

    return run(c)
