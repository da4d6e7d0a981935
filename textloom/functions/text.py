"""Text functions as Catalyst expressions. Every one takes and gives columns and keeps nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ALPHA, NUM = r"\p{IsAlphabetic}", r"\p{N}"
#: Signs of UTF-8 read as Windows-1252; longer ones count beside the shorter ones they hold.
SIGNS = ["Ã", "Â", "â€", "â„", " Å", *("Ã" + c for c in "©¨¶¼¤")]
URL_MARK, EMAIL_MARK = "⟨url⟩", "⟨email⟩"
_DOMAIN = "com|edu|gov|org|net|info|io|co|so"
EMAIL = r"(?iu)(?<![\p{L}\p{N}_])[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}(?![\p{L}\p{N}_])"
URL = rf"(?iu)(?<![\p{{L}}\p{{N}}_])(?:(?:www\.|https?://)[^\s<>]+|[a-z0-9][-.a-z0-9]+\.(?:{_DOMAIN})(?:/\S*)?)"
TAG = r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^>]*)?>"
ACTIVE = r"(?is)<\?.*?\?>|<(script|style)\b.*?</\1>|<(?:char|mutation)\b.*?>"
LINE_STARTS = ("share this", "live chat", "live help", "contact us", "click here", "posted by", "written by", "tags:")
#: Label -> what a text in lower case holds; each hit weighs 2.
NOISE = [
    ("url", "www."), ("url", "https://"), ("url", "http://"), ("copyright", "all rights reserved"), ("terms", "terms of use"),
    ("privacy", "privacy policy"), ("signup", "sign up"), ("subscribe", "subscribe"), ("click_here", "click here"), ("share", "share this"),
    ("read_more", "read more"), ("cookie", "cookie"), ("login", "login"),
]


def _re(c: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(by))


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def count_literal(c: Column, s: str) -> Column:
    return ((F.length(c) - F.length(F.replace(c, F.lit(s), F.lit("")))) / F.lit(len(s))).cast("int")


def trim_white(c: Column) -> Column:
    return _re(c, r"(?U)^\s+|\s+\z")


def is_blank(c: Column) -> Column:
    return c.isNull() | ~c.rlike(r"(?U)\S")


def fold_for_hash(nfc: Column) -> Column:
    """NFC text -> one space between words, none at the ends, lower case."""
    return F.lower(_re(_re(nfc, r"(?U)\s+", " "), r"^ | \z"))


def content_hash(nfc: Column) -> Column:
    return F.sha2(fold_for_hash(nfc), 256)


def make_doc_id(source: Column, digest: Column) -> Column:
    return F.concat(source, F.lit(":"), F.substring(digest, 1, 16))


def rejoin_split_signs(c: Column) -> Column:
    for mark in "¤©¨¶¼":
        c = F.replace(c, F.lit("Ã " + mark), F.lit("Ã" + mark))
    for tail in ("™", "\x9d"):
        c = F.replace(c, F.lit("â€ " + tail), F.lit("â€" + tail))
    return F.replace(c, F.lit("ÃƒÂ¢"), F.lit("Ã¢"))


def sign_count(c: Column) -> Column:
    return sum((count_literal(c, s) for s in SIGNS[1:]), count_literal(c, SIGNS[0]))


def replacement_count(c: Column) -> Column:
    return count_literal(c, "\ufffd")


def strip_invisibles(c: Column) -> Column:
    return _re(c, "[\\p{Cc}&&[^\\n\\t]]|[\u200b-\u200d\ufeff\u00ad\u202a-\u202e]")


def strip_stray_ufffd(c: Column) -> Column:
    return F.replace(c, F.lit("\ufffd"), F.lit(""))


def collapse_repeats(c: Column, most: int = 3) -> Column:
    """Runs of one letter or ASCII punctuation sign longer than ``most`` are cut to it; digits and spaces stay."""
    return _re(c, rf"([{ALPHA}\p{{Punct}}])\1{{{most},}}", "$1" * most)


def normalize_whitespace(c: Column) -> Column:
    """One space within lines, no space at their ends, at most one blank line, none at the ends."""
    for pattern, by in ((r"(?U)[\s&&[^\n]]+", " "), (r" ?\n ?", "\n"), (r"\n{3,}", "\n\n"), (r"^[ \n]+|[ \n]+\z", "")):
        c = _re(c, pattern, by)
    return c


def word_count(c: Column) -> Column:
    return count_of(c, r"(?U)\S+")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def ufffd_ratio(c: Column) -> Column:
    return _ratio(replacement_count(c), F.length(c))


def symbol_ratio(c: Column) -> Column:
    solid = _re(c, r"(?U)\s+")
    return _ratio(F.length(_re(solid, f"[{ALPHA}{NUM}]+")), F.length(solid))


def mostly_numbers(c: Column) -> Column:
    return count_of(c, NUM) > count_of(c, f"[{ALPHA}]")


def has_html_remnant(c: Column) -> Column:
    return c.rlike(TAG)


def has_active_html(c: Column) -> Column:
    return c.rlike(ACTIVE)


def strip_benign_tags(c: Column) -> Column:
    return _re(c, "(?s)" + TAG)


def is_boilerplate_line(line: Column, function_words: tuple[str, ...]) -> Column:
    return _is_boilerplate(trim_white(line), function_words)


def _is_boilerplate(t: Column, function_words: tuple[str, ...]) -> Column:
    starts = "|".join(LINE_STARTS)
    spoken = F.lower(t).rlike("|".join(function_words)) if function_words else F.lit(False)
    return t.rlike(r"\S") & (
        t.rlike(r"\A[|A-Z0-9«»]{10,}\z")
        | t.rlike(r"\A\|[^\n]*\|\z")
        | t.rlike(rf"(?iu)\A(?:{starts})")
        | t.rlike(r"\A[-+.()\d\s]{7,}\z")
        | (~t.rlike(r"(?U)\A(?:\S++\s++){3}\S") & ~spoken)  # fewer than four words
    )


def boilerplate_lines(c: Column, function_words: tuple[str, ...]) -> tuple[Column, Column]:
    """The text without boilerplate lines, and the share of all its lines that they are (blank lines count, and stay)."""
    lines = F.split(c, F.lit("\n"), -1)
    trimmed = F.transform(lines, lambda x: F.struct(x.alias("line"), trim_white(x).alias("t")))  # once a line, not once a test
    kept = F.filter(trimmed, lambda x: ~_is_boilerplate(x["t"], function_words))["line"]
    return F.array_join(kept, "\n"), (F.size(lines) - F.size(kept)) / F.size(lines)


def mask_contacts(c: Column, urls: bool = True, emails: bool = True) -> Column:
    if emails:
        c = _re(c, EMAIL, EMAIL_MARK)
    return _re(c, URL, URL_MARK) if urls else c


def word_set(c: Column) -> Column:
    """Words in lower case of more than two bytes, each once."""
    return F.array_distinct(F.filter(F.split(F.lower(c), F.lit(r"(?U)\s+")), lambda w: F.octet_length(w) > 2))


def set_jaccard(a: Column, b: Column) -> Column:
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def dedup_paragraphs(c: Column, tau: float = 0.95, separator: str = "\n\n") -> Column:
    """Paragraphs whose word set is like that of the last one kept go."""
    paras = F.filter(F.transform(F.split(c, F.lit(separator), -1), trim_white), lambda p: p != "")
    paras = F.transform(paras, lambda p: F.struct(p.alias("p"), word_set(p).alias("ws")))  # words once a paragraph, not once a use
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(None).cast("array<string>").alias("last"))

    def step(acc: Column, x: Column) -> Column:
        ws, last = x["ws"], acc["last"]
        # sizes bound the Jaccard index, so few sets are compared
        alike = (F.size(ws) == F.size(last)) | (F.least(F.size(ws), F.size(last)) / F.greatest(F.size(ws), F.size(last)) >= tau)
        same = last.isNotNull() & alike & (set_jaccard(ws, last) >= tau)
        grown = F.struct(F.concat(acc["kept"], F.array(x["p"])).alias("kept"), ws.alias("last"))
        return F.when(same, acc).otherwise(grown)

    return F.array_join(F.aggregate(paras, start, step)["kept"], separator)


def noise_score(c: Column) -> Column:
    """``struct<score, reasons>``: 2 for each phrase, 1 each for mostly Latin, many symbols, very short."""
    low, words = F.lower(c), word_count(c)
    alpha = count_of(c, f"[{ALPHA}]")
    signs = [(F.contains(low, F.lit(p)), 2, label) for label, p in reversed(NOISE)]
    signs += [
        ((words < 12) & (alpha > 0) & (count_of(c, "[A-Za-z]") / F.greatest(alpha, F.lit(1)) > 0.85), 1, "mostly_latin"),
        (symbol_ratio(c) > 0.35, 1, "high_symbols"),
        (words <= 3, 1, "very_short"),
    ]
    score = sum((F.when(s, w).otherwise(0) for s, w, _ in signs[1:]), F.when(signs[0][0], signs[0][1]).otherwise(0))
    return F.struct(score.alias("score"), F.array_compact(F.array(*[F.when(s, F.lit(n)) for s, _, n in signs])).alias("reasons"))


def length_bucket(words: Column) -> Column:
    return F.when(words <= 7, "1-7").when(words <= 15, "8-15").when(words <= 35, "16-35").otherwise("36+")


def join_lines(c: Column) -> Column:
    """A blank-line-delimited document as one line: trimmed lines without empty ones, a space between."""
    return F.array_join(F.filter(F.transform(F.split(c, F.lit("\n"), -1), trim_white), lambda x: x != ""), " ")


def _collapsed_or_null(c: Column) -> Column:
    return F.nullif(_re(_re(c, r"(?U)\s+", " "), r"^ | \z"), F.lit(""))


def clean_verse(c: Column) -> Column:
    """A translated verse without its number and footnote marks; null if nothing is left."""
    return _collapsed_or_null(_re(_re(c, r"\A\s*\d+\.\s*"), r"\s*\[\d+\]"))


def clean_footnote(c: Column) -> Column:
    return _collapsed_or_null(_re(c, r"\A\s*\[\d+\]\.\s*"))


def tidy_document(nfc: Column) -> Column:
    """What tokenizer training reads: trimmed, at most one blank line."""
    return _re(trim_white(nfc), r"\n{3,}", "\n\n")


def tokens(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), F.lit(r"(?U)\s+")), lambda w: w != "")


def shingles(tokens: Column, k: int = 3) -> Column:
    """Sorted distinct 31-bit hashes of the word k-grams of ``tokens``; empty for fewer than k."""
    n = F.size(tokens)
    starts = F.when(n >= k, F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1)))).otherwise(F.array().cast("array<int>"))
    gram = lambda i: F.array_join(F.slice(tokens, i, k), " ")
    h = lambda i: F.conv(F.substring(F.sha2(gram(i), 256), 1, 8), 16, 10).cast("long").bitwiseAND(F.lit(0x7FFFFFFF))
    return F.array_sort(F.array_distinct(F.transform(starts, h)))
