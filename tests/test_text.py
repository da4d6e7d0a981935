import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions import udfs as U
from textloom.operators.clean import clean_text, gate
from textloom.operators.deep_clean import html_policy


def one(spark, expr, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


CASES = [
    (lambda c: T.fold_for_hash(c), {"  Hello\t\nWORLD  ": "hello world", "   ": "", "a b": "a b", None: None}),
    (lambda c: T.strip_invisibles(c), {"a\r\nb\x07c": "a\nbc", "x​y\xad": "xy", "tab\tkept": "tab\tkept"}),
    (lambda c: T.collapse_repeats(c), {"waaaaaaa": "waaa", "stop!!!!!!!": "stop!!!", "10000000": "10000000", "a    b": "a    b"}),
    (lambda c: T.normalize_whitespace(c), {"a\n\n\n\nb": "a\n\nb", "\n\n  hi  \n\n": "hi", "a \xa0 b\x85c": "a b c", "a\n": "a"}),
    (lambda c: gate(c, F.lit(50), 0.005), {"": "too_short", "a���b": "corrupted", "one two three": "too_short"}),
    (lambda c: T.has_html_remnant(c), {"line<br>break": True, "2 < 3 and 5 > 4": False}),
    (lambda c: html_policy(c)[1], {"hello <?php echo x; ?>": "html_remnant", "a <b>bold</b> c": None}),
    (lambda c: T.strip_benign_tags(c), {"a <b>bold</b> c": "a bold c"}),
    (lambda c: T.mask_contacts(c), {"visit https://example.com or mail a@b.com": "visit ⟨url⟩ or mail ⟨email⟩"}),
    (lambda c: T.dedup_paragraphs(c), {"same words here\n\nsame words here\n\nother text there": "same words here\n\nother text there", "": ""}),
    (lambda c: T.clean_verse(c), {"2. A Ruler of the Day [2].": "A Ruler of the Day.", " [1] ": None}),
    (lambda c: T.clean_footnote(c), {" [12]. See above": "See above"}),
    (lambda c: T.join_lines(c), {" a \n\n b\n": "a b"}),
    (lambda c: U.decode_entities(c), {"a &amp; b": "a & b", "&#8217;": "’", "&amp;amp;": "&amp;", "&amp b &nosuch;": "&amp b &nosuch;"}),
    (lambda c: U.unescape(c), {"a\\nb\\\\n\\q\\": "a\nb\\n\\q\\"}),
    (lambda c: U.strip_markup_fragments(c), {"good text <p>": "good text", "text\\/p>": "text\\/p>", "a <div>\\/div>": "a"}),
    (lambda c: clean_text(c), {"itâ€™s   a  &amp; test​!!!!!!": "it’s a & test!!!"}),
    (lambda c: T.mostly_numbers(c), {"12 ab": False, "123 ab": True}),
    (lambda c: T.length_bucket(T.word_count(c)), {"a b": "1-7", "": "1-7", "w " * 20: "16-35"}),
    (lambda c: T.noise_score(c)["score"], {"Please login to read more about this very long story that has many words in it": 4}),
    (lambda c: T.boilerplate_lines(c, ("the",))[0], {"MENU|HOME|NEWS\nthe prose stays here\n\ntwo words": "the prose stays here\n"}),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_cases(spark, k):
    f, want = CASES[k]
    assert one(spark, f, *want) == list(want.values())


GOLDEN = "smörgåsbord|Ångström|Curaçao|it’s|don’t|‘single’|5–10|2024—2025|Dvořák|jalapeño|Beyoncé|fiancée|São Paulo|München|Köln|piñata|crème brûlée|déjà|résumé|mañana|Björk|François|Zürich|José|über|naïve|café|“quoted”"


def test_mojibake_golden():
    wrong = lambda t: "".join(next((k for k, v in U._BYTE.items() if v == b), chr(b)) for b in t.encode())
    for t in GOLDEN.split("|"):
        assert U.repair_mojibake(wrong(t)) == t and U.repair_mojibake(t) == t
    assert U.repair_mojibake(wrong(wrong("café"))) == wrong(wrong("café"))  # the signs would not get fewer at once
    assert U.repair_mojibake("plain 123") == "plain 123"


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40), st.integers(0, 60))
def test_clip_is_whole_characters(t, n):
    got = U.clip(t, n)
    assert t.startswith(got) and (len(got.encode()) <= n or len(t) * 4 <= n)


def test_whitespace_and_repeats_are_idempotent(spark):
    r = __import__("random").Random(1)
    ts = ["".join(r.choice(" \n\t\xa0ab!1") for _ in range(30)) for _ in range(300)]
    for f in (T.normalize_whitespace, T.collapse_repeats):
        once = one(spark, f, *ts)
        assert one(spark, f, *once) == once


def test_hash_and_id(spark):
    h = one(spark, T.content_hash, "Hello  World", "hello world")
    assert h[0] == h[1] and re.fullmatch("[0-9a-f]{64}", h[0])
    assert one(spark, lambda c: T.make_doc_id(F.lit("hplt"), T.content_hash(c)), "x")[0].startswith("hplt:")


def test_detectors():
    data = {"en": ["the quick brown fox and the lazy dog went to the market with the others"], "de": ["der schnelle braune fuchs und der faule hund gingen mit den anderen zum markt"]}
    for name in U.BACKENDS:
        d = U.from_samples(name, data)
        assert d.detect("the dog and the fox")[0] == "en" and d.detect("der hund und der fuchs")[0] == "de" and d.detect("  12 ") is None
