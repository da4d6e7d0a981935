"""Memory and work that must not follow the size of a batch or a bucket."""

import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom import config, registry
from textloom.functions import batches, udfs
from textloom.functions import text as T
from textloom.operators import bpe_counts, deep_clean, near_dup, sampling
from textloom.plans import catalogue


def test_parts_are_small_and_whole():
    texts = ["a" * n for n in (3, 0, 900, 5000, 1)] + [None] * 3 + ["b" * 300] * 40
    for a in (pa.array(texts, pa.string()), pa.array(["x", *texts], pa.string()).slice(1)):
        got = []
        out = batches.in_parts(lambda ts: got.append(ts) or pa.array(ts, pa.string()), pa.string(), a, most=1000)
        assert out.to_pylist() == texts and sum(got, []) == texts
        assert all(sum(len(t or "") for t in ts) <= 1000 or len(ts) == 1 for ts in got) and len(got) > 10
    assert batches.in_parts(None, pa.string(), pa.array([], pa.string())).to_pylist() == []


def test_encoding_takes_small_parts(spark, tmp_path, monkeypatch):
    """A whole batch of texts was encoded at once."""
    seen = []

    class Fake:
        def encode_batch(self, texts, **_):
            seen.append(sum(map(len, texts)))
            return [type("E", (), {"ids": [1] * len(t), "__len__": lambda s: len(s.ids)})() for t in texts]

        encode_batch_fast = encode_batch

    monkeypatch.setattr(bpe_counts, "_tokenizer", lambda path: Fake())
    caught = []
    monkeypatch.setattr(bpe_counts.F, "arrow_udf", lambda kind: lambda f: lambda c: caught.append(f))
    bpe_counts.encode(None, "x")
    texts = ["w" * 50_000] * 20 + [None, ""]
    assert [None if x is None else len(x) for x in caught[0](pa.array(texts, pa.string())).to_pylist()] == [None if t is None else len(t) for t in texts]
    assert max(seen) <= 1 << 17


def test_token_count_is_length_of_ids(spark):
    d = spark.createDataFrame([("The market, the dog.",), ("",), (None,), ("é 12 <s>",)], "text string")
    got = d.select(bpe_counts.token_count(F.col("text"), catalogue.VOCAB_FILE).alias("n"), F.size(bpe_counts.encode(F.col("text"), catalogue.VOCAB_FILE)).alias("m")).collect()
    assert [r.n for r in got][:2] == [r.m for r in got][:2] and got[1].n == 0 and got[2].n is None and got[3].n == got[3].m > 0


@pytest.mark.parametrize("n", [0, 1, 2, 21, 1000])
def test_ratio_summary_needs_no_table_of_all_ratios(spark, n):
    """Percentiles came from one task with a map of all distinct ratios."""
    r = random.Random(n)
    v = [r.choice([0.5, 1.0, r.random()]) for _ in range(n)]
    df = spark.createDataFrame([(x,) for x in [*v, None]], "ratio double")
    got = sampling.ratio_summary(df, "ratio")
    assert "percentile" not in got._jdf.queryExecution().toString() and "median(" not in got._jdf.queryExecution().toString()
    row, s = got.first(), sorted(v)
    assert row.n == n
    if n:
        assert row["median"] == pytest.approx((s[(n - 1) // 2] + s[n // 2]) / 2, abs=2e-6) and row.p95 == pytest.approx(s[round(0.95 * (n - 1))], abs=1e-6)


def test_texts_without_signs_stay_out_of_python(spark):
    assert all(unicodedata.is_normalized("NFC", chr(a) + chr(b)) for a in range(0x300) for b in (*range(0x300), 0x3FF))
    rows = ["plain", "é ñ", "caf\u0065\u0301", "cafÃ©", "a &amp; b", "â€™", "x Å\xb8", "\u212b", "", None, "Â\xa0x", "\U0001d15e"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    fixed = lambda t: udfs.to_nfc(udfs.repair_mojibake(udfs.decode_once(t)))
    got = df.select("t", udfs.nfc(F.col("t")).alias("n"), udfs.repair(F.col("t")).alias("r"), udfs.source_repair(F.col("t"), F.lit(None).cast("string"), ("a",), ("b",), 3).alias("s")).collect()
    for r in got:
        assert (r.n, r.r, r.s) == ((None,) * 3 if r.t is None else (unicodedata.normalize("NFC", r.t), fixed(r.t), fixed(r.t)))
    sources = df.select(udfs.source_repair(F.lit("a\\nb <p>\\/p>"), F.when(F.col("i") == 0, "u").when(F.col("i") == 1, "f"), ("u",), ("f",)).alias("s")).limit(3).collect()
    assert [r.s for r in sources] == ["a\nb <p>/p>", "a\\nb", "a\\nb <p>\\/p>"]


def test_udfs_take_small_parts(monkeypatch):
    """A whole batch of texts stood in Python at once, and its results beside it."""
    most, real = [], batches.pa.Array.to_pylist
    caught = []
    monkeypatch.setattr(udfs.F, "arrow_udf", lambda kind: lambda f: caught.append(f) or (lambda *c: None))
    udfs.fix_mojibake(None), udfs.unescape(None), udfs.strip_markup_fragments(None), udfs.decode_entities(None)
    monkeypatch.setattr(udfs, "in_parts", lambda make, kind, *a: batches.in_parts(lambda ts: most.append(sum(map(len, ts))) or make(ts), kind, *a))
    texts = ["w" * 100_000] * 40
    assert len(caught) == 4 and all(real(f(pa.array(texts))) == texts for f in caught)
    assert len(most) >= 16 and max(most) <= 1 << 20


def test_sketch_is_the_same_as_in_sql(spark):
    texts = ["A b  c D", "a b", "", None, "x\x1cy z w v", "É\xa0ß ñ\u2003q Σας r", " ".join(f"w{i}" for i in range(300)), "a a a a a", "İ \u0085 b\x0bc d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {r.doc_id: r.s for r in df.select("doc_id", T.shingles(T.tokens(F.col("text"))).alias("s")).collect()}
    sets = near_dup.shingle_table(df)
    rows = sets.collect()
    assert {r.node: r.shingles for r in rows} == want and all(r.n == len(r.shingles) and len(r.bands) == 16 * (r.n > 0) for r in rows)
    assert len({bytes(r.set_id) for r in rows}) == len({tuple(x) for x in want.values()})
    # sets agree on a band if and only if they agree on its minima
    r = random.Random(5)
    base = r.sample(range(1 << 31), 40)
    many = [sorted({*base[: r.randrange(5, 41)], *r.sample(range(1 << 31), r.randrange(3))}) for _ in range(60)] + [[0], [near_dup.PRIME], [near_dup.PRIME - 1]]
    lengths = np.array([len(m) for m in many])
    got = near_dup.band_hashes(np.concatenate(many).astype(np.int32), lengths, config.NearDedup())
    mins = [[min((x * a + b) % near_dup.PRIME for x in m) for a, b in near_dup.constants(64, 0)] for m in many]
    for i in range(len(many)):
        for j in range(i):
            assert [bool(x) for x in got[i] == got[j]] == [mins[i][4 * k : 4 * k + 4] == mins[j][4 * k : 4 * k + 4] for k in range(16)]


def test_pairs_that_sizes_rule_out_are_not_compared(spark):
    """All pairs of a bucket had their sets sent and compared."""
    long = [f"w{i}" for i in range(400)]
    texts = [long, long[:300], long[:395], long, ["b", *long[:390]]]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = near_dup.shingle_table(df)
    assert not near_dup.candidate_pairs(near_dup.distinct_sets(sets)).where("a = 298 or b = 298").isEmpty()
    assert near_dup.candidate_pairs(near_dup.distinct_sets(sets), tau=0.8).where("a = 298 or b = 298").isEmpty()
    assert sorted((r.src, r.dst) for r in near_dup.verified_pairs(near_dup.distinct_sets(sets)).collect()) == [(0, 2), (0, 4), (2, 4)]
    assert sorted((r.node, r.component) for r in near_dup.clusters(sets).collect()) == [(0, 0), (2, 0), (3, 0), (4, 0)]


def test_deep_clean_takes_each_step_once(spark):
    """A filter on the finished text was pushed below all steps, and ran them again in two branches."""
    d = spark.createDataFrame([("a", registry.DOCUMENT, "gate", "x y", "h", [], "kept")], "source string, kind string, lid_policy string, text string, content_hash string, flags array<string>, disposition string")
    en = udfs.from_samples("ngram_bayes", {"en": ["the dog"], "so": ["waa dal"]})
    plan = deep_clean.deep_clean(d, detector=en)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("ArrowEvalPython" in line for line in plan.splitlines()) == 2  # repair, then the share of the language
    assert not any("Filter" in line and "regexp_replace" in line for line in plan.splitlines())


@pytest.mark.parametrize("line", ["", " ", "a", "a b c", " a b c ", "a b c d", "a\u2003b\xa0c  d", "x" * 3000, "a b c\t"])
def test_fewer_than_four_words(spark, line):
    t = T.trim_white(F.lit(line))
    row = spark.range(1).select((T.word_count(t) < 4).alias("a"), (~t.rlike(r"(?U)\A(?:\S++\s++){3}\S")).alias("b")).first()
    assert row.a == row.b
