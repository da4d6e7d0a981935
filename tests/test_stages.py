import gzip
import json
import lzma

import pytest
from pyspark.sql import functions as F

from textloom import config, registry, schema
from textloom.functions.udfs import from_samples
from textloom.operators import bpe_counts, clean, deep_clean, lid, merge, near_dup, reports, sampling, skew
from textloom.plans import pipeline
from textloom.sources import readers, writers
from textloom.streaming import ingest

A, B = registry.Source("a", registry.DOCUMENT, rank=0), registry.Source("b", registry.SENTENCE, rank=1)
EN = from_samples("ngram_bayes", {"en": ["the quick brown fox and the lazy dog went to the market with the others"], "so": ["waa dal ku yaal geeska iyo magaalada oo ay ka mid tahay"]})


def raw(spark, rows):
    return spark.createDataFrame([(s, None if s is None else ord(s[0]) - 97, i, t) for i, (s, t) in enumerate(rows)], "source string, rank int, ordinal long, text string")


def test_merge_attributes_by_keeper(spark):
    m = merge.mark_first_wins(raw(spark, [("a", "X  y"), ("b", "x Y"), ("b", "x y"), ("a", "x y"), ("b", "z")]))
    got = {r.ordinal: (r.reason, r.kept_source) for r in m.collect()}
    assert got == {0: (None, "a"), 1: ("cross_source_dup", "a"), 2: ("cross_source_dup", "a"), 3: ("within_source_dup", "a"), 4: (None, "b")}
    assert merge.kept(m, 1).first().ordinal == 0
    two = merge.concat_in_order([("b", spark.createDataFrame([("t",), (" ",)], "text string")), ("a", spark.createDataFrame([("u",)], "text string"))])
    assert sorted((r.source, r["rank"], r.text) for r in two.collect()) == [("a", 1, "u"), ("b", 0, "t")]


def test_clean_stage(spark):
    doc = " ".join(f"word{i}" for i in range(30))
    df = clean.clean(raw(spark, [("a", "too short"), ("b", "a sentence of seven words stays here"), ("a", doc), ("a", doc + "  "), ("c", doc), (None, doc), ("b", "<b>x</b> one two three four five")]), [A, B])
    got = {r.ordinal: r for r in df.collect()}
    assert set(got) == {0, 1, 2, 3, 6}
    assert got[0].disposition == "rejected" and got[0].flags == ["too_short"] and got[1].disposition == "kept"
    assert got[3].reason == "exact_duplicate_after_clean" and got[3].duplicate_of == got[2].id and got[6].disposition == "review"
    assert clean.unknown_sources(raw(spark, [("a", "x"), ("c", "y"), (None, "z")]), [A, B]).count() == 2
    rec = schema.as_records(df.withColumn("lang", F.lit("en")))
    assert rec.schema["provenance"].dataType.fieldNames() == schema.PROVENANCE.fieldNames() and rec.where("dedup.is_duplicate").count() == 1


def test_lid_policy(spark):
    df = spark.createDataFrame([("the dog and the fox", "gate"), ("the dog and the fox", "tag_only"), ("waa dal ku yaal", "gate"), ("", None)], "text string, lid_policy string").withColumn("disposition", F.lit("kept"))
    got = lid.apply_gate(df, EN, "so", 0.5).collect()
    assert [r.lid_reason for r in got] == ["not_somali", None, None, "not_somali"] and got[3].lang_score == 0 and got[1].lang == "en"
    ev = lid.evaluate(spark.createDataFrame([("so", "so", "x"), ("en", "so", "x"), ("so", "en", "x")], "said string, truth string, text string"), "said", "truth", "so").where("bucket is null").first()
    assert (ev.tp, ev.fp, ev.fn, ev.precision, ev.recall) == (1, 1, 1, 0.5, 0.5)
    trained = lid.train(spark.createDataFrame([("aaa bbb", "x"), ("ccc ddd", "y")], "text string, lang string"))
    assert trained.detect("ccc")[0] == "y"


def test_deep_clean(spark):
    prose = "waa dal ku yaal geeska iyo magaalada oo ay ka mid tahay waxaa ku yaal dal"
    rows = [
        ("a", prose + " https://x.com/a", "kept"), ("a", "<script>x</script> " + prose, "kept"), ("a", "HOME|NEWS|SPORT\nCONTACT|ABOUT\n" + prose, "kept"),
        ("a", "the quick brown fox and the lazy dog went to the market", "kept"), ("a", "12345 678 9 waa ku", "kept"), ("a", "gone", "rejected"), ("madlad", "waa dal ku\\nyaal geeska iyo magaalada", "review"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, source string, text string, disposition string")
    df = df.selectExpr("*", "'document' as kind", "'gate' as lid_policy", "'h' as content_hash", "cast(array() as array<string>) as flags")
    got = {r.i: r for r in deep_clean.deep_clean(df, detector=EN).collect()}
    assert [got[i].deep_reason for i in range(7)] == [None, "html_remnant", "boilerplate", "not_somali", "mostly_numbers", None, None]
    assert got[0].text.endswith("⟨url⟩") and got[1].text == rows[1][1] and got[5].disposition == "rejected" and "\n" in got[6].text
    assert got[0].content_hash != "h" and got[1].content_hash == "h" and got[2].flags == ["boilerplate"]


def test_near_dup(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(0, base), (1, base + " morning"), (2, "quite other words in this text"), (3, "a"), (4, "b"), (5, base), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {r.node: r.near_duplicate_of for r in near_dup.removed(df).collect()}
    assert gone == {0: 1, 5: 1}
    empty_match = {r.node for r in near_dup.removed(df, config.NearDedup(empty_sets_match=True)).collect()}
    assert {4} <= empty_match
    s = near_dup.stats(near_dup.shingle_table(df))
    assert s["clusters"] == 1 and s["removed"] == 2
    assert near_dup.mark(df, takes_part=F.col("doc_id") > 1).where("near_duplicate_of is not null").count() == 0


def test_min_hash_estimates_jaccard(spark):
    a, b = list(range(0, 400)), list(range(200, 600))
    sets = spark.createDataFrame([(1, a), (2, b)], "node long, shingles array<bigint>")
    rows = near_dup.signatures(sets, config.NearDedup(k_hashes=128, bands=32)).drop("node").collect()
    assert abs(sum(x == y for x, y in zip(*rows)) / 128 - 1 / 3) < 0.15


def test_config_round_trip():
    cfg = config.Config(lid=config.Lid(target="en"))
    assert config.from_toml(config.to_toml(cfg)) == cfg
    with pytest.raises(ValueError):
        config.from_toml("[near_dedup]\nbands = 3")
    with pytest.raises(ValueError):
        config.Config(merge_source_order=())


def test_pipeline_covers_all_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    src = docs.selectExpr("source", "cast(substring(source, 4, 9) as int) as rank", "doc_id as ordinal", "text")
    r = pipeline.run(src, registry.numbered(), stages=("merge", "clean", "near_dedup"))
    n = r.kept.count()
    assert n + sum(df.count() for df in r.rejected.values()) == docs.count()
    assert [x.stage for x in r.funnel().orderBy("step").collect()] == ["merge", "clean", "near_dedup", "overall"]
    assert r.drops().agg(F.sum("n")).first()[0] == docs.count() - n
    assert r.kept.groupBy("content_hash").count().where("count > 1").isEmpty()
    with pytest.raises(ValueError):
        pipeline.run(src, registry.numbered(), stages=("nosuch",))


def test_readers(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"text": " one "}\n\n{bad\n{"text": 5}\n{"text": ""}\n{"source": "x"}\n{"text": "two"}\n')
    assert [r.text for r in readers.read_jsonl_texts(spark, str(p)).collect()] == ["one", "two"]
    with pytest.raises(Exception):
        readers.read_raw(spark, str(p)).collect()
    assert readers.read_lines(spark, str(p)).count() == 6
    with gzip.open(tmp_path / "z.json.gz", "wt") as f:
        f.write(json.dumps({"text": "a\\nb"}) + "\n" + json.dumps({"other": 1}) + "\n")
    assert [r.text for r in readers.read_source(spark, readers.SPECS["mc4"], str(tmp_path / "z.json.gz")).collect()] == ["a\nb"]
    for name, opener in (("d.txt", open), ("d.txt.xz", lzma.open)):
        with opener(tmp_path / name, "wt") as f:
            f.write("l1 \n l2\n\n\n\nm1\n\n")
        assert [r.text for r in readers.read_blank_line_documents(spark, str(tmp_path / name)).collect()] == ["l1 l2", "m1"]
    spark.sql("select named_struct('so', 'x <p>', 'en', 'y') as translation").write.parquet(str(tmp_path / "o"))
    assert readers.read_source(spark, readers.SPECS["opus"], str(tmp_path / "o")).collect()[0].asDict() == {"text": "x", "source": "opus"}
    with pytest.raises(TypeError):
        readers.read_text_column(spark, str(tmp_path / "o"), "translation")
    (tmp_path / "q.json").write_text(json.dumps({"result": [{"translation": "1. In [1] the", "footnotes": "[1]. note"}, {"translation": "2. ", "footnotes": ""}]}))
    assert sorted(r.text for r in readers.read_source(spark, readers.SPECS["quran"], str(tmp_path / "q.json")).collect()) == ["In the", "note"]
    (tmp_path / "c1.json").write_text((tmp_path / "q.json").read_text())
    assert readers.read_chapters(spark, f"file://{tmp_path}/c{{n}}.json", 1).count() == 2


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", "bad"), ("c", None)], "text string, reason string")
    out = str(tmp_path / "x.jsonl")
    assert writers.write_split(df, out) == {"kept": 2, "rejected": 1}
    assert readers.read_jsonl_texts(spark, writers.sidecar(out, "rejected")).count() == 1
    assert writers.write_split(df.where("reason is null"), str(tmp_path / "y.jsonl"))["rejected"] == 0
    writers.write_report(df, str(tmp_path / "r"), "Rows")
    assert (tmp_path / "r.md").read_text().startswith("# Rows") and len(json.loads((tmp_path / "r.json").read_text())) == 3
    writers.write_text(df, str(tmp_path / "t"))
    assert readers.read_lines(spark, str(tmp_path / "t")).count() == 3


def test_reports_and_samples(spark):
    df = spark.createDataFrame([(i, f"s{i % 2}", "w " * i, ["f"]) for i in range(1, 41)], "doc_id int, source string, text string, flags array<string>")
    assert sampling.reservoir(df, 5, "doc_id").collect() == sampling.reservoir(df.repartition(3), 5, "doc_id").collect()
    assert sampling.recommend(df).where("best").count() == 1
    assert reports.flags(df).first().n == 40 and reports.audit_repeated_sentences(df).first().docs == 0
    f = reports.flow(df, df.where("source = 's0'")).orderBy("source").collect()
    assert [(r.input, r.kept, r.dropped) for r in f] == [(20, 20, 0), (20, 0, 20)]
    s = sampling.ratio_summary(df.selectExpr("cast(doc_id as double) as r"), "r").first()
    assert (s.n, s.mean, s.median, s.p95) == (40, 20.5, 20.5, 38.0)
    w = {r.word: r.n for r in bpe_counts.word_counts(spark.createDataFrame([("ab ab, ab!",)], "text string"), min_freq=1).collect()}
    assert w == {"ab": 3, ",": 1, "!": 1}
    assert reports.percent(1, 0) == "0.0%" and reports.thousands(1234) == "1,234"
    assert reports.preview(df.withColumn("reason", F.lit("r")), "r", 3).count() == 3


def test_streaming(spark, tmp_path):
    src, table, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    spark.createDataFrame([("Hello  there", "a"), ("hello there", "b")], schema.RAW).coalesce(1).write.json(src)
    ingest.ingest(ingest.cleaned_stream(spark, src), table, cp).awaitTermination()
    spark.createDataFrame([("HELLO there", "c"), ("new words", "c")], schema.RAW).coalesce(1).write.mode("append").json(src)
    ingest.ingest(ingest.cleaned_stream(spark, src), table, cp).awaitTermination()
    assert sorted(r.text for r in spark.read.parquet(table).collect()) == ["Hello there", "new words"]


def test_concat_goes_by_file_and_place(spark, tmp_path):
    """Files that a scan would pack by size come in the order of their names, and first wins by it."""
    for name, n in (("a", 1), ("b", 3), ("c", 200)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(n)) + "same\n")
    lines = readers.read_lines(spark, str(tmp_path))
    got = merge.concat_in_order([("x", lines), ("y", spark.createDataFrame([("a0",), ("z",)], "text string"))])
    want = ["a0", "same", *(f"b{i}" for i in range(3)), "same", *(f"c{i}" for i in range(200)), "same", "a0", "z"]
    assert [r.text for r in got.orderBy("rank", "ordinal").collect()] == want
    first = merge.kept(merge.mark_first_wins(got)).where("text = 'same'").collect()
    assert [r.ordinal.file.rpartition("/")[2] for r in first] == ["a.txt"]


def test_first_of_hot_keys(spark):
    rows = [(0, i, "hot", f"s{i}") for i in range(200)] + [(1, 7, "cold", "x"), (0, 900, "cold", "y"), (0, 901, None, "n"), (0, 902, None, "m"), (0, 903, "one", "o")]
    df = spark.createDataFrame(rows, "rank int, ordinal long, key string, source string")
    got = skew.with_first(df, "key", "source", least=20).select("*", skew.is_first().alias("is_first")).collect()
    assert len(got) == len(rows) and sorted(r.source for r in got if r.is_first) == ["m", "n", "o", "s0", "y"]
    assert all(r._first.source == ("s0" if r.key == "hot" else "y") for r in got if r._first)
