import gc
import math
import subprocess
import sys
import tempfile
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline as C
from test_dedup import brute_exact, check_near
from test_search_urls_packing import brute_pack
from textloom.llm import near_dedup, packing, quality, queries, toxicity

SF = "/root/testdata/sf0.001"


def same(a, b):
    return len(a) == len(b) and all(len(x) == len(y) and all(p == q or isinstance(p, float) and math.isclose(p, q, abs_tol=1e-3) for p, q in zip(x, y)) for x, y in zip(a, b))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = queries.QUERIES[name](spark, sf)
    cols = sorted(got.columns)
    want = con.execute(f"select {', '.join(cols)} from ({queries.SQL[name]})").fetchall()
    have = [tuple(r) for r in got.select(*cols).collect()]
    assert same(sorted(have, key=str), sorted(want, key=str))


def test_pipeline_stage_by_stage(spark, docs):
    df, names = docs, [n for n, _ in C.STAGES]
    assert names == ["quality", "toxicity", "exact_dedup", "near_dedup", "packing"]
    for name, stage in C.STAGES:
        rows = df.collect()
        out = stage(spark, df, SF)
        got = out.collect()
        if name == "packing":
            assert sorted(((r.pack_id, r.doc_id, r.doc_from, r.doc_to, r.pack_from) for r in got), key=str) == brute_pack([(r.doc_id, r.text) for r in rows], 2048)
            continue
        assert out.columns == docs.columns
        kept = {r.doc_id for r in got}
        if name == "quality":
            p = {r.doc_id: r.p_low for r in quality.score_quality(df).collect()}
            assert kept == {r.doc_id for r in rows if r.text.strip() and p[r.doc_id] < 0.5} and 0.7 * len(rows) < len(kept) < len(rows)
        elif name == "toxicity":
            p = {r.doc_id: r.toxicity for r in toxicity.score_toxicity(df, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
            assert kept == {d for d, x in p.items() if x < 0.5} and len(kept) < len(rows)
        elif name == "exact_dedup":
            new = lambda s: int(s[3:]) >= 10
            assert kept == {d for d, _, dup in brute_exact([(r.doc_id, r.text, new(r.source)) for r in rows]) if not dup}
        else:
            groups = [(r.doc_id, r.kept_id) for r in near_dedup.near_duplicates(df).collect()]
            check_near([(r.doc_id, r.text) for r in rows], groups)
            assert kept == {r.doc_id for r in rows} - {d for d, k in groups if d != k}
        df = spark.createDataFrame(got, docs.schema)


def test_pipeline_run(spark):
    out = C.run(spark, SF)
    assert C.ORACLE_SQL is None and out.count() > 0
    assert out.groupBy("pack_id").agg({"doc_to": "max"}).count() == out.selectExpr("max(pack_id) + 1 as n").first().n


def test_pipeline_odd_documents(spark, docs, tmp_path):
    odd = spark.createDataFrame([(None, None, None, None, None), (900001, "", "en", "src1", 0), (900001, "", "en", "src1", 0), (900002, "word", None, None, None)], docs.schema)
    sf = str(tmp_path)
    docs.limit(40).union(odd).union(odd).write.parquet(f"{sf}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{sf}/labels.parquet")
    assert C.run(spark, sf).count() > 0
    docs.limit(0).write.parquet(f"{sf}/none/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{sf}/none/labels.parquet")
    assert C.run(spark, f"{sf}/none").count() == 0


def test_workers_keep_no_cache_of_a_finished_operator(spark, docs):
    near_dedup.near_duplicates(docs).collect()
    packing.pack(docs).collect()

    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(len(x) for x in gc.get_objects() if type(x) in (near_dedup._Hashes, packing.Looks))])], names=["n"])

    assert spark.range(0, 64, 1, 8).mapInArrow(held, "n long").agg({"n": "max"}).first()[0] == 0


def test_workers_give_batches_back():
    """What stays of 20 MB batches of texts once they are read through is far less than one of them."""
    code = """
import gc, io, re, pyarrow as pa
from textloom.llm.common import few
anon = lambda: sum(map(int, re.findall("Private_Dirty: +([0-9]+)", open("/proc/self/smaps_rollup").read()))) // 1024
def read():
    with open(PATH, "rb") as f:
        for b in pa.ipc.open_stream(f):
            assert all(len(x) == 2000 for x in few(b.column(0)))
PATH = __import__("sys").argv[1]
list(few(pa.array(["word"])))
first = anon()
read()
gc.collect()
print(anon() - first)
"""
    with tempfile.NamedTemporaryFile() as f:
        schema = pa.schema([("t", pa.string())])
        with pa.ipc.new_stream(f.name, schema) as out:
            for rows in (9_000, 10_000, 8_000, 9_500):
                out.write_batch(pa.record_batch([pa.array(["x" * 2000] * rows)], schema=schema))
        said = subprocess.run([sys.executable, "-c", code, f.name], capture_output=True, text=True, check=True, cwd=Path(C.__file__).parent)
    assert int(said.stdout) < 12
