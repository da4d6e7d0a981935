import hashlib
import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
import regex

from textloom.llm import packing as P
from textloom.llm import queries, search
from textloom.llm import url_filter as U
from textloom.llm.common import PATTERN, VOCAB, tiktoken_encoding
from textloom.storage import mounted, work_path

SF = "/root/testdata/sf0.001"


def brute_search(queries_, docs, k):
    ws = [(d, Counter(search.words(t)), len(search.words(t))) for d, t in docs if t is not None]
    n, mean = len(ws), sum(x[2] for x in ws) / max(1, len(ws))
    df = Counter(w for _, c, _ in ws for w in c)
    out = []
    for q, t in queries_:
        got = []
        for d, c, length in ws:
            hit = [(w, m) for w, m in Counter(search.words(t or "")).items() if w in c]
            if hit:
                s = sum(m * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * length / mean)) for w, m in hit)
                got.append((-round(s, 4), d is None, 0 if d is None else d, d))
        out += [(q, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(got)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard", [7, 20_000])
def test_top_k_against_brute_force(spark, shard):
    r = random.Random(4)
    word = lambda: "w%d" % int(r.expovariate(0.06))
    docs = [(i, " ".join(word() for _ in range(r.randrange(1, 60)))) for i in range(150)]
    docs += [(200, docs[3][1]), (200, docs[3][1]), (None, docs[3][1]), (201, None), (202, ""), (203, "w1 " * 20_000)]
    qs = [(i, " ".join(word() for _ in range(r.randrange(1, 8)))) for i in range(20)] + [(20, None), (21, ""), (0, "w1 w1 w2"), (None, "w3"), (22, "nowhere")]
    got = search.top_k(spark.createDataFrame(qs, "item_id long, text string"), spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, q int"), k=5, shard_docs=shard, query_batch=11)
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute_search(qs, docs, 5)


@pytest.mark.parametrize("name", ["doc_id", "q", "rank", "score", "qid"])
def test_top_k_takes_any_name_and_id_type(spark, name):
    docs = [("a", "one two"), ("b", "two"), (None, "two"), ("b", "two three")]
    qs = spark.createDataFrame([("x", "two"), ("y", "three one"), (None, "one")], f"{name} string, text string")
    got = search.top_k(qs, spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id string, text string, q int, score int"), k=3, query_id=name, query_batch=2)
    assert got.columns == ["_" + name if name in ("doc_id", "rank", "score") else name, "rank", "doc_id", "score"]
    rows = [(r[0], r[1], r[2]) for r in got.collect()]
    assert sorted(rows, key=str) == sorted([(q, i, d) for q, i, d, _ in brute_search([("x", "two"), ("y", "three one"), (None, "one")], docs, 3)], key=str)


def test_max_score_blocks():
    """Small blocks, so that terms become non-essential on the way."""
    r = random.Random(9)
    idf = np.array([0.2, 0.5, 2.0, 4.0, 1.0])
    s = search.Shard(idf, 10.0)
    for i in range(3000):
        s.add(i, Counter(t for t in range(5) if r.random() < 0.5 / (1 + t) for _ in range(r.randrange(1, 4))), r.randrange(5, 20))
    s.finish()
    q = [(t, 1) for t in range(5)]
    assert s.top(q, 10, block=64) == s.top(q, 10, block=10**6)


def test_search_of_nothing(spark):
    e = spark.createDataFrame([], "item_id long, text string")
    d = spark.createDataFrame([], "doc_id long, text string")
    assert search.top_k(e, d).count() == 0
    assert search.top_k(spark.createDataFrame([(1, "a")], "item_id long, text string"), d).count() == 0


def test_candidates():
    assert U.candidates("HTTPS://u:p@Sub.Example.COM.:8080/a/b/?q=1#f") == ["sub.example.com/a/b?q=1", "sub.example.com/a/b", "sub.example.com/a", "sub.example.com", "example.com"]
    for u in ("casino-win.example.com:8080/x", "http:/\\casino-win.example.com/x", "//casino-win.example.com/x", " https:casino-win.example.com\\x", "http://casino-win.example.com:/x/#y"):
        assert U.candidates(u) == ["casino-win.example.com/x", "casino-win.example.com", "example.com"], u
    assert U.candidates("http://10.0.0.1/x")[-1] == "10.0.0.1" and U.candidates("") == [] and U.candidates("///") == []


def test_urls_against_sets(spark):
    r = random.Random(3)
    hosts = ["h%d.%s" % (i, d) for i in range(200) for d in ("example.com", "example.org")]
    entries = r.sample(hosts, 60) + ["h1.example.org/bad", "h2.example.org/x?y=1", "dup.example.com", "dup.example.com", "", None]
    path = U.build(spark.createDataFrame([(e,) for e in entries], "entry string"), work_path(spark, "u"), per_shard=10)
    rows = [(i, f"http://{'www.' if r.random() < 0.5 else ''}{r.choice(hosts)}/{r.choice(['', 'bad/z', 'x?y=1'])}") for i in range(600)] + [(600, None), (601, ""), (602, "junk"), (602, "junk"), (603, "http://e/" + "a/" * 20_000)]
    got = U.match_urls(spark.createDataFrame([(*x, "m") for x in rows], "page_id long, url string, matched string"), path).collect()
    have = {e for e in entries if e}
    assert len(got) == len(rows)
    for x in got:
        assert x.matched == next((c for c in (U.candidates(x.url) if x.url else []) if c in have), None)
    assert sum(x.matched is not None for x in got) > 50
    nothing = U.build(spark.createDataFrame([], "entry string"), work_path(spark, "u"))
    assert U.match_urls(spark.createDataFrame(rows[:3], "page_id long, url string"), nothing).where("matched is not null").count() == 0


def test_url_collisions_are_confirmed(tmp_path):
    """Two strings under one digest: only the stored one matches."""
    for name, data in (("strings", b"aabb"), ("ends", np.array([0, 2, 4], np.int64).tobytes()), ("keys", np.array([5, 5], np.int64).tobytes())):
        (tmp_path / f"0.{name}").write_bytes(data)
    p = U.Probe(str(tmp_path))
    assert p.holds(["aa", "bb", "cc", "aa"], np.array([5, 5, 5, 6])).tolist() == [True, True, False, False]


def curve(c):
    return P.hilbert(np.array(c), 3)


def test_hilbert_is_a_curve():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = P.hilbert(cells, 3)
    walk = cells[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(512)) and (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def brute_coordinates(text):
    """Pre-tokens cut by another engine; plain sums."""
    n = Counter(crc32(w.encode()) % P.BUCKETS for p in regex.findall(PATTERN, text) if (w := p.strip().lower()))
    long = math.sqrt(sum(n.values()))
    return [round(sum(math.sqrt(c) / long * float(P._directions()[w, d]) for w, c in sorted(n.items())) * P.SCALE) for d in range(P.DIMS)]


def brute_pack(rows, capacity):
    enc = tiktoken_encoding(VOCAB)

    docs = [(d, hashlib.md5(t.encode()).digest(), len(enc.encode_ordinary(t)), brute_coordinates(t)) for d, t in rows if t]
    if not docs:
        return []
    x = np.array([d[3] for d in docs])
    mean = x.sum(axis=0) / len(docs)
    sd = np.sqrt(np.maximum((x.astype(object) ** 2).sum(axis=0).astype(float) / len(docs) - mean**2, 0))
    h = P.hilbert(P.cells(x, mean, sd))
    at, out = 0, []
    for _, _, _, _, (d, _, n, _) in sorted((int(k), d[0] is None, d[0] or 0, d[1], d) for k, d in zip(h, docs)):
        for p in range(at // capacity, (at + n - 1) // capacity + 1):
            lo, hi = max(at, p * capacity), min(at + n, (p + 1) * capacity)
            out.append((p, d, lo - at, hi - at, lo - p * capacity))
        at += n
    return sorted(out, key=str)


def test_packing_against_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(((r.pack_id, r.doc_id, r.doc_from, r.doc_to, r.pack_from) for r in queries.op10_packing(spark, SF).collect()), key=str)
    assert got == brute_pack(rows, 2048)


def test_packing_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "a b"), (4, "a b"), (None, "a b"), (5, "long " * 30_000), (6, "other words"), (7, "one"), (8, "日本 ¼ naïve 👍🏽")]
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id long, text string, n int, h int")
    got = P.pack(df, 100).collect()
    assert sorted(((r.pack_id, r.doc_id, r.doc_from, r.doc_to, r.pack_from) for r in got), key=str) == brute_pack(rows, 100)
    by = defaultdict(list)
    for r in got:
        by[r.pack_id].append((r.place, r.pack_from, r.doc_to - r.doc_from))
    assert all(sum(x[2] for x in v) == 100 for p, v in by.items() if p != max(by)) and all([x[0] for x in sorted(v)] == list(range(len(v))) for v in by.values())
    assert P.pack(df.limit(0)).count() == 0
    assert mounted("file:///a/b") == "/a/b"


def test_url_query_takes_an_entries_table(spark, tmp_path):
    pages = [(1, "http://bad.example.org/a"), (2, "http://ok.org/bad/page?x=1"), (3, "http://ok.org/good"), (4, "http://casino-win.example.com/"), (5, None)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    run = lambda: {r.page_id: (r.blocked, r.matched) for r in queries.op2_url_filter(spark, str(tmp_path)).collect()}
    no = (False, None)
    assert run() == {1: no, 2: no, 3: no, 4: (True, "casino-win.example.com"), 5: no}
    spark.createDataFrame([("bad.example.org",), ("ok.org/bad",), ("http://ok.org/bad/other",), (None,)], "entry string").write.parquet(f"{tmp_path}/url_entries.parquet")
    assert run() == {1: (True, "bad.example.org"), 2: (True, "ok.org/bad"), 3: no, 4: no, 5: no}
