import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.llm import exact_dedup as X
from textloom.llm import near_dedup as N
from textloom.llm import queries

SF = "/root/testdata/sf0.001"


def edit(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        c = [i]
        for j, y in enumerate(b, 1):
            c.append(min(p[j] + 1, c[-1] + 1, p[j - 1] + (x != y)))
        p = c
    return p[-1]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14), st.integers(0, 10))
def test_banded_distance(a, b, most):
    e = edit(a, b)
    assert N.banded_distance(a, b, most) == (e if e <= most else most + 1)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=60), st.lists(st.sampled_from("abcd"), max_size=60), st.integers(0, 30))
def test_banded_distance_in_windows(a, b, most):
    before, N.WINDOWED = N.WINDOWED, 0
    try:
        e = edit(a, b)
        assert N.banded_distance(a, b, most) == (e if e <= most else most + 1)
    finally:
        N.WINDOWED = before


def test_long_texts_align_in_little_memory():
    """Two texts of 2 MB, edited at both ends and here and there; one cut in two and turned round."""
    import tracemalloc

    r = random.Random(6)
    vocab = ["w%d" % i for i in range(30_000)]
    a = ["the" if r.random() < 0.1 else r.choice(vocab) for _ in range(290_000)]
    b = ["start", *(w if r.random() > 0.0002 else "new" for w in a[:-1]), "end"]
    tracemalloc.start()
    assert N.similar(a, b, N.THRESHOLD) and sum(map(len, a)) + len(a) > 1_800_000
    assert tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()
    c = a[:20_000]
    assert not N.similar(c, c[10_000:] + c[:10_000], N.THRESHOLD)


def test_sketch_follows_edit_similarity():
    r = random.Random(5)
    text = lambda: [str(r.randrange(3000)) for _ in range(300)]
    edited = lambda a, rate: [str(r.randrange(3000)) if r.random() < rate else w for w in a]
    share = lambda a, x: (N.sketch(a) == N.sketch(x)).mean()
    base = [text() for _ in range(40)]
    near = np.mean([share(a, edited(a, 0.05)) for a in base])
    moved = np.mean([share(a, a[150:] + a[:150]) for a in base])
    assert near > 0.45 and moved < 0.7  # the order of the picked k-mers counts, not only their set
    assert np.mean([share(a, edited(a, 0.2)) > 0 for a in base]) > 0.9
    assert max(share(a, text()) for a in base) == 0
    assert (N.sketch(["one"]) == N.sketch(["one"])).all() and len(set(N.kmers(["a"] * 50).tolist())) == 48


def brute_groups(rows, threshold=N.THRESHOLD):
    texts = {i: N.words(t) for i, (_, t) in enumerate(rows) if t and t.split()}
    up = {i: i for i in texts}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = list(texts)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = texts[i], texts[j]
            if rows[i][1] == rows[j][1] or (min(len(a), len(b)) >= threshold * max(len(a), len(b)) - 1e-6 and N.similar(a, b, threshold)):
                up[find(i)] = find(j)
    groups = defaultdict(set)
    for i in texts:
        groups[find(i)].add(i)
    return [g for g in groups.values() if len(g) > 1]


def check_near(rows, got, least=0.9):
    """Groups found against all pairs: nothing wrong, and at least ``least`` of the pairs."""
    pairs = lambda groups: {(a, b) for g in groups for a in g for b in g if a < b}
    want = pairs([{rows[i][0] for i in g} for g in brute_groups(rows)])
    by = defaultdict(set)
    for d, k in got:
        by[k].add(d)
    have = pairs(by.values())
    assert have <= want
    assert len(have) >= least * len(want)
    return want


def test_near_query_against_all_pairs(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [(r.doc_id, r.kept_id) for r in queries.op4_near_dedup(spark, SF).collect()]
    assert check_near(rows, got)


def planted(n=60, seed=2):
    r = random.Random(seed)
    vocab = ["w%d" % i for i in range(4000)]
    rows, i = [], 0
    for f in range(n):
        base = [r.choice(vocab) for _ in range(r.randrange(20, 400))]
        for c in range(r.randrange(1, 6)):
            rate = r.choice([0, 0.02, 0.08, 0.12])
            rows.append((i, " ".join(w if r.random() > rate else r.choice(vocab) for w in base)))
            i += 1
    return rows


def test_near_planted_and_order_of_keeping(spark):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.kept_id) for r in N.near_duplicates(df).collect()]
    check_near(rows, got)
    text = dict(rows)
    groups = defaultdict(list)
    for d, k in got:
        groups[k].append(d)
    for k, ds in groups.items():
        assert k == min(ds, key=lambda d: (-len(text[d]), d))
    kept = {r.doc_id for r in N.drop_near_duplicates(df).collect()}
    assert kept == {d for d, _ in rows} - {d for d, k in got if d != k}


def test_near_odd_rows(spark):
    long = " ".join("t%d" % (i * 7919 % 30011) for i in range(30000))
    rows = [
        (1, None, 1), (2, None, 1), (3, "", 1), (4, "", 1), (5, "  \n", 1), (6, "one", 1), (7, "one", 2), (8, "one two", 3),
        (None, "same text here again", 4), (9, "same text here again", 4), (9, "same text here again", 4),
        (10, long, 5), (11, long + " end", 5), (12, "zzz yyy xxx www", 6),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, k int").withColumn("id", F.lit("clash")).withColumn("n", F.lit(None).cast("int"))
    got = sorted(((r.doc_id is None, r.doc_id), r.kept_id) for r in N.near_duplicates(df).collect())
    assert [(d[1], k) for d, k in got] == [(6, 6), (7, 6), (9, 9), (9, 9), (10, 11), (11, 11), (None, 9)]
    kept = N.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 6, 8, 9, 11, 12]
    assert N.near_duplicates(df.limit(0)).count() == 0 and N.drop_near_duplicates(df.limit(0)).count() == 0


def test_binary_fuse():
    r = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 10, 1000, 50_000):
        keys = r.integers(0, 2**64, n, np.uint64)
        f = X.BinaryFuse.load(X.BinaryFuse.build(np.concatenate([keys, keys[:2]])).dump())
        assert f.may_hold(keys).all()
        assert f.may_hold(r.integers(0, 2**64, 20_000, np.uint64)).mean() < 0.02
    assert len(f.dump()) < 1.35 * 50_000


def brute_exact(rows):
    by = defaultdict(list)
    for i, (d, t, new) in enumerate(rows):
        if t is not None:
            by[t].append((bool(new), d is None, d or 0, i))
    out = [(d, d, False) for d, t, _ in rows if t is None]
    for g in by.values():
        g.sort()
        first = rows[g[0][3]][0]
        out += [(rows[x[3]][0], first, k > 0) for k, x in enumerate(g)]
    return sorted(out, key=str)


def test_exact_against_brute_force(spark, docs):
    r = random.Random(1)
    rows = [(i, r.choice(["a", "b", "", "c" * 20_000, None, "d%d" % i, "e%d" % r.randrange(40)]), r.choice([True, False, None])) for i in range(300)]
    rows += [(None, "a", True), (7, "a", True), (7, "a", True)]
    df = spark.createDataFrame([(*x, 0, "r") for x in rows], "doc_id long, text string, new boolean, k int, r string")
    got = sorted((tuple(x) for x in X.mark_duplicates(df, F.col("new")).collect()), key=str)
    assert got == brute_exact(rows)
    kept = X.drop_duplicates(df, F.col("new"))
    assert kept.columns == df.columns
    assert sorted((x.doc_id for x in kept.collect()), key=str) == sorted((d for d, _, dup in got if not dup), key=str)
    assert X.mark_duplicates(df.limit(0), F.col("new")).count() == 0
    assert X.drop_duplicates(df.where("new"), F.col("new")).count() > 0


def test_exact_screen_never_misses(spark, tmp_path):
    keys = lambda a, b: spark.range(a, b).selectExpr("unhex(md5(cast(id as string))) as k")
    paths = ["file://" + str(tmp_path / x) for x in "abc"]
    for p, (a, b) in zip(paths, ((0, 5000), (7000, 7100), (0, 0))):
        X.build_filters(keys(a, b), p, per_filter=700)
    filters = [X.load_filters(spark, p) for p in paths]
    assert [f.count() for f in filters] == [8, 1, 0]
    for per_task in (500_000, 100):  # one turn and many
        seen = X.screen(keys(2500, 12500), filters[:1], per_task)
        assert 2500 <= seen.count() < 2700 and seen.join(keys(0, 5000), "k").count() == 2500
        both = X.screen(keys(2500, 12500), filters, per_task)
        assert 2600 <= both.count() < 2850 and both.distinct().count() == both.count()
    assert X.screen(keys(0, 10), filters[2:]).count() == 0
    with pytest.raises(Exception, match="(?i)already exists"):
        X.build_filters(keys(0, 1), paths[0])


def test_exact_hot_texts_and_clashing_digests(spark, monkeypatch):
    """Copies beyond what one task should get, rows equal in everything, no snapshot at all; digests that differ in nothing."""
    hot = X.hot_keys
    monkeypatch.setattr(X, "hot_keys", lambda c, k, n, total: hot(c, k, n, total, 0.01, 20))
    rows = [(i, "hot", i % 3 > 0) for i in range(300)] + [(None, "same", True)] * 50 + [(7, "same2", False)] * 40 + [(1000 + i, f"u{i}", True) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, new boolean").withColumn("m", F.create_map(F.lit("a"), F.col("doc_id")))
    for d in (df, df.where("new")):
        want = brute_exact([(x.doc_id, x.text, x.new) for x in d.collect()])
        assert sorted((tuple(x) for x in X.mark_duplicates(d, F.col("new")).collect()), key=str) == want
        assert sorted((x.doc_id for x in X.drop_duplicates(d, F.col("new")).collect()), key=str) == sorted((i for i, _, dup in want if not dup), key=str)
    monkeypatch.setattr(X, "text_key", lambda c: F.unhex(F.substring(F.md5(c), 1, 2)))
    want = brute_exact(rows)
    assert sorted((tuple(x) for x in X.mark_duplicates(df, F.col("new")).collect()), key=str) == want
    assert sorted((x.doc_id for x in X.drop_duplicates(df, F.col("new")).collect()), key=str) == sorted((i for i, _, dup in want if not dup), key=str)


def test_near_hub_family(spark):
    r = random.Random(8)
    vocab = ["w%d" % i for i in range(5000)]
    hub = [r.choice(vocab) for _ in range(300)]
    copies = [[r.choice(vocab) if r.random() < 0.2 else w for w in hub] for _ in range(2000)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate([hub, *copies])], "doc_id long, text string")
    # what resembles the original and shares a bucket with it is in its group
    own = N.sketch(hub)
    want = {0, *(i for i, c in enumerate(copies, 1) if N.similar(hub, c, N.THRESHOLD) and (N.sketch(c) == own).any())}
    assert len(want) > 1900
    kept = dict((x.doc_id, x.kept_id) for x in N.near_duplicates(df).collect())
    assert want <= {d for d, k in kept.items() if k == kept[0]}


@pytest.mark.parametrize("split", [False, True])
def test_near_widely_shared_passage(spark, monkeypatch, split):
    monkeypatch.setattr(N, "BLOCK", 64)  # so that buckets take several blocks
    r = random.Random(9)
    vocab = ["w%d" % i for i in range(5000)]
    passage = [r.choice(vocab) for _ in range(120)]
    base = [[r.choice(vocab) for _ in range(80)] for _ in range(400)]
    edited = [[r.choice(vocab) if r.random() < 0.1 else w for w in b] for b in base]
    rows = [(i, " ".join(passage + t)) for i, t in enumerate([*base, *edited])]
    if split:  # so that buckets are dealt out in parts
        monkeypatch.setattr(N, "PART", 150)
        monkeypatch.setattr(N, "PARTS", 10**9)
    got = {x.doc_id: x.kept_id for x in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == 800 and all(got[i] == got[i + 400] for i in range(400)) and len(set(got.values())) == 400


def test_near_short_texts_against_all_pairs(spark):
    r = random.Random(4)
    vocab = ["w%d" % i for i in range(2000)]
    rows = []
    for n in [4, 5, 6, 7, 8] * 8 + [*range(9, 32)]:
        base = [r.choice(vocab) for _ in range(n)]
        edited = list(base)
        for at in r.sample(range(n), n // 4):
            edited[at] = r.choice(vocab)
        fewer = [w for i, w in enumerate(base) if i != r.randrange(n)] if n > 4 else base[1:]
        rows += [" ".join(x) for x in (base, edited, fewer)]
    rows = list(enumerate(rows))
    got = [(x.doc_id, x.kept_id) for x in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(check_near(rows, got, 1)) > 100
