import numpy as np
from pyspark.sql import functions as F

from textloom.llm import quality as Q
from textloom.llm import queries, weak
from textloom.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def test_label_model_recovers_accuracies():
    r = np.random.default_rng(0)
    y = r.random(20_000) < 0.1
    rates = np.array([[0.005, 0.8], [0.01, 0.6], [0.001, 0.5], [0.015, 0.3]])
    votes = r.random((20_000, 4)) < np.where(y[:, None], rates[:, 1], rates[:, 0])
    votes = np.column_stack([votes, votes[:, 3]])  # a copy of the last voter
    masks = (votes * (1 << np.arange(5))).sum(axis=1) | (31 << weak.SHIFT)
    m, c = np.unique(masks, return_counts=True)
    lm = weak.fit_label_model(m, c, 5, prior=0.2)
    good, bad = lm.rates()
    assert abs((1 - lm.prior[0]) - 0.1) < 0.03 and np.abs(bad[:3] - rates[:3, 1]).max() < 0.1 and (good <= 0.02).all()
    fired, judged = weak.bits(masks, 5)
    assert ((lm.posterior(fired, judged) > 0.5) == y).mean() > 0.95
    empty = weak.fit_label_model(np.zeros(0, int), np.zeros(0), 5, prior=0.2)
    assert abs(empty.prior[0] - 0.8) < 1e-9


def test_linear_without_rows_keeps_start():
    lin = weak.fit_linear([], np.zeros(0), {5: 2.0, 9: 1.0}, -3.0)
    assert lin.score(np.array([5, 7]), np.ones(2)) == -1.0


def scores(df, labels, flag, truth):
    rows = df.join(labels, "doc_id").select(F.col(flag).alias("p"), F.col(truth).alias("y")).collect()
    tp = sum(r.p and r.y for r in rows)
    return tp / max(1, sum(r.y for r in rows)), tp / max(1, sum(bool(r.p) for r in rows)), len(rows)


def test_quality_on_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").withColumn("low", 1 - F.col("quality"))
    got = queries.op5_quality(spark, SF)
    recall, precision, n = scores(got.withColumn("flag", ~F.col("keep")), labels, "flag", "low")
    assert n > 300 and recall > 0.9 and precision > 0.95
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_toxicity_held_out(spark):
    """Lexicon and model from one half of the labels, judged on the other."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = T.fit_toxicity(docs, labels.where("doc_id % 2 = 0"), train_rows=4000)
    got = T.score_toxicity(docs, model=model).withColumn("flag", F.col("toxicity") >= 0.5)
    recall, precision, n = scores(got, labels.where("doc_id % 2 = 1"), "flag", "toxic")
    assert n > 1500 and recall > 0.8 and precision > 0.95


ODD = [(1, None), (2, ""), (3, "You are a stupid idiot, a pathetic loser and worthless trash."), (4, "A calm and pleasant sentence about the weather in spring."), (5, "word " * 30_000), (3, "You are a stupid idiot, a pathetic loser and worthless trash."), (None, "quiet")]


def test_toxicity_odd_rows(spark):
    df = spark.createDataFrame([(*x, 1.0, "l") for x in ODD], "doc_id long, text string, toxicity double, t string")
    got = T.score_toxicity(df)
    assert got.columns == ["doc_id", "text", "toxicity", "t"] or set(got.columns) == {"doc_id", "text", "toxicity", "t"}
    p = {r.doc_id: r.toxicity for r in got.collect()}
    assert p[1] is None and p[3] > 0.5 and max(p[2], p[4], p[5], p[None]) < 0.5
    labels = spark.createDataFrame([(3, 1, 1), (4, 1, 0), (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    kept = T.drop_toxic(df, labels)
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 4, 5, None]
    assert T.drop_toxic(df.limit(0), labels).count() == 0


def test_quality_odd_rows(spark):
    junk = "BUY!! NOW!! CHEAP!! PILLS!! BEST!! PRICE!! CLICK!! HERE!! TODAY!! ONLY!! FREE!! GIFT!! FOR!! YOU!!"
    df = spark.createDataFrame([(*x, 0.5) for x in [*ODD, (8, junk)]], "doc_id long, text string, p_low double")
    p = {r.doc_id: r.p_low for r in Q.score_quality(df).collect()}
    assert p[1] is None and p[4] < 0.5
    kept = Q.keep_quality(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 not in ids and 2 not in ids and 4 in ids
    assert Q.keep_quality(df.limit(0)).count() == 0


def test_every_disguise_votes():
    task = T.make_task([])
    bit = 1 << T.VOTERS.index("disguised")
    listed = "1d10t|id1ot|id!ot|st*pid|st**id|stu*id|stuppid|stupid|m0r0n|l0ser|f*ck|f**k|sh*t|sh!t|sh1t|b*tch|b!tch|b1tch|a$$hole|a**hole|a$*hole|s t u p i d|i d i o t|l o s e r"
    for d in listed.split("|"):
        for t in (d, d.upper(), f"({d})", f"line\n{d} end", f"so {d}, so"):
            assert task.votes(t) & bit, t
    assert not task.votes("a plain text, 10 * 10 = $100!") & bit
