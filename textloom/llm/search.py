"""Exact top-k BM25 search by MaxScore over document shards."""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import few, free_name, slices

K1, B = 1.2, 0.75
PLACES = 4  # scores are ranked as rounded to this many places, so that equal ones are ties everywhere
SLACK = 10.0**-PLACES
_WORD = re.compile(r"\w+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Shard:
    """Postings of the queries' terms in some documents: per term, document numbers (ascending) and tf parts of the score."""

    def __init__(self, idf: np.ndarray, mean_len: float):
        self.idf, self.mean_len = idf, max(mean_len, 1e-9)
        self.ids: list = []
        self.lens: list[int] = []
        self.term: list[np.ndarray] = []
        self.tf: list[np.ndarray] = []
        self.sizes: list[int] = []

    def add(self, doc_id, terms: Counter, length: int) -> None:
        self.ids.append(doc_id)
        self.lens.append(length)
        self.term.append(np.fromiter(terms.keys(), np.int64, len(terms)))
        self.tf.append(np.fromiter(terms.values(), np.float64, len(terms)))
        self.sizes.append(len(terms))

    def finish(self) -> None:
        term, tf = np.concatenate([*self.term, np.zeros(0, np.int64)]), np.concatenate([*self.tf, np.zeros(0)])
        doc = np.repeat(np.arange(len(self.ids)), self.sizes)
        norm = K1 * (1 - B + B * np.array(self.lens, float) / self.mean_len)
        part = self.idf[term] * tf * (K1 + 1) / (tf + norm[doc]) if len(term) else tf
        order = np.argsort(term, kind="stable")
        term, self.doc, self.part = term[order], doc[order], part[order]
        self.starts = np.searchsorted(term, np.arange(len(self.idf) + 1))
        self.bound = np.zeros(len(self.idf))
        if len(term):
            np.maximum.at(self.bound, term, self.part)
        self.term = self.tf = []

    def top(self, terms: list[tuple[int, int]], k: int, block: int = 2048) -> list[tuple[int, float]]:
        """The k best (document number, score) for query ``terms`` (term, times in the query).

        Terms are ordered by score bound. While all terms up to i together cannot reach the k-th best
        score, they are non-essential: only documents in the other lists are candidates, and the
        non-essential lists are probed, highest bound first, for candidates that can still get there.
        """
        lists = []
        for t, times in terms:
            a, b = self.starts[t], self.starts[t + 1]
            if a < b:
                lists.append((times * self.bound[t], t, times, self.doc[a:b], self.part[a:b]))
        lists.sort(key=lambda x: x[:2])
        sums = np.cumsum([0.0, *(x[0] for x in lists)])
        best: list[tuple[float, int]] = []  # (-score, place in id order)
        floor = -np.inf
        for base in range(0, len(self.ids), block):
            split = int(np.searchsorted(sums[1:], floor - SLACK, "left")) if floor > -np.inf else 0
            if split >= len(lists):
                break
            acc, hit = np.zeros(block), np.zeros(block, bool)
            for _, _, times, doc, part in lists[split:]:
                a, b = np.searchsorted(doc, (base, base + block))
                at = doc[a:b] - base
                acc[at] += times * part[a:b]
                hit[at] = True
            cand = np.flatnonzero(hit)
            score = acc[cand]
            for i in range(split - 1, -1, -1):
                ok = score + sums[i + 1] >= floor - SLACK
                cand, score = cand[ok], score[ok]
                if not len(cand):
                    break
                _, _, times, doc, part = lists[i]
                at = np.minimum(np.searchsorted(doc, cand + base), len(doc) - 1)
                score = score + np.where(doc[at] == cand + base, times * part[at], 0.0)
            ok = score >= floor - SLACK
            for c, s in zip((cand[ok] + base).tolist(), score[ok].tolist()):
                best.append((-round(s, PLACES), c))
            if len(best) > k:
                best.sort(key=lambda x: (x[0], self.ids[x[1]] is None, 0 if self.ids[x[1]] is None else self.ids[x[1]]))
                del best[k:]
            if len(best) == k:
                floor = -max(x[0] for x in best)
        best.sort(key=lambda x: (x[0], self.ids[x[1]] is None, 0 if self.ids[x[1]] is None else self.ids[x[1]]))
        return [(c, -s) for s, c in best[:k]]


def top_k(queries: DataFrame, docs: DataFrame, k: int = 10, query_id: str = "item_id", query_text: str = "text", id_col: str = "doc_id", text: str = "text", query_batch: int = 5_000, shard_docs: int = 20_000, batch_terms: int = 500_000) -> DataFrame:
    """``(query_id, rank, doc_id, score)``: the k best documents of every query, exactly.

    Documents stay where they are read: each partition is indexed in shards of ``shard_docs``, for
    the terms of the queries only, with the corpus's document frequencies and mean length from one
    first pass over all documents, for the terms of all queries. Each shard gives its k best, which are
    merged. Queries go out in batches of ``query_batch`` rows and about ``batch_terms`` terms, so what is
    sent to executors is bounded; every row is a query.

    Scores are BM25 over lower-case words, ranked as rounded to 4 places, ties by id (null last). Ids of
    either side may be of any type that has an order. Repeated documents are hits of their own, repeated
    query rows queries of their own. Null or empty texts of either side match nothing; very long ones
    count whole; a query that matches fewer than k documents has fewer rows, and without documents or
    queries there are none. Other columns aren't read, whatever their names; a query id that is named
    like another column of the result gets an underscore in front.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t")).where("t is not null")
    q = queries.select(F.col(f"`{query_id}`").alias("qid"), F.col(f"`{query_text}`").cast("string").alias("t"))
    d_type, q_type = d.schema["id"].dataType, q.schema["qid"].dataType
    name = free_name(["rank", "doc_id", "score"], query_id)
    hit = T.StructType([T.StructField("q", T.IntegerType()), T.StructField("doc_id", d_type), T.StructField("score", T.DoubleType())])
    named = T.StructType([T.StructField("q", T.IntegerType()), T.StructField("qid", q_type)])

    batches_: list[list[tuple]] = [[]]
    held, every = 0, set()
    for qid, t in q.toLocalIterator():
        own = sorted(Counter(words(t or "")).items())
        if batches_[-1] and (len(batches_[-1]) >= query_batch or held + len(own) > batch_terms):
            batches_.append([])
            held = 0
        batches_[-1].append((qid, own))
        held += len(own)
        every.update(w for w, _ in own)

    asked_for = spark.sparkContext.broadcast(frozenset(every))

    def tally(batches):
        df, n, length = Counter(), 0, 0
        for b in batches:
            for t in few(b.column(0)):
                ws = words(t)
                n, length = n + 1, length + len(ws)
                df.update(asked_for.value.intersection(ws))
        rows = [*df.items(), (None, n), ("", length)]  # no word is empty
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.int64())], names=["term", "n"])

    sums = {r["term"]: r["n"] for r in d.select("t").mapInArrow(tally, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n, length = sums.get(None, 0) or 0, sums.get("", 0) or 0

    def run(rows: list) -> DataFrame:
        terms: dict[str, int] = {}
        asked = [[(terms.setdefault(w, len(terms)), c) for w, c in own] for _, own in rows]
        df = np.array([sums.get(w, 0) for w in terms], float)
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5)) if len(terms) else np.zeros(0)
        sent = spark.sparkContext.broadcast((terms, asked, idf))

        def search(batches):
            (terms, asked, idf), shard, kind = sent.value, None, None

            def flush():
                shard.finish()
                at, ids, scores = [], [], []
                for i, ts in enumerate(asked):
                    for c, s in shard.top(ts, k):
                        at.append(i)
                        ids.append(shard.ids[c])
                        scores.append(s)
                return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(ids, kind), pa.array(scores, pa.float64())], names=["q", "doc_id", "score"])

            for b in batches:
                kind = b.column(0).type
                for part in slices(b):
                    for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                        shard = shard or Shard(idf, length / max(1, n))
                        ws = words(t)
                        shard.add(i, Counter(i for i in map(terms.get, ws) if i is not None), len(ws))
                        if len(shard.ids) >= shard_docs:
                            yield flush()
                            shard = None
            if shard:
                yield flush()

        best = _best(d.mapInArrow(search, hit), k)
        return best.join(spark.createDataFrame([(i, qid) for i, (qid, _) in enumerate(rows)], named), "q").select(F.col("qid").alias(name), "rank", "doc_id", "score")

    return reduce(DataFrame.unionByName, map(run, batches_))


def _best(hits: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
