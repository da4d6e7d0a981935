"""Toxicity by weak supervision: lexicon and pattern voters, a label model, a linear classifier."""

from __future__ import annotations

import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import free_name, slices
from textloom.llm.weak import DIMS, SHIFT, Linear, Task, score, train
from textloom.storage import written

#: Common terms of abuse by theme; each theme is one voter.
LEXICONS = {
    "wits": "idiot idiots idiotic stupid moron moronic imbecile dumb dumbass dimwit fool fools halfwit idiota imbécil tonto dummkopf idioten blöd crétin débile abruti",
    "worth": "worthless loser losers pathetic useless scum trash garbage vermin parasite filth inútil basura abschaum wertlos versager ordure minable nul raclure",
    "scorn": "disgusting clown clowns freak pig swine creep repulsive vile asqueroso cerdo payaso ekelhaft schwein widerlich dégoûtant porc",
    "oaths": "fuck fucking shit bullshit bitch bastard asshole crap damn cunt dick slut whore mierda puta cabrón scheiße arschloch hurensohn merde putain salope connard",
    "harm": "kill yourself hate die murder strangle exterminate",
}
SLICES = 6  # voters among which mined words are dealt out
PATTERNS = ["two_terms", "aimed", "disguised"]
VOTERS = [*LEXICONS, *(f"mined{i}" for i in range(SLICES)), *PATTERNS]
VOTER_AT = [DIMS - 64 + i for i in range(len(VOTERS))]
_WORD = re.compile(r"\w+")
_DISGUISE = re.compile(r"\b(?:1d10t|id[1!]ot|st[*u][*p]?[*p]id|m0r0n|l0ser|f[*]+c?k\w*|sh[*!1]t|b[*!1]tch|a[$*]{2}hole|(?:s t u p i d|i d i o t|l o s e r))\b")
_MARKS = ("*", "1", "0", "!", "$", "stup", "i d i", "s t u", "l o s")  # whatever _DISGUISE matches has one
_YOU = {"you", "your", "youre", "ur", "du", "dein", "ihr", "tu", "toi", "vous", "tú", "usted", "eres"}
_STRONG = frozenset(w for k, v in LEXICONS.items() if k != "harm" for w in v.split())
_HARM = (("kill", "yourself"), ("hate", "you"), ("go", "die"), ("should", "die"))


def mine_lexicon(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label_rows: int = 20_000, least_share: float = 0.75, p_value: float = 3e-5) -> list[str]:
    """Words that mark labelled toxic documents, for languages and slang that no list covers.

    ``label_rows`` bounds the labelled sample (least hashes of the id first), so it can be broadcast, and
    with it the lexicon. Words are tallied in the joined rows alone, per partition, then summed. A word
    is taken if at least ``least_share`` of the documents with it are toxic and that many toxic ones by
    chance is less likely than ``p_value``. Rows without id, text or label are ignored.
    """
    known = (
        labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("y"))
        .where("id is not null and y is not null")
        .orderBy(F.xxhash64("id"), "id", "y")
        .limit(label_rows)
    )
    pairs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t")).join(F.broadcast(known), "id").select("y", "t")

    def tally(batches):
        all_, toxic, sizes = Counter(), Counter(), [0, 0]
        for b in batches:
            for s in slices(b):
                for y, t in zip(s.column(0).to_pylist(), s.column(1).to_pylist()):
                    if t is not None:
                        own = set(_WORD.findall(t.lower()))
                        all_.update(own)
                        sizes[0] += 1
                        if y:
                            toxic.update(own)
                            sizes[1] += 1
        ws = list(all_)
        cols = [None, *ws], [sizes[0], *map(all_.__getitem__, ws)], [sizes[1], *map(toxic.__getitem__, ws)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64()))], names=["w", "d", "d1"])

    df = written(pairs.mapInArrow(tally, "w string, d long, d1 long").groupBy("w").agg(F.sum("d").alias("d"), F.sum("d1").alias("d1")), "tally")
    size = df.where("w is null").first()
    n, n1 = (size["d"], size["d1"]) if size else (0, 0)
    if not n1 or n1 == n:
        return []
    rate = n1 / n
    q, z = F.col("d1") / F.col("d"), F.lit(0.0)
    # Chernoff bound on the binomial tail
    far = q * F.ln(q / rate) + F.when(q < 1, (1 - q) * F.ln((1 - q) / (1 - rate))).otherwise(z)
    sure = df.where("w is not null and d1 > 0").where((q >= least_share) & (q > rate) & (-F.col("d") * far <= math.log(p_value)))
    return [r["w"] for r in sure.select("w").orderBy("w").collect()]


def make_task(mined: list[str]) -> Task:
    themes = {w: 1 << i for i, k in enumerate(LEXICONS) if k != "harm" for w in LEXICONS[k].split()}
    harm = 1 << list(LEXICONS).index("harm")
    base = len(LEXICONS)
    terms = dict(themes)
    for w in mined:
        terms[w] = terms.get(w, 0) | 1 << base + crc32(w.encode()) % SLICES
    judged = ((1 << len(VOTERS)) - 1) << SHIFT
    two, aimed, disguised = (1 << base + SLICES + i for i in range(3))
    known = frozenset(terms)

    def look(text: str) -> tuple[int, set[str]]:
        low = text.lower()
        words = _WORD.findall(low)
        own = set(words)
        met, mask = own & known, 0
        for w in met:
            mask |= terms[w]
        if len(met) > 1:
            mask |= two
        if met and own & _YOU and any(words[i] in met and _YOU & set(words[max(0, i - 3) : i + 4]) for i in range(len(words))):
            mask |= aimed
        if {"kill", "hate", "die"} & own and any(p in _HARM for p in zip(words, words[1:])):
            mask |= harm
        if any(m in low for m in _MARKS) and _DISGUISE.search(low):
            mask |= disguised
        return mask, own

    def votes(text: str) -> int:
        return look(text)[0] | judged

    def features(text: str) -> tuple[np.ndarray, np.ndarray]:
        mask, own = look(text)
        idx = {crc32(w.encode()) % (DIMS - 64) for w in own}
        at = [*idx, *(VOTER_AT[i] for i in range(len(VOTERS)) if mask >> i & 1)]
        return np.array(at, np.int64), np.ones(len(at))

    return Task(VOTERS, votes, features, VOTER_AT, prior=0.05)


def fit_toxicity(docs: DataFrame, labels: DataFrame | None = None, text: str = "text", id_col: str = "doc_id", train_rows: int = 8000, label_rows: int = 20_000) -> tuple[Task, Linear]:
    """Mines a lexicon from ``labels`` (doc_id, toxic) if given, fits the label model on all documents' votes and
    the linear classifier on the posteriors of at most ``train_rows`` texts."""
    task = make_task(mine_lexicon(docs, labels, text, id_col, label_rows) if labels is not None else [])
    return task, train(docs, text, task, train_rows)[1]


def score_toxicity(docs: DataFrame, labels: DataFrame | None = None, text: str = "text", id_col: str = "doc_id", out: str = "toxicity", model: tuple[Task, Linear] | None = None, **bounds: int) -> DataFrame:
    """``docs`` with ``out``, the probability that a text is toxic, from its whole words.

    Null text gives null and never counts as toxic; empty text has no sign of toxicity; repeated
    rows score alike; other columns are kept (one named ``out`` is replaced); an empty table leaves
    the model at its start values, which still knows the built-in lexicons.
    """
    task, linear = model or fit_toxicity(docs, labels, text, id_col, **bounds)
    return score(docs, text, task, linear, out)


def drop_toxic(docs: DataFrame, labels: DataFrame | None = None, text: str = "text", id_col: str = "doc_id", threshold: float = 0.5, **bounds: int) -> DataFrame:
    """The rows whose text isn't toxic, null texts among them."""
    p = free_name(docs.columns, "toxicity")
    return score_toxicity(docs, labels, text, id_col, p, **bounds).where(F.col(p).isNull() | (F.col(p) < threshold)).drop(p)
