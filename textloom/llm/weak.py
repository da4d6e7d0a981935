"""Weak supervision: a label model over noisy voters, and a hashed linear scorer fitted to its posteriors.

Voters say 1 (a sign of the unwanted class), 0, or nothing. The label model is a latent-class model
fitted by expectation-maximisation on the counts of vote patterns over *all* documents, so its cost
on the driver depends on the number of distinct patterns alone. Class 0 is the wanted one; the
unwanted ones are kinds of bad text, as many as there are groups of voters that fire together. The
model estimates each voter's rate of firing in each class (its accuracies) and, from the residuals
within the classes, how voters still correlate; correlated voters then share one voice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import few, text_key

SHIFT = 24  # a vote pattern is fired | judged << SHIFT
DIMS = 1 << 18


@dataclass
class LabelModel:
    prior: np.ndarray  # (classes,): class 0 is the wanted one
    hit: np.ndarray  # (classes, voters): probability of a 1
    voice: np.ndarray  # (voters,): 1 for an independent voter, less for correlated ones
    corr: np.ndarray  # (voters, voters): correlation that the classes don't explain

    def classes(self, fired: np.ndarray, judged: np.ndarray) -> np.ndarray:
        """Posterior of every class for rows of 0/1 votes; voters that didn't judge count for nothing."""
        z = np.log(self.prior) + (fired * self.voice) @ np.log(self.hit.T) + ((judged - fired) * self.voice) @ np.log(1 - self.hit.T)
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def posterior(self, fired: np.ndarray, judged: np.ndarray) -> np.ndarray:
        """Probability that a text is of any unwanted class."""
        return 1 - self.classes(fired, judged)[:, 0]

    def rates(self) -> tuple[np.ndarray, np.ndarray]:
        """Each voter's rate of firing in the wanted class and in the unwanted ones together."""
        return self.hit[0], self.prior[1:] @ self.hit[1:] / self.prior[1:].sum()


def bits(masks: np.ndarray, voters: int) -> tuple[np.ndarray, np.ndarray]:
    masks = np.asarray(masks, np.int64)
    at = np.arange(voters)
    return ((masks[:, None] >> at) & 1).astype(float), ((masks[:, None] >> (SHIFT + at)) & 1).astype(float)


def _kinds(fired: np.ndarray, counts: np.ndarray, agree: float = 0.3, alike: float = 0.85) -> list[np.ndarray]:
    """Profiles of what fires beside each voter, one of each sort; a voter that fires alone founds no class."""
    n = counts @ fired
    found: list[np.ndarray] = []
    for k in np.lexsort((np.arange(len(n)), -n)):
        if not n[k]:
            continue
        prof = (counts * fired[:, k]) @ fired / n[k]
        others = np.delete(prof, k)
        if others.size and others.max() >= agree and all(prof @ f / np.linalg.norm(prof) / np.linalg.norm(f) < alike for f in found):
            found.append(prof)
    return found


def fit_label_model(masks: np.ndarray, counts: np.ndarray, voters: int, prior: float, strength: float = 4.0, rounds: int = 60, most_false: float = 0.02) -> LabelModel:
    """EM from ``prior`` for all unwanted classes together.

    The unwanted classes start from the profiles of voters that fire together. In the wanted class no
    voter may fire on more than ``most_false``: voters are written to be precise, and without this
    bound texts with the commonest sign would make up a class of their own. Rates are held to their
    start by ``strength`` pseudo-documents; without documents the start values stay.
    """
    fired, judged = bits(masks, voters)
    counts = np.asarray(counts, float)
    total = counts.sum()
    start = np.stack([np.full(voters, most_false / 2), *(_kinds(fired, counts) or [np.full(voters, 0.4)])]).clip(most_false / 2, 0.9)
    first = np.array([1 - prior, *[prior / (len(start) - 1)] * (len(start) - 1)])
    m = LabelModel(first, start.copy(), np.ones(voters), np.eye(voters))
    for r in range(rounds):
        cls = m.classes(fired, judged).T * counts
        rate = ((cls @ fired + strength * start) / (cls @ judged + strength)).clip(1e-4, 1 - 1e-4)
        rate[0] = np.minimum(rate[0], most_false)
        m = LabelModel((cls.sum(axis=1) + strength * first) / (total + strength), rate, m.voice, m.corr)
        if r % 10 == 9 and total:
            m.corr = _residual(fired, judged, cls, rate)
            m.voice = 1 / np.where(m.corr > 0.1, m.corr, 0).sum(axis=1)
    return m


def _residual(fired: np.ndarray, judged: np.ndarray, cls: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Correlation of the voters within the classes, weighted by class size."""
    total, out = cls.sum() + 1e-9, np.zeros((fired.shape[1],) * 2)
    for w, q in zip(cls, rate):
        e = (fired - q) * judged
        cov = (e * w[:, None]).T @ e / ((judged * w[:, None]).T @ judged + 1.0)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-6))
        out += w.sum() / total * cov / sd[:, None] / sd
    np.fill_diagonal(out, 1.0)
    return np.clip(out, -1, 1)


@dataclass
class Linear:
    """Weights by hashed feature; only ``at`` are not zero. Sorted, so that scoring is a binary search."""

    bias: float
    at: np.ndarray
    w: np.ndarray

    def score(self, idx: np.ndarray, val: np.ndarray) -> float:
        if not len(self.at) or not len(idx):
            return self.bias
        k = np.minimum(np.searchsorted(self.at, idx), len(self.at) - 1)
        return float(self.bias + (self.w[k] * val * (self.at[k] == idx)).sum())


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, start: dict[int, float], bias: float, least_chi2: float = 30.0, hold: float = 0.05, rounds: int = 300) -> Linear:
    """Logistic regression on soft ``labels``.

    Features are screened: those in ``start`` stay, others only if their chi-squared against the
    labels reaches ``least_chi2``. Weights are held towards ``start`` (the label model's log odds,
    0 for the rest), which alone decides when there are no rows.
    """
    held = np.array(sorted(start), np.int64)
    if not rows:
        return Linear(bias, held, np.array([start[k] for k in held.tolist()], float))
    idx = np.concatenate([r[0] for r in rows]).astype(np.int64)
    val = np.concatenate([r[1] for r in rows]).astype(float)
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    n, n1 = len(rows), labels.sum()
    df = np.bincount(idx, minlength=DIMS).astype(float)
    df1 = np.bincount(idx, weights=labels[row], minlength=DIMS)
    want = df * n1 / n
    chi = (df1 - want) ** 2 / np.maximum(want * (1 - n1 / n) * (1 - df / n).clip(1e-9), 1e-9)
    keep = (chi >= least_chi2) & (df >= 5)
    keep[held] = True
    at = np.flatnonzero(keep)
    sel = keep[idx]
    col, val, row = np.searchsorted(at, idx[sel]), val[sel], row[sel]
    base = np.array([start.get(k, 0.0) for k in at.tolist()])
    w, b = base.copy(), bias
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = b + np.bincount(row, weights=w[col] * val, minlength=n)
        g = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels
        gw = np.bincount(col, weights=val * g[row], minlength=len(at)) / n + hold / n * (w - base)
        gb = g.mean()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.2 * (1 - t / (rounds + 1))
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        b = b - rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-6)
    return Linear(float(b), at, w)


@dataclass
class Task:
    """What the voters of one classifier are and what its linear scorer sees."""

    voters: list[str]
    #: text -> vote pattern
    votes: Callable[[str], int]
    #: text -> hashed features (sorted or not, no repeats) and values
    features: Callable[[str], tuple[np.ndarray, np.ndarray]]
    #: feature of each voter's 1, for the linear scorer's start
    voter_at: list[int]
    prior: float
    extra: dict = field(default_factory=dict)


def train(docs: DataFrame, text: str, task: Task, train_rows: int) -> tuple[LabelModel, Linear]:
    """Label model from every document's votes; linear scorer from about ``train_rows`` distinct texts.

    The texts are those with the least content keys, which is the same sample wherever it is drawn.
    """
    t = docs.select(F.col(f"`{text}`").cast("string").alias("t")).where("t is not null")

    @F.arrow_udf("long")
    def votes(a: pa.Array) -> pa.Array:
        return pa.array([task.votes(x) for x in few(a)], pa.int64())

    patterns = t.select(votes("t").alias("v")).groupBy("v").count().collect()
    masks, counts = np.array([r["v"] for r in patterns], np.int64), np.array([r["count"] for r in patterns], float)
    model = fit_label_model(masks, counts, len(task.voters), task.prior)

    @F.arrow_udf("struct<v: bigint, i: binary, x: binary>")
    def featured(a: pa.Array) -> pa.Array:
        vs, ids, xs = [], [], []
        for x in few(a):
            i, w = task.features(x)
            vs.append(task.votes(x))
            ids.append(np.asarray(i, "<i4").tobytes())
            xs.append(np.asarray(w, "<f4").tobytes())
        return pa.StructArray.from_arrays([pa.array(vs, pa.int64()), pa.array(ids, pa.binary()), pa.array(xs, pa.binary())], ["v", "i", "x"])

    total = counts.sum()
    part = min(1.0, 1.2 * train_rows / max(1.0, total))
    sample = t.select(text_key("t").alias("k"), "t").where(F.pmod(F.xxhash64("t"), F.lit(1 << 30)) < int(part * (1 << 30)) + 1)
    got = sorted(sample.dropDuplicates(["k"]).select("k", featured("t").alias("f")).collect(), key=lambda r: bytes(r["k"]))[:train_rows]
    rows = [(np.frombuffer(r["f"]["i"], "<i4"), np.frombuffer(r["f"]["x"], "<f4")) for r in got]
    fired, judged = bits(np.array([r["f"]["v"] for r in got], np.int64), len(task.voters))
    labels = model.posterior(fired, judged) if got else np.zeros(0)
    good, bad = model.rates()
    start = {k: float(x) for k, x in zip(task.voter_at, np.maximum(0, np.log(bad / good)) * model.voice)}
    bias = float(np.log((1 - model.prior[0]) / model.prior[0])) - 1
    return model, fit_linear(rows, labels, start, bias)


def score(docs: DataFrame, text: str, task: Task, linear: Linear, out: str) -> DataFrame:
    """``docs`` with ``out``: the linear scorer's probability of the unwanted class, null for null text."""

    @F.arrow_udf("double")
    def p(a: pa.Array) -> pa.Array:
        got = []
        for x in few(a):
            if x is None:
                got.append(None)
            else:
                z = linear.score(*task.features(x))
                got.append(round(1 / (1 + float(np.exp(-min(40.0, max(-40.0, z))))), 9))
        return pa.array(got, pa.float64())

    return docs.withColumn(out, p(F.col(f"`{text}`").cast("string")))
