"""Quality classifier: weak labels from overlapping heuristics, EM, and a hashed linear scorer."""

from __future__ import annotations

import functools
import re
from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import free_name
from textloom.llm.weak import DIMS, SHIFT, Linear, Task, score, train

#: Heuristic labellers: name, and whether a text shows the sign (None: it can't be judged).
VOTERS = [
    "symbols", "symbol_ends", "capitals", "exclamations", "menu_bars", "stutter", "few_distinct",
    "one_word_rules", "no_stops", "repeated_sentences", "odd_word_length", "symbol_words", "digits",
]
_RUN = re.compile(r"[^\w\s.,;:'\"()\-]{2,}(?=\s|\Z)")
_STOP = re.compile(r"[.!?\n]+")
_RUNS = [(re.compile(c + "+"), c) for c in "aA0"]
_OTHER_RUNS = re.compile(r"([^\w\s])\1{2,}")


class _Signs(dict):
    """Code point to what stands for it in a shape: a, A or 0 for small letters, capitals, digits; others stay."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        got = self[point] = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isalnum() else c
        return got


@functools.lru_cache(100_000)
def _place(shape: str) -> int:
    return crc32(shape.encode("utf-8", "surrogatepass")) % (DIMS - 4096)


_signs = _Signs()
VOTER_AT = [DIMS - 4096 + i for i in range(len(VOTERS))]


def _look(text: str) -> tuple[dict[str, float | None], Counter]:
    """Measures behind the labellers (None where a text is too short to judge), and the words' shapes.

    The whole text is turned into shapes at once: letters, capitals and digits as one sign a run, runs
    of other signs as two, so a few string passes do for all words.
    """
    signs = text.translate(_signs)
    small, upper, digits = map(signs.count, "aA0")
    runs = signs
    for r, c in _RUNS:
        runs = r.sub(c, runs)
    shapes = Counter(_OTHER_RUNS.sub(r"\1\1", runs).split())
    low = [w.strip(".,;:!?") for w in text.lower().split()]
    n = len(low)
    if not n:
        return dict.fromkeys(VOTERS), shapes
    letters = len(text) - sum(map(text.count, " \n")) if text.isascii() and text.isprintable() else len("".join(text.split()))
    alnum = small + upper + digits
    counts = Counter(low)
    long_enough = n >= 12
    sentences = [s for s in map(str.strip, _STOP.split(text)) if s] if n >= 4 else []
    return {
        "symbols": 1 - alnum / letters if long_enough else None,
        "symbol_ends": len(_RUN.findall(signs)) / n if long_enough else None,
        "capitals": upper / max(1, alnum) if long_enough else None,
        "exclamations": text.count("!") / n if long_enough else None,
        "menu_bars": text.count("|") / n if n >= 6 else None,
        "stutter": sum(map(str.__eq__, low, low[1:])) / n if n >= 6 else None,
        "few_distinct": 1 - len(counts) / n**0.9 if n >= 40 else None,
        "one_word_rules": max(counts.values()) / n if long_enough else None,
        "no_stops": 1 - min(1.0, sum(c for s, c in shapes.items() if s[-1] in ".!?") * 60 / n) if n >= 30 else None,
        "repeated_sentences": 1 - len(set(sentences)) / len(sentences) if len(sentences) >= 4 else None,
        "odd_word_length": abs(letters / n - 5.5) if long_enough else None,
        "symbol_words": sum(c for s, c in shapes.items() if not any(x in s for x in "aA0")) / n if n >= 6 else None,
        "digits": digits / letters if long_enough else None,
    }, shapes


def measures(text: str) -> dict[str, float | None]:
    return _look(text)[0]


LIMITS = {
    "symbols": 0.2, "symbol_ends": 0.15, "capitals": 0.5, "exclamations": 0.15, "menu_bars": 0.12, "stutter": 0.2,
    "few_distinct": 0.55, "one_word_rules": 0.3, "no_stops": 0.9, "repeated_sentences": 0.45, "odd_word_length": 4.5,
    "symbol_words": 0.12, "digits": 0.4,
}


def votes(text: str) -> int:
    mask = 0
    for i, (k, v) in enumerate(measures(text).items()):
        if v is not None:
            mask |= (1 << SHIFT + i) | ((v > LIMITS[k]) << i)
    return mask


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Share of each word shape (hashed), each labeller's vote, and each measure in four steps around its limit."""
    found, shapes = _look(text)
    total = shapes.total()
    by: dict[int, float] = {}
    for s, c in shapes.items():
        k = _place(s) if len(s) < 40 else crc32(s.encode("utf-8", "surrogatepass")) % (DIMS - 4096)
        by[k] = by.get(k, 0.0) + c / total
    idx, val = list(by), list(by.values())
    for i, (k, v) in enumerate(found.items()):
        if v is None:
            continue
        if v > LIMITS[k]:
            idx.append(VOTER_AT[i])
            val.append(1.0)
        for step, x in enumerate((0.4, 0.7, 1.5)):
            if v > x * LIMITS[k]:
                idx.append(DIMS - 4096 + 64 + 4 * i + step)
                val.append(1.0)
    return np.array(idx, np.int64), np.array(val)


TASK = Task(VOTERS, votes, features, VOTER_AT, prior=0.1)


def fit_quality(docs: DataFrame, text: str = "text", train_rows: int = 6000) -> Linear:
    """EM over all documents' labeller votes, then the linear scorer on at most ``train_rows`` texts."""
    return train(docs, text, TASK, train_rows)[1]


def score_quality(docs: DataFrame, text: str = "text", out: str = "p_low", model: Linear | None = None, train_rows: int = 6000) -> DataFrame:
    """``docs`` with ``out``, the probability that a text is of low quality (fitted on ``docs`` unless given a model).

    Null text gives null; empty text is scored by the bias (no labeller can judge it); repeated rows
    get equal scores; other columns are kept, one named like ``out`` is replaced; an empty table
    leaves the model at its start values.
    """
    return score(docs, text, TASK, model or fit_quality(docs, text, train_rows), out)


def keep_quality(docs: DataFrame, text: str = "text", threshold: float = 0.5, train_rows: int = 6000) -> DataFrame:
    """The rows whose text isn't rejected; null and empty texts have nothing to keep and go."""
    p = free_name(docs.columns, "p_low")
    scored = score_quality(docs.where(F.col(f"`{text}`").rlike(r"\S")), text, p, fit_quality(docs, text, train_rows))
    return scored.where(F.col(p) < threshold).drop(p)
