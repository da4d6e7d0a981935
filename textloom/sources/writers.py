"""Sinks: JSONL, rejected and dropped rows beside it, plain text, reports."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators import reports
from textloom.storage import mounted, written


def write_jsonl(df: DataFrame, path: str) -> int:
    """Rows as JSON lines without null fields; their number."""
    df.write.mode("overwrite").option("ignoreNullFields", True).json(path)
    return df.sparkSession.read.text(path).count()


def sidecar(path: str, kind: str) -> str:
    """x.jsonl -> x.rejected.jsonl"""
    stem, dot, ext = path.rpartition(".")
    return f"{stem}.{kind}.{ext}" if dot and "/" not in ext else f"{path}.{kind}"


def write_split(tagged: DataFrame, path: str, reason: str = "reason", kind: str = "rejected") -> dict[str, int]:
    """Rows without a reason to ``path``, the others to its sidecar, from one computation; no sidecar if there are none."""
    once = written(tagged, "split")
    out = {"kept": write_jsonl(once.where(F.col(reason).isNull()).drop(reason), path), kind: 0}
    bad = once.where(F.col(reason).isNotNull())
    if not bad.isEmpty():
        out[kind] = write_jsonl(bad, sidecar(path, kind))
    return out


def write_text(df: DataFrame, path: str, text: str = "text") -> None:
    df.select(text).write.mode("overwrite").text(path)


def write_report(df: DataFrame, path: str, title: str) -> None:
    """A small table as path.json and path.md."""
    base = mounted(path)
    os.makedirs(os.path.dirname(base) or ".", exist_ok=True)
    for end, body in ((".json", reports.as_json(df)), (".md", reports.as_markdown(df, title))):
        with open(base + end, "w", encoding="utf-8") as f:
            f.write(body)
