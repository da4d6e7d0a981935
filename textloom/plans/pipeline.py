"""The curation pipeline: merge, clean, language gate, deep clean, near dedup."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom import registry
from textloom.config import Config
from textloom.functions.udfs import Detector
from textloom.operators import clean, deep_clean, lid, merge, near_dup, reports
from textloom.schema import reject
from textloom.storage import written

STAGES = ("merge", "clean", "lid", "deep_clean", "near_dedup")


@dataclass
class Result:
    kept: DataFrame
    rejected: dict[str, DataFrame] = field(default_factory=dict)
    taken: dict[str, DataFrame] = field(default_factory=dict)
    passed: dict[str, DataFrame] = field(default_factory=dict)

    def funnel(self) -> DataFrame:
        return reports.funnel([(s, self.taken[s], self.passed[s]) for s in self.taken])

    def drops(self) -> DataFrame:
        """(stage, source, reason, n) of all stages."""
        out = None
        for s, df in self.rejected.items():
            part = df.groupBy(F.lit(s).alias("stage"), "source", "reason").agg(F.count("*").alias("n"))
            out = part if out is None else out.unionByName(part)
        return out


def run(raw: DataFrame, sources: list[registry.Source], cfg: Config = Config(), detector: Detector | None = None, stages: tuple[str, ...] = STAGES) -> Result:
    """``raw`` (source, rank, ordinal, text) through the named stages, in their order.

    Each stage's rows are written once to the shared folder with their reasons; what it keeps, what
    it drops and its counts are then filters of that table.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"no such stage: {', '.join(sorted(unknown))}")
    result = Result(raw)
    df = raw
    for s in STAGES:
        if s not in stages:
            continue
        taken = df
        if s == "merge":
            tagged = merge.mark_first_wins(df)
        elif s == "clean":
            tagged = clean.clean(df.select("source", "rank", "ordinal", "text"), sources, cfg.clean)
        elif s == "lid":
            if detector is None:
                continue
            tagged = lid.apply_gate(df.drop("reason"), detector, cfg.lid.target, cfg.lid.min_confidence, cfg.lid.detect_clip_bytes).withColumnRenamed("lid_reason", "reason")
        elif s == "deep_clean":
            tagged = deep_clean.deep_clean(df.drop("reason"), cfg.deep_clean, detector, cfg.lid.target, cfg.clean.max_repeated_run).withColumnRenamed("deep_reason", "reason")
        else:
            tagged = near_dup.mark(df.drop("reason"), cfg.near_dedup, "id", "text", F.col("kind") == registry.DOCUMENT)
            tagged = tagged.withColumn("reason", F.when(F.col("near_duplicate_of").isNotNull(), "near_duplicate"))
            tagged = tagged.withColumn("disposition", reject(F.col("disposition"), F.col("reason")))
        table = written(tagged, f"stage-{s}")
        df = table.where("reason is null")
        result.taken[s], result.passed[s], result.rejected[s] = taken, df, table.where("reason is not null")
    result.kept = df
    return result
