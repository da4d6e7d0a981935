"""What is known of each source: a small static table, joined by broadcast."""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT, SENTENCE = "document", "sentence"


@dataclass(frozen=True)
class Source:
    """Sentence sources are tagged with a language but never gated by it, and take no part in near dedup."""

    key: str
    kind: str
    license_id: str = "Other"
    rank: int = 0

    @property
    def lid_policy(self) -> str:
        return "gate" if self.kind == DOCUMENT else "tag_only"

    @property
    def near_dedup(self) -> bool:
        return self.kind == DOCUMENT


#: Public corpora, in merge order: curated first, the largest crawl last.
PUBLIC = [
    Source(key, kind, license_id, rank)
    for rank, (key, kind, license_id) in enumerate(
        [
            ("quran", SENTENCE, "Other"), ("mt560", SENTENCE, "CC-BY-4.0"), ("opus", SENTENCE, "CC0-1.0"),
            ("cc100", DOCUMENT, "CC-BY-SA-4.0"), ("mc4", DOCUMENT, "ODC-BY"), ("madlad", DOCUMENT, "ODC-BY"),
            ("wikipedia", DOCUMENT, "CC-BY-SA-4.0"), ("hplt", DOCUMENT, "CC0-1.0"),
        ]
    )
]


def numbered(n: int = 20, prefix: str = "src") -> list[Source]:
    """A registry for numbered sources: even ones hold documents, odd ones sentences."""
    return [Source(f"{prefix}{i}", DOCUMENT if i % 2 == 0 else SENTENCE, "CC0-1.0", i) for i in range(n)]


def as_frame(spark: SparkSession, sources: list[Source]) -> DataFrame:
    rows = [(*astuple(s), s.lid_policy, s.near_dedup) for s in sources]
    return spark.createDataFrame(rows, "source string, kind string, license_id string, rank int, lid_policy string, near_dedup boolean")


def look_up(df: DataFrame, sources: list[Source], source: str = "source") -> DataFrame:
    """``df`` with kind, license_id, rank, lid_policy and near_dedup; null for unknown sources. One row per source is broadcast."""
    reg = as_frame(df.sparkSession, sources).withColumnRenamed("source", "_key")
    return df.join(F.broadcast(reg), F.col(source) == F.col("_key"), "left").drop("_key")
