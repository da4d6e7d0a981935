"""Scans: typed and lenient JSONL, columns and struct fields of Parquet, gzip JSONL, blank-line documents, verses."""

from __future__ import annotations

import json
import lzma
from dataclasses import dataclass
from urllib.request import urlopen

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from textloom.functions import text as T
from textloom.functions.udfs import nfc, strip_markup_fragments, unescape
from textloom.schema import RAW, RECORD


def read_jsonl(spark: SparkSession, path: str, schema: S.StructType) -> DataFrame:
    """Typed rows; blank lines are skipped, a bad line ends the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, RAW)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, RECORD)


def read_jsonl_texts(spark: SparkSession, path: str) -> DataFrame:
    """``text`` of every line that has one: trimmed; bad JSON, missing, non-string and blank texts are passed over."""
    v = F.try_parse_json(F.col("value"))
    kind = F.schema_of_variant(F.try_variant_get(v, "$.text", "variant"))
    text = F.when(kind == "STRING", F.try_variant_get(v, "$.text", "string"))
    return spark.read.text(path).select(T.trim_white(text).alias("text")).where(~T.is_blank(F.col("text")))


def read_text_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One string column, or a struct's string field (``struct.field``), of Parquet; only it is read."""
    df = spark.read.parquet(path).select(F.col(column).alias("text"))
    if not isinstance(df.schema["text"].dataType, S.StringType):
        raise TypeError(f"{column} is {df.schema['text'].dataType.simpleString()}, not a string")
    return df.where(~T.is_blank(F.col("text")))


def read_gzip_jsonl(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """``text`` of gzip JSONL; gzip can't be split, so rows are spread if ``partitions`` is given."""
    df = read_jsonl(spark, path, S.StructType([S.StructField("text", S.StringType())])).where(~T.is_blank(F.col("text")))
    return df.repartition(partitions) if partitions else df


def read_blank_line_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents set apart by a blank line, each as one line; plain or xz files (xz is unpacked file by file as a stream)."""
    if not path.endswith(".xz"):
        raw = spark.read.option("lineSep", "\n\n").text(path).select(F.col("value").alias("text"))
    else:
        names = spark.read.format("binaryFile").load(path).select("path")

        def unpack(batches):
            for b in batches:
                for name in b.column(0).to_pylist():
                    with lzma.open("/" + name.split(":", 1)[1].lstrip("/") if name.startswith("file:") else name) as f:
                        held = []
                        for line in f:
                            if line.strip(b"\r\n"):
                                held.append(line.decode("utf-8", "replace"))
                            elif held:
                                yield pa.RecordBatch.from_arrays([pa.array(["".join(held)])], names=["text"])
                                held = []
                        if held:
                            yield pa.RecordBatch.from_arrays([pa.array(["".join(held)])], names=["text"])

        raw = names.mapInArrow(unpack, "text string")
    return raw.select(T.join_lines(F.col("text")).alias("text")).where("text <> ''")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty lines."""
    return spark.read.text(path).select(F.col("value").alias("text")).where("text <> ''")


def read_training_texts(spark: SparkSession, path: str) -> DataFrame:
    """Texts as tokenizer training reads them: tidy, in NFC, without empty ones."""
    return read_jsonl_texts(spark, path).select(T.tidy_document(nfc(F.col("text"))).alias("text")).where("text <> ''")


@dataclass(frozen=True)
class SourceSpec:
    """How one source is read: format, where the text is, what is mended at export."""

    key: str
    format: str
    column: str = "text"
    unescape: bool = False
    cut_fragments: bool = False
    shards: tuple[str, ...] = ()


SPECS = {
    s.key: s
    for s in (
        SourceSpec("hplt", "parquet"),
        SourceSpec("wikipedia", "parquet"),
        SourceSpec("opus", "parquet", "translation.so", cut_fragments=True),
        SourceSpec("mt560", "parquet", "som", shards=("train-00000-of-00001",)),
        SourceSpec("mc4", "json.gz", unescape=True, shards=tuple(f"c4-so.tfrecord-{i:05d}-of-00064.json.gz" for i in range(64))),
        SourceSpec("madlad", "json.gz", unescape=True, shards=("clean", "noisy")),
        SourceSpec("cc100", "blank_line"),
        SourceSpec("quran", "verses"),
    )
}


def read_source(spark: SparkSession, spec: SourceSpec, path: str, limit: int | None = None) -> DataFrame:
    """``(text, source)`` of a source's files: non-blank, mended as the source needs; nothing at all is an error."""
    if spec.format == "parquet":
        df = read_text_column(spark, path, spec.column)
    elif spec.format == "json.gz":
        df = read_gzip_jsonl(spark, path)
    elif spec.format == "blank_line":
        df = read_blank_line_documents(spark, path)
    else:
        df = verses(spark.read.schema(VERSES).option("multiLine", True).json(path))
    if spec.unescape:
        df = df.withColumn("text", unescape(F.col("text")))
    if spec.cut_fragments:
        df = df.withColumn("text", strip_markup_fragments(F.col("text")))
    df = df.where(~T.is_blank(F.col("text")))
    if df.isEmpty():
        raise ValueError(f"{spec.key}: no text in {path}")
    df = df.select("text", F.lit(spec.key).alias("source"))
    return df.limit(limit) if limit else df


VERSES = S.StructType([S.StructField("result", S.ArrayType(S.StructType([S.StructField("translation", S.StringType()), S.StructField("footnotes", S.StringType())])))])


def verses(chapters: DataFrame) -> DataFrame:
    """Translations and footnotes of chapter responses, a row each, cleaned; empty ones go."""
    one = chapters.select(F.explode("result").alias("v"))
    both = F.array(T.clean_verse(F.col("v.translation")), T.clean_footnote(F.col("v.footnotes")))
    return one.select(F.explode(F.array_compact(both)).alias("text"))


class ChapterSource(DataSource):
    """A JSON API of numbered chapters, one partition each. Options: url (with {n}), chapters (114)."""

    @classmethod
    def name(cls) -> str:
        return "chapters"

    def schema(self) -> str:
        return "chapter int, body string"

    def reader(self, schema: S.StructType) -> DataSourceReader:
        return _ChapterReader(self.options)


class _ChapterReader(DataSourceReader):
    def __init__(self, options):
        self.url, self.n = options["url"], int(options.get("chapters", "114"))

    def partitions(self):
        return [InputPartition(i) for i in range(1, self.n + 1)]

    def read(self, partition):
        with urlopen(self.url.replace("{n}", str(partition.value)), timeout=60) as r:
            yield partition.value, json.dumps(json.loads(r.read()), ensure_ascii=False)


def read_chapters(spark: SparkSession, url: str, chapters: int = 114) -> DataFrame:
    spark.dataSource.register(ChapterSource)
    raw = spark.read.format("chapters").option("url", url).option("chapters", chapters).load()
    return verses(raw.select(F.from_json("body", VERSES).alias("b")).select("b.*"))


def list_shards(paths: list[str], suffix: str) -> list[str]:
    """Paths with a suffix, sorted."""
    return sorted(p for p in paths if p.endswith(suffix))
