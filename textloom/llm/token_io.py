"""Token ids on disk: independent zstandard frames, a trailing seek table, a checksum per frame.

A file is a run of zstd frames, one per document, then a skippable frame that holds, for every
frame, compressed size, raw size and the low 32 bits of the raw bytes' XXH64, and a 9-byte footer
(number of frames, descriptor, magic number): the public seekable-zstd layout, so any zstd reader
can still stream the whole file.
"""

from __future__ import annotations

import os
import struct
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import VOCAB, encoder, free_name
from textloom.storage import mounted

SKIPPABLE, SEEKABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1, struct.Struct("<IBI")
ENTRY = np.dtype([("packed", "<u4"), ("raw", "<u4"), ("sum", "<u4")])
MOST_RAW = 1 << 30  # a document's ids beyond this many bytes do not fit a 32-bit entry safely


class FrameWriter:
    """One file; it appears under its name only when whole."""

    def __init__(self, path: str, level: int = 3):
        self.path, self.temp = path, f"{path}.{uuid.uuid4().hex}.tmp"
        self.file, self.entries = open(self.temp, "wb"), []
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)

    def add(self, raw: bytes) -> tuple[int, int, int]:
        """Frame number, packed size, checksum."""
        if len(raw) > MOST_RAW:
            raise ValueError(f"a document of {len(raw)} bytes of ids is too long for one frame")
        packed, check = self.zstd.compress(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF
        self.file.write(packed)
        self.entries.append((len(packed), len(raw), check))
        return len(self.entries) - 1, len(packed), check

    def close(self) -> None:
        table = np.array(self.entries, ENTRY).tobytes() + FOOTER.pack(len(self.entries), 0x80, SEEKABLE)
        self.file.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.file.flush()
        os.fsync(self.file.fileno())
        self.file.close()
        os.replace(self.temp, self.path)


class FrameReader:
    """Reads the seek table, then only the frames that are asked for."""

    def __init__(self, path: str):
        self.path, self.file = path, open(path, "rb")
        end = self.file.seek(0, os.SEEK_END)
        if end < FOOTER.size + 8:
            raise ValueError(f"{path}: no seek table")
        self.file.seek(end - FOOTER.size)
        n, _, magic = FOOTER.unpack(self.file.read(FOOTER.size))
        if magic != SEEKABLE:
            raise ValueError(f"{path}: no seek table")
        self.file.seek(end - FOOTER.size - n * ENTRY.itemsize)
        self.table = np.frombuffer(self.file.read(n * ENTRY.itemsize), ENTRY)
        self.starts = np.concatenate([[0], np.cumsum(self.table["packed"], dtype=np.int64)])
        self.zstd = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> bytes:
        if not 0 <= k < len(self.table):
            raise IndexError(f"{self.path}: no frame {k}")
        self.file.seek(int(self.starts[k]))
        raw = self.zstd.decompress(self.file.read(int(self.table["packed"][k])))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table["sum"][k] or len(raw) != self.table["raw"][k]:
            raise ValueError(f"{self.path}: frame {k} does not match its checksum")
        return raw

    def close(self) -> None:
        self.file.close()


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", vocab: str = VOCAB, level: int = 3) -> DataFrame:
    """Encodes every text and writes one seekable file per partition under ``path`` (a shared folder).

    Returns the catalogue, also kept in ``path``/index: doc_id, file, frame, n_tokens, packed_bytes,
    checksum. It has one row per input row, repeated rows and ids included, each with its own frame.
    Null text has no frame (frame, sizes and checksum null); empty text has a frame of no ids. A null
    id stays null. Other columns are not read. An empty table gives an empty catalogue. Files are
    named by partition and renamed into place, so a repeated task leaves one whole file.
    """
    folder = mounted(path)
    os.makedirs(folder, exist_ok=True)
    schema = pa.schema([("file", pa.int32()), ("frame", pa.int64()), ("n_tokens", pa.int64()), ("packed_bytes", pa.int64()), ("checksum", pa.int64())])
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    id_type = narrow.schema["id"].dataType.simpleString()

    def part(batches):
        e, k, writer = encoder(vocab), TaskContext.get().partitionId(), None
        for b in batches:
            rows = []
            for t in b.column(1).to_pylist():
                if t is None:
                    rows.append((None, None, None, None, None))
                    continue
                writer = writer or FrameWriter(os.path.join(folder, f"part-{k:06d}.tokz"), level)
                raw = e.raw(t)
                rows.append((k, *(lambda f, p, c: (f, len(raw) // 4, p, c))(*writer.add(raw))))
            made = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, schema.types)]
            yield pa.RecordBatch.from_arrays([b.column(0), *made], names=["id", *schema.names])
        if writer:
            writer.close()

    index = narrow.mapInArrow(part, f"id {id_type}, file int, frame long, n_tokens long, packed_bytes long, checksum long")
    index.withColumnRenamed("id", id_col if id_col not in schema.names else free_name(schema.names, id_col)).write.mode("overwrite").parquet(f"{path}/index")
    return docs.sparkSession.read.parquet(f"{path}/index")


def read_tokens(spark: SparkSession, path: str, wanted: DataFrame, out: str = "token_ids") -> DataFrame:
    """``wanted`` (rows of the catalogue, any columns, at least file and frame) with their ids.

    Only the wanted frames are decompressed, file by file in frame order; a frame that does not
    match its checksum is an error. Rows without a frame get null ids.
    """
    folder = mounted(path)
    rows = wanted.repartition("file").sortWithinPartitions("file", "frame")
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.BinaryType())])
    names = rows.columns

    def part(batches):
        reader, at = None, None
        for b in batches:
            got = []
            for f, k in zip(b.column(names.index("file")).to_pylist(), b.column(names.index("frame")).to_pylist()):
                if f is None or k is None:
                    got.append(None)
                    continue
                if f != at:
                    if reader:
                        reader.close()
                    reader, at = FrameReader(os.path.join(folder, f"part-{f:06d}.tokz")), f
                got.append(reader.frame(k))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.binary())], names=[*names, out])
        if reader:
            reader.close()

    as_ids = F.arrow_udf(_to_list, "array<long>")
    return rows.mapInArrow(part, schema).withColumn(out, as_ids(out))


def _to_list(raw: pa.Array) -> pa.Array:
    return pa.array([None if r is None else np.frombuffer(r, "<u4").astype("i8") for r in raw.to_pylist()], pa.list_(pa.int64()))
