"""Places that all executors share, and cutting lineage through them."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local one only where the session runs on this machine alone."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "textloom-checkpoints")
        os.makedirs(root[len("file://") :], exist_ok=True)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A new URI under the shared folder; nothing is there yet."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def mounted(uri: str) -> str:
    """The path of a file: URI or plain path, for code that memory-maps or seeks in files."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:") :].lstrip("/")
    if "://" in uri:
        raise ValueError(f"{uri}: this needs a mounted shared folder (file: URI)")
    return uri


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: lineage is cut and survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of ``df``."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
