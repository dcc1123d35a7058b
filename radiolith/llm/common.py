"""Helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word and equality rules: space, tab, line feed to carriage return.
WHITE = "[\\x20\\x09-\\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session, where all run in one machine, gets one of its own if it is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="radiolith-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_base(spark)}/llm-{purpose}-{uuid.uuid4().hex}"


def store_of(folder: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a folder and its name there: a plain path, ``file:/x``, ``file:///x`` or a store's URI."""
    scheme, colon, rest = folder.partition(":")
    if not colon or "/" in scheme:
        return pafs.LocalFileSystem(), folder
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(folder)


def cut(frame: DataFrame) -> DataFrame:
    """The frame computed once and read back from a reliable checkpoint in the shared folder."""
    spark = frame.sparkSession
    base = shared_base(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return frame.checkpoint()


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame computed once, as a Parquet table in the shared folder; smaller than a checkpoint."""
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text_key`` (a hash of the text) and ``text`` (null as empty); other columns are not read.

    Rows with one id and different texts stay apart; rows equal in both get equal results.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return documents.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def text_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes, null as empty."""
    return [v or b"" for v in batch.column(name).cast(pa.binary()).to_pylist()]
