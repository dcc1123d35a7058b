"""Object listings and arrival notifications."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radiolith.functions.keys import decoded
from radiolith.schemas import ARRIVAL_EVENT
from radiolith.sources.stores import list_tree, qualified, with_checksums


def object_listing(spark: SparkSession, root: str, with_etag: bool = False, pattern: str = "*") -> DataFrame:
    """All objects below a root folder: key, size, last_modified and etag.

    Contents are read, a piece at a time, only when the etag is asked for.
    """
    files = list_tree(spark, root, pattern)
    if with_etag:
        files = with_checksums(files)
    key = F.substring("path", F.lit(len(qualified(root).rstrip("/")) + 2), F.length("path"))
    etag = F.col("etag") if with_etag else F.lit(None).cast("string")
    return files.select(key.alias("key"), "size", "last_modified", etag.alias("etag"))


def arrivals(events: DataFrame, body: str = "body", suffix: str = ".dcm", versioned: bool = False) -> DataFrame:
    """One row per notified object with the wanted suffix: bucket, decoded key and size; ``versioned`` adds version and time."""
    kept = [name for name in events.columns if name != body]
    records = events.select(*kept, F.explode(F.from_json(body, ARRIVAL_EVENT)["Records"]).alias("r"))
    found = records.select(
        *kept,
        F.col("r.s3.bucket.name").alias("bucket"),
        decoded(F.col("r.s3.object.key")).alias("key"),
        F.col("r.s3.object.size").alias("size"),
        *([F.col("r.s3.object.versionId").alias("version"), F.col("r.eventTime").alias("event_time")] if versioned else []),
    )
    return found.where(F.endswith("key", F.lit(suffix))) if suffix else found


def distinct_arrivals(arrived: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Versioned arrivals without the notifications that come again, on streams and in batch.

    A stream remembers a (bucket, key, version) until the watermark is ``lateness`` past its first notification, so
    repeats must come within that time; state grows with the arrivals of that time, not with all.
    """
    identity = ["bucket", "key", "version"]
    if arrived.isStreaming:
        return arrived.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(identity)
    return arrived.dropDuplicates(identity)
