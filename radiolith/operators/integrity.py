"""Object listings, existence and checksums.

Requested keys may repeat without bound, so they are reduced to distinct keys (with
partial aggregation before the shuffle) before any join; listings have one row per key.
Join strategies are left to adaptive execution, which broadcasts by measured size only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def list_objects(listing: DataFrame, prefix: str = "", max_keys: int | None = None) -> DataFrame:
    """All objects below a prefix, or the first ``max_keys`` in key order."""
    found = listing.where(F.startswith(F.col("key"), F.lit(prefix))) if prefix else listing
    found = found.select("key", "size", "last_modified", "etag")
    return found if max_keys is None else found.orderBy("key").limit(max_keys)


def distinct_keys(requests: DataFrame, column: str = "object_key") -> DataFrame:
    return requests.select(F.col(column).alias("object_key")).distinct()


def check_exists(requests: DataFrame, listing: DataFrame, column: str = "object_key") -> DataFrame:
    """Each distinct requested key with whether the object exists."""
    stored = listing.select(F.col("key"), F.lit(True).alias("found"))
    return (
        distinct_keys(requests, column)
        .join(stored, F.col("object_key") == F.col("key"), "left")
        .select("object_key", F.coalesce("found", F.lit(False)).alias("object_exists"))
    )


def existing_keys(requests: DataFrame, listing: DataFrame, column: str = "object_key") -> DataFrame:
    keys = distinct_keys(requests, column)
    return keys.join(listing.select("key"), F.col("object_key") == F.col("key"), "left_semi")


def missing_keys(requests: DataFrame, listing: DataFrame, column: str = "object_key") -> DataFrame:
    keys = distinct_keys(requests, column)
    return keys.join(listing.select("key"), F.col("object_key") == F.col("key"), "left_anti")


def object_metadata(requests: DataFrame, listing: DataFrame, column: str = "object_key") -> DataFrame:
    """Metadata of the requested objects that exist; an unset content type reads ``unknown``."""
    extra = [name for name in ("custom_metadata",) if name in listing.columns]
    return (
        distinct_keys(requests, column)
        .join(listing, F.col("object_key") == F.col("key"))
        .select(
            "key",
            "size",
            "last_modified",
            "etag",
            F.coalesce("content_type", F.lit("unknown")).alias("content_type"),
            *extra,
        )
    )


def verify_transfer(copies: DataFrame, listing: DataFrame) -> DataFrame:
    """Copies and stored objects side by side; verified where the MD5 equals the stored etag.

    Keys that only one side has are kept, and are not verified.
    """
    local = copies.select("key", "checksum")
    stored = listing.select("key", "etag", "size")
    return local.join(stored, "key", "full").select(
        "key",
        "size",
        "checksum",
        "etag",
        F.coalesce(F.col("checksum") == F.col("etag"), F.lit(False)).alias("checksum_verified"),
    )
