"""Delivery: grants for download and upload, and manifests.

Grants carry everything but the signature, which belongs to the service that serves them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from radiolith.functions.keys import attachment
from radiolith.functions.values import true_or_false
from radiolith.operators import integrity
from radiolith.operators.rules import DELIVERY_FILE, MANIFEST, Fields, broken_flags, with_verdict
from radiolith.session import shared_dir

DEFAULT_EXPIRY = 3600
DICOM_CONTENT = "application/dicom"


def _issued(at: datetime | str | None) -> Column:
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def client_method(http_method: Column) -> Column:
    """``GET`` in any case reads an object; any other method writes one."""
    return F.when(F.upper(http_method) == "GET", "get_object").otherwise("put_object")


def _download_columns(
    bucket: str, expires_in: int, content_type: str | None, offer_as_file: bool, issued_at: datetime | str | None
) -> list[Column]:
    """What a download grant says about the object, next to its key."""
    offer = attachment(F.col("object_key")) if offer_as_file else F.lit(None).cast("string")
    return [
        F.lit(bucket).alias("bucket"),
        F.lit("get_object").alias("client_method"),
        F.lit(expires_in).alias("expires_in"),
        F.timestamp_add("SECOND", F.lit(expires_in), _issued(issued_at)).alias("expires_at"),
        F.lit(content_type).cast("string").alias("response_content_type"),
        offer.alias("response_content_disposition"),
    ]


def download_grants(
    keys: DataFrame,
    bucket: str,
    expires_in: int = DEFAULT_EXPIRY,
    content_type: str | None = None,
    offer_as_file: bool = False,
    issued_at: datetime | str | None = None,
) -> DataFrame:
    """One download grant per row of keys, with optional response headers."""
    return keys.select(
        "object_key", *_download_columns(bucket, expires_in, content_type, offer_as_file, issued_at)
    )


def upload_grants(
    keys: DataFrame,
    bucket: str,
    expires_in: int = DEFAULT_EXPIRY,
    content_type: str | None = None,
    metadata: dict[str, str] | None = None,
    issued_at: datetime | str | None = None,
) -> DataFrame:
    """One upload grant per row of keys, with the content type and metadata the upload must carry."""
    pairs = [F.lit(part) for pair in (metadata or {}).items() for part in pair]
    return keys.select(
        F.lit(bucket).alias("bucket"),
        "object_key",
        F.lit("put_object").alias("client_method"),
        F.lit(expires_in).alias("expires_in"),
        F.timestamp_add("SECOND", F.lit(expires_in), _issued(issued_at)).alias("expires_at"),
        F.lit(content_type).cast("string").alias("content_type"),
        F.create_map(*pairs).cast("map<string,string>").alias("metadata"),
    )


def batch_grants(
    requests: DataFrame, listing: DataFrame, bucket: str, **options
) -> tuple[DataFrame, DataFrame]:
    """Grants for the distinct requested keys that exist, and the keys that were refused."""
    checked = integrity.check_exists(requests, listing)
    granted = download_grants(checked.where("object_exists").select("object_key"), bucket, **options)
    return granted, checked.where("NOT object_exists").select("object_key")


def secure_grants(
    requests: DataFrame,
    listing: DataFrame | None,
    bucket: str,
    expires_in: int = DEFAULT_EXPIRY,
    validate_exists: bool = True,
    issued_at: datetime | str | None = None,
) -> DataFrame:
    """Each distinct requested key with a grant that offers it as a DICOM file, or NULL if it does not exist."""
    if validate_exists:
        checked = integrity.check_exists(requests, listing)
    else:
        checked = integrity.distinct_keys(requests).withColumn("object_exists", F.lit(True))
    grant = F.struct(*_download_columns(bucket, expires_in, DICOM_CONTENT, True, issued_at))
    return checked.withColumn("grant", F.when(F.col("object_exists"), grant))


# --- Manifests -------------------------------------------------------------------------

STUDY = ("patient_id", "study_instance_uid")


def manifest_id() -> Column:
    """The manifest of a patient and study always has the same id; lengths keep different pairs apart, NULL too."""
    patient, study = (F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in STUDY)
    return F.concat(F.lit("MAN-"), F.substring(F.sha2(F.concat(patient, F.lit("|"), study), 256), 1, 24))


def manifest_headers(files: DataFrame, created_at: Column) -> DataFrame:
    """One row per patient and study: number and total size of the files.

    Counts and sums combine before the shuffle, so a study that holds a large share of all
    files costs no more than any other.
    """
    return (
        files.groupBy(*STUDY)
        .agg(F.count("*").alias("total_files"), F.sum("file_size").alias("total_size_bytes"))
        .select(manifest_id().alias("manifest_id"), created_at.alias("created_at"), *STUDY, "total_files", "total_size_bytes")
    )


def manifest_files(files: DataFrame) -> DataFrame:
    """The files of all manifests, one row each, tied by manifest id. Needs no shuffle at any size."""
    return files.select(manifest_id().alias("manifest_id"), "file_path", "file_size", "checksum")


def manifest_documents(files: DataFrame, created_at: Column, max_files: int) -> DataFrame:
    """Manifests with their files as an array, at most ``max_files`` in a document, for consumers that want whole ones.

    A study's files are numbered in path order by a prefix sum: files are dealt out by ranges of (study, path), so that
    a large study lies in several ranges, counted in each, and numbered on from the counts of the ranges before. Every
    ``max_files`` make a document, so no list is longer, whatever share of all files a study has.
    """
    spark = files.sparkSession
    order = ["file_path", "file_size", "checksum"]
    ranges, keys = shared_dir(spark, "manifest-files"), ["_patient", "_study"]
    # Ranges are drawn from a sample, so they are written before they are counted and numbered. The manifest id is a
    # digest that no shuffle can compress; rows are dealt by patient and study (NULL as a key), and documents get it at the end.
    whole = [F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit("-")).alias(key) for name, key in zip(STUDY, keys, strict=True)]
    dealt = files.select(*whole, *order).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, *order)
    dealt.withColumn("range", F.spark_partition_id()).write.parquet(ranges)
    numbered = spark.read.parquet(ranges)
    before = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy(*keys, "range")
        .agg(F.count("*").alias("files"))
        .select(
            *keys,
            "range",
            F.coalesce(F.sum("files").over(before), F.lit(0)).alias("before"),
            F.sum("files").over(Window.partitionBy(*keys)).alias("all_files"),
        )
    )
    within = F.row_number().over(Window.partitionBy(*keys, "range").orderBy(*order))
    place = F.col("before") + F.col("n") - 1
    listed = (
        numbered.withColumn("n", within)
        .join(offsets, [*keys, "range"])
        .groupBy(*keys, F.floor(place / max_files).cast("int").alias("part"))
        .agg(
            F.ceil(F.first("all_files") / max_files).cast("int").alias("parts"),
            F.sort_array(F.collect_list(F.struct(*order))).alias("files"),
            F.sum("file_size").alias("part_size_bytes"),
        )
    )
    studies = {
        name: F.when(F.startswith(key, F.lit("=")), F.expr(f"substr({key}, 2)")).cast(files.schema[name].dataType)
        for name, key in zip(STUDY, keys, strict=True)
    }
    return listed.withColumns(studies).select(
        manifest_id().alias("manifest_id"),
        created_at.alias("created_at"),
        *STUDY,
        "part",
        "parts",
        F.size("files").alias("part_files"),
        "part_size_bytes",
        "files",
    )


def granted_files(files: DataFrame, grants: DataFrame) -> DataFrame:
    """Manifest files with ``presigned_url`` (where the grant's service offers the object) and ``url_expiration``.

    Grants are those of ``download_grants``, one for each key; a file without one keeps NULLs. The URL names bucket and
    key and carries no signature.
    """
    offered = grants.groupBy("object_key").agg(F.max(F.struct("expires_at", "bucket")).alias("grant"))
    key = F.replace(F.url_encode("file_path"), F.lit("%2F"), F.lit("/"))
    return files.join(offered, F.col("file_path") == F.col("object_key"), "left").select(
        *files.columns,
        F.concat(F.lit("https://"), F.col("grant.bucket"), F.lit("/"), key).alias("presigned_url"),
        F.date_format("grant.expires_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("url_expiration"),
    )


def validate_manifests(declared: DataFrame, files: DataFrame) -> DataFrame:
    """Verdict over declared manifests and their file rows.

    File rules and the file count are aggregated per manifest before the join, so the join
    has one row per manifest on both sides. Declared sizes are not checked against the files.
    """
    file_fields = Fields(files)
    per_file = with_verdict(files, broken_flags(DELIVERY_FILE, file_fields))
    counted = per_file.groupBy("manifest_id").agg(
        F.count("*").alias("actual_files"),
        *[
            F.max(F.array_contains(F.split("error_codes", ","), code)).alias(code)
            for code in dict.fromkeys(rule.code for rule in DELIVERY_FILE)
        ],
    )
    joined = declared.join(counted, "manifest_id", "left").withColumn(
        "actual_files", F.coalesce("actual_files", F.lit(0))
    )
    fields = Fields(joined)
    flags = broken_flags(MANIFEST, fields)
    flags += [(true_or_false(F.col(code)), code) for code in ("F1", "F2", "F3")]
    flags.append((~true_or_false(F.col("actual_files") == F.col("total_files")), "D7"))
    return with_verdict(joined, flags).select(*declared.columns, "actual_files", "error_codes", "is_valid")
