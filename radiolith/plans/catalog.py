"""The registered queries: one per operator, each over whole tables.

Results are scalar columns, so that they can be compared with other engines: arrays are
joined in their order, structs are flattened, nullable whole numbers are shown as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiolith.functions import keys

from radiolith.operators import accounting, deid, delivery, extract, integrity, merge, retention, rules, structural
from radiolith.plans import pipeline
from radiolith.schemas import CSV_RECORD, DATE_TAGS, JSON_STUDY, XML_STUDY
from radiolith.session import shared_dir
from radiolith.sources import dicom, objects, sidecar, sinks, splitting, stores, study_view
from radiolith.streaming import alarms, jobs

Query = Callable[[SparkSession, str], DataFrame]

SALT = "query-catalog-salt"
BUCKET = "delivery"
ISSUED_AT = "2025-01-01 00:00:00"
AS_OF = "2025-03-01"
REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def _text(name: str | Column, alias: str | None = None) -> Column:
    column = F.col(name) if isinstance(name, str) else name
    return column.cast("string").alias(alias or name)


def _stamp(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def _list(name: str, separator: str = ",") -> Column:
    return F.concat_ws(separator, name).alias(name)


def _instances(spark: SparkSession, sf: str) -> DataFrame:
    return study_view.instances(spark, sf)


def _metadata(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_metadata(_instances(spark, sf), keep=["path"])


def _spacing(name: str) -> Column:
    return F.concat_ws("/", F.transform(name, lambda x: (x * 10).cast("int").cast("string"))).alias("pixel_spacing")


def _verdict(judged: DataFrame, *columns: str) -> DataFrame:
    return judged.select("path", *columns, "error_codes", "is_valid")


# --- Sources ---------------------------------------------------------------------------

_HEADER_TEXT = (
    "PatientID",
    "PatientName",
    "PatientSex",
    "PatientAge",
    "InstitutionName",
    "StudyInstanceUID",
    "StudyDate",
    "SeriesInstanceUID",
    "SeriesNumber",
    "Modality",
    "SOPInstanceUID",
    "KVP",
)
_HEADER_NUMBERS = ("Rows", "Columns", "BitsAllocated")
#: Files that a round of the header scan has in its store.
FILES_AT_ONCE = 1_000_000


@register
def src_dicom_headers(spark: SparkSession, sf: str) -> DataFrame:
    files = study_view.as_dicom_bytes(_instances(spark, sf), _HEADER_TEXT, _HEADER_NUMBERS)
    parsed = dicom.parse_headers(files, [*_HEADER_TEXT, *_HEADER_NUMBERS, "has_pixel_data", "parse_error"])
    return parsed.select(
        "path", *_HEADER_TEXT, *[_text(n) for n in _HEADER_NUMBERS], _text("has_pixel_data"), "parse_error"
    )


@register
def src_dicom_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Files written from the instances, listed level by level and scanned through the listing table.

    A file takes a block of the disk, however short its header is. So whole folders take turns: the headers are dealt out
    to rounds in a table, and a round's files make room for the next one's when its rows are written.
    """
    base, found = shared_dir(spark, "dicom-rounds"), []
    columns = [*_HEADER_TEXT, *_HEADER_NUMBERS, "has_pixel_data"]
    instances, folder = _instances(spark, sf).select("path", *columns), F.regexp_replace("path", "/[^/]*$", "/")
    rounds = max(1, -(-instances.count() // FILES_AT_ONCE))
    dealt = instances.withColumn("round", F.pmod(F.xxhash64(folder), F.lit(rounds)))
    sinks.write_where_they_lie(dealt, f"{base}/headers", ["round"])
    headers = spark.read.schema(dealt.schema).parquet(f"{base}/headers")
    for row in headers.groupBy("round").count().sort("round").collect() or [{"round": 0}]:
        if found:
            stores.remove_objects(written, root)
        root = shared_dir(spark, "dicom-files")
        files = study_view.as_dicom_bytes(headers.where(F.col("round") == row["round"]), _HEADER_TEXT, _HEADER_NUMBERS)
        # Named by content: order lines with one path and different headers are different files.
        keyed = files.select(F.concat(folder, F.md5("content"), F.lit(".dcm")).alias("key"), "content")
        written = stores.put_objects(keyed, root)
        scanned = dicom.read_dicom(spark, root, ["path", *columns, "parse_error"])
        shown = scanned.select(
            F.regexp_extract("path", "/raw/([^/]+)/[^/]+$", 1).alias("folder"),
            *_HEADER_TEXT,
            *[_text(n) for n in _HEADER_NUMBERS],
            _text("has_pixel_data"),
            "parse_error",
        )
        found.append(f"{base}/rows/{row['round']}")
        shown.write.option("compression", "zstd").parquet(found[-1])
    return spark.read.schema(shown.schema).parquet(*found)


@register
def src_list_tree(spark: SparkSession, sf: str) -> DataFrame:
    """A tree of the pages' payloads, folders by host, listed on the executors; checksums are read from the files."""
    root, number = shared_dir(spark, "pages"), F.col("page_id")
    host = F.regexp_replace(F.regexp_extract(F.coalesce("url", F.lit("")), "://([^/?#]*)", 1), "[^A-Za-z0-9.-]", "_")
    key = F.concat_ws("/", F.lit("web"), F.concat(F.lit("h-"), host), _text(number % 13, "d"), F.concat(F.lit("page-"), _text(number, "n"), F.lit(".html")))
    pages = study_view.table(spark, sf, "pages")
    stores.put_objects(pages.select(key.alias("key"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("content")), root)
    return objects.object_listing(spark, root, with_etag=True, pattern="*.html").select("key", "size", "etag")


@register
def src_csv(spark: SparkSession, sf: str) -> DataFrame:
    target = shared_dir(spark, "csv")
    records = study_view.csv_records(spark, sf).select(CSV_RECORD.names)
    records.write.option("header", "true").option("sep", ";").csv(target)
    return sidecar.read_csv(spark, target, delimiter=";")


def _json_documents(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    series = F.transform(
        F.sequence(F.lit(1), (key % 3 + 1).cast("int")),
        lambda n: F.struct(
            F.concat(F.lit("1.2."), key.cast("string"), F.lit("."), n.cast("string")).alias("series_instance_uid"),
            n.alias("series_number"),
            F.lit("axial").alias("description"),
        ),
    )
    document = F.struct(
        F.concat(F.lit("1.2.840."), key.cast("string")).alias("study_instance_uid"),
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("patient_id"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("study_date"),
        F.lit("CT").alias("modality"),
        F.col("o_orderpriority").alias("institution"),
        F.when(key % 5 != 0, F.lit("Dr^A")).alias("referring_physician"),
        series.alias("series"),
    )
    return study_view.table(spark, sf, "orders").select(F.to_json(document).alias("value"))


@register
def src_json(spark: SparkSession, sf: str) -> DataFrame:
    target = shared_dir(spark, "json")
    _json_documents(spark, sf).write.text(target)
    read = sidecar.read_json(spark, target, one_per_line=True)
    return read.select(
        *[name for name in JSON_STUDY.names if name != "series"],
        F.size("series").alias("series_count"),
        F.concat_ws(",", "series.series_instance_uid").alias("series_uids"),
        F.expr("aggregate(series, 0, (a, s) -> a + s.series_number)").alias("number_sum"),
        "_corrupt_record",
    )


_DOCUMENT = T.StructType([T.StructField(name, T.StringType()) for name in ("doc_id", "lang", "source", "text")])


def _document_texts(spark: SparkSession, sf: str) -> DataFrame:
    documents = study_view.table(spark, sf, "documents")
    return documents.select(*[F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) for n in _DOCUMENT.names])


def _digests(read: DataFrame) -> DataFrame:
    whole = [F.coalesce(n, F.lit("")).alias(n) for n in ("doc_id", "lang", "source")]
    text = F.coalesce("text", F.lit(""))
    return read.select(*whole, F.length(text).alias("n_chars"), F.md5(text).alias("text_md5"), "_corrupt_record")


@register
def src_csv_large(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents, line breaks and quotes included, as cells of CSV files that many tasks cut."""
    target = shared_dir(spark, "csv-large")
    writer = _document_texts(spark, sf).write.option("header", "true").option("quoteAll", "true").option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(target)
    return _digests(splitting.read_large_csv(spark, target, _DOCUMENT, piece_bytes=1 << 18))


@register
def src_json_large(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as elements of JSON arrays that many tasks cut."""
    target = shared_dir(spark, "json-large")
    one = F.to_json(F.struct(*_DOCUMENT.names), {"ignoreNullFields": "false"})
    arrays = _document_texts(spark, sf).groupBy(F.floor(F.col("doc_id").cast("bigint") / 64).alias("bucket")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(one), ",\n"), F.lit("]")).alias("text")
    )
    named = arrays.select(F.concat(F.lit("part-"), _text("bucket"), F.lit(".json")).alias("key"), F.encode("text", "UTF-8").alias("content"))
    stores.put_objects(named, target)
    return _digests(splitting.read_large_json(spark, target, _DOCUMENT, piece_bytes=1 << 16))


def _xml_documents(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    items = F.array_join(
        F.transform(
            F.sequence(F.lit(1), (key % 3 + 1).cast("int")),
            lambda n: F.format_string('<item number="%d">series %d</item>', n, n * 10),
        ),
        "",
    )
    text = F.concat(
        F.lit("<imaging_study>"),
        F.format_string('<patient id="P%d"><name>N%d</name><dob></dob></patient>', "o_custkey", "o_custkey"),
        F.concat(
            F.format_string('<study uid="1.2.%d" date="', key),
            F.date_format("o_orderdate", "yyyyMMdd"),
            F.lit('"><description>Scan</description><modality>CT</modality><series>'),
            items,
            F.lit("</series></study>"),
        ),
        F.format_string(
            "<acquisition><protocol>%s</protocol><kvp>%d</kvp><slice_thickness>%d.5</slice_thickness></acquisition>",
            F.col("o_orderpriority"),
            key % 200,
            key % 7,
        ),
        F.lit("</imaging_study>"),
    )
    return study_view.table(spark, sf, "orders").select(text.alias("value"))


def _flat_study(study: DataFrame) -> DataFrame:
    return study.select(
        F.col("patient._id").alias("patient_id"),
        F.col("patient.name").alias("patient_name"),
        F.col("patient.dob").alias("dob"),
        F.col("study._uid").alias("study_uid"),
        F.col("study._date").alias("study_date"),
        F.col("study.modality").alias("modality"),
        F.size("study.series.item").alias("items"),
        F.concat_ws(",", "study.series.item._VALUE").alias("item_texts"),
        F.expr("aggregate(study.series.item, 0, (a, s) -> a + s._number)").alias("number_sum"),
        F.col("acquisition.protocol").alias("protocol"),
        F.col("acquisition.kvp").alias("kvp"),
        F.col("acquisition.slice_thickness").alias("slice_thickness"),
    )


@register
def src_xml(spark: SparkSession, sf: str) -> DataFrame:
    target = shared_dir(spark, "xml")
    _xml_documents(spark, sf).write.text(target)
    return _flat_study(sidecar.read_xml(spark, target, whole_documents=False))


@register
def src_list_objects(spark: SparkSession, sf: str) -> DataFrame:
    listing = integrity.list_objects(study_view.stored_objects(spark, sf), prefix="raw/src1", max_keys=1000)
    return listing.select("key", "size", _stamp("last_modified"), "etag")


@register
def src_list_objects_all(spark: SparkSession, sf: str) -> DataFrame:
    listing = integrity.list_objects(study_view.stored_objects(spark, sf), prefix="raw/src1")
    return listing.select("key", "size", _stamp("last_modified"), "etag")


@register
def src_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return objects.arrivals(study_view.arrival_events(spark, sf))


@register
def src_stream_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    target = shared_dir(spark, "arrivals")
    pages = spark.readStream.schema(study_view.table(spark, sf, "pages").schema).parquet(f"{sf}/pages.parquet*")
    stream = (
        objects.arrivals(study_view.as_arrival_events(pages))
        .writeStream.format("parquet")
        .option("path", f"{target}/out")
        .option("checkpointLocation", f"{target}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return spark.read.parquet(f"{target}/out")


@register
def src_stream_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Every notification comes twice, in two micro-batches; each object version is let through once."""
    base = shared_dir(spark, "notified")
    events = study_view.arrival_events(spark, sf)
    for _ in range(2):
        events.write.mode("append").parquet(f"{base}/in")
        read = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        stream = (
            objects.distinct_arrivals(objects.arrivals(read, versioned=True))
            .writeStream.format("parquet")
            .option("path", f"{base}/out")
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        stream.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("event_id", "bucket", "key", "size", "version", _stamp("event_time"))


@register
def src_log_events(spark: SparkSession, sf: str) -> DataFrame:
    events = study_view.log_events(spark, sf)
    found = accounting.read_log(events, "2024-01-05 00:00:00", "2024-01-20 00:00:00", limit=100)
    return found.select("event_id", _stamp("ts"), "message")


@register
def src_log_events_all(spark: SparkSession, sf: str) -> DataFrame:
    found = accounting.read_log(study_view.log_events(spark, sf), "2024-01-05 00:00:00", "2024-01-20 00:00:00")
    return found.select("event_id", _stamp("ts"), "message")


# --- Sinks -------------------------------------------------------------------------------


@register
def snk_validated(spark: SparkSession, sf: str) -> DataFrame:
    target = shared_dir(spark, "validated")
    sinks.write_validated(rules.validate_metadata(_metadata(spark, sf)), target)
    return spark.read.parquet(target).select("path", "validated_key", "patient_id", "study_uid", "modality")


@register
def snk_deidentified(spark: SparkSession, sf: str) -> DataFrame:
    target = shared_dir(spark, "deidentified")
    # The instances come out of the join's shuffle.
    sinks.write_deidentified(_instances(spark, sf), target, SALT, rebalance=False)
    return spark.read.parquet(target).select("path", "deidentified_key", "deidentified", "PatientID", "StudyDate", "Modality")


@register
def snk_execution_log(spark: SparkSession, sf: str) -> DataFrame:
    target = shared_dir(spark, "execution-log")
    judged = rules.validate_metadata(_metadata(spark, sf))
    status = F.when(F.col("is_valid"), "completed").otherwise("failed")
    error = F.when(~F.col("is_valid"), F.col("error_codes"))
    rows = sinks.execution_rows(judged, "parse_and_validate", status, {"file_path": F.col("path")}, error, ISSUED_AT)
    sinks.append(rows, target)
    return spark.read.parquet(target).select(
        "operation",
        "status",
        F.col("details")["file_path"].alias("file_path"),
        F.col("error.type").alias("error_type"),
        F.col("error.message").alias("error_message"),
        _stamp("ts"),
    )


@register
def snk_metrics(spark: SparkSession, sf: str) -> DataFrame:
    target = shared_dir(spark, "metrics")
    counted = accounting.files_processed(rules.validate_metadata(_metadata(spark, sf)))
    points = sinks.metric_rows(
        counted,
        "MedicalImaging/Ingestion",
        F.lit("FilesProcessed"),
        F.col("files_processed"),
        dimensions={"Modality": F.col("modality")},
        at=ISSUED_AT,
    )
    sinks.append(points, target)
    return spark.read.parquet(target).select(
        "namespace", "name", "value", "unit", F.col("dimensions")["Modality"].alias("modality"), _stamp("ts")
    )


def _points(points: DataFrame) -> DataFrame:
    dimension = F.concat_ws("=", F.element_at(F.map_keys("dimensions"), 1), F.element_at(F.map_values("dimensions"), 1))
    summed = points.groupBy("namespace", "name", "unit", F.when(F.size("dimensions") > 0, dimension).otherwise("").alias("dimension"))
    return summed.agg(F.sum("value").alias("value"))


@register
def snk_run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The metric families of one batch run, counted while its rows are written."""
    target = shared_dir(spark, "run")
    pipeline.run_batch(_instances(spark, sf), f"{target}/out", f"{target}/metrics", SALT, at=ISSUED_AT)
    return _points(spark.read.parquet(f"{target}/metrics").where(F.col("ts") == F.lit(ISSUED_AT).cast("timestamp")))


@register
def snk_log_events(spark: SparkSession, sf: str) -> DataFrame:
    target = shared_dir(spark, "log-events")
    events = study_view.log_events(spark, sf)
    messages = F.array(F.concat(F.col("operation"), F.lit(" started")), F.col("message"))
    rows = sinks.log_rows(events, "/imaging/ingestion", F.concat(F.lit("stream-"), F.col("level")), messages, F.col("ts"))
    sinks.append(rows, target)
    return spark.read.parquet(target).select("log_group", "log_stream", _stamp("ts"), "message")


# --- Projections -------------------------------------------------------------------------


@register
def prj_base_metadata(spark: SparkSession, sf: str) -> DataFrame:
    base = extract.base_metadata(_instances(spark, sf), keep=["path"])
    numbers = ("rows", "columns", "bits_allocated", "bits_stored")
    others = [name for name in base.columns if name not in (*numbers, "pixel_spacing")]
    return base.select(*others, *[_text(n) for n in numbers], _spacing("pixel_spacing"))


@register
def prj_modality_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return extract.modality_metadata(_instances(spark, sf), keep=["path"])


@register
def prj_nested_records(spark: SparkSession, sf: str) -> DataFrame:
    records = extract.nested_records(_metadata(spark, sf), keep=["path"])
    return records.select(
        "path",
        F.col("patient.patient_id").alias("patient_id"),
        F.col("study.study_instance_uid").alias("study_instance_uid"),
        _text("series.series_number", "series_number"),
        F.col("series.modality").alias("modality"),
        _text("instance.instance_number", "instance_number"),
        F.col("image").isNotNull().alias("has_image"),
        _text("image.rows", "image_rows"),
        _text("image.bits_stored", "image_bits_stored"),
        F.col("ct_metadata").isNotNull().alias("has_ct"),
        F.col("ct_metadata.kvp").alias("ct_kvp"),
        F.col("mr_metadata").isNotNull().alias("has_mr"),
        F.col("mr_metadata.magnetic_field_strength").alias("mr_field"),
    )


@register
def prj_tag_default(spark: SparkSession, sf: str) -> DataFrame:
    instances = _instances(spark, sf)
    return instances.select(
        "path",
        extract.tag_value(instances, "StudyDescription", "none given").alias("study_description"),
        extract.tag_value(instances, "0018,0015", "unknown").alias("body_part"),
        extract.tag_value(instances, "NoSuchTag", "absent").alias("no_such_tag"),
        extract.tag_value(instances, "AccessionNumber").alias("accession_number"),
    )


@register
def prj_xml_record(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _xml_documents(spark, sf).select(sidecar.parse_xml(F.col("value"), XML_STUDY).alias("r"))
    return _flat_study(parsed.select("r.*"))


@register
def prj_row_records(spark: SparkSession, sf: str) -> DataFrame:
    return extract.row_records(study_view.csv_records(spark, sf))


@register
def prj_summary(spark: SparkSession, sf: str) -> DataFrame:
    return extract.summaries(_instances(spark, sf))


@register
def prj_object_keys(spark: SparkSession, sf: str) -> DataFrame:
    uri = F.when(F.col("page_id") % 2 == 0, F.regexp_replace("url", r"\Ahttps?://", "s3://")).otherwise(
        F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("s3://lonely-"), F.col("page_id").cast("string"))).otherwise(F.col("url"))
    )
    key = F.col("key")
    return study_view.table(spark, sf, "pages").select("page_id", keys.key_of(uri).alias("key")).select(
        "page_id",
        "key",
        keys.base_name(key).alias("base_name"),
        keys.under("validated", key).alias("validated_key"),
        keys.under("deidentified", key).alias("deidentified_key"),
    )


@register
def prj_content_md5(spark: SparkSession, sf: str) -> DataFrame:
    return study_view.table(spark, sf, "documents").select("doc_id", F.md5("text").alias("md5"))


@register
def prj_grants(spark: SparkSession, sf: str) -> DataFrame:
    listing = study_view.stored_objects(spark, sf).select(F.col("key").alias("object_key"))
    down = delivery.download_grants(
        listing, BUCKET, content_type=delivery.DICOM_CONTENT, offer_as_file=True, issued_at=ISSUED_AT
    ).withColumn("content_type", F.lit(None).cast("string"))
    up = delivery.upload_grants(
        listing, BUCKET, expires_in=900, content_type="application/dicom", metadata={"origin": "scanner"}, issued_at=ISSUED_AT
    )
    both = down.unionByName(up.withColumn("upload_origin", F.col("metadata")["origin"]).drop("metadata"), allowMissingColumns=True)
    return both.withColumn("expires_at", _stamp("expires_at")).withColumn(
        "asked_method", delivery.client_method(F.when(F.col("client_method") == "get_object", "get").otherwise("PATCH"))
    )


@register
def prj_normalized(spark: SparkSession, sf: str) -> DataFrame:
    return extract.normalized(_metadata(spark, sf)).select("path", "patient_id", "modality")


# --- Validation ----------------------------------------------------------------------------


@register
def val_structural(spark: SparkSession, sf: str) -> DataFrame:
    checked = structural.structural_check(_instances(spark, sf))
    return checked.select("path", _list("errors", "; "), _list("warnings", "; "), "is_valid")


@register
def val_required_fields(spark: SparkSession, sf: str) -> DataFrame:
    checked = extract.required_fields(
        study_view.csv_records(spark, sf),
        ["patient_id", "study_date", "modality", "accession_number", "no_such_field"],
        keep=["record_id"],
    )
    return checked.select("record_id", _list("missing_fields"), _list("present_fields"), "is_valid")


@register
def val_patient(spark: SparkSession, sf: str) -> DataFrame:
    return _verdict(rules.validate(_metadata(spark, sf), rules.PATIENT))


@register
def val_study(spark: SparkSession, sf: str) -> DataFrame:
    return _verdict(rules.validate(_metadata(spark, sf), rules.STUDY))


@register
def val_series(spark: SparkSession, sf: str) -> DataFrame:
    return _verdict(rules.validate(_metadata(spark, sf), rules.SERIES))


@register
def val_image(spark: SparkSession, sf: str) -> DataFrame:
    metadata = _metadata(spark, sf)
    fields = rules.Fields(metadata)
    return _verdict(rules.with_verdict(metadata, rules.image_flags(fields)))


@register
def val_modality(spark: SparkSession, sf: str) -> DataFrame:
    metadata = _metadata(spark, sf)
    fields = rules.Fields(metadata)
    return _verdict(rules.with_verdict(metadata, rules.modality_flags(fields)))


@register
def val_instance(spark: SparkSession, sf: str) -> DataFrame:
    return _verdict(rules.validate(_metadata(spark, sf), rules.INSTANCE))


def _variants(**values: float | None) -> list[Column]:
    return [F.lit(value).cast("double").cast("variant").alias(name) for name, value in values.items()]


def _mixed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Raw nested records from elsewhere, some with the block of another modality."""
    records = extract.raw_records(_metadata(spark, sf), keep=["path"])
    number = F.try_variant_get("instance.instance_number", "$", "double")
    return records.withColumns(
        {
            "ct_metadata": F.when(
                number == 2, F.struct(*_variants(kvp=120.0, slice_thickness=None, reconstruction_diameter=-1.0))
            ).otherwise(F.col("ct_metadata")),
            "mr_metadata": F.when(
                number == 3, F.struct(*_variants(repetition_time=500.0, echo_time=9.0, magnetic_field_strength=1.5))
            ).otherwise(F.col("mr_metadata")),
        }
    )


@register
def val_cross_model(spark: SparkSession, sf: str) -> DataFrame:
    return _verdict(rules.validate_cross_model(_mixed_records(spark, sf)))


@register
def val_nested_record(spark: SparkSession, sf: str) -> DataFrame:
    return _verdict(rules.validate_records(_mixed_records(spark, sf)))


@register
def val_typed_record(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records as typed ones, next to their verdict: a number that can't be read is NULL and reported."""
    judged = rules.validate_records(extract.raw_records(_metadata(spark, sf), keep=["path"]))
    typed = extract.typed_records(judged)
    return typed.select(
        "path",
        F.col("patient.patient_id").alias("patient_id"),
        _text("series.series_number", "series_number"),
        _text("instance.instance_number", "instance_number"),
        _text("image.rows", "image_rows"),
        F.col("ct_metadata.kvp").alias("ct_kvp"),
        F.col("mr_metadata.magnetic_field_strength").alias("mr_field"),
        "error_codes",
    )


@register
def val_csv_record(spark: SparkSession, sf: str) -> DataFrame:
    judged = rules.validate(study_view.csv_records(spark, sf), rules.CSV_RECORD)
    return judged.select("record_id", "error_codes", "is_valid")


def _delivery_files(spark: SparkSession, sf: str) -> DataFrame:
    """One file per order line, of the order's patient."""
    lines = study_view.table(spark, sf, "lineitem").select(
        "l_orderkey", study_view.object_key().alias("file_path"), F.col("l_extendedprice").cast("bigint").alias("file_size")
    )
    orders = study_view.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("patient_id"),
        F.concat(F.lit("1.2.840."), F.col("o_orderkey").cast("string")).alias("study_instance_uid"),
        "file_path",
        "file_size",
        F.md5("file_path").alias("checksum"),
    )


@register
def val_manifest(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    name = F.concat(F.lit("M"), key.cast("string"))
    declared = study_view.table(spark, sf, "orders").select(
        F.when(key % 301 != 0, name).otherwise("").alias("manifest_id"),
        F.when(key % 31 == 0, "2024-01-01 10:00:00")
        .when(key % 37 == 0, "2024-13-01T10:00:00Z")
        .when(key % 2 == 0, "2024-01-01T10:00:00.123+02:00")
        .otherwise("2024-01-01T10:00:00Z")
        .alias("created_at"),
        F.when(key % 41 != 0, F.concat(F.lit("P"), F.col("o_custkey").cast("string"))).otherwise("").alias("patient_id"),
        F.when(key % 43 != 0, F.concat(F.lit("1.2."), key.cast("string"))).alias("study_instance_uid"),
        (key % 9 - 1).cast("int").alias("total_files"),
        (F.col("o_totalprice").cast("bigint") - F.when(key % 47 == 0, 10**9).otherwise(0)).alias("total_size_bytes"),
    )
    line = F.col("l_partkey")
    files = study_view.table(spark, sf, "lineitem").select(
        F.concat(F.lit("M"), F.col("l_orderkey").cast("string")).alias("manifest_id"),
        F.when(line % 401 == 0, "").otherwise(study_view.object_key()).alias("file_path"),
        (F.col("l_extendedprice").cast("bigint") - F.when(line % 409 == 0, 10**7).otherwise(0)).alias("file_size"),
        F.when(line % 419 == 0, "short").otherwise(F.md5(study_view.object_key())).alias("checksum"),
    )
    judged = delivery.validate_manifests(declared, files)
    return judged.select("manifest_id", "actual_files", "error_codes", "is_valid")


@register
def val_manifest_array(spark: SparkSession, sf: str) -> DataFrame:
    """Manifests that carry their files as an array, some with a wrong count or a damaged file."""
    created = F.lit("2025-01-01T00:00:00Z")
    documents = delivery.manifest_documents(_delivery_files(spark, sf), created, max_files=4)
    first, size = F.col("files")[0], F.size("files")
    number = F.regexp_extract("study_instance_uid", "([0-9]+)$", 1).cast("bigint")
    damaged = F.struct(
        F.when(number % 17 == 0, "").otherwise(first["file_path"]).alias("file_path"),
        F.when(number % 19 == 0, -1).otherwise(first["file_size"]).alias("file_size"),
        F.when(number % 23 == 0, "short").otherwise(first["checksum"]).alias("checksum"),
    )
    carried = documents.select(
        "manifest_id", "part", "created_at", "patient_id", "study_instance_uid",
        (size + F.when(number % 13 == 0, 1).otherwise(0)).alias("total_files"),
        F.col("part_size_bytes").alias("total_size_bytes"),
        F.concat(F.array(damaged), F.slice("files", 2, 4)).alias("files"),
    )
    return rules.validate_nested_manifests(carried).select("manifest_id", "part", F.size("files").alias("n_files"), "error_codes", "is_valid")


@register
def val_record(spark: SparkSession, sf: str) -> DataFrame:
    return _verdict(rules.validate_metadata(_metadata(spark, sf)))


@register
def val_record_details(spark: SparkSession, sf: str) -> DataFrame:
    detailed = rules.with_error_details(rules.validate_metadata(_metadata(spark, sf)))
    return detailed.where("NOT is_valid").select("path", F.explode("errors").alias("e")).groupBy("e.rule", "e.field").agg(
        F.count("*").alias("rows_broken")
    )


@register
def val_side_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return _verdict(rules.validate_side_metadata(_metadata(spark, sf)))


@register
def val_split(spark: SparkSession, sf: str) -> DataFrame:
    return rules.responses(rules.validate_side_metadata(_metadata(spark, sf)), ["path"])


# --- Joins ---------------------------------------------------------------------------------


@register
def join_merge_metadata(spark: SparkSession, sf: str) -> DataFrame:
    primary = study_view.csv_records(spark, sf).select("record_id", "patient_id", "modality", "status")
    orders = study_view.table(spark, sf, "orders")
    first = orders.select(
        # Odd orders carry a key that no record has.
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).otherwise(-F.col("o_orderkey")).alias("record_id"),
        F.when(F.col("o_orderkey") % 4 == 0, "XR").alias("modality"),
        F.col("o_orderpriority").alias("priority"),
    )
    lines = study_view.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("record_id"),
        F.col("l_returnflag").alias("status"),
        F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey").alias("line"),
    )
    return merge.merge_metadata(primary, [(first, "priority"), (lines, "line")], ["record_id"])


@register
def join_merge_maps(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    base = F.create_map(F.lit("id"), key.cast("string"), F.lit("status"), F.col("o_orderstatus"))
    later = F.create_map(
        F.lit("status"), F.when(key % 3 == 0, F.lit("merged")), F.lit("priority"), F.col("o_orderpriority")
    )
    merged = study_view.table(spark, sf, "orders").select(key, merge.merged_maps(base, later).alias("m"))
    return merged.select(
        "o_orderkey", *[F.col("m")[n].alias(n) for n in ("id", "status", "priority")], F.size("m").alias("entries")
    )


@register
def join_object_exists(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.check_exists(study_view.requested_keys(spark, sf), study_view.stored_objects(spark, sf))


@register
def join_object_metadata(spark: SparkSession, sf: str) -> DataFrame:
    found = integrity.object_metadata(study_view.requested_keys(spark, sf), study_view.stored_objects(spark, sf))
    return found.select(
        "key", "size", _stamp("last_modified"), "etag", "content_type", F.col("custom_metadata")["source"].alias("source")
    )


@register
def join_verify_transfer(spark: SparkSession, sf: str) -> DataFrame:
    verified = integrity.verify_transfer(study_view.local_copies(spark, sf), study_view.stored_objects(spark, sf))
    return verified.select("key", _text("size"), "checksum", "etag", "checksum_verified")


@register
def join_batch_grants(spark: SparkSession, sf: str) -> DataFrame:
    granted, refused = delivery.batch_grants(
        study_view.requested_keys(spark, sf), study_view.stored_objects(spark, sf), BUCKET, issued_at=ISSUED_AT
    )
    return granted.select("object_key", _text("expires_in"), _stamp("expires_at"), F.lit(True).alias("granted")).unionByName(
        refused.withColumn("granted", F.lit(False)), allowMissingColumns=True
    )


@register
def join_secure_grants(spark: SparkSession, sf: str) -> DataFrame:
    grants = delivery.secure_grants(
        study_view.requested_keys(spark, sf), study_view.stored_objects(spark, sf), BUCKET, 7200, issued_at=ISSUED_AT
    )
    return grants.select(
        "object_key",
        "object_exists",
        F.col("grant.bucket").alias("bucket"),
        F.date_format("grant.expires_at", "yyyy-MM-dd HH:mm:ss").alias("expires_at"),
        F.col("grant.response_content_type").alias("response_content_type"),
        F.col("grant.response_content_disposition").alias("response_content_disposition"),
    )


@register
def join_pipeline_results(spark: SparkSession, sf: str) -> DataFrame:
    return accounting.wide_results(pipeline.stage_outcomes(_instances(spark, sf), SALT, "SeriesDate"))


@register
def join_stage_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Stage events that know only their time, matched to the upload before them: users' events against orders' lines."""
    uploads = study_view.table(spark, sf, "events").where(F.col("event_type") == "purchase")
    later = study_view.table(spark, sf, "events").where(F.col("event_type") != "purchase")
    stamped = F.col("ts").cast("timestamp").alias("at")
    versions = uploads.select(F.col("user_id").alias("key"), stamped, F.col("event_id").alias("version"))
    events = later.select(F.col("user_id").alias("key"), stamped, "event_id", F.col("event_type").alias("stage"))
    return merge.as_of(events, versions, ["key"]).select("key", "event_id", "stage", _text("version"))


# --- Aggregations ------------------------------------------------------------------------


@register
def agg_files_by_modality(spark: SparkSession, sf: str) -> DataFrame:
    return accounting.files_processed(rules.validate_metadata(_metadata(spark, sf)))


@register
def agg_validation_counts(spark: SparkSession, sf: str) -> DataFrame:
    return accounting.validation_counts(rules.validate_side_metadata(_metadata(spark, sf)))


@register
def agg_deid_counts(spark: SparkSession, sf: str) -> DataFrame:
    return accounting.deid_counts(deid.deidentify_all(_instances(spark, sf), SALT))


@register
def agg_pipeline_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return accounting.handler_outcomes(pipeline.stage_outcomes(_instances(spark, sf), SALT, "SeriesDate"))


@register
def agg_batch_results(spark: SparkSession, sf: str) -> DataFrame:
    judged = rules.validate_metadata(_metadata(spark, sf))
    results = judged.select(
        "study_date", F.when(F.col("is_valid"), "success").otherwise("failed").alias("status")
    )
    return accounting.batch_results(results, F.coalesce("study_date", F.lit("none")))


@register
def agg_manifests(spark: SparkSession, sf: str) -> DataFrame:
    return delivery.manifest_headers(_delivery_files(spark, sf), F.lit("2025-01-01T00:00:00Z"))


@register
def agg_manifest_files(spark: SparkSession, sf: str) -> DataFrame:
    return delivery.manifest_files(_delivery_files(spark, sf))


@register
def agg_manifest_documents(spark: SparkSession, sf: str) -> DataFrame:
    documents = delivery.manifest_documents(_delivery_files(spark, sf), F.lit("2025-01-01T00:00:00Z"), max_files=3)
    return documents.select(
        "manifest_id",
        "part",
        "parts",
        "part_files",
        "part_size_bytes",
        F.concat_ws(",", "files.file_path").alias("paths"),
    )


@register
def agg_manifest_grants(spark: SparkSession, sf: str) -> DataFrame:
    """Manifest files with the URL and expiry of their grant; every fifth object was not granted."""
    files = delivery.manifest_files(_delivery_files(spark, sf))
    lines = study_view.table(spark, sf, "lineitem").where(F.col("l_partkey") % 5 != 0)
    grants = delivery.download_grants(lines.select(study_view.object_key().alias("object_key")), BUCKET, issued_at=ISSUED_AT)
    return delivery.granted_files(files, grants).select("manifest_id", "file_path", "presigned_url", "url_expiration")


@register
def agg_metric_rollup(spark: SparkSession, sf: str) -> DataFrame:
    rolled = accounting.metric_rollup(study_view.metric_points(spark, sf), "1 hour")
    total = F.round("total", 6)
    return rolled.select(
        _stamp("period_start"), _stamp("period_end"), "namespace", "name", total.alias("total"),
        (total / F.col("points")).alias("average"), "maximum", "points",
    )


@register
def agg_failure_alarms(spark: SparkSession, sf: str) -> DataFrame:
    failures = study_view.metric_points(spark, sf).where(F.col("name") == "error")
    raised = accounting.alarms(accounting.metric_rollup(failures, "5 minutes"))
    return raised.select(_stamp("period_start"), "name", F.round("total", 6).alias("total"), "points")


@register
def agg_phi_totals(spark: SparkSession, sf: str) -> DataFrame:
    return deid.phi_totals(_instances(spark, sf))


# --- Limits, runs, retention -----------------------------------------------------------------


@register
def top_failed_operations(spark: SparkSession, sf: str) -> DataFrame:
    found = accounting.failed_operations(study_view.log_events(spark, sf), limit=100)
    return found.select("event_id", _stamp("ts"), "operation", "status", "message")


@register
def top_failed_operations_all(spark: SparkSession, sf: str) -> DataFrame:
    found = accounting.failed_operations(study_view.log_events(spark, sf))
    return found.select("event_id", _stamp("ts"), "operation", "status", "message")


@register
def run_list_all(spark: SparkSession, sf: str) -> DataFrame:
    found = accounting.list_runs(study_view.runs(spark, sf), "arn:machine:imaging", "SUCCEEDED")
    return found.select("execution_arn", "name", "status", _stamp("start_date"), _stamp("stop_date"))


@register
def run_list(spark: SparkSession, sf: str) -> DataFrame:
    found = accounting.list_runs(study_view.runs(spark, sf), "arn:machine:imaging", "SUCCEEDED", 100)
    return found.select("execution_arn", "name", "status", _stamp("start_date"), _stamp("stop_date"))


@register
def run_describe(spark: SparkSession, sf: str) -> DataFrame:
    described = accounting.describe_runs(
        study_view.runs(spark, sf), "key string, patient bigint", "status string, files int"
    )
    return described.select(
        "execution_arn",
        "state_machine_arn",
        "name",
        "status",
        _stamp("start_date"),
        _stamp("stop_date"),
        F.col("input.key").alias("input_key"),
        F.col("input.patient").alias("input_patient"),
        F.col("output.status").alias("output_status"),
        _text("output.files", "output_files"),
        "error",
        "cause",
    )


@register
def ret_storage_tiers(spark: SparkSession, sf: str) -> DataFrame:
    tiers = retention.storage_tiers(study_view.stored_objects(spark, sf), AS_OF)
    return tiers.select("key", "age_days", "storage_class")


@register
def ret_unexpired_logs(spark: SparkSession, sf: str) -> DataFrame:
    kept = retention.unexpired(study_view.table(spark, sf, "events"), "2024-04-10")
    return kept.select("event_id", _stamp("ts"))


# --- De-identification -----------------------------------------------------------------------


@register
def deid_remove_tags(spark: SparkSession, sf: str) -> DataFrame:
    left = deid.remove_tags(_instances(spark, sf))
    return left.select(
        "path", "PatientID", "PatientSex", "StudyDate", F.lit(",".join(left.columns)).alias("columns_left"), F.size("tags").alias("tag_count")
    )


@register
def deid_hash_ids(spark: SparkSession, sf: str) -> DataFrame:
    return deid.hash_tags(_instances(spark, sf), SALT).select("path", "PatientID", "AccessionNumber")


@register
def deid_date_shift(spark: SparkSession, sf: str) -> DataFrame:
    return _instances(spark, sf).select("path", deid.date_shift(F.col("PatientID"), SALT).alias("date_shift_days"))


@register
def deid_shift_dates(spark: SparkSession, sf: str) -> DataFrame:
    return deid.shift_dates(_instances(spark, sf), SALT).select("path", "shift_failed", *DATE_TAGS)


@register
def deid_cap_age(spark: SparkSession, sf: str) -> DataFrame:
    return _instances(spark, sf).select(
        "path",
        deid.capped_age(F.col("PatientAge")).alias("PatientAge"),
        deid.age_unreadable(F.col("PatientAge")).alias("unreadable"),
    )


@register
def deid_remove_private_and_pixels(spark: SparkSession, sf: str) -> DataFrame:
    stripped = deid.remove_pixels(deid.remove_private(_instances(spark, sf)))
    return stripped.select("path", F.size("private_tags").alias("private_tags"), "has_pixel_data")


@register
def deid_report(spark: SparkSession, sf: str) -> DataFrame:
    report = deid.deid_report(_instances(spark, sf))
    lists = ("phi_tags_present", "tags_to_remove", "tags_to_hash", "tags_to_shift")
    return report.select("path", *[_list(n) for n in lists], "private_tags_count", "total_phi_elements")


@register
def deid_phi_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return deid.phi_inventory(_instances(spark, sf)).select("path", _list("phi_tags"))


_DEID_SHOWN = (
    "path",
    "PatientID",
    "PatientSex",
    "PatientAge",
    "AccessionNumber",
    "StudyInstanceUID",
    *DATE_TAGS,
    "StudyTime",
    "Modality",
    "SOPInstanceUID",
    "PatientIdentityRemoved",
    "DeidentificationMethod",
)


@register
def deid_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return deid.deidentified(_instances(spark, sf), SALT).select(*_DEID_SHOWN, F.size("private_tags").alias("private_tags"))


@register
def deid_failures(spark: SparkSession, sf: str) -> DataFrame:
    return deid.deid_failures(_instances(spark, sf), SALT)


@register
def deid_audit(spark: SparkSession, sf: str) -> DataFrame:
    rows = deid.audit_rows(_instances(spark, sf), SALT)
    return rows.select(
        "event_type",
        "user",
        "resource",
        "action",
        "result",
        F.col("details.hashed_patient_id").alias("hashed_patient_id"),
        F.col("details.date_shift_days").alias("date_shift_days"),
    )


# --- Whole pipeline, batch and stream ----------------------------------------------------------

_ROUTED = ("path", "outcome", "error_codes", "failure", "PatientID", "PatientAge", "StudyDate", "Modality")


@register
def pipeline_batch(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.routed(_instances(spark, sf), SALT).select(*_ROUTED)


def _stream_pipeline(spark: SparkSession, sf: str) -> str:
    target = shared_dir(spark, "stream-pipeline")
    lines = spark.readStream.schema(study_view.table(spark, sf, "lineitem").schema).parquet(f"{sf}/lineitem.parquet*")
    studies = study_view.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    patients = study_view.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    instances = study_view.as_instances(lines, studies, patients)
    jobs.start_pipeline(instances, f"{target}/out", f"{target}/checkpoint", SALT).awaitTermination()
    return f"{target}/out"


@register
def stream_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.committed(spark, _stream_pipeline(spark, sf)).select(*_ROUTED)


@register
def stream_pipeline_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The metric points of all micro-batches, summed."""
    return _points(jobs.committed(spark, _stream_pipeline(spark, sf), "metrics"))


@register
def stream_failure_alarms(spark: SparkSession, sf: str) -> DataFrame:
    target = shared_dir(spark, "stream-alarms")
    events = spark.readStream.schema(study_view.table(spark, sf, "events").schema).parquet(f"{sf}/events.parquet*")
    points = events.where(F.col("event_type") == "error").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("name"), "value"
    )
    jobs.start_alarms(points, f"{target}/out", f"{target}/checkpoint").awaitTermination()
    raised = jobs.raised_alarms(spark, f"{target}/out")
    return raised.select(_stamp("period_start"), "name", F.round("total", 6).alias("total"), "points")


@register
def stream_alarm_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Changes between OK and ALARM of the error metric, as far as the watermark has come."""
    target = shared_dir(spark, "alarm-changes")
    events = spark.readStream.schema(study_view.table(spark, sf, "events").schema).parquet(f"{sf}/events.parquet*")
    points = events.where(F.col("event_type") == "error").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("name"), F.col("value").cast("double").alias("value")
    )
    alarms.start_alarm_changes(points, f"{target}/out", f"{target}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{target}/out").select("name", _stamp("period_start"), "from_state", "to_state")
