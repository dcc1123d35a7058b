"""The engine's inputs as views over a star schema of customers, orders and order lines.

Patients are customers, studies are orders and instances are order lines. Values follow
from the keys by fixed moduli, so that every rule of the catalogue has rows on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from radiolith.functions.values import apart
from radiolith.schemas import INTEGER_TAGS, TEXT_TAGS
from radiolith.sources.header import EXPLICIT_LITTLE, NUMBERS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(number: Column, values: list, dtype: str = "string") -> Column:
    """The value at position ``number mod len(values)``."""
    return F.get(F.array(*[F.lit(value).cast(dtype) for value in values]), (number % len(values)).cast("int"))


def _every(number: Column, cases: dict[int, Column | str | None], usual: Column) -> Column:
    """The first case whose modulus divides ``number``, otherwise the usual value."""
    chain = None
    for modulus, value in cases.items():
        value = value if isinstance(value, Column) else F.lit(value).cast("string")
        condition = number % modulus == 0
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return usual if chain is None else chain.otherwise(usual)


def _text(value: Column) -> Column:
    return value.cast("string")


def instance_columns() -> dict[str, Column]:
    """Expressions of the ``instances`` columns over joined lines, orders and customers."""
    order, patient = F.col("l_orderkey"), F.col("o_custkey")
    part, supplier, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    nation, quantity = F.col("c_nationkey"), F.col("l_quantity").cast("int")
    percent = F.round(F.col("l_discount") * 100).cast("int")
    shipped = F.date_format("l_shipdate", "yyyyMMdd")
    study = F.concat(F.lit("1.2.840."), _text(order))
    modality = _every(
        part,
        {149: None, 151: "X"},
        _pick(part, ["CT", "MR", "CR", "DX", "XA", "PT", "NM", "US", "ct", "ZZ"]),
    )
    return {
        "PatientID": _every(
            order,
            {
                101: None,
                103: "   ",
                107: F.concat(F.lit("  P"), _text(patient), F.lit(" ")),
                109: F.lpad(_text(patient), 65, "7"),
            },
            F.concat(F.lit("P"), _text(patient)),
        ),
        "PatientName": F.when(patient % 17 != 0, F.col("c_name")),
        "PatientBirthDate": F.when(
            patient % 6 != 0,
            F.date_format(F.date_add(F.lit("1930-01-01").cast("date"), ((patient * 11) % 25000).cast("int")), "yyyyMMdd"),
        ),
        "PatientSex": _pick(patient, ["M", "F", "O", "X"]),
        "PatientAge": _every(
            patient,
            {211: "XXXY", 223: None, 227: "45Y"},
            F.concat(F.lpad(_text((patient * 7) % 160), 3, "0"), _pick(part, ["M", "W", "D", "Y"])),
        ),
        "PatientAddress": F.when(patient % 3 == 0, "").when(
            patient % 3 == 1, F.concat(_text(patient), F.lit(" Main Street"))
        ),
        "InstitutionName": F.concat(F.lit("Hospital "), _text(nation)),
        "InstitutionAddress": F.when(part % 2 == 0, F.concat(F.lit("Block "), _text(nation))),
        "ReferringPhysicianName": F.concat(F.lit("Dr^"), _text(supplier % 50)),
        "PerformingPhysicianName": F.when(supplier % 3 == 0, F.concat(F.lit("Perf^"), _text(supplier))),
        "OperatorsName": F.when(supplier % 4 == 1, F.concat(F.lit("Op^"), _text(supplier))),
        "StationName": F.concat(F.lit("ST"), _text(supplier % 20)),
        "DeviceSerialNumber": F.concat(F.lit("SN"), _text(supplier)),
        "ProtocolName": F.when(part % 7 != 0, F.concat(F.lit("Protocol "), _text(part % 30))),
        "OtherPatientIDs": F.when(patient % 9 == 0, F.concat(F.lit("ALT"), _text(patient))),
        "StudyInstanceUID": _every(
            order,
            {
                97: F.concat(F.lit("1.2.."), _text(order)),
                89: F.concat(F.lit("1.2.x"), _text(order)),
                83: None,
            },
            study,
        ),
        "StudyDate": _every(
            order,
            {53: "20251332", 59: "2025010", 61: None, 509: "00010105", 521: "99991230"},
            F.date_format("o_orderdate", "yyyyMMdd"),
        ),
        "StudyTime": _pick(order, ["081500", "256199", "101112.123456", None, "12:30", "235959.1234567", "0930"]),
        "StudyDescription": _every(
            order, {71: F.repeat(F.lit("x"), 65), 74: None}, F.concat(F.lit("Study "), _text(order % 100))
        ),
        "AccessionNumber": _every(
            order,
            {73: F.concat(F.lit("ACC"), F.lpad(_text(order), 14, "0")), 79: None},
            F.concat(F.lit("ACC"), _text(order)),
        ),
        "SeriesDate": shipped,
        "AcquisitionDate": F.when(part % 5 != 0, shipped),
        "ContentDate": F.when(part % 3 == 0, shipped).when(part % 3 == 1, ""),
        "InstanceCreationDate": F.when(part % 4 == 0, F.date_format("l_shipdate", "yyyy-MM-dd")),
        "SeriesTime": F.when(supplier % 2 == 0, "101500"),
        "AcquisitionTime": F.when(supplier % 5 == 0, "101530"),
        "ContentTime": F.when(supplier % 7 == 0, "").when(supplier % 7 == 1, "101600"),
        "SeriesInstanceUID": _every(
            part, {113: F.concat(study, F.lit(".")), 117: None}, F.concat(study, F.lit("."), _text(supplier))
        ),
        "SeriesNumber": _every(
            part,
            {127: "100000", 131: "abc", 137: F.concat(_text(supplier), F.lit(".0")), 139: None, 141: "7.5"},
            _text(supplier),
        ),
        "SeriesDescription": _every(
            part, {119: F.repeat(F.lit("y"), 70), 118: None}, F.concat(F.lit("Series "), _text(supplier % 10))
        ),
        "Modality": apart(modality),  # wide queries read it; a method of all columns would be too large
        "SOPInstanceUID": _every(
            supplier * 31 + part,
            {191: None},
            F.concat(study, F.lit("."), _text(line), F.lit("."), _text(part), F.lit("."), _text(supplier)),
        ),
        "SOPClassUID": _every(
            part, {157: "1..2", 163: None}, F.concat(F.lit("1.2.840.10008.5.1.4.1.1."), _text(part % 10 + 1))
        ),
        "InstanceNumber": _every(part, {167: "-1", 169: None}, _text(line)),
        "Rows": _pick(part + supplier, [512, 256, 32, 0, None, 65536, 1024, 512, 512, 512, 512], "int"),
        "Columns": _pick(part + supplier * 3, [512, 256, 32, 0, None, 512, 1024, 512, 512], "int"),
        "BitsAllocated": _pick(part, [16, 16, 12, None, 16, 16, 65], "int"),
        "BitsStored": _pick(supplier, [12, 12, 16, None, 12, 0], "int"),
        "PixelSpacing": F.when(part % 6 < 4, F.array(F.lit(0.5), F.lit(0.5))).when(part % 6 == 4, F.array(F.lit(0.7))),
        "KVP": _every(part, {110: None, 170: "n/a"}, _text(quantity * 5)),
        "SliceThickness": _every(part, {180: "-2.5", 130: None}, _text(percent)),
        "ReconstructionDiameter": F.when(part % 30 != 0, _text(quantity * 10)),
        "RepetitionTime": _every(part, {121: None, 171: "-1"}, _text(quantity * 40)),
        "EchoTime": F.when(part % 21 != 0, _text(percent + 2)),
        "MagneticFieldStrength": _pick(supplier, ["1.5", "3", "7", "25", None, "3.0"]),
        "has_pixel_data": supplier % 7 != 0,
        "private_tags": F.when(
            part % 5 == 0,
            F.create_map(F.lit("0009,0010"), F.lit("VENDOR"), F.lit("0009,1001"), _text(part)),
        )
        .when(part % 5 == 1, F.create_map(F.lit("0011,0010"), F.lit("LAB")))
        .otherwise(F.create_map().cast("map<string,string>")),
        "tags": F.create_map(F.lit("0018,0015"), F.col("l_returnflag")),
    }


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``instances``: one row per order line. Columns a query leaves unused are never computed."""
    lines = table(spark, sf_dir, "lineitem")
    studies = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    patients = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return as_instances(lines, studies, patients)


def as_instances(lines: DataFrame, studies: DataFrame, patients: DataFrame) -> DataFrame:
    """``instances`` over given (batch or streaming) lines.

    The small dimension joins first, so the large side is shuffled once. Lines and studies are joined by sort and
    merge at every size: neither is small on a cluster, and a broadcast of few lines would leave one task per studies
    file; adaptive execution splits a hot study.
    """
    made = instance_columns()
    columns = [object_key().alias("path")]
    columns += [made.get(tag, F.lit(None).cast("string")).alias(tag) for tag in TEXT_TAGS]
    columns += [made[tag].alias(tag) for tag in INTEGER_TAGS]
    columns += [made[name].alias(name) for name in ("PixelSpacing", "has_pixel_data", "tags", "private_tags")]
    dated = studies.join(patients, F.col("o_custkey") == F.col("c_custkey"))
    joined = lines.join(dated.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(*columns)


def object_key() -> Column:
    """The key of the object that holds an order line's instance."""
    return F.concat(
        F.lit("raw/study-"),
        _text(F.col("l_orderkey")),
        F.lit("/"),
        F.concat_ws("-", _text(F.col("l_linenumber")), _text(F.col("l_partkey")), _text(F.col("l_suppkey"))),
        F.lit(".dcm"),
    )


# --- DICOM bytes ---------------------------------------------------------------------


def _little(number: Column) -> Column:
    """A number below 65536 as two little-endian bytes."""
    swapped = F.shiftleft(number.bitwiseAND(255), 8).bitwiseOR(F.shiftright(number, 8))
    return F.unhex(F.lpad(F.hex(swapped.cast("bigint")), 4, "0"))


def _element(tag: int, vr: str, value: Column) -> Column:
    """One explicit little-endian data element; nothing where the value is NULL."""
    number = f"{(tag >> 16) & 0xFF:02X}{tag >> 24:02X}{tag & 0xFF:02X}{(tag >> 8) & 0xFF:02X}"
    if vr == "US":
        body = _little(value % 65536)
    else:
        body = F.encode(F.concat(value, F.when(F.length(value) % 2 == 1, F.lit(" ")).otherwise("")), "UTF-8")
    head = F.unhex(F.lit(number + vr.encode().hex()))
    return F.coalesce(F.concat(head, _little(F.octet_length(body)), body), F.unhex(F.lit("")))


def as_dicom_bytes(rows: DataFrame, text_tags: tuple[str, ...], integer_tags: tuple[str, ...]) -> DataFrame:
    """Files of (path, content): the given tags of each instance as a DICOM header.

    Every row whose PatientSex is no valid code loses its preamble and so cannot be read.
    """
    numbered = sorted([(NUMBERS[tag], "LO", tag) for tag in text_tags] + [(NUMBERS[tag], "US", tag) for tag in integer_tags])
    meta = _element(0x00020010, "UI", F.lit(EXPLICIT_LITTLE))
    magic = F.when(F.col("PatientSex").isin("M", "F", "O"), F.unhex(F.lit("00" * 128 + b"DICM".hex()))).otherwise(
        F.unhex(F.lit("00" * 132))
    )
    pixels = F.when(F.col("has_pixel_data"), F.unhex(F.lit("E07F10004F57000004000000" + "00000000"))).otherwise(
        F.unhex(F.lit(""))
    )
    body = [_element(number, vr, F.col(tag)) for number, vr, tag in numbered]
    return rows.select("path", F.concat(magic, meta, *body, pixels).alias("content"))


# --- Other roles ---------------------------------------------------------------------


def stored_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object listing with checksum and content type: one object per document."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("raw/"), F.col("source"), F.lit("/doc-"), _text(doc), F.lit(".dcm")).alias("key"),
        F.col("n_chars").alias("size"),
        F.date_add(F.lit("2024-01-01").cast("date"), (doc % 400).cast("int")).cast("timestamp").alias("last_modified"),
        F.md5("text").alias("etag"),
        F.when(doc % 4 != 0, F.when(doc % 4 == 1, "application/dicom").otherwise("binary/octet-stream")).alias(
            "content_type"
        ),
        F.create_map(F.lit("source"), F.col("source")).alias("custom_metadata"),
    )


def requested_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys asked for, with repeats and with keys that do not exist: one per event."""
    wanted = F.floor(F.col("event_id") / 2)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("raw/src"), _text(wanted % 20), F.lit("/doc-"), _text(wanted), F.lit(".dcm")).alias("object_key")
    )


def local_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Downloaded copies with their checksum: some damaged, some never uploaded, some not downloaded."""
    doc = F.col("doc_id")
    key = F.concat(F.lit("raw/"), F.col("source"), F.lit("/doc-"), _text(doc), F.lit(".dcm"))
    return (
        table(spark, sf_dir, "documents")
        .select(
            F.when((doc % 13 == 0) | (doc % 11 == 0), F.concat(F.lit("stray/"), key)).otherwise(key).alias("key"),
            F.md5(F.when(doc % 7 == 0, F.concat("text", F.lit("\n"))).otherwise(F.col("text"))).alias("checksum"),
        )
    )


def arrival_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_arrival_events(table(spark, sf_dir, "pages"))


def as_arrival_events(pages: DataFrame) -> DataFrame:
    """Arrival notifications as JSON text, one per page (batch or streaming), each with two records."""
    key = F.concat(
        F.lit("in+box/"), F.url_encode(F.col("url")), F.when(F.col("page_id") % 3 != 0, ".dcm").otherwise(".txt")
    )

    size, version = F.length("html").cast("bigint"), F.concat(F.lit("v"), _text(F.col("page_id")))
    moment = F.timestamp_add("SECOND", (F.col("page_id") % 600).cast("int"), F.lit("2024-01-01").cast("timestamp"))

    def record(name: Column) -> Column:
        return F.struct(
            F.lit("ObjectCreated:Put").alias("eventName"),
            F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventTime"),
            F.struct(
                F.struct(F.lit("incoming").alias("name")).alias("bucket"),
                F.struct(name.alias("key"), size.alias("size"), version.alias("versionId")).alias("object"),
            ).alias("s3"),
        )

    second = F.concat(F.lit("second/"), _text(F.col("page_id")), F.lit("%20a.dcm"))
    body = F.to_json(F.struct(F.array(record(key), record(second)).alias("Records")))
    return pages.select(F.col("page_id").alias("event_id"), body.alias("body"))


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log events: status by event type, message with the JSON properties."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(kind, F.lit(" "), F.col("props")).alias("message"),
        kind.alias("operation"),
        F.when(kind == "error", "error").when(F.col("event_id") % 29 == 0, "failed").otherwise("completed").alias("status"),
        F.when(kind == "error", "ERROR").otherwise("INFO").alias("level"),
    )


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric points: one per event, named by event type."""
    return table(spark, sf_dir, "events").select(
        F.lit("MedicalImaging/Pipeline").alias("namespace"),
        F.col("event_type").alias("name"),
        F.col("value").alias("value"),
        F.lit("Count").alias("unit"),
        F.create_map(F.lit("User"), _text(F.col("user_id"))).alias("dimensions"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run ledger: one run per order."""
    key, state = _text(F.col("o_orderkey")), F.col("o_orderstatus")
    name = F.concat(F.lit("run-"), key)
    start = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("arn:run:"), name).alias("execution_arn"),
        F.lit("arn:machine:imaging").alias("state_machine_arn"),
        name.alias("name"),
        F.when(state == "O", "RUNNING").when(state == "F", "FAILED").otherwise("SUCCEEDED").alias("status"),
        start.alias("start_date"),
        F.when(state != "O", F.timestamp_add("SECOND", (F.col("o_orderkey") % 600).cast("int"), start)).alias("stop_date"),
        F.concat(F.lit('{"key": "raw/'), key, F.lit('.dcm", "patient": '), _text(F.col("o_custkey")), F.lit("}")).alias(
            "input"
        ),
        F.when(state == "P", F.concat(F.lit('{"status": "SUCCESS", "files": '), _text(F.col("o_orderkey") % 9), F.lit("}"))).alias(
            "output"
        ),
        F.when(state == "F", "PipelineExecutionFailed").alias("error"),
        F.when(state == "F", F.concat(F.lit("step "), _text(F.col("o_orderkey") % 3), F.lit(" failed"))).alias("cause"),
    )


def csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Side records as they stand in a CSV file: one per order."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("record_id"),
        F.when(key % 41 != 0, F.concat(F.lit("P"), _text(F.col("o_custkey")))).alias("patient_id"),
        _every(key, {43: "2025-13-32", 47: None, 53: "2025/01/01"}, F.date_format("o_orderdate", "yyyy-MM-dd")).alias(
            "study_date"
        ),
        _every(key, {59: "X", 61: None}, _pick(key, ["CT", "MR", "CR"])).alias("modality"),
        F.when(key % 3 != 0, F.concat(F.lit("ACC"), _text(key))).alias("accession_number"),
        _pick(key, ["pending", "completed", "failed", "done", None]).alias("status"),
    )
