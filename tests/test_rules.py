"""Rule catalogue on single values: each rule accepts and rejects."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiolith.operators import extract, rules

GOOD = dict(
    patient_id="P1",
    patient_sex="M",
    patient_age="045Y",
    study_instance_uid="1.2.3",
    study_date="20230615",
    study_time="101112",
    study_description="Head",
    accession_number="A1",
    series_instance_uid="1.2.3.4",
    series_number="1",
    series_description="Axial",
    modality="CT",
    sop_instance_uid="1.2.3.4.5",
    sop_class_uid="1.2.840",
    instance_number="1",
    rows="512",
    columns="512",
    bits_allocated="16",
    bits_stored="12",
    pixel_spacing=[0.5, 0.5],
    kvp="120",
    slice_thickness="2.5",
    reconstruction_diameter="300",
    repetition_time=None,
    echo_time=None,
    magnetic_field_strength=None,
)
SCHEMA = T.StructType(
    [T.StructField("n", T.IntegerType())]
    + [
        T.StructField(k, T.ArrayType(T.DoubleType()) if k == "pixel_spacing" else T.StringType()) for k in GOOD
    ]
)
MR = dict(modality="MR", kvp=None, slice_thickness=None, reconstruction_diameter=None)
CASES = [
    ({}, ""),
    ({"patient_id": None}, "P1"),
    ({"patient_id": ""}, "P1,P2"),
    ({"patient_id": " \t"}, "P2"),
    ({"patient_id": "x" * 65}, "P1"),
    ({"patient_id": " " + "x" * 64}, "P1"),
    ({"patient_sex": "X"}, "P3"),
    ({"patient_sex": None}, ""),
    ({"patient_age": "45Y"}, "P4"),
    ({"patient_age": "200Y"}, "P5"),
    ({"patient_age": "150Y"}, ""),
    ({"patient_age": "999M"}, ""),
    ({"patient_age": "045Y\n"}, "P4"),
    ({"study_instance_uid": None}, "S1"),
    ({"study_instance_uid": ""}, "S1"),
    ({"study_instance_uid": "1.2.x"}, "S1"),
    ({"study_instance_uid": ".1.2.3"}, "S2"),
    ({"study_instance_uid": "1.2.3."}, "S2"),
    ({"study_instance_uid": "1..2.3"}, "S2"),
    ({"study_instance_uid": "1.2.3\n"}, "S1"),
    ({"study_date": "20251332"}, "S4"),
    ({"study_date": "20240229"}, ""),
    ({"study_date": "20230229"}, "S4"),
    ({"study_date": "00000101"}, "S4"),
    ({"study_date": "2025-01-01"}, "S3"),
    ({"study_time": "256199"}, ""),
    ({"study_time": "101112.1234567"}, "S5"),
    ({"study_time": "1011"}, "S5"),
    ({"study_description": "x" * 65}, "S6"),
    ({"accession_number": "0123456789abcdef"}, ""),
    ({"accession_number": "0123456789abcdef0"}, "S6"),
    ({"series_instance_uid": "1.2."}, "E2"),
    ({"series_number": "100000"}, "E3"),
    ({"series_number": "1.0"}, ""),
    ({"series_number": "1.5"}, "E3"),
    ({"series_number": "NaN"}, "E3"),
    ({"series_number": "1d"}, "E3"),
    ({"series_description": "x" * 65}, "E4"),
    ({"modality": "C", "kvp": "999"}, "E5"),
    ({"modality": None}, "E5"),
    ({"rows": "0"}, "I1"),
    ({"columns": "65536"}, "I2"),
    ({"rows": None, "columns": None, "bits_stored": "99"}, ""),
    ({"bits_allocated": "65"}, "I3"),
    ({"bits_allocated": "12", "bits_stored": "16"}, "I6"),
    ({"pixel_spacing": [0.5]}, "I5"),
    ({"pixel_spacing": None}, ""),
    ({"kvp": "201"}, "C1"),
    ({"kvp": "abc"}, "C1"),
    ({"slice_thickness": "-1"}, "C2"),
    ({"reconstruction_diameter": "-1"}, "C3"),
    ({"modality": "ct", "kvp": "999"}, ""),
    (MR | {"repetition_time": "-1"}, "M1"),
    (MR | {"echo_time": "-0.1"}, "M2"),
    (MR | {"magnetic_field_strength": "20.5"}, "M3"),
    (MR | {"magnetic_field_strength": "3e0"}, ""),
    ({"sop_instance_uid": None}, "N1"),
    ({"sop_class_uid": "1..2"}, "N2"),
    ({"instance_number": "-1"}, "N3"),
]


@pytest.fixture(scope="module")
def metadata(spark):
    rows = [(n, *{**GOOD, **change}.values()) for n, (change, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, SCHEMA)


def test_flat_metadata(metadata):
    found = {r["n"]: r["error_codes"] for r in rules.validate_metadata(metadata).select("n", "error_codes").collect()}
    assert found == {n: codes for n, (_, codes) in enumerate(CASES)}


def test_nested_records_have_the_same_verdict(metadata):
    """Unreadable numbers and ids with white space included."""
    records = extract.raw_records(metadata, keep=["n"])
    found = {r["n"]: r["error_codes"] for r in rules.validate_records(records).select("n", "error_codes").collect()}
    assert found == {n: codes for n, (_, codes) in enumerate(CASES)}


def test_typed_records_are_the_nested_ones(metadata):
    typed = extract.typed_records(extract.raw_records(metadata, keep=["n"]))
    nested = extract.nested_records(metadata, keep=["n"])
    assert typed.columns == nested.columns
    assert sorted(map(str, typed.collect())) == sorted(map(str, nested.collect()))


def test_error_details(metadata):
    detailed = rules.with_error_details(rules.validate_metadata(metadata))
    rows = {r["n"]: r["errors"] for r in detailed.select("n", "errors").collect()}
    assert rows[0] == []
    assert [(e["rule"], e["field"]) for e in rows[2]] == [("P1", "patient_id"), ("P2", "patient_id")]
    assert all(e["message"] for errors in rows.values() for e in errors)


def test_block_only_with_a_value(metadata):
    bare = metadata.where("n = 0").withColumns(
        {c: F.lit(None).cast("string") for c in ("kvp", "slice_thickness", "reconstruction_diameter", "rows", "columns")}
    )
    record = extract.nested_records(bare).first()
    assert record["ct_metadata"] is None and record["mr_metadata"] is None and record["image"] is None


MANIFEST_GOOD = ("M1", "2024-01-01T10:00:00Z", "P1", "1.2", 1, 10, [("a.dcm", 10, "0" * 32)])


@pytest.mark.parametrize(
    "at, value, codes",
    [
        (0, "M1", ""),
        (0, "", "D1"),
        (1, "2024-01-01 10:00:00", "D4"),
        (1, "2024-01-01T10:00:00", "D4"),
        (1, "2024-13-01T10:00:00Z", "D4"),
        (1, "2024-01-01T10:00:00.5+02:00", ""),
        (4, 3, "D7"),
        (4, -1, "D5,D7"),
        (5, -1, "D6"),
        (5, 999, ""),
        (6, [("", 10, "0" * 32)], "F1"),
        (6, [("a", -1, "0" * 32)], "F2"),
        (6, [("a", 10, "short")], "F3"),
    ],
)
def test_nested_manifest(spark, at, value, codes):
    row = list(MANIFEST_GOOD)
    row[at] = value
    schema = (
        "manifest_id string, created_at string, patient_id string, study_instance_uid string, total_files int,"
        " total_size_bytes long, files array<struct<file_path: string, file_size: long, checksum: string>>"
    )
    judged = rules.validate_nested_manifests(spark.createDataFrame([tuple(row)], schema)).first()
    assert judged["error_codes"] == codes
