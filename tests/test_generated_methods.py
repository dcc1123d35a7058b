"""The JVM interprets generated methods above 8000 bytes."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from radiolith.operators import extract, rules
from radiolith.plans import pipeline
from radiolith.sources import study_view

TAGS = ("PatientID", "PatientSex", "StudyInstanceUID", "StudyDate", "SeriesNumber", "Modality", "SOPInstanceUID", "KVP")


def _metadata(instances):
    return extract.extract_metadata(instances, keep=["path"])


JOBS = {
    "flat": lambda i: rules.validate_metadata(_metadata(i)).select("path", "error_codes", "is_valid"),
    "typed": lambda i: extract.typed_records(rules.validate_records(extract.raw_records(_metadata(i), keep=["path"]))),
    "nested": lambda i: extract.nested_records(_metadata(i), keep=["path"]),
    "routed": lambda i: pipeline.routed(i, "salt"),
    "outcomes": lambda i: pipeline.stage_outcomes(i, "salt", "SeriesDate"),
    "bytes": lambda i: study_view.as_dicom_bytes(i, TAGS, ("Rows", "Columns")),
}


@pytest.fixture
def instances(spark):
    lines = spark.range(1).selectExpr(
        "id l_orderkey", "2L l_partkey", "3L l_suppkey", "1 l_linenumber", "CAST(id + 4 AS DOUBLE) l_quantity",
        "0.05D l_discount", "date_add(DATE'1995-01-02', CAST(id AS INT)) l_shipdate", "'N' l_returnflag",
    )
    lines = lines.withColumns({"l_partkey": F.col("l_orderkey") + 2, "l_suppkey": F.col("l_orderkey") + 3})
    studies = spark.range(1).selectExpr("id o_orderkey", "id + 5 o_custkey", "date_add(DATE'1995-01-01', CAST(id AS INT)) o_orderdate")
    patients = spark.range(5, 6).selectExpr("id c_custkey", "concat('Name', id) c_name", "CAST(id AS INT) c_nationkey")
    return study_view.as_instances(lines, studies, patients)


@pytest.mark.parametrize("job", JOBS)
def test_generated_methods_are_compiled(spark, instances, job):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = JOBS[job](instances)
        code = spark._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(-?\d+)", code)]
    assert sizes and 0 < min(sizes) and max(sizes) <= 8000
    assert plan.count() == 1


def test_a_verdict_copies_a_row_once(spark, instances):
    """Numbers are read in the projection of the verdict: one generator, with the columns of the row passed through once."""
    judged = JOBS["flat"](instances)
    assert judged._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 1
