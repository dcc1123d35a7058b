"""Wide rows are copied seldom."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from radiolith.functions.values import with_computed
from radiolith.plans import pipeline
from radiolith.plans.metrics import RunMetrics
from radiolith.schemas import INTEGER_TAGS, TEXT_TAGS


@pytest.fixture
def instances(spark):
    texts = [F.lit("19990101" if tag.endswith("Date") else "1").alias(tag) for tag in TEXT_TAGS]
    numbers = [F.lit(8).alias(tag) for tag in INTEGER_TAGS]
    others = [F.array(F.lit(0.5), F.lit(0.5)).alias("PixelSpacing"), F.lit(True).alias("has_pixel_data")]
    return spark.range(3).select(F.concat(F.lit("raw/"), F.col("id")).alias("path"), *texts, *numbers, *others)


@pytest.mark.parametrize("job", ["routed", "outcomes"])
def test_verdicts_and_failure_share_a_generator(instances, job):
    rows = pipeline.routed(instances, "salt") if job == "routed" else pipeline.stage_outcomes(instances, "salt", "SeriesDate")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 1
    assert rows.count() == 3


def test_metrics_add_no_column_for_a_flag(instances):
    plan = pipeline.routed(instances, "salt", RunMetrics())._jdf.queryExecution().optimizedPlan().toString()
    assert "_common_expr" not in plan


def test_a_computed_column_replaces_its_namesake(spark):
    rows = with_computed(spark.range(2).withColumn("n", F.col("id") + 1), n=F.col("n") * 10)
    assert rows.columns == ["id", "n"]
    assert sorted(rows.collect()) == [(0, 10), (1, 20)]
