"""Counting outcomes, rolling up metrics, and reading logs and runs.

All aggregates combine on the map side; all limits are ordered with a unique last key, so
Spark takes the first rows per partition instead of sorting everything.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def files_processed(judged: DataFrame) -> DataFrame:
    """Valid files by modality (upper case), the dimension of the ``FilesProcessed`` metric."""
    return judged.where("is_valid").groupBy(F.upper("modality").alias("modality")).agg(F.count("*").alias("files_processed"))


def validation_counts(judged: DataFrame) -> DataFrame:
    return judged.agg(
        F.count_if("is_valid").alias("validation_success"), F.count_if(~F.col("is_valid")).alias("validation_failure")
    )


def deid_counts(treated: DataFrame) -> DataFrame:
    """Successes and failures of rows that carry ``failure``."""
    return treated.agg(
        F.count_if(F.col("failure").isNull()).alias("files_deidentified"),
        F.count_if(F.col("failure").isNotNull()).alias("deidentification_failure"),
    )


def batch_results(results: DataFrame, batch: Column) -> DataFrame:
    """Per batch: rows processed, failures included, and successes. The result rows stay a table of their own."""
    return results.groupBy(batch.alias("batch_id")).agg(
        F.count("*").alias("processed"),
        F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count_if(F.col("status") != "success").alias("failed"),
    )


def pipeline_results(ingestion: DataFrame, validation: DataFrame, deidentification: DataFrame) -> DataFrame:
    """The three stage outcomes of each uploaded object version side by side, and the overall status.

    Stage tables have ``key``, ``version``, ``status`` and ``attempt``; events that know no version get that of the
    latest upload before them from ``merge.as_of``. The tables are stacked and aggregated instead of joined, see
    ``stacked_results``.
    """
    stages = {"ingestion": ingestion, "validation": validation, "deidentification": deidentification}
    stacked = None
    for name, stage in stages.items():
        rows = stage.select("key", "version", "status", "attempt", F.lit(name).alias("stage"))
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return stacked_results(stacked)


#: The good and the bad status of each stage.
STAGE_STATUS = {
    "ingestion": ("success", "failed"),
    "validation": ("valid", "invalid"),
    "deidentification": ("success", "failed"),
}


def _last(attempt: Column, passed: Column) -> Column:
    """The last attempt and its outcome in one whole number, so that aggregation hashes instead of sorting.

    Even numbers passed. Of equal attempts the failed one counts.
    """
    return F.max(attempt.cast("bigint") * 2 + F.when(passed, 0).otherwise(1))


def stacked_results(stacked: DataFrame) -> DataFrame:
    """As ``pipeline_results``, from one table with ``key``, ``version``, ``stage``, ``status`` and ``attempt``.

    Repeats combine before the one shuffle; any status but the stage's good one counts as its bad one. A run belongs to
    one version of an object and succeeds where every stage did.
    """
    last = []
    for name, (good, _) in STAGE_STATUS.items():
        own = F.col("stage") == name
        last.append(_last(F.when(own, F.col("attempt")), F.col("status").eqNullSafe(good)).alias(name))
    return _results(stacked.groupBy("key", "version").agg(*last).where(F.col("ingestion").isNotNull()))


def wide_results(wide: DataFrame) -> DataFrame:
    """As ``stacked_results``, from rows that hold the outcomes of all three stages as booleans: a third of the rows."""
    last = [_last(F.col("attempt"), F.col(name)).alias(name) for name in STAGE_STATUS]
    return _results(wide.groupBy("key", "version").agg(*last))


def _results(grouped: DataFrame) -> DataFrame:
    passed = {name: F.pmod(name, F.lit(2)) == 0 for name in STAGE_STATUS}
    return grouped.select(
        "key",
        "version",
        *[
            F.when(passed[name], good).when(~passed[name], bad).alias(f"{name}_status")
            for name, (good, bad) in STAGE_STATUS.items()
        ],
        F.when(_every(passed), "SUCCESS").otherwise("FAILED").alias("status"),
    )


def _every(passed: dict[str, Column]) -> Column:
    return F.coalesce(passed["ingestion"] & passed["validation"] & passed["deidentification"], F.lit(False))


def handler_outcomes(wide: DataFrame) -> DataFrame:
    """Counts of handler runs, every row one run of each stage, and of whole pipeline runs, one for a key and version.

    One pass and one shuffle: the runs of a version are counted where its last attempts are found.
    """
    counts = [
        F.count_if(flag).cast("bigint").alias(f"{name}_{outcome}")
        for name in STAGE_STATUS
        for outcome, flag in (("success", F.col(name)), ("failure", ~F.col(name)))
    ]
    last = [_last(F.col("attempt"), F.col(name)).alias(name) for name in STAGE_STATUS]
    runs = wide.groupBy("key", "version").agg(*last, *counts)
    success = _every({name: F.pmod(name, F.lit(2)) == 0 for name in STAGE_STATUS})
    sums = [F.sum(f"{name}_{outcome}").alias(f"{name}_{outcome}") for name in STAGE_STATUS for outcome in ("success", "failure")]
    totals = runs.agg(*sums, F.count_if(success).alias("pipeline_success"), F.count_if(~success).alias("pipeline_failure"))
    rows = [
        F.struct(F.lit(name.capitalize()).alias("handler"), F.lit(outcome).alias("outcome"), F.col(f"{name}_{outcome}").alias("count"))
        for name in (*STAGE_STATUS, "pipeline")
        for outcome in ("success", "failure")
    ]
    found = totals.select(F.inline(F.array(*rows))).where("count > 0")
    return found.select(F.concat("handler", F.initcap("outcome")).alias("metric_name"), "handler", "outcome", "count")


def metric_rollup(points: DataFrame, period: str = "5 minutes") -> DataFrame:
    """Sum, average, maximum and number of points per metric and period.

    Sums are plain doubles: small and large values both count. Round where they are shown.
    """
    return (
        points.groupBy(F.window("ts", period).alias("w"), "namespace", "name")
        .agg(F.sum("value").alias("total"), F.max("value").alias("maximum"), F.count("value").alias("points"))
        .select(
            F.col("w.start").alias("period_start"),
            F.col("w.end").alias("period_end"),
            "namespace",
            "name",
            "total",
            (F.col("total") / F.col("points")).alias("average"),
            "maximum",
            "points",
        )
    )


def alarms(rollup: DataFrame, threshold: float = 0) -> DataFrame:
    """Periods whose sum exceeds the threshold; a period without points raises nothing."""
    return rollup.where(F.col("total") > threshold)


def read_log(
    events: DataFrame, start: datetime | str | None = None, end: datetime | str | None = None, limit: int | None = None
) -> DataFrame:
    """Log events from ``start`` up to but not including ``end``, in time order."""
    found = events
    if start is not None:
        found = found.where(F.col("ts") >= F.lit(start).cast("timestamp"))
    if end is not None:
        found = found.where(F.col("ts") < F.lit(end).cast("timestamp"))
    return found if limit is None else found.orderBy("ts", "event_id").limit(limit)


def failed_operations(events: DataFrame, limit: int | None = None) -> DataFrame:
    """The latest failed operations."""
    found = events.where(F.col("status").isin("failed", "error"))
    return found if limit is None else found.orderBy(F.desc("ts"), "event_id").limit(limit)


def list_runs(
    runs: DataFrame, machine: str | None = None, status: str | None = None, limit: int | None = None
) -> DataFrame:
    """Runs of a state machine, latest first, optionally with one status only."""
    found = runs.select("execution_arn", "state_machine_arn", "name", "status", "start_date", "stop_date")
    if machine is not None:
        found = found.where(F.col("state_machine_arn") == machine)
    if status is not None:
        found = found.where(F.col("status") == status)
    found = found.drop("state_machine_arn")
    return found if limit is None else found.orderBy(F.desc("start_date"), "name").limit(limit)


def describe_runs(runs: DataFrame, input_schema: str, output_schema: str) -> DataFrame:
    """Runs with input and output as structures; parts a run does not have are NULL."""
    return runs.withColumns(
        {"input": F.from_json("input", input_schema), "output": F.from_json("output", output_schema)}
    )
