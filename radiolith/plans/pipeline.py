"""The whole flow over instances: extract, validate, de-identify, route.

One lazy plan and one pass over the input: every row is judged where it lies, dealt out by its folder and written once;
the run's metrics are counted on the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radiolith.functions.values import joined
from radiolith.operators.deid import deidentify_all
from radiolith.operators.extract import BASE_FIELDS, CT_FIELDS, MR_FIELDS
from radiolith.operators.rules import metadata_flags, side_metadata_flags
from radiolith.plans.metrics import RunMetrics
from radiolith.sources.sinks import append, modality_group, write_partitioned

DELIVERED, QUARANTINED, FAILED = "delivered", "quarantined", "failed"
_NAMES = {**BASE_FIELDS, **CT_FIELDS, **MR_FIELDS}
_VERDICT = ("parse_error", "error_codes", "failure", "outcome")
_OPEN = ("path", "length", "modificationTime", "SOPInstanceUID", *_VERDICT)


def routed(instances: DataFrame, salt: str, metrics: RunMetrics | None = None, **options) -> DataFrame:
    """Every instance with its outcome; only delivered rows carry (de-identified) header values.

    A row is quarantined if its header cannot be read or breaks a rule, and failed if it
    cannot be de-identified.
    """
    # The verdict is evaluated with the failure, so that a wide row is copied once for both. Rows that can't be
    # de-identified lose their header values, but are counted under their modality.
    also = {"error_codes": joined(metadata_flags(instances, _NAMES)), "_group": modality_group(F.col("Modality"))}
    treated = deidentify_all(instances, salt, keep=_VERDICT, also=also, **options)
    unreadable = F.col("parse_error").isNotNull() if "parse_error" in instances.columns else F.lit(False)
    outcome = (
        F.when(unreadable | (F.col("error_codes") != ""), QUARANTINED)
        .when(F.col("failure").isNotNull(), FAILED)
        .otherwise(DELIVERED)
    )
    with_outcome = treated.withColumn("outcome", outcome).drop("date_shift_days")
    if metrics is not None:
        with_outcome = metrics.watch(with_outcome, unreadable)
    return with_outcome.select(
        *[
            F.col(name) if name in _OPEN else F.when(F.col("outcome") == DELIVERED, F.col(name)).alias(name)
            for name in with_outcome.columns
            if name != "_group"
        ]
    )


def stage_outcomes(instances: DataFrame, salt: str, version: str, **options) -> DataFrame:
    """The first attempt of every upload at the three stages: ``key``, ``version``, ``attempt`` and a boolean for each.

    One pass over the instances; ``version`` names the column that tells uploads under one key apart.
    """
    verdicts = {"ingestion": metadata_flags(instances, _NAMES), "validation": side_metadata_flags(instances, _NAMES)}
    also = {"version": F.col(version)} | {stage: joined(flags) == "" for stage, flags in verdicts.items()}
    treated = deidentify_all(instances, salt, also=also, **options)
    return treated.select(
        F.col("path").alias("key"),
        "version",
        F.lit(1).alias("attempt"),
        "ingestion",
        "validation",
        F.col("failure").isNull().alias("deidentification"),
    )


def write_routed(
    instances: DataFrame, target: str, salt: str, metrics: RunMetrics | None = None, mode: str = "overwrite",
    marks: dict[str, Column] | None = None, **options,
) -> None:
    """Write each instance into ``outcome=…/modality_group=…`` below the target; ``marks`` are further columns."""
    rows = routed(instances, salt, metrics, **options).withColumn("modality_group", modality_group(F.col("Modality")))
    write_partitioned(rows.withColumns(marks or {}), target, ["outcome", "modality_group"], mode)


def run_batch(instances: DataFrame, target: str, metrics_target: str, salt: str, at=None, **options) -> None:
    """The batch job: route all instances, and append the counts of that pass to the metric table."""
    metrics = RunMetrics()
    write_routed(instances, target, salt, metrics, **options)
    append(metrics.points(instances.sparkSession, at), metrics_target)
