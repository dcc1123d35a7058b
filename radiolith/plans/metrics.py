"""Metrics of a run, counted in the pass that writes its rows.

``observe`` carries the counts along with the write, so no row is read a second time. The dimensions are closed sets;
the driver gets a few numbers, whatever the size of the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from radiolith.functions.values import true_or_false
from radiolith.schemas import METRICS, SUPPORTED_MODALITIES
from radiolith.sources.sinks import moment

#: Codes of the rules that the validation stage judges by: patient, study, series and instance.
_SIDE_RULES = r"(^|,)[PSEN][0-9]"
OUTCOMES = ("delivered", "quarantined", "failed")


class RunMetrics:
    """The four metric families of one run: ingestion, validation, de-identification and pipeline."""

    def __init__(self) -> None:
        self.observation = Observation()

    def watch(self, rows: DataFrame, unreadable: Column) -> DataFrame:
        """The rows (``error_codes``, ``failure``, ``outcome``, ``_group`` of the modality), counted when they are written."""
        readable = ~unreadable
        ingested = readable & (F.col("error_codes") == "")
        checked = readable & ~true_or_false(F.col("error_codes").rlike(_SIDE_RULES))
        treated = readable & F.col("failure").isNull()
        every = ingested & checked & treated
        group = F.col("_group")
        flags = {f"files {name}": ingested & (group == name) for name in (*SUPPORTED_MODALITIES, "OTHER")}
        flags |= {"checked": checked, "unchecked": ~checked, "treated": treated, "untreated": ~treated, "run": every, "broken": ~every}
        flags |= {f"outcome {name}": F.col("outcome") == name for name in OUTCOMES}
        # Not count_if: Spark would add a column for each flag in one more copy of the row.
        return rows.observe(self.observation, *[F.count(F.when(flag, 1)).alias(name) for name, flag in flags.items()])

    def points(self, spark: SparkSession, at=None) -> DataFrame:
        """Metric points of the counts above 0; waits for the write."""
        counts = self.observation.get
        families = [
            ("Ingestion", [(f"files {m}", "FilesProcessed", "Modality", m) for m in (*SUPPORTED_MODALITIES, "OTHER")]),
            ("Validation", [("checked", "ValidationSuccess", None, None), ("unchecked", "ValidationFailure", None, None)]),
            ("Deidentification", [("treated", "FilesDeidentified", None, None), ("untreated", "DeidentificationFailure", None, None)]),
            ("Pipeline", [("run", "PipelineSuccess", None, None), ("broken", "PipelineFailure", None, None)]),
            ("Pipeline", [(f"outcome {name}", "Files", "Outcome", name) for name in OUTCOMES]),
        ]
        rows = [
            (f"MedicalImaging/{family}", name, float(counts[key]), "Count", {dimension: value} if dimension else {})
            for family, entries in families
            for key, name, dimension, value in entries
            if counts.get(key)
        ]
        points = spark.createDataFrame(rows, "namespace string, name string, value double, unit string, dimensions map<string,string>")
        return points.withColumn("ts", moment(at)).to(METRICS)
