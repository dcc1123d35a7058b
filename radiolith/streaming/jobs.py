"""Arrival, pipeline and alarm streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from radiolith.operators.accounting import alarms
from radiolith.plans.metrics import RunMetrics
from radiolith.plans.pipeline import write_routed
from radiolith.schemas import FILE_FIELDS

AVAILABLE_NOW = {"availableNow": True}
SUMS = "period_start timestamp, period_end timestamp, name string, total double, points bigint"
BINARY_FILE = T.StructType(FILE_FIELDS + [T.StructField("content", T.BinaryType())])


def arriving_files(spark: SparkSession, path: str, suffix: str = ".dcm", per_batch: int | None = None) -> DataFrame:
    """New files below a path as they arrive. Without ``content`` in use no file is opened."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
    )
    return (reader if per_batch is None else reader.option("maxFilesPerTrigger", per_batch)).load(path)


COMMITS = "query_id string, batch_id bigint, write_id string"


def start_pipeline(
    instances: DataFrame, target: str, checkpoint: str, salt: str, trigger: dict | None = None, at=None, **options
) -> StreamingQuery:
    """Route arriving instances as the batch job does, into ONE table and ONE metric table below the target.

    Every micro-batch writes under a new ``write_id`` and commits it when rows and metrics are written. What a batch
    that died has left behind carries an id that is never committed; a batch that comes again after its commit is not
    written again. So ``committed`` shows every instance and every metric point exactly once.
    """
    spark = instances.sparkSession
    log = f"{target}/commits"
    spark.createDataFrame([], COMMITS).write.mode("append").parquet(log)

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        done = session.read.schema(COMMITS).parquet(log).where((F.col("query_id") == query_id) & (F.col("batch_id") == batch_id))
        if not done.isEmpty():
            return
        write_id, metrics = uuid.uuid4().hex, RunMetrics()
        marks = {"write_id": F.lit(write_id)}
        write_routed(batch, f"{target}/data", salt, metrics, "append", marks, **options)
        metrics.points(session, at).withColumns(marks).write.mode("append").parquet(f"{target}/metrics")
        session.createDataFrame([(query_id, batch_id, write_id)], COMMITS).write.mode("append").parquet(log)

    return (
        instances.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def committed(spark: SparkSession, target: str, table: str = "data") -> DataFrame:
    """The rows (``data``) or metric points (``metrics``) of committed micro-batches."""
    log = spark.read.schema(COMMITS).parquet(f"{target}/commits")
    return spark.read.parquet(f"{target}/{table}").join(log.select("write_id"), "write_id", "left_semi").drop("write_id")


def failure_sums(points: DataFrame, period: str = "5 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Sum and number of points per period and metric; a period takes points until it is ``lateness`` old."""
    return (
        points.withWatermark("ts", lateness)
        .groupBy(F.window("ts", period).alias("w"), "name")
        .agg(F.sum("value").alias("total"), F.count("*").alias("points"))
        .select(F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"), "name", "total", "points")
    )


def start_alarms(points: DataFrame, target: str, checkpoint: str, trigger: dict | None = None, **options) -> StreamingQuery:
    """Write the sums that a micro-batch changed, of open periods too, into a folder of the batch.

    A batch that is run again overwrites its folder; ``raised_alarms`` reads the last state of each period.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return (
        failure_sums(points, **options)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def raised_alarms(spark: SparkSession, target: str) -> DataFrame:
    """The periods whose last written sum raises an alarm."""
    written = spark.read.schema(f"{SUMS}, batch_id bigint").parquet(target)
    last = written.groupBy("period_start", "period_end", "name").agg(
        F.max_by("total", "batch_id").alias("total"), F.max_by("points", "batch_id").alias("points")
    )
    return alarms(last)
