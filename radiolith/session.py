"""Session construction and the two settings the library reads from it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_COMPILE_LARGE = "-XX:-DontCompileHugeMethods"


def build_session(app_name: str = "radiolith", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for.

    Shuffle width is left to adaptive execution: start from a wide
    ``spark.sql.shuffle.partitions`` on a cluster and let small partitions coalesce.
    A verdict over the whole rule catalogue is one large generated method, which the JVM
    would interpret instead of compiling unless told otherwise.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.extraJavaOptions", _COMPILE_LARGE)
        .config("spark.executor.extraJavaOptions", _COMPILE_LARGE)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one machine, may leave that unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/radiolith-{purpose}-{uuid.uuid4().hex}"
