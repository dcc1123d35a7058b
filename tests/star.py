"""Small tables of lines, studies and patients."""

from __future__ import annotations

from pyspark.sql import functions as F


def write_tables(spark, folder):
    """Sixty lines of twelve studies; one line comes twice."""
    key = F.col("id").cast("bigint")
    lines = spark.range(60).unionByName(spark.range(1)).select(
        (key % 12).alias("l_orderkey"),
        (key + 3).alias("l_partkey"),
        (key % 7).alias("l_suppkey"),
        (key / 12).cast("int").alias("l_linenumber"),
        F.lit(5.0).alias("l_quantity"),
        F.lit(0.02).alias("l_discount"),
        F.lit("2024-01-02").cast("timestamp_ntz").alias("l_shipdate"),
        F.lit("N").alias("l_returnflag"),
    )
    studies = spark.range(12).select(
        key.alias("o_orderkey"), (key % 4).alias("o_custkey"), F.lit("2024-01-01").cast("timestamp_ntz").alias("o_orderdate")
    )
    patients = spark.range(4).select(
        key.alias("c_custkey"), F.concat(F.lit("Name "), key.cast("string")).alias("c_name"), key.cast("int").alias("c_nationkey")
    )
    for name, rows in (("lineitem", lines), ("orders", studies), ("customer", patients)):
        rows.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
