"""Rows out of a shuffle are written where they lie."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from radiolith.plans import catalog
from radiolith.sources import sinks
from star import write_tables

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def written(monkeypatch):
    """The plans and the open files of the Parquet writes."""
    seen, write = [], DataFrameWriter.parquet

    def noted(writer, *args, **options):
        plan = writer._df._jdf.queryExecution().optimizedPlan().toString()
        seen.append((plan, writer._df.sparkSession.conf.get(OPEN_FILES)))
        return write(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    return seen


def test_deidentified_rows_of_a_join_are_not_shuffled_again(spark, tmp_path, written):
    tables = write_tables(spark, tmp_path)
    written.clear()
    rows = catalog.snk_deidentified(spark, tables)
    assert len(written) == 1 and "RebalancePartitions" not in written[0][0]
    assert rows.count() == catalog.deid.deidentified(catalog._instances(spark, tables), catalog.SALT).count() > 0


def test_deidentified_rows_are_the_same_either_way(spark, tmp_path):
    instances, found = catalog._instances(spark, write_tables(spark, tmp_path / "in")), []
    for rebalance in (True, False):
        target = str(tmp_path / f"out-{rebalance}")
        sinks.write_deidentified(instances, target, "salt", rebalance=rebalance)
        rows = spark.read.parquet(target)
        found.append((rows.schema, sorted(map(str, rows.drop("tags", "private_tags").collect()))))
    assert found[0] == found[1]


def test_a_task_keeps_a_file_for_each_folder(spark, tmp_path, written):
    before, target = spark.conf.get(OPEN_FILES), tmp_path / "out"
    rows = spark.range(0, 90, 1, 2).withColumn("folder", F.col("id") % 9)
    sinks.write_where_they_lie(rows, str(target), ["folder"])
    assert written[0][1] == str(sinks.FOLDERS) and spark.conf.get(OPEN_FILES) == before
    assert len(list(target.rglob("*.parquet"))) == 18
    assert sorted(map(tuple, spark.read.parquet(str(target)).collect())) == [(n, n % 9) for n in range(90)]
