"""Benchmark items without an id, against the registered SQL."""

from compare import differences
import duckdb

from radiolith.llm import decontaminate
from radiolith.llm.oracle import ORACLE
from radiolith.llm.queries import op8_decontaminate


def test_items_without_id_are_hit(spark, tmp_path):
    items = [(1, "red green blue"), (None, "one two three four"), (None, "lone"), (None, "lone")]
    docs = [(1, "say one two three four now"), (2, "lone red green blue lone"), (3, "red green blue"), (4, "clean text"), (5, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert differences(op8_decontaminate(spark, str(tmp_path)), ORACLE["op8_decontaminate"], connection) == []
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(documents, benchmark).collect()) == [4, 5]
