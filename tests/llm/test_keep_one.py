"""Which rows of a SimHash component stay."""

from radiolith.llm import simhash

SCHEMA = "doc_id long, text string, source string"


def test_simhash_keeps_one_row_of_a_component(spark):
    rows = [(1, "a b", "s"), (1, "A  b", "s"), (1, "a b", "s"), (None, "c d", "s"), (None, "C d", "s"), (1, "e f", "s"), (2, "e f", "s")]
    got = simhash.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["doc_id"]), " ".join(r["text"].lower().split())) for r in got) == [("1", "a b"), ("1", "e f"), ("None", "c d")]
