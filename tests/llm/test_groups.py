"""Operators 3 and 10 against plain versions."""

import random

import pytest
from brute import near_components, simhash

from radiolith.llm import exact_dedup, simhash as near
from radiolith.llm.common import table
from radiolith.llm.components import components

SF = "/root/testdata/sf0.001"


def test_simhash_whole_table(spark):
    rows = table(spark, SF, "documents").collect()
    marks = [simhash((r["text"] or "").encode()) for r in rows]
    want = near_components([r["doc_id"] for r in rows], marks, 4)
    got = near.near_groups(table(spark, SF, "documents")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {r["doc_id"]: f"{m:016x}" for r, m in zip(rows, marks, strict=True)}


@pytest.mark.parametrize("cell_rows", [4096, 3])
def test_links_of_close_fingerprints(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(near, "CELL_ROWS", cell_rows)
    rng = random.Random(2)
    marks = [0, (1 << 64) - 1]
    for _ in range(60):
        base = rng.getrandbits(64)
        for bits in (0, 1, 3, 4, 5, 8):
            marks.append(base ^ sum(1 << b for b in rng.sample(range(64), bits)))
    marks = list(dict.fromkeys(marks))
    frame = spark.createDataFrame([(near._signed(m),) for m in marks], "fp long")
    found = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in components(near.fingerprint_links(frame)).collect()}
    want = near_components(marks, marks, 4)
    groups = lambda of: {frozenset(x for x in marks if of(x) == of(m)) for m in marks}
    assert groups(lambda m: found.get(m, m)) == groups(want.__getitem__)


def test_simhash_edges(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, " \t"), (4, "a b"), (4, "a b"), (None, "a b")], "doc_id long, text string")
    got = near.near_groups(frame).collect()
    zero = [r for r in got if r["fingerprint"] == "0" * 16]
    assert {(r["doc_id"], r["component_id"]) for r in zero} == {(1, 1), (2, 1), (3, 1)}
    assert [r["component_id"] for r in got if r not in zero] == [4, 4, 4]
    assert near.near_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert sorted(r["doc_id"] for r in near.keep_one(frame.where("doc_id < 4")).collect()) == [1]


def test_components_of_chain(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (102, 101), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(2, 61)} | {101: 100, 102: 100}


def test_exact_edges(spark):
    rows = [(3, " a b "), (1, "ab"), (2, "a  b  "), (4, None), (5, ""), (6, " "), (7, "x"), (None, "x"), (8, "solo")]
    frame = spark.createDataFrame([(i, t, "t") for i, t in rows], "doc_id long, text string, text_sha256 string")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(frame).collect()}
    assert got == {1: (2, 3, False), 2: (2, 3, True), 3: (2, 3, False), 4: (6, 3, False), 5: (6, 3, False), 6: (6, 3, True),
                   7: (None, 2, False), None: (None, 2, True), 8: (8, 1, True)}
    kept = exact_dedup.deduplicate(frame.union(frame))
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] or 0 for r in kept.collect())) == [0, 2, 6, 8]
    assert exact_dedup.deduplicate(frame.limit(0)).count() == 0


def test_full_filter_changes_nothing(spark):
    documents = table(spark, SF, "documents")
    tight = exact_dedup.exact_groups(documents, filter_bits=1 << 15)
    assert sorted(map(tuple, tight.collect())) == sorted(map(tuple, exact_dedup.exact_groups(documents).collect()))
