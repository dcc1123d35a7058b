"""The pipeline's near-duplicate stage against plain Jaccard similarity."""

import random

import pytest

import corpus_pipeline
from radiolith.llm import near_copies

SCHEMA = "doc_id long, text string, source string"


def similarity(a: str, b: str) -> float:
    sets = []
    for text in (a, b):
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def plain_kept(rows):
    kept, open_ids = [], sorted(i for i, _, _ in rows)
    texts = {i: t for i, t, _ in rows}
    while open_ids:
        group = [open_ids.pop(0)]
        kept.append(group[0])
        for i in group:
            near = [j for j in open_ids if similarity(texts[i], texts[j]) >= 0.8]
            group += near
            open_ids = [j for j in open_ids if j not in near]
    return kept


@pytest.fixture(scope="module")
def rows():
    """Of 40 texts: copies with some words changed, at similarities from 0.3 to 1."""
    rng, texts = random.Random(4), []
    for _ in range(40):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice((30, 90, 300)))]
        for changed in (0, 1, 2, 3, 5, 9):
            words = list(base)
            for at in rng.sample(range(len(words)), changed):
                words[at] = "new" + str(rng.random())
            texts.append(" ".join(words))
    rng.shuffle(texts)
    return [(i, t, "s") for i, t in enumerate(texts)]


@pytest.mark.parametrize("block_rows", [2048, 2])
def test_stage_keeps_no_near_copy_and_drops_no_other(spark, monkeypatch, rows, block_rows):
    monkeypatch.setattr(near_copies, "BLOCK_ROWS", block_rows)
    got = corpus_pipeline.near_stage(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert got.columns == ["doc_id", "text", "source"]
    assert sorted(r["doc_id"] for r in got.collect()) == plain_kept(rows)


def test_stage_edges(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, "a b", "s"), (3, "A  b", "t"), (3, "A  b", "t"), (None, "a b", "s"), (4, "a", "s"),
            (None, "x y", "s"), (None, "X y", "s")]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = [(r["doc_id"], (r["text"] or "").lower().split()) for r in near_copies.keep_one(frame).collect()]
    assert sorted(got, key=str) == sorted([(1, []), (3, ["a", "b"]), (4, ["a"]), (None, ["x", "y"])], key=str)
    assert near_copies.keep_one(frame.limit(0)).count() == 0
