"""Hard negatives against all scores of small tables; the walk against all scores of a block."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from radiolith.llm import negatives
from radiolith.llm.queries import REGISTRY


def plain(rows, anchor, k=5, least=80, most=100):
    """``rows``: id, label, whole vector; repeated rows once."""
    rows = sorted({(i, lab, tuple(v)) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    dot = lambda a, b: sum(int(x) * int(y) for x, y in zip(a, b, strict=False))
    out = []
    for a in rows:
        if not anchor(a[0]):
            continue
        others = sorted((-dot(a[2], r[2]), r[0], r[1]) for r in rows if r != a)
        for score, found, _ in [o for o in others if o[2] == a[1]][:k]:
            fits = [o for o in others if o[2] != a[1] and least * -score <= 100 * -o[0] <= most * -score][:k]
            out += [(a[0], found, n, o[1], -score, -o[0]) for n, o in enumerate(fits, 1)]
    return sorted(out)


def mined(frame, anchor, **more):
    return sorted(tuple(r) for r in negatives.mine(frame, anchor, **more).collect())


def made(seed, n, dims=6, spread=9):
    pick = random.Random(seed)
    return [(i, pick.randrange(3), [pick.randrange(-2, spread) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("block_rows", [40, 1 << 16])
def test_against_all_scores(spark, monkeypatch, block_rows):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block_rows)
    rows = made(1, 400) + [(1000 + i, i % 2, [3, 3, 3, 3, 3, 3]) for i in range(60)]  # many equal rows, anchors among them
    frame = spark.createDataFrame(rows, "id long, label int, vector array<int>").repartition(3)
    assert mined(frame, F.col("id") % 10 == 0) == plain(rows, lambda i: i % 10 == 0)


def test_defined_cases(spark):
    rows = [(0, 1, [1.0, 2.0]), (10, 1, [0.0, 0.0]), (20, 2, []), (30, 3, [5.0, 5.0]), (40, 1, [-3.0, -3.0]), (1, 1, [2.0]), (2, 2, [2.0, 2.0, 9.0]),
            (3, 2, [1.0, 1.0]), (4, 1, [1.0, 2.0]), (4, 1, [1.0, 2.0]), (4, 1, [2.0, 1.0]), (5, 2, [1.0, 2.0]), (6, 2, [0.0, 3.0])]
    rows += [(None, 1, [1.0, 1.0]), (7, None, [1.0, 1.0]), (8, 1, None), (9, 2, [1.0, None]), (11, 2, [float("nan"), 1.0]), (12, 2, [float("inf"), 1.0])]
    frame = spark.createDataFrame(rows, "id long, label int, vector array<double>")
    odd = frame.withColumns({"key": F.lit(1), "v": F.lit("x"), "ids": F.lit(2), "block": F.lit(3), "score": F.lit(4)})
    assert mined(odd, F.col("id") % 10 == 0) == plain(rows, lambda i: i % 10 == 0)
    assert mined(frame, F.col("id") % 10 == 0, least=50, most=200) == plain(rows, lambda i: i % 10 == 0, least=50, most=200)
    assert mined(frame.limit(0), F.col("id") % 10 == 0) == []
    assert mined(frame, F.lit(None).cast("boolean")) == []


def test_rounding_down_and_odd_components(spark):
    rows = [(1, [0.5, -0.001, 3.4e38]), (2, [None, 1.0, 1.0]), (3, [float("nan")] * 3), (4, [float("-inf")] * 3), (5, []), (6, None)]
    frame = spark.createDataFrame(rows, "id long, x array<float>")
    got = {r["id"]: r["w"] for r in frame.select("id", negatives.whole_components(F.col("x"), 256).alias("w")).collect()}
    assert got == {1: [128.0, -1.0, 256 * float(np.float32(3.4e38))], 2: None, 3: None, 4: None, 5: [], 6: None}


def test_large_components_are_exact():
    a = np.array([[2.0**52 + 1, 3.0], [1e30, -1e30]])
    got = negatives.scores(a, a)
    assert got[0, 0] == (2**52 + 1) ** 2 + 9 and got[1, 1] == 2 * int(1e30) ** 2 and got[0, 1] == int(1e30) * (2**52 + 1 - 3)


def test_the_walk_ends_early_and_loses_nothing():
    pick = np.random.default_rng(4)
    centers = pick.normal(size=(20, 16))
    rows = np.floor(256 * (centers[pick.integers(0, 20, 6000)] + 0.1 * pick.normal(size=(6000, 16))))
    labels = (np.arange(6000) % 7).tolist()
    block = negatives.Block([str(i) for i in range(6000)], labels, [[i] for i in range(6000)], list(rows))
    near = np.argsort(-(rows @ centers[0]))[:20]
    queries = [negatives.Query(str(i), labels[i], rows[i], 6, True) for i in near]
    low = [int(rows[i] @ rows[i]) for i in near]
    queries += [negatives.Query(str(i), labels[i], rows[i], 5, False, s, s * 8 // 10, s) for i, s in zip(near, low, strict=True)]
    taken = block.walk(queries)
    assert taken < 0.3 * len(queries) * 6000
    for q in queries:
        want = [(-int(s), j) for j, s in enumerate(rows @ q.vector) if (labels[j] == q.label) == q.own and (q.low is None or q.low <= s <= q.high)]
        assert [b[:2] for b in q.best] == sorted(want)[: q.k]


def test_query_covers_every_anchor(spark):
    rows = REGISTRY["op12_hard_negatives"](spark, "/root/testdata/sf0.001")
    assert rows.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert dict(rows.dtypes)["rank"] == "int" and rows.select("anchor_id").distinct().count() > 1
