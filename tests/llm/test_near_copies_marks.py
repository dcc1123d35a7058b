"""The pipeline's near-duplicate stage takes SimHash links as candidates."""

import random

import numpy as np

import corpus_pipeline
from radiolith.llm import near_copies


def test_stage_links_what_only_fingerprints_link(spark, monkeypatch):
    rng = random.Random(8)
    texts = []
    for _ in range(4):
        words = [f"w{rng.randrange(3000)}" for _ in range(3000)]
        texts += [" ".join(words), " ".join([*words[:-1], "last"])]
    own = lambda ids: np.full(near_copies.BANDS, int(ids.sum()), np.int64)
    monkeypatch.setattr(near_copies, "band_keys", own)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_stage(spark, rows, "").collect()) == [0, 2, 4, 6]
