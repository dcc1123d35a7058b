"""The registered queries against their SQL, and the pipeline against plain stages."""

import pytest
from brute import near_groups
from compare import differences, oracle_connection

import corpus_pipeline
from radiolith.llm import decontaminate, quality
from radiolith.llm.common import table
from radiolith.llm.oracle import ORACLE
from radiolith.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    assert differences(REGISTRY[name](spark, SF), ORACLE[name], oracle_connection(SF)) == []


def test_all_thirteen_are_registered():
    assert [int(n.split("_")[0][2:]) for n in REGISTRY] == list(range(1, 14))


def test_pipeline_against_plain_stages(spark):
    documents = table(spark, SF, "documents")
    classifier = quality.train(documents, table(spark, SF, "labels"))
    rows = [(r["doc_id"], r["text"] or "") for r in documents.collect()]
    rows = [(i, t) for i, t in rows if classifier.score(t.encode()) >= 0.5]
    best = {}
    for i, t in rows:
        key = "".join(t.split())
        best[key] = min(best.get(key, (1, 0, "")), (-len(t), i, t))
    rows = sorted((i, t) for _, i, t in best.values())
    group = near_groups(rows)
    rows = [(i, t) for i, t in rows if group[i] == i]
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        words = decontaminate.words_of(r["text"].encode())
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))}
    clean = []
    for i, t in rows:
        words = decontaminate.words_of(t.encode())
        if not any(tuple(words[k : k + 10]) in windows for k in range(len(words))):
            clean.append(i)
    got = corpus_pipeline.run(spark, SF)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(clean)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "simhash", "decontaminate", "pieces"]
