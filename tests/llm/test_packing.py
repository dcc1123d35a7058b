"""Packing: ids against the tokenizer itself, places checked piece by piece, waste against best fit by size."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from radiolith.llm import packing
from radiolith.llm.queries import REGISTRY

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def ids_of(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids + [0]


def check_places(rows, capacity):
    """Sequences are gapless from 0 and not above the capacity; gives their number."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def best_fit_by_size(lengths, capacity):
    bins = packing.OpenBins(capacity, 1 << 30, 0)
    for n in sorted(lengths, reverse=True):
        bins.place(n)
    return bins.next_id


def test_query_against_the_tokenizer(spark, plain):
    rows = REGISTRY["op11_best_fit"](spark, SF).collect()
    documents = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = {}
    for doc, text in documents.items():
        ids = ids_of(plain, text)
        cuts = [0] if len(ids) <= 2048 else sorted({0, *range(len(ids) % 2048, len(ids), 2048)})
        for piece, at in enumerate(cuts):
            own = ids[at : cuts[piece + 1] if piece + 1 < len(cuts) else None]
            want[doc, piece] = (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert len(rows) == len(want)
    used = check_places(rows, 2048)
    assert used <= 1.01 * best_fit_by_size([w[1] for w in want.values()], 2048) + 1


ODD = [
    None, "", " ", "  ", "\n", " a", "a ", "a  b", "a \n b", "a\tb c", "it's we'll", "x" * 9000, "  a  b", "\x1c a \x85 b",
    "a\x1c!", "!\x1f ! \x1c?", "a\xa0 b", "a \u3000b c", "a\x0b b", "end. 'S it's, 12. x², y. Ⅷ. é, \u0301. a.\n\nb?! c?", ".", " .", "\t.\r\n!",
    "日本語 テキスト 🙂 🙂", "é " * 3000, "a " * 700000, "word\n" * 5000, "<|endoftext|> a<|endoftext|>b",
]


def test_words_by_themselves_have_the_ids_of_the_whole(plain, monkeypatch):
    with open(PATH, encoding="utf-8") as file:
        content = file.read()
    for stretch, remembered in ((1 << 20, 1 << 18), (7, 1)):
        monkeypatch.setattr(packing, "STRETCH", stretch)
        encoder = packing.WordEncoder(content, remembered=remembered)
        for text in ODD:
            if stretch > 7 or len(text or "") < 40000:
                assert np.frombuffer(encoder(text or ""), "<u4").tolist() == ids_of(plain, text)[:-1]
        assert len(encoder) <= remembered
    assert 50256 not in np.frombuffer(packing.WordEncoder(content, True)("<|endoftext|>"), "<u4").tolist()


def test_texts_together_have_the_ids_of_each(plain):
    pick = random.Random(7)
    texts = [*ODD, *("".join(pick.choices(["a", "Be", " ", " ", "\n", ".", "é", "'s", "1"], k=pick.randrange(12))) for _ in range(3000))]
    with open(PATH, encoding="utf-8") as file:
        encoder = packing.WordEncoder(file.read())
    for some in (texts, texts[:1], [None], [" "], texts[40:44]):
        sliced = pa.array(["x", *some, "y"], pa.string()).slice(1, len(some))
        ids, starts = packing.encode_texts(encoder, sliced)
        for i, text in enumerate(some):
            assert ids[starts[i] : starts[i + 1]].tolist() == ids_of(plain, text)[:-1], repr(text)[:100]
    ids, starts = packing.encode_texts(encoder, pa.array([], pa.string()))
    assert len(ids) == 0 and starts.tolist() == [0]


def test_defined_cases(spark, plain):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "again"), (3, "again")]
    documents = spark.createDataFrame(rows, "key long, body string").repartition(5).withColumns(
        {"piece": F.lit(1), "length": F.lit("x"), "ids": F.lit(2.0), "text": F.lit("no")}
    )
    packed = packing.pack_documents(documents, PATH, "key", "body", capacity=500, open_bins=3)
    assert packed.columns == ["key", "piece", "start", "length", "ids", "sequence_id", "offset"]
    got = packed.collect()
    assert check_places(got, 500) == packed.select("sequence_id").distinct().count()
    by = {}
    for r in sorted((r for r in got if r["key"] not in (None, 3)), key=lambda r: (r["key"], r["piece"])):
        assert r["start"] == len(by.setdefault(r["key"], [])) and len(r["ids"]) == 4 * r["length"]
        assert r["piece"] == 0 or r["length"] == 500
        by[r["key"]] += np.frombuffer(r["ids"], "<u4").tolist()
    assert by == {i: ids_of(plain, t) for i, t in enumerate(ODD) if i != 3}
    assert sum(r["key"] == 3 for r in got) == 3 and sum(r["key"] is None for r in got) == 1
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in got:
        assert whole[r["sequence_id"]]["ids"][4 * r["offset"] :][: len(r["ids"])] == r["ids"]
    assert sum(r["length"] for r in whole.values()) == sum(r["length"] for r in got)
    assert packing.pack_documents(documents.limit(0), PATH, "key", "body").count() == 0


def test_any_table_in_many_tasks_and_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 3)
    pieces = spark.range(0, 20000, 1, 20).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(97)) + 1).alias("size"), F.array(F.lit("x")).alias("more")
    )
    packed = packing.pack(pieces, "size", capacity=100, open_bins=100)
    rows = packed.withColumnRenamed("size", "length").collect()
    assert sorted(r["id"] for r in rows) == list(range(20000)) and rows[0]["more"] == ["x"]
    assert check_places(rows, 100) <= 1.03 * best_fit_by_size([r["length"] for r in rows], 100)
    with pytest.raises(ValueError):
        packing.pack(pieces.withColumnRenamed("id", "Offset"), "size")
    with pytest.raises(Exception, match="lengths must be"):
        packing.pack(pieces, "size", capacity=50).count()


def test_the_fullest_bin_closes_first_and_the_best_fit_is_taken():
    bins = packing.OpenBins(10, 2, 0)
    assert [bins.place(n) for n in (7, 4, 3, 5, 6, 1)] == [(0, 0), (1, 0), (0, 7), (1, 4), (2, 0), (1, 9)]
    assert bins.place(5) == (3, 0) and bins.place(6) == (4, 0) and sorted(bins.open_ids()) == [3, 4]
