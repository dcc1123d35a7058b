"""Operators 4, 6, 8 and 9."""

import hashlib
import random

import numpy as np
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiolith.llm import chat, decontaminate, pieces, quality
from radiolith.llm.common import table

SF = "/root/testdata/sf0.001"


def test_escapes_are_reversible():
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice([*chat.CONTROLS, "\\", "<", "s>", "[", "INST]", "\n", "a", "\\n"]) for _ in range(rng.randrange(8)))
        for role in ("user", text):
            segment = chat.format_turn(role, text)[0]
            assert chat.read_turn(segment) == (role, text)
            inner = segment[len("<s>[INST] ") : -len(" [/INST]</s>")]
            assert not any(c in inner for c in chat.CONTROLS)


def test_typed_parts(spark):
    parts = [
        {"type": "text", "text": "see <image> "}, {"type": "image", "ref": "a.png", "tokens": 576}, {"type": "audio", "ref": "b.wav"},
        None, {"type": "document", "ref": "c.pdf", "tokens": 90}, {"type": "other", "text": "!"},
    ]
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.ArrayType(chat.PART))])
    frame = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, None, None), (1, 2, "user", [])], schema)
    first, second, third = chat.format_conversations(frame).orderBy("turn").collect()
    assert [a["ref"] for a in first["attachments"]] == ["a.png", "b.wav", "c.pdf"] and first["n_tokens"] == 667
    for a in first["attachments"]:
        assert first["segment"][a["at"] :].startswith(chat.PLACEHOLDERS[a["kind"]])
    assert chat.unescape(first["segment"][first["loss_start"] : first["loss_end"]]) == "see <image> <image><audio><document>!"
    assert chat.read_turn(second["segment"]) == ("", "") and second["loss_start"] == second["loss_end"] and third["n_tokens"] == 0


def test_conversation_edges(spark):
    rows = [(None, 1, "user", None), (None, 0, None, "x"), (5, 0, "user", "a"), (5, 0, "user", "a"), (5, None, "assistant", "b")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(frame)).collect()}
    assert got[None]["n_turns"] == 2 and got[5]["n_turns"] == 3 and got[5]["loss_chars"] == 1
    assert got[None]["turns_sha256"] == hashlib.sha256(b"\nx\nuser\n\n").hexdigest()
    assert got[5]["turns_sha256"] == hashlib.sha256(b"assistant\nb\nuser\na\nuser\na\n").hexdigest()
    assert chat.digests(chat.format_conversations(frame.limit(0))).count() == 0


def _encoded(texts):
    codec = pieces.Codec(open(pieces.MODEL_PATH, "rb").read())
    return codec, [np.frombuffer(b, np.int32) for b in codec.encode_batch(texts)]


def test_pieces_equal_the_library(spark):
    rng = random.Random(7)
    texts = ["", " ", "  a", "a\n\n b\t", "日本語 텍스트 ñ", "\0a\0", "🙂🙂 x", "a" * 60, "▁x▁ y", "<s> </s> <0x41>"]
    texts += ["".join(rng.choice("ab eitnsr\n.éß1") for _ in range(rng.randrange(60))) for _ in range(500)]
    texts += [r["text"] for r in table(spark, SF, "documents").limit(60).collect()]
    codec, got = _encoded(texts)
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    assert [g.tolist() for g in got] == library.encode(texts)
    assert [codec.decode(g) for g in got] == [t.replace("▁", " ").encode() for t in texts]


def test_pieces_over_tables(spark):
    frame = spark.createDataFrame([(1, "hello world", 0), (None, None, 0), (1, "hello world", 0)], "doc_id long, text string, pieces int")
    made = pieces.encode(frame)
    assert sorted((r["doc_id"] or 0, r["n_pieces"]) for r in made.collect()) == [(0, 0), (1, 3), (1, 3)]
    assert sorted(r["text"] for r in pieces.decode(made).collect()) == ["", "hello world", "hello world"]
    assert pieces.encode(frame.limit(0)).count() == 0
    assert pieces.round_trip(table(spark, SF, "documents")).where("not exact").count() == 0


def _windows(text, least=1):
    words = decontaminate.words_of(text.encode())
    size = min(10, len(words))
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)] if size else []


def test_contamination_cases(spark):
    rng = random.Random(8)
    long = " ".join(rng.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(30))
    items = [(1, long), (2, "one two"), (3, "lone"), (4, ""), (5, None), (6, "The; cat-sat!"), (10, long.upper()), (1, long), (None, "lone")]
    docs = [(1, f"x {long} y"), (2, " ".join(long.split()[3:14])), (3, "One, TWO three"), (4, "lone lone"), (5, None), (6, ""), (7, "the cat sat the cat"), (7, "the cat sat the cat"), (8, "clean text")]
    documents = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_hit", F.lit(-1))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for i, t in docs:
        words = decontaminate.words_of((t or "").encode())
        hit, names = set(), set()
        for item, text in items:
            for w in _windows(text or ""):
                for at in range(len(words) - len(w) + 1):
                    if tuple(words[at : at + len(w)]) == w and item is not None:
                        hit.update(range(at, at + len(w)))
                        names.add(str(item))
        want.append((i, len(words), len(hit), tuple(sorted(names))))
    got = [(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in decontaminate.contamination(documents, benchmark).collect()]
    assert sorted(got) == sorted(want)
    kept = decontaminate.drop_contaminated(documents, benchmark)
    assert kept.columns == documents.columns and sorted(r["doc_id"] for r in kept.collect()) == [5, 6, 8]
    assert decontaminate.contamination(documents, benchmark.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(documents.limit(0), benchmark).count() == 0


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.8, 0.85])
    votes = np.where(rng.random((20_000, 4)) < right, truth[:, None], ~truth[:, None]) * 2
    votes[rng.random(votes.shape) < 0.3] = quality.NONE
    seen, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_label_model(seen, counts.astype(float))
    assert np.abs(model.accuracies() - right).max() < 0.03 and abs(model.prior - 0.8) < 0.03


def test_quality_on_held_out_labels(spark):
    documents, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    classifier = quality.train(documents, labels.where(half == 0))
    judged = quality.classify(documents, classifier).join(labels.where(half == 1), "doc_id")
    rows = judged.select("keep", "quality", "toxic").collect()
    clean = [r["keep"] for r in rows if r["quality"] and not r["toxic"]]
    poor = [r["keep"] for r in rows if not r["quality"]]
    assert np.mean(clean) > 0.97 and np.mean(poor) < 0.1


def test_quality_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (None, "A plain sentence that is fine for all of us.", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None, None), (1, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, None, labels.limit(0)):
        classifier = quality.train(frame, given)
        assert {r["doc_id"]: r["keep"] for r in quality.classify(frame, classifier).collect() if r["doc_id"]} == {1: False, 2: False, 3: False}
        assert quality.keep_good(frame, classifier).columns == frame.columns
    assert quality.classify(frame.limit(0), quality.train(frame.limit(0), labels)).count() == 0


def test_pieces_of_long_and_odd_texts_are_the_librarys():
    plain = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    with open(pieces.MODEL_PATH, "rb") as file:
        codec = pieces.Codec(file.read())
    pick = random.Random(1)
    texts = ["", " ", "a\0b", "￿", "日本語🙂", "x" * 5000, "ab" * 3000, "\n\t\r", "▁▁ ▁a", "é" * 70 + "ñ", "word " * 60000, "z" * 257 + " " + "z" * 256]
    texts += ["".join(pick.choices("ab ▁\n\0é日x.,12", k=pick.randrange(400))) for _ in range(500)]
    for some in (texts, texts[::-1]):
        for text, made in zip(some, codec.encode_batch(some), strict=True):
            assert np.frombuffer(made, np.int32).tolist() == plain.encode(text), repr(text)[:60]


def test_a_passage_that_many_items_and_places_share(spark):
    """Two thousand items hold one passage, and one document repeats it two thousand times."""
    passage = " ".join(f"shared{i}" for i in range(14))
    items = spark.range(2000).select(F.concat(F.lit("i"), F.col("id").cast("string")).alias("item_id"), F.lit(passage).alias("text"))
    texts = [(1, f"{passage} stop " * 2000), (2, "clean words only " * 50), (3, passage.replace("shared13", "other")), (4, " ".join(passage.split()[:9]))]
    got = {r["doc_id"]: r for r in decontaminate.contamination(spark.createDataFrame(texts, "doc_id long, text string"), items).collect()}
    assert (got[1]["n_words"], got[1]["n_hit"], got[1]["n_items"]) == (30000, 28000, 2000)
    assert got[1]["items"] == sorted(f"i{k}" for k in range(2000))
    assert [got[i]["n_hit"] for i in (2, 3, 4)] == [0, 13, 0] and got[3]["n_items"] == 2000


def test_words_are_counted_once_where_stretches_meet(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "STARTS", 3)
    words = [f"w{i % 17}" for i in range(120)]
    items = spark.createDataFrame([("a", " ".join(words[5:40])), ("b", "w1 w2"), (None, "w3 w4")], "item_id string, text string")
    document = spark.createDataFrame([(1, " ".join(words) + " tail")], "doc_id long, text string")
    row = decontaminate.contamination(document, items).first()
    windows = {tuple(words[i : i + 10]) for i in range(5, 31)} | {("w1", "w2"), ("w3", "w4")}
    hit = set()
    for i in range(len(words)):
        for n in (2, 10):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
    assert (row["n_hit"], row["items"], row["n_items"]) == (len([h for h in hit if h < 120]), ["a", "b"], 3)
