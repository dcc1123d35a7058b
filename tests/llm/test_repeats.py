"""Operators 2 and 5 against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import repeated_bytes, repeated_words

from radiolith.llm import substring_dedup, suffix_dedup
from radiolith.llm.anchors import grams
from radiolith.llm.common import table

SF = "/root/testdata/sf0.001"


def _bytes_result(frame):
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in frame.collect())


def _words_result(frame):
    return sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in frame.collect())


def _cases():
    rng = random.Random(5)
    base = " ".join(f"w{rng.randrange(4000)}" for _ in range(400))
    common = " ".join(f"c{rng.randrange(900)}" for _ in range(90))
    texts = [base, base, f"x {common} y", f"{common}", "z " * 300, "", None, " \n\t ", "ab" * 900, base[50:1500]]
    texts += [f"{i} pre{i} {common} post{i} {i}" for i in range(40)]
    texts += [base[:700] + f" edit{i} " + base[700:] for i in range(5)]
    return [(i, t, "extra") for i, t in enumerate(texts)]


def test_bytes_whole_table(spark):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in table(spark, SF, "documents").collect()]
    want = sorted((i, *w) for (i, _), w in zip(rows, repeated_bytes([t for _, t in rows], 400), strict=True))
    assert _bytes_result(suffix_dedup.remove_repeats(table(spark, SF, "documents"))) == want
    assert sum(w[2] for w in want) > 0


@pytest.mark.parametrize("window,gram", [(400, 300), (60, 30)])
def test_bytes_cases(spark, window, gram):
    cases = _cases()
    frame = spark.createDataFrame(cases, "doc_id long, text string, kept string").repartition(3)
    want = repeated_bytes([(t or "").encode() for _, t, _ in cases], window)
    got = _bytes_result(suffix_dedup.remove_repeats(frame, window=window, gram=gram))
    assert got == sorted((i, *w) for (i, _, _), w in zip(cases, want, strict=True))


@pytest.mark.parametrize("shard_rows", [1024, 4])
def test_words_cases(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(substring_dedup, "SHARD_ROWS", shard_rows)
    cases = _cases()
    frame = spark.createDataFrame(cases, "doc_id long, text string, kept string").repartition(3)
    want = repeated_words([(t or "").encode() for _, t, _ in cases], 35)
    got = _words_result(substring_dedup.remove_repeats(frame))
    assert got == sorted((i, *w) for (i, _, _), w in zip(cases, want, strict=True))


def test_repeated_rows_and_null_ids(spark):
    text = "one two three " * 200
    frame = spark.createDataFrame([(None, text), (None, text), (7, "short")], "doc_id long, text string")
    for operator, size in ((suffix_dedup, "n_bytes"), (substring_dedup, "n_words")):
        rows = operator.remove_repeats(frame).collect()
        assert sorted((r["doc_id"] is None, r[size] == r["n_removed"]) for r in rows) == [(False, False), (True, True), (True, True)]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(frame).count() == 0
    assert substring_dedup.remove_repeats(frame).count() == 0


def test_very_long_text(spark):
    rng = np.random.default_rng(1)
    part = rng.integers(97, 123, 1000, np.uint8).tobytes().decode()
    text = rng.integers(97, 123, 700_000, np.uint8).tobytes().decode()
    text = text[:300_000] + part + text[300_000:] + part
    row = suffix_dedup.remove_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["n_removed"], row["n_spans"]) == (2000, 2)


def test_automaton_counts():
    rng = random.Random(3)
    sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 30))] for _ in range(12)]
    automaton = substring_dedup.SuffixAutomaton(sequences)
    windows = [tuple(s[i : i + 4]) for s in sequences for i in range(len(s) - 3)]
    for s in sequences:
        want = [i for i in range(len(s) - 3) if windows.count(tuple(s[i : i + 4])) > 1]
        assert automaton.repeated(s, 4, 2) == want


def test_texts_in_a_doubling_pattern_are_told_apart(spark):
    """Modulo a power of two any polynomial takes these for equal."""
    blocks = ["".join("ab"[bin(i).count("1") % 2] for i in range(64)), "".join("cd"[bin(i).count("1") % 2] for i in range(64)), "".join("ef"[bin(i).count("1") % 2] for i in range(64))]
    swapped = [b.translate(str.maketrans("abcdef", "badcfe")) for b in blocks]
    front, behind = "".join(chr(97 + i % 23) for i in range(100)), "".join(chr(97 + i * 7 % 25) for i in range(108))
    texts = [front + "".join(b) + behind for b in (blocks, swapped)]
    assert [len(t) for t in texts] == [400, 400] and texts[0] != texts[1]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["n_removed"] for r in suffix_dedup.remove_repeats(frame).collect()] == [0, 0]
    one, two = (grams(suffix_dedup.byte_tokens(t.encode()), 300) for t in texts)
    assert not (one == two).any()


def test_identifiers_depend_on_the_tokens_alone():
    pick = np.random.default_rng(3)
    tokens = pick.integers(0, 1 << 64, 5000, np.uint64)
    whole = grams(tokens, 300)
    assert len(np.unique(whole)) == len(whole) == 4701
    for start in (1, 77, 4000):
        assert (grams(tokens[start:], 300) == whole[start:]).all()
    assert len(grams(tokens[:299], 300)) == 0


def test_words_of_a_column_are_those_of_each_text():
    texts = ["", " ", "a b", " a\tb\x0bc\x0c\r\n d ", "x\x1cy\xa0z \u2003 w", "é " * 50, "a", "  "] * 700
    column = pa.array(["skipped", *texts], pa.string()).slice(1)
    got = list(substring_dedup._token_arrays(column))
    assert [g.tolist() for g in got] == [substring_dedup.word_tokens(t.encode()).tolist() for t in texts]
    assert list(substring_dedup._token_arrays(column.slice(0, 0))) == []
