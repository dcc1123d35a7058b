"""Files cut into pieces against the whole-file readers."""

import json
import random

import pytest
from pyspark.sql import types as T

from radiolith.sources import sidecar, splitting

ROW = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "b", "c")])


def cut(cutter, data, size):
    """All records of a file, piece by piece, from composed effects alone."""
    state, depth, first, out = 0, 0, None, []
    read = lambda at, length: data[at : at + length]
    for at in range(0, len(data), size):
        piece = data[at : at + size]
        first = first or piece.removeprefix(b"\xef\xbb\xbf").lstrip()[:1].decode("latin-1") or None
        out += list(cutter.records(splitting.Piece("", at, size, len(data), state, depth, data.removeprefix(b"\xef\xbb\xbf").lstrip()[:1].decode()), read))
        ends, changes = cutter.effect(piece.removeprefix(b"\xef\xbb\xbf") if at == 0 else piece)
        state, depth = ends[state], depth + changes[state]
    return out


def made_csv(pick, rows):
    def cell():
        kind = pick.randrange(6)
        text = "".join(pick.choices('xyé", \n;', k=pick.randrange(12)))
        if kind < 3:
            return '"' + text.replace('"', '""') + '"'
        if kind == 3:
            return "in\"side"  # a quote within a plain cell is only a character
        return "".join(c for c in text if c not in '",\n') or "z"

    return "".join(f"{i},{cell()},{cell()}\n" for i in range(rows))


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 100000])
def test_csv_pieces_give_the_records_of_the_whole(size):
    pick = random.Random(size)
    for ending in ("", "\n", "\n\n"):
        text = "a,b,c\n" + made_csv(pick, 25).rstrip("\n") + ending
        for data in (text.encode(), b"\xef\xbb\xbf" + text.encode(), text.replace("\n", "\r\n").encode()):
            whole = cut(splitting.CsvCutter(",", ["a", "b", "c"], "utf-8"), data, 1 << 20)
            assert len(whole) == 25 and [r.split(b",")[0] for r in whole] == [str(i).encode() for i in range(25)]
            assert cut(splitting.CsvCutter(",", ["a", "b", "c"], "utf-8"), data, size) == whole


@pytest.mark.parametrize("size", [1, 2, 5, 33, 100000])
def test_json_pieces_give_the_elements_of_the_whole(size):
    pick = random.Random(size)
    values = [{"a": "".join(pick.choices('x[]{},"\\é\n', k=8)), "b": [1, [2, {"c": "]"}]], "n": i} for i in range(12)] + [1, "s,", [3, 4], None, {}]
    for indent in (None, 1):
        for found in (values, [], [7]):
            data = json.dumps(found, indent=indent, ensure_ascii=False).encode()
            for text in (data, b" \n" + data + b"\n "):
                got = cut(splitting.JsonCutter(), text, size)
                assert [json.loads(r) for r in got] == found
    assert cut(splitting.JsonCutter(), b' {"a": [1, 2]} ', size) == [b' {"a": [1, 2]} ']
    assert cut(splitting.JsonCutter(), b"", size) == []


def test_one_csv_file_read_by_many_tasks(spark, tmp_path):
    pick = random.Random(5)
    text = "a;b;c\n" + "".join(
        f'{i};"{"".join(pick.choices("xyé;  " + chr(10), k=pick.randrange(60)))} ""q"" {i}";{"" if i % 3 else chr(34) * 2}\n' for i in range(3000)
    )
    (tmp_path / "one.csv").write_text(text, encoding="utf-8")
    got = splitting.read_large_csv(spark, str(tmp_path / "one.csv"), ROW, ";", piece_bytes=5000)
    whole = (
        spark.read.schema(sidecar.with_corrupt(ROW)).option("header", "true").option("sep", ";").option("multiLine", "true").option("escape", '"')
        .option("columnNameOfCorruptRecord", "_corrupt_record").csv(str(tmp_path / "one.csv"))
    )
    assert got.columns == whole.columns and whole.count() == 3000
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    records = splitting.cut_records(splitting.list_tree(spark, str(tmp_path)), splitting.CsvCutter(";", None, "utf-8"), piece_bytes=5000)
    assert records.select("at").distinct().count() > 10 and records.count() == 3001


def test_csv_header_encoding_and_bad_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("a,b,c\nÄ,\"1\n2\",z\n1,2\n\n1,2,3,4\n".encode("latin-1"))
    rows = splitting.read_large_csv(spark, str(tmp_path / "x.csv"), ROW, encoding="latin-1", piece_bytes=4).collect()
    assert sorted((r["a"], r["b"], r["c"]) for r in rows if r["_corrupt_record"] is None) == [("Ä", "1\n2", "z")]
    assert sorted(r["_corrupt_record"] for r in rows if r["_corrupt_record"]) == ["1,2", "1,2,3,4"]
    (tmp_path / "y.csv").write_text("b,a,c\n1,2,3\n")
    with pytest.raises(Exception, match="the header names"):
        splitting.read_large_csv(spark, str(tmp_path / "y.csv"), ROW).collect()
    with pytest.raises(ValueError):
        splitting.read_large_csv(spark, str(tmp_path), ROW, encoding="utf-16")
    with pytest.raises(ValueError):
        splitting.read_large_csv(spark, str(tmp_path), ROW, delimiter="||")


def test_one_json_array_read_by_many_tasks(spark, tmp_path):
    pick = random.Random(6)
    values = [{"a": "".join(pick.choices('x[]{},"\\é\n', k=20)), "b": str(i), "more": {"c": [1, 2]}} for i in range(2000)]
    (tmp_path / "one.json").write_text(json.dumps(values, ensure_ascii=False, indent=1), encoding="utf-8")
    (tmp_path / "two.json").write_text('{"a": "single"}')
    (tmp_path / "_hidden.json").write_text("nothing")
    (tmp_path / "empty.json").write_text("")
    got = splitting.read_large_json(spark, str(tmp_path), ROW, piece_bytes=3000)
    whole = sidecar.read_json(spark, str(tmp_path / "*.json"), ROW)
    assert got.count() == 2001 and sorted(map(str, got.collect())) == sorted(map(str, whole.where("a is not null or b is not null").collect()))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "b.json").write_text('[{"a": "1"}, {"a": }, {"a": "3"}]')
    rows = splitting.read_large_json(spark, str(tmp_path / "bad"), ROW, piece_bytes=7).collect()
    assert sorted(r["a"] for r in rows if r["a"]) == ["1", "3"] and [r["_corrupt_record"] for r in rows if r["_corrupt_record"]] == ['{"a": }']
