"""Large CSV and JSON files, read by many tasks each.

Whether a line break ends a record, or a comma an element, depends on everything before it. So a file is cut into pieces
of equal size, and a task finds for its piece what it does to EACH state in which it may be entered: the states of an
automaton for quotes, and for JSON the change of bracket depth. These effects compose, so a running composition over the
pieces of a file (a few numbers each) gives the state at the start of every piece. Knowing that, a task cuts the records
that start in its piece, reading on behind its end until the last of them is whole. Records are parsed by Spark's own
parsers.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiolith.session import shared_dir
from radiolith.sources.sidecar import CORRUPT, with_corrupt
from radiolith.sources.stores import list_tree, locate

PIECE_BYTES = 8 << 20
_STEP, _BATCH_BYTES = 512, 4 << 20
_BOM = b"\xef\xbb\xbf"
#: Encodings in which every byte below 128 is the ASCII character.
_ENCODINGS = ("utf-8", "utf8", "ascii", "us-ascii", "latin-1", "latin1", "iso-8859-1", "iso-8859-15", "cp1252", "windows-1252")


class Automaton:
    """A table ``state, class -> state`` over bytes of few classes; class 0 is any other byte.

    Runs of class 0 count as one byte: doing it twice must be as doing it once.
    """

    def __init__(self, classes: dict[bytes, int], table: list[list[int]]):
        self.class_of = np.zeros(256, np.uint8)
        for text, kind in classes.items():
            self.class_of[list(text)] = kind
        # One class more, which changes nothing, to fill up rows.
        self.table = np.array([[*row, state] for state, row in enumerate(table)], np.uint8)
        self.states, self.idle = len(table), len(table[0])

    def marks(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places and classes of the bytes that count."""
        kinds = self.class_of[np.frombuffer(data, np.uint8)]
        counts = kinds != 0
        if len(kinds):
            counts[0] = True
            counts[1:] |= kinds[:-1] != 0
        places = np.flatnonzero(counts)
        return places, kinds[places]

    def _rows(self, kinds: np.ndarray) -> np.ndarray:
        step = max(1, min(_STEP, len(kinds)))
        rows = -(-len(kinds) // step)
        return np.concatenate([kinds, np.full(rows * step - len(kinds), self.idle, np.uint8)]).reshape(rows, step)

    def effect(self, kinds: np.ndarray) -> list[int]:
        """The state behind these bytes for every state before them."""
        now = list(range(self.states))
        for own in self._effects(self._rows(kinds)):
            now = [own[s] for s in now]
        return now

    def _effects(self, rows: np.ndarray) -> list[list[int]]:
        at = np.tile(np.arange(self.states, dtype=np.uint8), (len(rows), 1))
        for k in range(rows.shape[1] if len(rows) else 0):
            at = self.table[at, rows[:, k, None]]
        return at.tolist()

    def before(self, kinds: np.ndarray, state: int) -> np.ndarray:
        """The state before each byte, entered in ``state``."""
        rows, starts = self._rows(kinds), []
        for own in self._effects(rows):
            starts.append(state)
            state = own[state]
        at, out = np.array(starts, np.uint8), np.empty(rows.shape, np.uint8)
        for k in range(rows.shape[1] if len(rows) else 0):
            out[:, k] = at
            at = self.table[at, rows[:, k]]
        return out.ravel()[: len(kinds)]


# CSV: 0 a field may start, 1 in a plain field, 2 between quotes, 3 behind a quote that ends or doubles.
_QUOTED = 2


def csv_automaton(delimiter: str) -> Automaton:
    classes = {b'"': 1, delimiter.encode("ascii"): 2, b"\n": 3}
    return Automaton(classes, [[1, 2, 0, 0], [1, 1, 0, 0], [2, 3, 2, 2], [1, 2, 0, 0]])


# JSON: 0 outside strings, 1 in a string, 2 in a string behind a backslash.
_OPEN, _CLOSE, _COMMA = 3, 4, 5
JSON = Automaton({b'"': 1, b"\\": 2, b"[{": _OPEN, b"]}": _CLOSE, b",": _COMMA}, [[0, 1, 0, 0, 0, 0], [1, 0, 2, 1, 1, 1], [1, 1, 1, 1, 1, 1]])


def _depth_change(kinds: np.ndarray, before: np.ndarray) -> np.ndarray:
    free = before == 0
    return np.where(free & (kinds == _OPEN), 1, np.where(free & (kinds == _CLOSE), -1, 0))


@dataclass(frozen=True)
class Piece:
    """A piece of a file with what holds at its start."""

    path: str
    at: int
    length: int
    size: int
    state: int = 0
    depth: int = 0
    first: str | None = None


class CsvCutter:
    """Records of a CSV file: lines that end outside quotes."""

    def __init__(self, delimiter: str, header: list[str] | None, encoding: str):
        self.delimiter, self.header, self.encoding = delimiter, header, encoding

    def effect(self, data: bytes) -> tuple[list[int], list[int]]:
        automaton = csv_automaton(self.delimiter)
        return automaton.effect(automaton.marks(data)[1]), [0] * automaton.states

    def records(self, piece: Piece, read) -> Iterator[bytes]:
        automaton = csv_automaton(self.delimiter)
        begin = len(_BOM) if piece.at == 0 and read(0, 3) == _BOM else piece.at
        # The byte before tells whether a record starts with the piece.
        fresh = piece.at == 0 or (piece.state != _QUOTED and read(piece.at - 1, 1) == b"\n")
        at, state, kept, open_record = begin, piece.state, [], fresh
        end, first_record = piece.at + piece.length, piece.at == 0
        while at < piece.size:
            data = read(at, (end if at < end else at + piece.length) - at)
            if not data:
                break
            places, kinds = automaton.marks(data)
            before = automaton.before(kinds, state)
            ends = places[(kinds == 3) & (before != _QUOTED)]
            last = int(kinds[-1]), int(before[-1])
            state = int(automaton.table[last[1], last[0]])
            start, inside = 0, at < end
            for stop in ends.tolist():
                if open_record:
                    kept.append(data[start:stop])
                    record = b"".join(kept).removesuffix(b"\r")
                    kept = []
                    if first_record and self.header is not None:
                        self._check(record)
                    elif record:
                        yield record
                    first_record = False
                start = stop + 1
                # The record behind belongs to this piece if it starts in it.
                open_record = at + start < end
                if not inside:
                    return
            if not open_record and at + len(data) >= end:
                return
            if open_record:
                kept.append(data[start:])
            at += len(data)
        record = b"".join(kept).removesuffix(b"\r")
        if open_record and record:
            if first_record and self.header is not None:
                self._check(record)
            else:
                yield record

    def _check(self, record: bytes) -> None:
        names = next(csv.reader([record.decode(self.encoding)], delimiter=self.delimiter))
        if [n.strip().lower() for n in names] != [n.lower() for n in self.header]:
            raise ValueError(f"the header names {names}, the schema {self.header}")


class JsonCutter:
    """Elements of a JSON array, or the one document that a file holds."""

    def effect(self, data: bytes) -> tuple[list[int], list[int]]:
        _, kinds = JSON.marks(data)
        changes = [int(_depth_change(kinds, JSON.before(kinds, s)).sum()) for s in range(JSON.states)]
        return JSON.effect(kinds), changes

    def records(self, piece: Piece, read) -> Iterator[bytes]:
        if piece.first != "[":
            if piece.at == 0:
                whole = b"".join(read(at, piece.length) for at in range(0, piece.size, piece.length)).removeprefix(_BOM)
                if whole.strip():
                    yield whole
            return
        at, state, depth, end = piece.at, piece.state, piece.depth, piece.at + piece.length
        kept, open_element, opened_by = [], False, 0
        while at < piece.size:
            data = read(at, (end if at < end else at + piece.length) - at)
            if not data:
                break
            places, kinds = JSON.marks(data)
            before = JSON.before(kinds, state)
            changes = _depth_change(kinds, before)
            behind = depth + np.cumsum(changes)
            free = before == 0
            # An element starts behind the array's bracket or a comma in it, and ends at the next comma or its end.
            borders = free & (((kinds == _OPEN) & (behind == 1)) | ((kinds == _COMMA) & (behind == 1)) | ((kinds == _CLOSE) & (behind == 0)))
            start = 0
            for k in np.flatnonzero(borders).tolist():
                stop, kind = int(places[k]), int(kinds[k])
                if open_element:
                    kept.append(data[start:stop])
                    element = b"".join(kept).strip()
                    kept, open_element = [], False
                    if element or kind == _COMMA or opened_by == _COMMA:
                        yield element
                if kind == _CLOSE or at + stop >= end:
                    return
                open_element, opened_by, start = True, kind, stop + 1
            if not open_element and at + len(data) >= end:
                return
            if open_element:
                kept.append(data[start:])
            state, depth = int(JSON.table[before[-1], kinds[-1]]), int(behind[-1])
            at += len(data)
        if open_element:  # the array has no end
            yield b"".join(kept).strip()


def _reader(path: str, opened: dict):
    store, name = locate(path, opened)
    source = store.open_input_file(name)
    return source, lambda at, length: source.read_at(length, at)


def _pieces(files: DataFrame, piece_bytes: int) -> DataFrame:
    """``path, size, at`` of each piece, spread evenly."""
    spark = files.sparkSession
    cut = files.where("size > 0").select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(piece_bytes).cast("long"))).alias("at"))
    return cut.repartition(8 * spark.sparkContext.defaultParallelism, "path", "at")


_EFFECT = "path string, size long, at long, ends array<int>, changes array<long>, first string"
_START = "path string, size long, at long, state int, depth long, first string"


def _compose(pieces: pa.Table) -> pa.Table:
    """Effects of a file's pieces to the state at the start of each: a few numbers a piece."""
    pieces = pieces.sort_by("at")
    state, depth, first, states, depths, firsts = 0, 0, None, [], [], []
    for ends, changes, found in zip(*(pieces.column(c).to_pylist() for c in ("ends", "changes", "first")), strict=True):
        states.append(state)
        depths.append(depth)
        first = first or found
        firsts.append(first)
        state, depth = ends[state], depth + changes[state]
    plain = [pieces.column(c) for c in ("path", "size", "at")]
    return pa.table([*plain, pa.array(states, pa.int32()), pa.array(depths, pa.int64()), pa.array(firsts, pa.string())], names=["path", "size", "at", "state", "depth", "first"])


def cut_records(files: DataFrame, cutter: CsvCutter | JsonCutter, encoding: str = "utf-8", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``path, at, record``: the records that start in the piece at ``at`` of each file of a listing (path, size)."""
    spark = files.sparkSession
    if encoding.lower() not in _ENCODINGS:
        raise ValueError(f"{encoding}: only encodings that extend ASCII can be cut")
    spread = shared_dir(spark, "pieces")

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            out = []
            for path, at in zip(batch.column("path").to_pylist(), batch.column("at").to_pylist(), strict=True):
                source, read = _reader(path, opened)
                with source:
                    data = read(at, piece_bytes)
                if at == 0:
                    data = data.removeprefix(_BOM)
                ends, changes = cutter.effect(data)
                out.append((ends, changes, data.lstrip()[:1].decode("latin-1") or None))
            ends, changes, first = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("path", "size", "at")), pa.array(ends, pa.list_(pa.int32())), pa.array(changes, pa.list_(pa.int64())), pa.array(first, pa.string())],
                names=["path", "size", "at", "ends", "changes", "first"],
            )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                source, read = _reader(row["path"], opened)
                with source:
                    out, held = [], 0
                    for record in cutter.records(Piece(length=piece_bytes, **row), read):
                        out.append(record)
                        held += len(record) + 64
                        if held > _BATCH_BYTES:
                            yield _record_batch(row, out, encoding)
                            out, held = [], 0
                    if out:
                        yield _record_batch(row, out, encoding)

    _pieces(files, piece_bytes).mapInArrow(effects, _EFFECT).write.parquet(spread)
    starts = spark.read.schema(_EFFECT).parquet(spread).groupBy("path").applyInArrow(_compose, _START)
    return starts.repartition(8 * spark.sparkContext.defaultParallelism, "path", "at").mapInArrow(records, "path string, at long, record string")


def _record_batch(row: dict, records: list[bytes], encoding: str) -> pa.RecordBatch:
    n = len(records)
    texts = pa.array([r.decode(encoding, "replace") for r in records], pa.string())
    return pa.RecordBatch.from_arrays([pa.array([row["path"]] * n, pa.string()), pa.array([row["at"]] * n, pa.int64()), texts], names=["path", "at", "record"])


def _parsed(records: DataFrame, parsed: Column, schema: T.StructType) -> DataFrame:
    return records.select(parsed.alias("r")).select(*[F.col("r")[name].alias(name) for name in schema.names])


def read_large_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    delimiter: str = ",",
    encoding: str = "utf-8",
    mode: str = "PERMISSIVE",
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """CSV files with a header row whose quoted cells may hold line breaks; one file is read by many tasks.

    Quotes inside quotes are doubled. Equals ``read_csv`` with its ``multiLine`` reader and ``"`` as escape. A lone carriage
    return ends no record; blank lines are none.
    """
    if len(delimiter) != 1 or not delimiter.isascii():
        raise ValueError("the delimiter must be one ASCII character")
    whole = with_corrupt(schema)
    names = [name for name in schema.names if name != CORRUPT]
    options = {
        "sep": delimiter,
        "escape": '"',
        "mode": mode,
        "multiLine": "true",
        "columnNameOfCorruptRecord": CORRUPT,
        "maxCharsPerColumn": "-1",
    }
    records = cut_records(list_tree(spark, path).where(_visible()), CsvCutter(delimiter, names, encoding), encoding, piece_bytes)
    return _parsed(records, F.from_csv("record", whole.toDDL(), options), whole)


def read_large_json(
    spark: SparkSession, path: str, schema: T.StructType, mode: str = "PERMISSIVE", piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """JSON files (UTF-8) that hold one array, a row for each element, or one document; an array is read by many tasks.

    A malformed element is one row with its text in ``_corrupt_record``, and does not touch the others.
    """
    whole = with_corrupt(schema)
    records = cut_records(list_tree(spark, path).where(_visible()), JsonCutter(), piece_bytes=piece_bytes)
    options = {"mode": mode, "columnNameOfCorruptRecord": CORRUPT}
    return _parsed(records, F.from_json("record", whole.toDDL(), options), whole)


def _visible() -> Column:
    """Files that Spark's readers would read too."""
    return ~F.element_at(F.split("path", "/"), -1).rlike("^[._]")
