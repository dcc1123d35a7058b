"""Packing of token sequences: bounded-space online best fit, the open bins in a bitset keyed by free space.

Every task tokenises its share of the documents and packs the pieces as they come, with at most ``open_bins``
open bins. Bit ``f`` of an integer is set while an open bin has ``f`` places free: the lowest bit at or above a
piece's length is its best fit, and the lowest bit of all is the fullest bin, which closes first when a new bin is
needed and none may be opened. Pieces come in windows of ``open_bins`` (more would close bins that the window's
short pieces could fill), the longest of a window first.

Nothing shuffles but the remains: at its end a task closes the fullest bins and hands the pieces of the ``CARRY``
emptiest on. The remains of ``FAN_IN`` tasks are packed again in one task, and so on until one task is left, so a
task never holds more than the open bins or the remains of ``FAN_IN`` tasks. Each level is written before the next
reads it, so that a lost executor repeats whole tasks of one level and never half a sequence.

Defined cases: a null text counts as empty; an empty text is one piece with the end token alone; a text of any
length is tokenised in stretches cut before a word, where ids can't differ from those of the whole; only
documents above the capacity are cut, their first piece is the short one; rows that repeat are packed each; a null
id stays null; an empty table gives no rows; columns of other names are not read by ``pack_documents`` and are
passed on by ``pack``, where a column named ``sequence_id`` or ``offset`` raises ``ValueError``, as does a length
that is null, negative or above the capacity.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructType
from tokenizers import Tokenizer

from radiolith.llm.common import stored

CAPACITY, END_ID = 2048, 0
OPEN_BINS, CARRY, FAN_IN = 1024, 64, 64
#: Texts are tokenised in stretches of about so many characters; so many words keep their ids in a task.
STRETCH, REMEMBERED = 1 << 20, 3 << 17
#: Bytes of text whose words are told apart together.
SHARE = 8 << 20
#: Sequence ids: level, task and number in the task.
_LEVEL, _TASK = 1 << 60, 1 << 36

#: A word with the white space before it. White space ends any token of the byte-level pattern, so none reaches over the
#: end of a word; in texts with rarer white space only the places between two plain words count.
_WORD = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
_RARE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BETWEEN = re.compile(r"(?<=\S)(?= \S)")
#: What the byte-level pre-tokenizer cuts a text into (fixed by the public tokenizer); ids belong to these parts.
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_MARKS = ".,;:!?%$&"
#: The character that stands for a byte in the vocabulary: printable ones for themselves, others from 256 on.
_PRINTED = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
_CHARS = [chr(b) if b in _PRINTED else chr(256 + sum(c not in _PRINTED for c in range(b))) for b in range(256)]


def _parts(word: str) -> list[str]:
    """The pre-tokenizer's parts of one word; the usual shapes are told without a pattern."""
    body = word[1:] if word[0] == " " else word
    if body.isalpha():
        return [word]
    stem = body.rstrip(_MARKS)
    if stem.isalpha():
        return [word[: len(word) - len(body) + len(stem)], body[len(stem) :]]
    return _PARTS.findall(word)


class WordEncoder(dict):
    """Ids of a text by a byte-level tokenizer, as little-endian unsigned 32-bit integers.

    The pre-tokenizer's parts don't depend on their neighbours, so ids of words and parts met lately are kept, in two
    generations, and only other parts go to the tokenizer's model. A text with a control string goes to the tokenizer as a
    whole, unless such strings count as text.
    """

    def __init__(self, tokenizer: str, as_text: bool = False, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        spec = json.loads(tokenizer)
        before = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or before.get("type") != "ByteLevel" or before["add_prefix_space"] or not before.get("use_regex", True):
            raise ValueError("the tokenizer must be byte-level, without normalizer and prefix space")
        self.tokenizer, self.remembered, self.older = Tokenizer.from_str(tokenizer), remembered, {}
        self.model = self.tokenizer.model
        self.control = [] if as_text else [t["content"] for t in spec["added_tokens"]]

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            parts = _parts(word)
            if len(parts) > 1:
                met = parts[0] in self
                ids = b"".join([self[part] for part in parts])
                if not met:  # a word met once with a mark is seldom met so again
                    return ids
            else:
                if word.isascii() and word.isprintable():
                    chars = word.replace(" ", _CHARS[32])
                else:
                    chars = "".join(map(_CHARS.__getitem__, word.encode()))
                ids = array("I", [token.id for token in self.model.tokenize(chars)]).tobytes()
        if len(self) >= self.remembered:
            self.older = self.copy()
            self.clear()
        self[word] = ids
        return ids

    def stretch(self, text: str) -> bytes:
        if any(control in text for control in self.control):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        words = _BETWEEN.split(text) if _RARE.search(text) else _WORD.findall(text)
        return b"".join(map(self.__getitem__, words)) if text else b""

    def __call__(self, text: str) -> bytes:
        if len(text) <= STRETCH:
            return self.stretch(text)
        out, start = [], 0
        while start < len(text):
            cut = _BETWEEN.search(text, start + STRETCH)
            end = cut.start() if cut else len(text)
            out.append(self.stretch(text[start:end]))
            start = end
        return b"".join(out)


#: What a text must not have to be cut at single spaces and line breaks: of a longer run of white space all but the last
#: character is one token. A zero byte marks the first word.
_IRREGULAR = "[ \\n]{3}|[ \\n]{2}$|[\\x00\\t\\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def encode_texts(encoder: WordEncoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one behind the other, and where each starts; null counts as empty.

    Words are cut and told apart by Arrow, so that only distinct ones are looked up; their ids are put in place at once.
    """
    texts = pc.fill_null(texts, "")
    odd = pc.or_(pc.match_substring_regex(texts, _IRREGULAR), pc.greater(pc.utf8_length(texts), STRETCH))
    for control in encoder.control:
        odd = pc.or_(odd, pc.match_substring(texts, control))
    plain = pc.replace_substring(pc.if_else(odd, "", texts), "\n", " \n")
    parts = pc.split_pattern(pc.binary_join_element_wise("\0", plain, ""), " ")
    coded = pc.dictionary_encode(parts.flatten())
    found = [encoder[w[1:]] if w[:1] == "\0" and len(w) > 1 else b"" if w == "\0" else encoder[w if w[:1] == "\n" else " " + w] for w in coded.dictionary.to_pylist()]
    lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
    flat, firsts = np.frombuffer(b"".join(found), "<u4"), np.cumsum(lengths) - lengths
    words = coded.indices.to_numpy()
    counts = lengths[words]
    ends = np.cumsum(counts)
    ids = flat[np.repeat(firsts[words] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]
    word_starts = parts.offsets.to_numpy()
    starts = np.concatenate([[0], ends])[word_starts - word_starts[0]]
    if not pc.any(odd).as_py():
        return ids, starts
    own = [ids[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
    for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
        own[i] = np.frombuffer(encoder(texts[i].as_py()), "<u4")
    return np.concatenate(own), np.concatenate([[0], np.cumsum([len(o) for o in own])])


#: A worker's encoder, kept from task to task.
_ENCODERS: dict[tuple[int, bool], WordEncoder] = {}


def _encoder(tokenizer: str, as_text: bool) -> WordEncoder:
    key = (hash(tokenizer), as_text)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(tokenizer, as_text)
    return _ENCODERS[key]


def _pieces(batches: Iterable[pa.RecordBatch], encoder: WordEncoder, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """Documents (id, text) to pieces, in batches of bounded size."""
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        for ids, texts in _shares(batch):
            rows = []
            tokens, starts = encode_texts(encoder, texts)
            for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
                own, n = tokens[a:b].tobytes() + end, b - a + 1
                if n <= capacity:
                    rows.append((i, 0, 0, n, own))
                    continue
                for piece, at in enumerate(range(-(-n % capacity), n, capacity)):
                    cut = own[4 * max(at, 0) : 4 * (at + capacity)]
                    rows.append((i, piece, max(at, 0), len(cut) // 4, cut))
            for at in range(0, len(rows), 2 * OPEN_BINS):
                yield _piece_batch(ids, rows[at : at + 2 * OPEN_BINS])


def _shares(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    """A batch in shares of about ``SHARE`` bytes of text, a longer text by itself."""
    ids, texts = batch.column(0), batch.column(1)
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + SHARE, "right")))
        yield ids.slice(start, stop - start), texts.slice(start, stop - start)
        start = stop


def _piece_batch(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    doc, piece, start, length, own = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
         pa.array(own, pa.binary())],
        names=["id", "piece", "start", "length", "ids"],
    )


class OpenBins:
    """At most ``limit`` open bins, found by free space."""

    def __init__(self, capacity: int, limit: int, first_id: int):
        self.capacity, self.limit, self.next_id = capacity, limit, first_id
        self.free: dict[int, list[int]] = {}
        self.mask = self.count = 0

    def _take(self, free: int) -> int:
        stack = self.free[free]
        bin_id = stack.pop()
        if not stack:
            self.mask ^= 1 << free
        self.count -= 1
        return bin_id

    def _put(self, bin_id: int, free: int) -> None:
        self.free.setdefault(free, []).append(bin_id)
        self.mask |= 1 << free
        self.count += 1

    def close_fullest(self) -> None:
        self._take((self.mask & -self.mask).bit_length() - 1)

    def place(self, length: int) -> tuple[int, int]:
        """The bin and offset of a piece; a bin without free space closes at once."""
        fits = self.mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_id = self._take(free)
        else:
            if self.count == self.limit:
                self.close_fullest()
            bin_id, free = self.next_id, self.capacity
            self.next_id += 1
        if free > length:
            self._put(bin_id, free - length)
        return bin_id, self.capacity - free

    def open_ids(self) -> list[int]:
        return [b for stack in self.free.values() for b in stack]


def _pack(batches: Iterable[pa.RecordBatch], length: str, capacity: int, open_bins: int, carry: int, first_id: int) -> Iterator[pa.RecordBatch]:
    """The batches' rows with ``sequence_id`` and ``offset``, in the order in which bins close; the rows of the
    ``carry`` emptiest bins come last, with nulls."""
    bins, waiting, held = OpenBins(capacity, open_bins, first_id), [], 0
    pending: pa.Table | None = None

    def window(rows: pa.Table) -> pa.Table:
        lengths = rows.column(length).to_numpy(zero_copy_only=False)
        if rows.column(length).null_count or (lengths < 0).any() or (lengths > capacity).any():
            raise ValueError(f"lengths must be from 0 to {capacity}")
        order = np.argsort(-lengths, kind="stable")
        at = [bins.place(n) for n in lengths[order].tolist()]
        places = np.empty((len(at), 2), np.int64)
        places[order] = at
        rows = rows.append_column("sequence_id", pa.array(places[:, 0])).append_column("offset", pa.array(places[:, 1]))
        return rows if pending is None else pa.concat_tables([pending, rows])

    def settle(rows: pa.Table, still: list[int]) -> tuple[pa.Table, pa.Table]:
        is_open = pc.is_in(rows.column("sequence_id"), pa.array(still, pa.int64()))
        return rows.filter(pc.invert(is_open)), rows.filter(is_open).combine_chunks()

    for batch in batches:
        waiting.append(pa.Table.from_batches([batch]))
        held += batch.num_rows
        if held < open_bins:
            continue
        rows = pa.concat_tables(waiting)
        for at in range(0, held - open_bins + 1, open_bins):
            closed, pending = settle(window(rows.slice(at, open_bins)), bins.open_ids())
            yield from closed.combine_chunks().to_batches()
        waiting = [rows.slice(held // open_bins * open_bins)]
        held %= open_bins
    rows = pa.concat_tables(waiting) if held else None
    rows = window(rows) if rows is not None else pending
    if rows is None or not rows.num_rows:
        return
    while bins.count > carry:
        bins.close_fullest()
    closed, left = settle(rows, bins.open_ids())
    yield from closed.combine_chunks().to_batches()
    if left.num_rows:
        nothing = pa.nulls(left.num_rows, pa.int64())
        yield from left.drop_columns(["sequence_id", "offset"]).append_column("sequence_id", nothing).append_column("offset", nothing).combine_chunks().to_batches()


def _levels(first: DataFrame, length: str, capacity: int, open_bins: int) -> DataFrame:
    """The first level's rows, those without a sequence packed again until none is left."""
    done, level, names = [], 0, [c for c in first.columns if c != "task"]
    written = stored(first, "packed-0")
    tasks = 1 + (written.agg(F.max("task").alias("n")).first()["n"] or 0)
    while True:
        done.append(written.where("sequence_id is not null").select(*[F.col(f"`{c}`") for c in names]))
        level, tasks, last = level + 1, -(-tasks // FAN_IN), tasks <= FAN_IN
        left = written.where("sequence_id is null").withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int"))
        left = left.drop("sequence_id", "offset").repartition(tasks, "task")
        again = left.mapInArrow(_packer(length, capacity, open_bins, 0 if last else CARRY, level), first.schema)
        written = stored(again, f"packed-{level}")
        if last:
            return _union([*done, written.select(*[F.col(f"`{c}`") for c in names])])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def _packer(length: str, capacity: int, open_bins: int, carry: int, level: int, before=None):
    """A task of one level; ``before`` turns the task's input into pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        rows = before(batches) if before else (b.drop_columns(["task"]) for b in batches)
        for batch in _pack(rows, length, capacity, open_bins, carry, level * _LEVEL + task * _TASK):
            yield batch.append_column("task", pa.array(np.full(batch.num_rows, task, np.int32)))

    return run


def _schema(pieces: StructType) -> StructType:
    out = StructType(list(pieces.fields))
    return out.add("sequence_id", LongType()).add("offset", LongType()).add("task", IntegerType())


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Any table of pieces with ``sequence_id`` and ``offset`` of each."""
    if {"sequence_id", "offset", "task"} & {c.lower() for c in pieces.columns}:
        raise ValueError("sequence_id, offset and task must be free column names")
    run = _packer(length, capacity, open_bins, CARRY, 0, before=lambda batches: batches)
    return _levels(pieces.mapInArrow(run, _schema(pieces.schema)), length, capacity, open_bins)


def pack_documents(documents: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   open_bins: int = OPEN_BINS, end_id: int = END_ID, as_text: bool = False) -> DataFrame:
    """Per piece: id, ``piece, start, length, ids`` (little-endian unsigned 32-bit), ``sequence_id, offset``.

    ``tokenizer`` is the path of a byte-level tokenizer file; the driver reads it and sends it on.
    """
    with open(tokenizer, encoding="utf-8") as file:
        sent = documents.sparkSession.sparkContext.broadcast(file.read())
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    pieces = StructType([rows.schema["id"]]).add("piece", IntegerType()).add("start", LongType()).add("length", LongType()).add("ids", BinaryType())

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pieces(batches, _encoder(sent.value, as_text), capacity, end_id)

    run = _packer("length", capacity, open_bins, CARRY, 0, before=tokenised)
    return _levels(rows.mapInArrow(run, _schema(pieces)), "length", capacity, open_bins).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, length, ids``; a sequence has at most ``capacity`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda all_ids, part: F.concat(all_ids, part["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
