"""Sampled q-gram buckets: where sequences of a given length may repeat, over tokens of any kind.

Texts are sequences of 64-bit tokens. Every window of ``window`` tokens owns one anchor: the first of its q-grams
with the least identifier. Equal windows own equal anchors at equal offsets, and neighbouring windows mostly own
the same one, so about ``2 / (window - gram + 2)`` of the positions are anchors. An anchor's *bucket* is its
q-gram; its *context* spans all windows that own it.

1. Anchors are counted by bucket; buckets of one anchor hold no repeat. The others go into a filter of fixed size
   (``FILTER_BITS``), which is all that is broadcast. False positives cost work and change nothing.
2. A second pass writes a table of all texts: finished where no anchor is in the filter, else with its anchors.
3. Anchors are counted by bucket and context. Equal contexts settle each other: all their windows repeat. Of each
   context one anchor goes on where its bucket has several contexts, for the operator to compare window by window.

Identifiers are two polynomials over random tokens modulo the prime 2**31 - 1, with a base and coefficients of their own:
62 bits together. Modulo a power of two, texts in a doubling pattern would agree for any base. A window is told by two
identifiers and a context by its bucket and a chain of them, so two different windows or contexts count as equal with a
chance of about 2**-120.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radiolith.llm.common import keyed, stored, text_bytes

FILTER_BITS = 1 << 26
_CHUNK = 1 << 18
_PRIME = np.uint64((1 << 31) - 1)
#: Two bases of the polynomials; a token's low and high bits are the coefficients of one each.
_BASES = (1_103_515_245, 1_812_433_253)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_FOLD = np.uint64(0x94D049BB133111EB)
_POSITION = np.uint64((1 << 20) - 1)
_POWERS: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse modulo the prime."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS[size] = [tuple(_row_of_powers(b, size) for b in (base, pow(base, -1, int(_PRIME)))) for base in _BASES]
    return _POWERS[size]


def _row_of_powers(base: int, size: int) -> np.ndarray:
    out = np.ones(size, np.uint64)
    done, power = 1, base
    while done < size:  # doubled: the next half is this one times base ** done
        out[done : 2 * done] = _modulo(out[:done] * np.uint64(power))
        done, power = 2 * done, power * power % int(_PRIME)
    return out


def _fold(x: np.ndarray) -> np.ndarray:
    """A smaller number of the same residue modulo 2**31 - 1: the bits above are added to those below."""
    return (x & _PRIME) + (x >> np.uint64(31))


def _modulo(x: np.ndarray) -> np.ndarray:
    """Residues modulo 2**31 - 1 of numbers below 2**63."""
    x = _fold(_fold(x))
    return np.where(x >= _PRIME, x - _PRIME, x)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(29))


def grams(tokens: np.ndarray, gram: int) -> np.ndarray:
    """An identifier of the ``gram`` tokens from each position on."""
    n = len(tokens)
    if n < gram:
        return np.zeros(0, np.uint64)
    halves = []
    for half, (up, down) in zip((tokens & _PRIME, tokens >> np.uint64(33)), _powers(n), strict=True):
        sums = np.zeros(n + 1, np.uint64)
        # Products stay below 2**63: 2**18 terms below 2**32 each, a difference of them folded below 2**32.
        np.cumsum(_fold(half * up[:n]), out=sums[1:])
        halves.append(_modulo(_fold(sums[gram:] - sums[: n - gram + 1]) * down[: n - gram + 1]))
    return _mixed(halves[0] << np.uint64(31) | halves[1])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    rows = -(-n // width)
    block = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    block[:n] = values
    block = block.reshape(rows, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


@dataclass(frozen=True)
class Sampling:
    """Windows of ``window`` tokens, told by q-grams of ``gram``; a window must be covered by two of them."""

    window: int
    gram: int

    def __post_init__(self):
        if not self.window // 2 <= self.gram < self.window:
            raise ValueError("gram must be at least half of window and below it")

    @property
    def reach(self) -> int:
        return self.window - self.gram + 1

    def anchors(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each run of windows with one anchor: bucket, context, first and last window."""
        count = len(tokens) - self.window + 1
        parts = []
        for start in range(0, max(count, 0), _CHUNK):
            ids = grams(tokens[start : start + _CHUNK + self.window - 1], self.gram)
            place = np.arange(len(ids), dtype=np.uint64)
            least = _sliding_least((ids & ~_POSITION) | place, self.reach)
            owner = (least & _POSITION).astype(np.int64)
            first = np.concatenate(([0], np.flatnonzero(owner[1:] != owner[:-1]) + 1))
            last = np.concatenate((first[1:] - 1, [len(owner) - 1]))
            at = owner[first]
            end = last + self.window - self.gram
            context = (last - first).astype(np.uint64) * _FOLD + (at - first).astype(np.uint64)
            for k in range(-(-(self.window + self.reach - 1) // self.gram)):
                context = _mixed(context * _FOLD + ids[np.minimum(first + k * self.gram, end)])
            context = _mixed(context * _FOLD + ids[end])
            parts.append((ids[at], context, first + start, last + start))
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def window_ids(self, tokens: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Two identifiers of each window from ``first`` to ``last``: its first q-gram and its last one."""
        ids = grams(tokens[first : last + self.window], self.gram)
        size = last - first + 1
        return ids[:size].view(np.int64), ids[self.reach - 1 : self.reach - 1 + size].view(np.int64)


def _repeated_filter(documents: DataFrame, tokens_of: Callable[[pa.Array], Iterator[np.ndarray]], sampling: Sampling) -> np.ndarray:
    """A filter, as bytes, of the buckets with two or more anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sampling.anchors(tokens)[0] for tokens in tokens_of(batch.column("text"))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["bucket"])

    buckets = documents.select("text").mapInArrow(run, "bucket long")
    cell = F.pmod("bucket", F.lit(FILTER_BITS)) + 1
    bits = (
        buckets.groupBy("bucket").count().where("count > 1")
        .groupBy(F.bitmap_bucket_number(cell).alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("bits"))
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in bits.collect():  # at most FILTER_BITS / 8 bytes
        at = (row["part"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


def anchor_table(documents: DataFrame, id_col: str, text_col: str, tokens_of: Callable[[pa.Array], Iterator[np.ndarray]],
                 whole: Callable[[bytes], tuple[int, str]], sampling: Sampling) -> DataFrame:
    """Written to the shared folder, a row per document (``tokens_of`` makes tokens of each text of a column): ``doc`` (a number of its own), ``id``, ``size`` and ``sha``
    (what ``whole`` says of the text), and for texts that may hold repeats ``text`` and ``anchors``."""
    spark = documents.sparkSession
    rows = keyed(documents, id_col, text_col)
    sent = spark.sparkContext.broadcast(_repeated_filter(rows, tokens_of, sampling))
    kind = rows.schema["id"].dataType.simpleString()
    shape = pa.struct([("bucket", pa.int64()), ("context", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            sizes, shas, texts, lengths, parts = [], [], [], [], []
            for text, tokens in zip(text_bytes(batch, "text"), tokens_of(batch.column("text")), strict=True):
                bucket, context, first, last = sampling.anchors(tokens)
                cell = bucket.view(np.int64) % FILTER_BITS
                hit = np.flatnonzero(bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1)
                size, sha = whole(text)
                sizes.append(size)
                shas.append(sha)
                texts.append(text if len(hit) else None)
                lengths.append(len(hit))
                parts.append((bucket[hit].view(np.int64), context[hit].view(np.int64), first[hit], last[hit]))
            if not sizes:
                continue
            flat = [np.concatenate(p) for p in zip(*parts, strict=True)]
            values = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(flat, shape, strict=True)], fields=list(shape))
            offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(shas, pa.string()),
                    pa.array(texts, pa.binary()),
                    pa.ListArray.from_arrays(offsets, values),
                ],
                names=["id", "size", "sha", "text", "anchors"],
            )

    made = rows.mapInArrow(
        run,
        f"id {kind}, size long, sha string, text binary, "
        "anchors array<struct<bucket: long, context: long, first: int, last: int>>",
    )
    return stored(made.withColumn("doc", F.monotonically_increasing_id()), "anchors")


def settle(table: DataFrame) -> DataFrame:
    """The anchors that matter: ``doc, bucket, first, last``, ``settled`` (all its windows repeat), ``leads`` (it stands
    for its context where the bucket has several) and ``contexts``, the number of those."""
    anchors = table.where("text is not null").select("doc", F.explode("anchors").alias("a")).select("doc", "a.*")
    place = F.xxhash64("doc", "first")
    classes = anchors.groupBy("bucket", "context").agg(F.count("*").alias("copies"), F.min(place).alias("lead"))
    buckets = classes.groupBy("bucket").agg(F.count("*").alias("contexts"))
    known = classes.join(buckets, "bucket").where("copies > 1 or contexts > 1")
    found = (
        anchors.join(known, ["bucket", "context"])
        .select("doc", "bucket", "first", "last", (F.col("copies") > 1).alias("settled"),
                ((place == F.col("lead")) & (F.col("contexts") > 1)).alias("leads"), "contexts")
        .where("settled or leads")
    )
    return stored(found, "settled")


def spans(frame: DataFrame) -> DataFrame:
    """``doc, spans``: the runs of repeated windows of each document, from rows ``doc, first, last``."""
    return frame.groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def covered(size: int, found: list[dict], window: int) -> np.ndarray:
    """Which tokens a repeated window covers."""
    step = np.zeros(size + 1, np.int32)
    if found:
        np.add.at(step, [s["first"] for s in found], 1)
        np.add.at(step, [s["last"] + window for s in found], -1)
    return np.cumsum(step[:-1]) > 0
