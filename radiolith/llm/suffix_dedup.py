"""Repeated byte strings, by bucket pointers of sampled suffixes.

Suffixes start in buckets of equal q-grams. A bucket is refined twice by the bucket identifiers found at later offsets of
its suffixes: over a whole context, which settles all its windows and leaves one suffix to stand for it, and over single
windows. The method's further rounds, in which updated ranks serve the doubled offset, are not there: two q-grams cover a
window already. Only the suffixes sampled by ``anchors`` get a bucket in the first place, as a suffix array of every
byte would not fit the shuffle. Equality is that of identifiers.

Last refinement: a window of 400 bytes is covered by two q-grams, so its pointers at offset 0 and at the last
q-gram's offset tell it whole. Windows of the suffixes that are left are sorted by the two pointers, and equal
neighbours repeat. Sorted runs are streamed, so a string shared by a third of all rows needs no memory.

Defined cases: a null text is empty; a text shorter than a window stays whole; repeated rows repeat each other; ids
may be null or repeated, as rows are told apart by a number of their own; very long texts are worked through in
chunks; an empty table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radiolith.llm.anchors import Sampling, anchor_table, covered, settle, spans
from radiolith.llm.common import width

WINDOW, GRAM = 400, 300
_BYTES = np.random.Generator(np.random.PCG64(400)).integers(0, 1 << 64, 256, np.uint64)
_BATCH = 1 << 18


def byte_tokens(text: bytes) -> np.ndarray:
    return _BYTES[np.frombuffer(text, np.uint8)]


def _token_arrays(texts: pa.Array) -> Iterator[np.ndarray]:
    return (byte_tokens(t) for t in texts.cast(pa.binary()).to_pylist())


def _whole(text: bytes) -> tuple[int, str]:
    return len(text), hashlib.sha256(text).hexdigest()


def _equal_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From windows sorted by their two pointers: those that equal another."""
    names, held, paired = ("one", "two", "doc", "at"), None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if held is not None:
            columns = [np.concatenate(([h], c)) for h, c in zip(held, columns, strict=True)]
        same = (columns[0][1:] == columns[0][:-1]) & (columns[1][1:] == columns[1][:-1])
        hit = np.zeros(len(columns[0]), bool)
        hit[1:] |= same
        hit[:-1] |= same
        # The last row waits for the next batch; the first was waiting, and may have been paired before.
        hit[0] |= paired
        held, paired = [c[-1] for c in columns], bool(hit[-1])
        out = np.flatnonzero(hit[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(columns[k][out]) for k in (2, 3)], names=["doc", "first"])
    if held is not None and paired:
        yield pa.RecordBatch.from_arrays([pa.array([held[k]]) for k in (2, 3)], names=["doc", "first"])


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row: id, ``kept`` (the bytes that are left; null: the whole text), ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256``."""
    sampling = Sampling(window, gram)
    table = anchor_table(documents, id_col, text_col, _token_arrays, _whole, sampling)
    anchors = settle(table)
    asked = anchors.where("leads").groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    # The same columns for both joins below, so that the texts are shuffled once.
    texts = table.where("text is not null and doc is not null").select("doc", "id", "size", "text")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts):
            arrays = [pa.array(np.concatenate(p)) for p in zip(*parts, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["one", "two", "doc", "at"])

        for batch in batches:
            parts, held = [], 0
            for doc, text, runs in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                tokens = byte_tokens(text)
                for run in runs:
                    first, size = run["first"], run["last"] - run["first"] + 1
                    one, two = sampling.window_ids(tokens, first, run["last"])
                    parts.append((one, two, np.full(size, doc), np.arange(first, first + size, dtype=np.int32)))
                    held += size
                    if held > _BATCH:
                        yield flush(parts)
                        parts, held = [], 0
            if parts:
                yield flush(parts)

    equal = (
        texts.join(asked, "doc")
        .mapInArrow(windows, "one long, two long, doc long, at int")
        .repartition(width(documents.sparkSession), "one", "two")
        .sortWithinPartitions("one", "two")
        .mapInArrow(_equal_neighbours, "doc long, first int")
    )
    repeated = spans(anchors.where("settled").select("doc", "first", "last").union(equal.select("doc", "first", F.col("first").alias("last"))))
    kind = table.schema["id"].dataType.simpleString()
    whole = table.where("text is null").select(
        "id", F.lit(None).cast("binary").alias("kept"), F.col("size").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256"),
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, runs, shas = [], [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                gone = covered(len(text), found or [], window)
                rest = np.frombuffer(text, np.uint8)[~gone].tobytes()
                kept.append(rest)
                removed.append(len(text) - len(rest))
                runs.append(int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)))
                shas.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(kept, pa.binary()), batch.column("size"), pa.array(removed, pa.int64()),
                 pa.array(runs, pa.int64()), pa.array(shas, pa.string())],
                names=["id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    cut_texts = (
        texts.join(repeated, "doc", "left")
        .mapInArrow(remove, f"id {kind}, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )
    return whole.union(cut_texts).withColumnRenamed("id", id_col)
