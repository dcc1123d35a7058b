"""Repeated word sequences, by suffix automata of reference shards.

``anchors`` splits what may repeat into shards: the contexts around equal q-grams of words, each distinct context
once. A shard's contexts are the reference of one suffix automaton, with the number of occurrences in every state.
The contexts are streamed through it: the matching statistic at each word is the longest suffix read so far
that the reference holds, and where it reaches the window's length, in a state with two occurrences or more, the window
repeats. Maximal spans of such windows are removed.

A shard meets only the spans that can match it, by a shuffle, as a broadcast of all automata would
grow with the corpus. A shard above ``SHARD_ROWS`` contexts is refined to shards of single windows: each is then
read against the automaton of its first row, one row at a time, so neither a common passage nor its
surroundings need memory.

Defined cases: a null or empty text has no words; a text of fewer words than a window stays whole; repeated rows repeat
each other; ids may be null or repeated; very long texts are worked through in chunks; an empty table gives no rows;
columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radiolith.llm.anchors import Sampling, anchor_table, covered, settle, spans
from radiolith.llm.common import width

WINDOW, GRAM = 35, 20
SHARD_ROWS = 1024
_BATCH = 4096
#: Texts whose words are told apart together.
_SHARE = 2048


class _Tokens(dict):
    """A word's 64-bit token; cleared when large, as it is only a cache."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_TOKENS = _Tokens()


def word_tokens(text: bytes) -> np.ndarray:
    return np.fromiter(map(_TOKENS.__getitem__, text.split()), np.uint64)


def _token_arrays(texts: pa.Array) -> Iterator[np.ndarray]:
    """Tokens of each text; words are cut and told apart by Arrow, so that only a share's distinct ones are hashed."""
    for start in range(0, len(texts), _SHARE):
        parts = pc.ascii_split_whitespace(texts.slice(start, _SHARE))
        coded = pc.dictionary_encode(parts.flatten())
        words = coded.dictionary.cast(pa.binary()).to_pylist()
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        places, ends = coded.indices.to_numpy(), parts.offsets.to_numpy()
        ends = ends - ends[0]
        if b"" in words:  # what stands before, behind and between white space
            full = places != words.index(b"")
            ends = np.concatenate([[0], np.cumsum(full)])[ends]
            places = places[full]
        yield from np.split(hashes[places], ends[1:-1])


def _whole(text: bytes) -> tuple[int, str]:
    words = text.split()
    return len(words), hashlib.sha256(b" ".join(words)).hexdigest()


class SuffixAutomaton:
    """Of several sequences; ``count`` says how often a state's strings occur in them."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]
        for sequence in sequences:
            last = 0
            for token in sequence:
                last = self._extend(last, token)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def _state(self, length: int, link: int, after: dict[int, int], count: int) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.count.append(count)
        return len(self.link) - 1

    def _split(self, p: int, token: int, q: int) -> int:
        """The part of ``q`` one longer than ``p``, as a state of its own."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]), 0)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, token: int) -> int:
        q = self.next[last].get(token)
        if q is not None:
            if self.length[q] != self.length[last] + 1:
                q = self._split(last, token, q)
            self.count[q] += 1
            return q
        new, p = self._state(self.length[last] + 1, 0, {}, 1), last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, token, q)
        return new

    def repeated(self, sequence: list[int], window: int, times: int) -> list[int]:
        """Starts of the windows of ``sequence`` that occur ``times`` or more."""
        state, matched, starts = 0, 0, []
        nexts, link, length = self.next, self.link, self.length
        for i, token in enumerate(sequence):
            while state and token not in nexts[state]:
                state = link[state]
                matched = length[state]
            if token in nexts[state]:
                state = nexts[state][token]
                matched += 1
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
                if self.count[state] >= times:
                    starts.append(i - window + 1)
        return starts


def _read_shards(window: int):
    """Rows sorted by shard to the repeated windows, ``doc, first``."""

    def rows(batches):
        for batch in batches:
            names = ("bucket", "part", "doc", "at", "tokens")
            yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)

    def hits(batches):
        for (_, part), shard in groupby(rows(batches), key=lambda r: r[:2]):
            if part:
                _, _, doc, at, tokens = next(shard)
                automaton, met = SuffixAutomaton([tokens]), False
                for _, _, other, place, sequence in shard:
                    if automaton.repeated(sequence, window, 1):
                        met = True
                        yield other, place
                if met:
                    yield doc, at
                continue
            members = list(shard)  # at most SHARD_ROWS
            if len(members) > 1:
                automaton = SuffixAutomaton([m[4] for m in members])
                for _, _, doc, at, tokens in members:
                    for start in automaton.repeated(tokens, window, 2):
                        yield doc, at + start

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, firsts = [], []
        for doc, first in hits(batches):
            docs.append(doc)
            firsts.append(first)
            if len(docs) >= 16 * _BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(firsts, pa.int32())], names=["doc", "first"])
                docs, firsts = [], []
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(firsts, pa.int32())], names=["doc", "first"])

    return run


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row: id, ``kept`` (the words that are left, joined by a space; null: all of them), ``n_words``, ``n_removed``,
    ``kept_sha256``."""
    sampling = Sampling(window, gram)
    table = anchor_table(documents, id_col, text_col, _token_arrays, _whole, sampling)
    anchors = settle(table)
    asked = anchors.where("leads").groupBy("doc").agg(F.collect_list(F.struct("bucket", "first", "last", "contexts")).alias("runs"))
    # The same columns for both joins below, so that the texts are shuffled once.
    texts = table.where("text is not null and doc is not null").select("doc", "id", "size", "text")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows):
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["bucket", "part", "doc", "at", "tokens"])

        rows = []
        for batch in batches:
            for doc, text, runs in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                tokens = word_tokens(text)
                for run in runs:
                    first, last = run["first"], run["last"]
                    if run["contexts"] <= SHARD_ROWS:
                        rows.append((run["bucket"], 0, doc, first, tokens[first : last + window].view(np.int64)))
                    else:
                        one, two = sampling.window_ids(tokens, first, last)
                        for k, part in enumerate((one ^ (two * 31) | 1).tolist()):
                            at = first + k
                            rows.append((run["bucket"], part, doc, at, tokens[at : at + window].view(np.int64)))
                    if len(rows) >= _BATCH:
                        yield flush(rows)
                        rows = []
        if rows:
            yield flush(rows)

    equal = (
        texts.join(asked, "doc")
        .mapInArrow(contexts, "bucket long, part long, doc long, at int, tokens array<long>")
        .repartition(width(documents.sparkSession), "bucket", "part")
        .sortWithinPartitions("bucket", "part")
        .mapInArrow(_read_shards(window), "doc long, first int")
    )
    repeated = spans(anchors.where("settled").select("doc", "first", "last").union(equal.select("doc", "first", F.col("first").alias("last"))))
    kind = table.schema["id"].dataType.simpleString()
    whole = table.where("text is null").select(
        "id", F.lit(None).cast("string").alias("kept"), F.col("size").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.col("sha").alias("kept_sha256"),
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, shas = [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                words = text.split()
                gone = covered(len(words), found or [], window)
                left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                rest = b" ".join(left)
                kept.append(rest)
                removed.append(len(words) - len(left))
                shas.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(kept, pa.binary()).cast(pa.string()), batch.column("size"), pa.array(removed, pa.int64()),
                 pa.array(shas, pa.string())],
                names=["id", "kept", "n_words", "n_removed", "kept_sha256"],
            )

    cut_texts = (
        texts.join(repeated, "doc", "left")
        .mapInArrow(remove, f"id {kind}, kept string, n_words long, n_removed long, kept_sha256 string")
    )
    return whole.union(cut_texts).withColumnRenamed("id", id_col)
