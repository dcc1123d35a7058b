"""Near copies of the pipeline: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

0. Texts whose SimHash fingerprints are linked (``simhash.near_groups``) are candidates. These links miss most pairs at
   0.8, and join some far below it, so further candidates and an exact check follow.
1. A document gets ``BANDS`` keys of ``ROWS`` minima each. A pair at similarity s shares none with a chance of
   (1 - s ** ROWS) ** BANDS: 8 in a million at 0.8, less above. A pair is lost only if no fingerprint links it either.
2. Each document is linked to the smallest of every key it shares, and to the smallest of its SimHash component;
   components of these links are the candidates.
   No pairs are listed, so a key that many documents share costs one row for each.
3. Within a component, shingle sets are compared in full, and only pairs that reach the similarity become links.
   Components of more than ``BLOCK_ROWS`` texts or ``BLOCK_CHARS`` characters are cut into blocks, and every two blocks meet in a
   task of their own. Links span what is connected, they are not all pairs.
4. Components of these links are the groups; any two documents that stay are below the similarity.

Defined cases: words are separated by white space and only A-Z are lower-cased; fewer than five words make one shingle;
null, empty and white texts have one shingle that no other text has; equal texts are one node; of a group the row with
the smallest id stays, a null id only if there is no other, of one id the smallest text hash, and of rows equal in
both one; an empty table gives no rows. Shingles and texts are told by 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radiolith.llm.common import cut, keyed, stored, text_bytes, width
from radiolith.llm.components import components
from radiolith.llm.decontaminate import shingle_ids
from radiolith.llm.simhash import and_end, near_groups, only_rows, row_key

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 64, 8
BLOCK_ROWS, BLOCK_CHARS = 2048, 1 << 23
_CHUNK = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(20)
_TIMES = _RANDOM.integers(0, 1 << 31, BANDS * ROWS, np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, np.uint32)


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The identifiers of a text's shingles, each once."""
    words = text.lower().split()
    if not words:
        return np.zeros(1, np.int64)
    return np.unique(shingle_ids(words, min(shingle, len(words))))


def band_keys(ids: np.ndarray) -> np.ndarray:
    """The keys of a shingle set, one a band."""
    high = (ids.view(np.uint64) >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(high), _CHUNK):
        np.minimum(least, (high[at : at + _CHUNK, None] * _TIMES + _PLUS).min(0), out=least)
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        keys = (keys ^ rows[:, k]) * _MIX
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def spanning_links(sets: list[np.ndarray], similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """Links that join what is connected among the sets, each of a pair that reaches the similarity."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    holders = np.repeat(np.arange(n), sizes)[np.argsort(flat, kind="stable")]
    held = np.bincount(flat, minlength=len(values))
    first = np.concatenate(([0], np.cumsum(held)))
    unseen, left, links = np.ones(n, bool), n, []
    for seed in range(n):
        if not unseen[seed]:
            continue
        unseen[seed] = False
        left -= 1
        reached = [seed]
        while reached and left:
            i = reached.pop()
            own = flat[starts[i] : starts[i + 1]]
            own = own[held[own] > 1]
            counts = held[own]
            ends = np.cumsum(counts)
            at = np.repeat(first[own] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)
            both = np.bincount(holders[at], minlength=n)
            near = np.flatnonzero(unseen & (both / (sizes + sizes[i] - both) >= similarity)).tolist()
            unseen[near] = False
            left -= len(near)
            links += [(i, j) for j in near]
            reached += near
    return links


def candidates(texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``text_key, cluster`` of the texts that SimHash or a band's key links to another; near copies have one cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [band_keys(shingle_set(t, shingle)) for t in text_bytes(batch, "text")]
            flat = pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))
            offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * BANDS)
            yield pa.RecordBatch.from_arrays([batch.column("text_key"), pa.ListArray.from_arrays(offsets, flat)], names=["text_key", "bands"])

    marked = stored(texts.select("text_key", "text").mapInArrow(run, "text_key long, bands array<long>"), "bands")
    keys = marked.select("text_key", F.explode("bands").alias("band"))
    least = keys.groupBy("band").agg(F.min("text_key").alias("low"), F.max("text_key").alias("high")).where("low < high")
    banded = keys.join(least.select("band", "low"), "band").select(F.col("text_key").alias("a"), F.col("low").alias("b"))
    marks = near_groups(texts, "text_key", "text").select(F.col("text_key").alias("a"), F.col("component_id").alias("b"))
    roots = cut(components(marks.union(banded)))
    return roots.select(F.col("node").alias("text_key"), F.col("root").alias("cluster")).union(
        roots.select("root", "root").distinct()
    )


def verified_links(texts: DataFrame, clusters: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``a, b``: links between text keys of one cluster that span what reaches the similarity."""
    members = stored(texts.join(clusters, "text_key").dropDuplicates(["text_key"]).select("cluster", "text_key", "text"), "near")
    parts = F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum(F.length("text")) / BLOCK_CHARS)).cast("int")
    large = members.groupBy("cluster").agg(parts.alias("parts")).where("parts > 1")
    blocks = F.coalesce("parts", F.lit(1))
    split = (
        members.join(large, "cluster", "left")
        .withColumns({"parts": blocks, "own": F.pmod(F.xxhash64("text_key"), blocks).cast("int")})
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "text_key", "text")
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cluster and blocks; what a batch leaves open is carried to the next."""
        now, keys, sets = None, [], []
        for batch in and_end(batches):
            pairs = []
            rows = [(None, None, None, None, None)] if batch is None else zip(
                *(batch.column(c).to_pylist() for c in ("cluster", "i", "j", "text_key")), text_bytes(batch, "text"), strict=True
            )
            for *place, key, text in rows:
                if place != now:
                    if len(keys) > 1:
                        pairs += [(keys[a], keys[b]) for a, b in spanning_links(sets, similarity)]
                    now, keys, sets = place, [], []
                if batch is not None:
                    keys.append(key)
                    sets.append(shingle_set(text, shingle))
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs, strict=True)], names=["a", "b"])

    return (
        split.repartition(width(texts.sparkSession), "cluster", "i", "j")
        .sortWithinPartitions("cluster", "i", "j")
        .mapInArrow(solve, "a long, b long")
    )


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             similarity: float = SIMILARITY) -> DataFrame:
    """One row of each group of near copies, with all its columns."""
    if not SIMILARITY <= similarity <= 1:
        raise ValueError(f"the bands are made for a similarity of {SIMILARITY} to 1")
    texts = keyed(documents, id_col, text_col)
    roots = components(verified_links(texts, candidates(texts, shingle), shingle, similarity))
    rows = documents.select(row_key(id_col, text_col).alias("key")).withColumn("node", F.col("key.text_key"))
    group = F.coalesce("root", "node")
    firsts = rows.join(roots, "node", "left").groupBy(group).agg(F.min("key").alias("key")).select("key")
    return only_rows(documents, firsts, id_col, text_col)
