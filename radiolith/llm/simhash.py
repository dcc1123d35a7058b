"""Near-duplicates by SimHash, linked in the space of segment bit counts.

A fingerprint maps to the bit counts of its 32 two-bit segments. The Manhattan distance of two such
vectors is never above the Hamming distance of the fingerprints, so pairs within 4 bits lie within 4 there.
A count of 0, 1 or 2 is written as 00, 01 or 11; the vector is then one 64-bit word, and Manhattan
distance is the bit count of an exclusive or.

Grid join: the segments form 8 groups. With a distance of 4 at most 4 groups differ, so a linked pair agrees in
all counts of some 4 groups: it shares one of 70 grid cells. Within a cell the vectors are compared by
Manhattan distance and what is left by Hamming distance. A cell gives links that span its
components, not all pairs. Cells of more than ``CELL_ROWS`` fingerprints are cut into blocks, and every two blocks
meet in a task of their own. Only distinct fingerprints take part, so copies cost nothing.

Defined cases: a null or empty text, and one of white space, has no words and fingerprint zero, which links
like any other; fewer than 4 words make one shingle; repeated rows share fingerprint and component; null ids sort
first as the smallest only if the whole component has none other (``min`` ignores nulls); an empty table gives no
rows; columns other than id and text are not read by ``near_groups``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radiolith.llm.common import cut, free_name, text_bytes, width
from radiolith.llm.components import components

SHINGLE, SEED, DISTANCE = 4, 42, 4
GROUPS = 8
CELL_ROWS = 4096
_CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bits set in more than half of the shingles' hashes; only A-Z are lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1)).tolist()
    ends = np.concatenate((gaps, [len(joined)])).tolist()[shingle - 1 :]
    digest, total = xxhash.xxh64_digest, np.zeros(64, np.int64)
    count = len(ends)
    for at in range(0, count, _CHUNK):
        part = b"".join([digest(joined[a:b], seed) for a, b in zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])])  # noqa: B905
        total += np.unpackbits(np.frombuffer(part, np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > count).tobytes(), "big")


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``id, fp``: the fingerprint as a signed 64-bit number."""
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t, shingle, seed) for t in text_bytes(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(marks.view(np.int64))], names=["id", "fp"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def unary_counts(fp: Column) -> Column:
    """The counts of two-bit segments, each written as 00, 01 or 11."""
    odd = F.lit(0x5555555555555555)
    high = F.shiftrightunsigned(fp, 1)
    both = fp.bitwiseAND(high).bitwiseAND(odd)
    return F.shiftleft(both, 1).bitwiseOR(fp.bitwiseOR(high).bitwiseAND(odd))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _cell_masks(distance: int) -> list[int]:
    """Of each choice of groups that a pair within the distance may agree in: the mask of their bits."""
    bits = 64 // GROUPS
    group = [((1 << bits) - 1) << (bits * g) for g in range(GROUPS)]
    return [_signed(sum(group[g] for g in chosen)) for chosen in combinations(range(GROUPS), GROUPS - distance)]


def _unary(marks: np.ndarray) -> np.ndarray:
    odd = np.uint64(0x5555555555555555)
    high = marks >> np.uint64(1)
    return ((marks & high & odd) << np.uint64(1)) | ((marks | high) & odd)


def spanning_links(marks: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links that join what is connected among the fingerprints of one cell, each within the distance."""
    n, counts = len(marks), _unary(marks)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for i in range(n - 1):
        near = np.flatnonzero(np.bitwise_count(counts[i + 1 :] ^ counts[i]) <= distance) + i + 1
        near = near[np.bitwise_count(marks[near] ^ marks[i]) <= distance]
        for j in near.tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((i, j))
    return links


def fingerprint_links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a, b``: links between the distinct fingerprints ``fp`` that span their components."""
    if not 0 <= distance < GROUPS:
        raise ValueError(f"distance must be below {GROUPS}")
    masks = F.array(*[F.lit(m).cast("long") for m in _cell_masks(distance)])
    cells = distinct.select(
        "fp", F.posexplode(F.transform(masks, lambda m: unary_counts(F.col("fp")).bitwiseAND(m))).alias("grid", "cell")
    )
    large = cells.groupBy("grid", "cell").count().where(F.col("count") > CELL_ROWS)
    blocks = F.coalesce(F.ceil(F.col("count") / CELL_ROWS), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    split = (
        cells.join(large, ["grid", "cell"], "left")
        .select("grid", "cell", "fp", blocks.alias("blocks"))
        .select("grid", "cell", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("grid", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; what a batch leaves open is carried to the next."""
        rest = None
        for batch in and_end(batches):
            found_a, found_b = [], []
            if batch is not None:
                now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("grid", "cell", "i", "j", "fp")]
                rest = now if rest is None else [np.concatenate(p) for p in zip(rest, now, strict=True)]
            if rest is None or not len(rest[0]):
                continue
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in rest[:4]], axis=0)) + 1
            bounds = np.concatenate(([0], change, [len(rest[0])]))
            done = len(bounds) - 1 if batch is None else len(bounds) - 2
            sizes = np.diff(bounds)
            for k in np.flatnonzero(sizes[:done] > 1).tolist():
                marks = np.unique(rest[4][bounds[k] : bounds[k + 1]]).view(np.uint64)
                for a, b in spanning_links(marks, distance):
                    found_a.append(marks[a])
                    found_b.append(marks[b])
            rest = [c[bounds[done] :] for c in rest]
            if found_a:
                pair = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (found_a, found_b)]
                yield pa.RecordBatch.from_arrays(pair, names=["a", "b"])

    return (
        split.repartition(width(distinct.sparkSession), "grid", "cell", "i", "j")
        .sortWithinPartitions("grid", "cell", "i", "j")
        .mapInArrow(solve, "a long, b long")
    )


def and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_groups(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                distance: int = DISTANCE) -> DataFrame:
    """Per row: id, ``fingerprint`` (hex) and ``component_id`` (the smallest id that links reach, itself included)."""
    marked = cut(fingerprints(documents, id_col, text_col))
    distinct = cut(marked.groupBy("fp").agg(F.min("id").alias("first_id")))
    roots = components(fingerprint_links(distinct.select("fp"), distance))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def row_key(id_col: str, text_col: str) -> Column:
    """A row's id and text as one value; the smallest has the smallest id, null last, and then the smallest text hash."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"))


def only_rows(documents: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents whose ``row_key`` is a ``key``, each once, with all their columns."""
    names = [free_name(documents, n) for n in ("__none", "__id", "__text_key")]

    def parts(key: Column) -> list[Column]:
        return [key["none"], F.coalesce(key["id"].cast("string"), F.lit("")), key["text_key"]]

    wanted = keys.select(*[p.alias(n) for p, n in zip(parts(F.col("key")), names, strict=True)])
    marked = documents.withColumns(dict(zip(names, parts(row_key(id_col, text_col)), strict=True)))
    return marked.join(wanted, names, "left_semi").dropDuplicates(names).drop(*names)


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: the smallest ``row_key``, and of rows equal in it one."""
    rows = documents.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    firsts = near_groups(rows, "key", "text").select(F.col("component_id").alias("key")).distinct()
    return only_rows(documents, firsts, id_col, text_col)
