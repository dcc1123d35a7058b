"""Hard negatives by lists that anchors of a cluster share (the MAXIMUS scheme for exact inner-product search).

Anchors are clustered by direction; centroids are fitted on a bounded sample and only steer the work. For a cluster
whose members lie within an angle ``r`` of the centroid, a row at angle ``t`` from it has an inner product of at most
``|anchor| * |row| * cos(max(0, t - r))`` with any member. Rows are sorted by that bound once for each cluster, and all
members walk this one list, dropping out when the bound falls below what each has certainly found. What is left out
can't be among the first, so the result is exact.

Rows lie in blocks of bounded size by a hash, and every cluster walks the list of each block; the firsts of blocks are
merged by rank. So a task holds one block and one piece of a cluster, and what shuffles is each row once and each
anchor once for each block. Two walks follow one another: the first finds the nearest rows of an anchor's own label,
the second, for each score found there, the best rows of other labels within its window.

Rows equal in label and vector are one class, of which only the smallest ids can be among the first; the limit is taken
before the shuffle, so any number of copies costs one row. Equal anchors walk once.

Defined cases: rows with a null id, label or vector or with a null or non-finite component take no part; components
are whole numbers, others are rounded down; a shorter vector counts as padded by zeros; zero and empty vectors score 0; a window of a negative positive is empty; rows equal in id, label and
vector count once, rows that share an id only are rows of their own, where an anchor leaves out itself alone; scores
beyond 64 bits are compared exactly and returned as the nearest 64-bit number; a label of one row has no positives;
an empty table gives no rows; other columns are not read. Vectors of one class are told by SHA-256.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from radiolith.llm.common import stored, width

POSITIVES, NEGATIVES = 5, 5
#: A negative scores from 80 to 100 hundredths of the positive.
LEAST, MOST = 80, 100
#: Clusters of anchors and the anchors they are fitted on, at most.
CLUSTERS, FITTED = 64, 8192
#: Rows of a block, members of a cluster that walk at a time, and the first step on the list, which doubles.
BLOCK_ROWS, MEMBERS, STEP = 1 << 16, 512, 256
_EXACT = float(1 << 53)
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def whole_components(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component as a double; null if any component is null or not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # floor() of Spark gives a long, which the largest floats don't fit.
    scaled = F.transform(vector, lambda x: F.lit(float(scale)) * x.cast("double"))
    return F.when(fine, F.transform(scaled, lambda y: F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)))


def matrix(vectors: list[np.ndarray], dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers: int64, or Python's integers where doubles might round."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if a.shape[1] * np.abs(a).max() * np.abs(b).max() < _EXACT:
        return np.rint(a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in b.tolist()]
    return np.array([[sum(x * y for x, y in zip(map(int, row), other, strict=True)) for other in whole] for row in a.tolist()], object).reshape(len(a), len(b))


def angles(rows: np.ndarray, norms: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    cosine = np.divide(rows @ centroid, norms, out=np.ones(len(rows)), where=norms > 0)
    return np.arccos(np.clip(cosine, -1, 1))


class Query:
    """The first ``k`` rows of an anchor by score, then id, with ``low <= score <= high``; of its label or of others."""

    __slots__ = ("best", "high", "k", "key", "label", "low", "own", "positive", "vector")

    def __init__(self, key, label, vector, k, own, positive=None, low=None, high=None):
        self.key, self.label, self.vector, self.k, self.own = key, label, vector, k, own
        self.positive, self.low, self.high = positive, low, high
        #: Negated score, id, and whether the row is of the anchor's class.
        self.best: list[tuple[int, int, bool]] = []

    def floor(self):
        """Rows below can't be among the first; None if any can."""
        kth = -self.best[self.k - 1][0] if len(self.best) >= self.k else None
        return kth if self.low is None or (kth is not None and kth > self.low) else self.low

    def take(self, found: Iterable[tuple[int, list[int], bool]]) -> None:
        more = [(-score, row_id, equal) for score, ids, equal in found for row_id in ids]
        if more:
            self.best = sorted(self.best + more)[: self.k]


class Block:
    """Rows of one block, with what every cluster's list needs."""

    def __init__(self, keys: list[str], labels: list[int], ids: list[list[int]], vectors: list[np.ndarray]):
        self.labels, self.keys, self.ids = np.array(labels, np.int64), keys, ids
        self.rows = matrix(vectors, max(map(len, vectors), default=0))
        self.norms = np.linalg.norm(self.rows, axis=1)
        self.of_label: dict[int, np.ndarray] = {}
        order = np.argsort(self.labels, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(self.labels[order])) + 1) if len(order) else []:
            self.of_label[int(self.labels[part[0]])] = part

    def walk(self, queries: list[Query]) -> int:
        """Answers the queries of one cluster; gives the number of scores taken."""
        dims = max(self.rows.shape[1], max(len(q.vector) for q in queries))
        if dims > self.rows.shape[1]:
            self.rows = np.pad(self.rows, ((0, 0), (0, dims - self.rows.shape[1])))
        members = matrix([q.vector for q in queries], dims)
        norms = np.linalg.norm(members, axis=1)
        unit = np.divide(members, norms[:, None], out=np.zeros_like(members), where=norms[:, None] > 0)
        centroid = unit.sum(0)
        length = np.linalg.norm(centroid)
        centroid = centroid / length if length > 0 else centroid
        radius = angles(members, norms, centroid).max() + 1e-6
        bound = self.norms * np.cos(np.maximum(0, angles(self.rows, self.norms, centroid) - radius)) * (1 + 1e-9)
        taken, wants = 0, {}
        for i, q in enumerate(queries):
            wants.setdefault(q.label if q.own else None, []).append(i)
        for label, active in wants.items():
            listed = np.arange(len(self.rows)) if label is None else self.of_label.get(label)
            if listed is None:
                continue
            listed = listed[np.argsort(-bound[listed], kind="stable")]
            at, step = 0, STEP
            while at < len(listed):
                top = bound[listed[at]]
                active = [i for i in active if (f := queries[i].floor()) is None or norms[i] * top + 1e-6 + 1e-9 * abs(f) >= f]
                if not active:
                    break
                own = listed[at : at + step]
                found = scores(members[active], self.rows[own])
                taken += found.size
                for i, row in zip(active, found, strict=True):
                    self._pick(queries[i], row, own)
                at, step = at + step, min(2 * step, 16 * STEP)
        return taken

    def _pick(self, q: Query, row: np.ndarray, own: np.ndarray) -> None:
        fits = np.ones(len(row), bool) if q.own else self.labels[own] != q.label
        if q.high is not None:
            fits &= row <= q.high
        floor = q.floor()
        if floor is not None:
            fits &= row >= floor
        places = np.flatnonzero(fits)
        if len(places) > q.k:  # the k-th score among them is a floor; its equals stay, for the ids
            kth = np.sort(row[places])[-q.k]
            places = places[row[places] >= kth]
        q.take((int(row[j]), self.ids[own[j]], self.keys[own[j]] == q.key) for j in places.tolist())


def _walks(k: int, own: bool):
    """Rows sorted by (block, kind, cluster): a block's rows, then its anchors; to the firsts of each query in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                v = batch.column("v")
                flat, offsets = v.values.to_numpy(zero_copy_only=False), v.offsets.to_numpy()
                plain = [batch.column(c).to_pylist() for c in ("block", "kind", "cluster", "key", "label", "ids", "windows")]
                for i, row in enumerate(zip(*plain, strict=True)):
                    yield *row, flat[offsets[i] : offsets[i + 1]].copy()

        for _, of_block in groupby(rows(), key=lambda r: r[0]):
            block = None
            keys, labels, ids, vectors = [], [], [], []
            for (kind, _), group in groupby(of_block, key=lambda r: (r[1], r[2])):
                if kind == 0:
                    for r in group:
                        keys.append(r[3])
                        labels.append(r[4])
                        ids.append(r[5])
                        vectors.append(r[7])
                    continue
                if block is None:
                    block = Block(keys, labels, ids, vectors)
                queries: list[Query] = []
                for r in group:
                    queries += [Query(r[3], r[4], r[7], k, own, **w) for w in ([{}] if own else r[6])]
                    if len(queries) >= MEMBERS:
                        block.walk(queries)
                        yield _answers(queries)
                        queries = []
                if queries:
                    block.walk(queries)
                    yield _answers(queries)

    return run


def _answers(queries: list[Query]) -> pa.RecordBatch:
    out = [(q.key, q.positive, min(max(-s, _LOW), _HIGH), i, equal) for q in queries for s, i, equal in q.best]
    columns = zip(*out, strict=True) if out else [[]] * 5
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["key", "positive", "score", "found", "equal"])


def fit_centroids(vectors: list[list[float]], clusters: int = CLUSTERS, rounds: int = 8) -> np.ndarray:
    """Directions of clusters by spherical k-means from evenly spaced rows; no rows give one direction of zeros."""
    rows = matrix([np.array(v, float) for v in vectors], max(map(len, vectors), default=0))
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    rows = np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)
    if not len(rows):
        return rows.reshape(0, 0)
    clusters = max(1, min(clusters, int(math.sqrt(len(rows)))))
    centroids = rows[np.linspace(0, len(rows) - 1, clusters).astype(int)].copy()
    for _ in range(rounds):
        near = (rows @ centroids.T).argmax(1)
        for c in range(clusters):
            mean = rows[near == c].sum(0)
            if np.linalg.norm(mean) > 0:
                centroids[c] = mean / np.linalg.norm(mean)
    return centroids


def _clustered(anchors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Anchor classes ``key, label, v`` with the number of the nearest centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.array(v, float) for v in batch.column("v").to_pylist()]
            near = np.zeros(len(vectors), np.int32)
            if len(vectors) and centroids.size:
                dims = max(centroids.shape[1], *map(len, vectors))
                wide = np.pad(centroids, ((0, 0), (0, dims - centroids.shape[1])))
                near = (matrix(vectors, dims) @ wide.T).argmax(1).astype(np.int32)
            yield batch.append_column("cluster", pa.array(near))

    return anchors.mapInArrow(run, "key string, label long, v array<double>, cluster int")


def _first(answers: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Of each query's answers from all blocks the first ``k``, as a sorted array of (rank, score, id)."""
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "found"))).where(F.col("rank") <= k)
    return ranked.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rank", "score", "found", "equal"))).alias("first"))


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "id", label_col: str = "label", vector_col: str = "vector",
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` hold whole numbers (see ``whole_components``, which makes them of others); ``is_anchor`` is a condition on the given columns.
    """
    spark = vectors.sparkSession
    wide = width(spark)
    vector = whole_components(F.col(vector_col).cast("array<double>"), 1)
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vector.alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
        .where("id is not null and label is not null and v is not null")
        .withColumn("key", F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.array_join("v", ",")), 256))
    )
    # Only the first ids of a class can be among the first rows of a query; an anchor may have to leave out itself.
    most_ids = max(positives + 1, negatives)
    distinct = rows.select("key", "id", "label", "v").dropDuplicates(["key", "id"])
    first_ids = distinct.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(F.col("n") <= most_ids)
    classes = stored(first_ids.groupBy("key").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids")), "classes")
    anchors = stored(rows.where("anchor").select("key", "id", "label", "v").dropDuplicates(["key", "id"]), "anchors")
    lone = anchors.select("key", "label", "v").dropDuplicates(["key"])
    sample = lone.orderBy(F.xxhash64("key"), "key").limit(FITTED).select("v").collect()
    lone = stored(_clustered(lone, fit_centroids([r["v"] for r in sample])), "clusters")

    blocks = max(wide, math.ceil(classes.count() / BLOCK_ROWS))
    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")
    no_windows = F.lit(None).cast("array<struct<positive:long,low:long,high:long>>")
    data = classes.select(block.alias("block"), F.lit(0).alias("kind"), F.lit(0).alias("cluster"), "key", "label", "ids", no_windows.alias("windows"), "v")

    def walk(asked: DataFrame, k: int, own: bool) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        asked = asked.select(every.alias("block"), F.lit(1).alias("kind"), "cluster", "key", "label", F.lit(None).cast("array<long>").alias("ids"), "windows", "v")
        both = data.union(asked).repartition(blocks, "block").sortWithinPartitions("block", "kind", "cluster", "key")
        return both.mapInArrow(_walks(k, own), "key string, positive long, score long, found long, equal boolean")

    near = stored(_first(walk(lone.withColumn("windows", no_windows), positives + 1, True), ["key"], positives + 1), "positives")
    # The window of a score s runs from least * s / 100 rounded up to most * s / 100 rounded down; of a negative s it is empty.
    windows = F.array_distinct(F.transform(F.filter("first", lambda x: x["score"] >= 0), lambda x: F.struct(x["score"].alias("positive"), _up(x["score"], least).alias("low"), _down(x["score"], most).alias("high"))))
    asked = lone.join(near.select("key", windows.alias("windows")), "key").where(F.size("windows") > 0)
    hard = _first(walk(asked, negatives, False), ["key", "positive"], negatives)
    hard = hard.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("positive", "first"))).alias("hard"))  # one a positive
    by_class = near.join(hard, "key").select("key", F.col("first").alias("near"), "hard")
    taken = F.slice(F.filter("near", lambda x: ~x["equal"] | (x["found"] != F.col("id"))), 1, positives)
    return (
        anchors.select("key", "id")
        .join(by_class, "key")
        .select(F.col("id").alias("anchor_id"), "hard", F.explode(taken).alias("positive"))
        .withColumn("negatives", F.try_element_at("hard", F.col("positive.score")))
        .select("anchor_id", F.col("positive.found").alias("positive_id"), F.explode("negatives").alias("negative"), F.col("positive.score").alias("positive_score"))
        .select("anchor_id", "positive_id", F.col("negative.rank").cast("int").alias("rank"), F.col("negative.found").alias("negative_id"), "positive_score", F.col("negative.score").alias("negative_score"))
    )


def _hundredths(score: Column, share: int) -> Column:
    return score.cast("decimal(20,0)") * F.lit(share).cast("decimal(4,0)")


def _up(score: Column, share: int) -> Column:
    """score * share / 100, rounded up, of a score not below 0."""
    return F.call_function("div", _hundredths(score, share) + F.lit(99), F.lit(100).cast("decimal(3,0)"))


def _down(score: Column, share: int) -> Column:
    return F.call_function("div", _hundredths(score, share), F.lit(100).cast("decimal(3,0)"))
