"""Audit of how sources differ from their language in the words they use.

1. Tasks count terms of the documents they read, per language and source, with the documents that hold them; partial
   counts of a task meet by (language, term). A language keeps the terms of ``min_documents`` or more of its documents.
2. The shares ``p`` of a group and ``q`` of its language are whole numbers, and so is the value
   ``f = floor((p - q)^2 / (p + q))``.
3. Part ``term``: while a group's share is above its language's, f rises with the group's count and falls with the
   language's. So of terms dominated by k others (count not lower, language's count not higher, earlier in UTF-8
   order) none is among the first k. Every partition keeps the terms dominated by fewer than k others, its skyband,
   without knowing shares; skybands of ``FAN_IN`` partitions merge into one until one is left for a group. Only these
   are ranked by f.
4. Part ``pair``: f between two sources is summed over all kept terms, those included that neither has. A term's
   counts lie in one partition, which makes them dense against the language's sources, ``CHUNK`` terms at a time, and
   sends one sum for each pair.

A hot language or source never meets in one task: counts are spread by term, sums and skybands are made before the
shuffle. The pairs of a language's sources are the result itself.

Defined cases: null text, language and source count as empty; texts of any length are read in whole; a document that
is there twice counts twice; a group without terms has count 0 for each kept term; without kept terms all values are 0
and part ``term`` has no rows; a source alone in its language has no pairs; equal values rank by the item's UTF-8; an
empty table gives no rows; other columns are not read, whatever their names. Shares are exact while a language has
fewer than 10^19 occurrences.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from radiolith.llm.common import stored, text_bytes, width

MIN_DOCUMENTS, TOP, SCALE = 10, 10, 1_000_000_000
FAN_IN, CHUNK = 64, 256
#: Counted terms that a task holds before it sends them on; sums of pairs likewise.
HELD, HELD_PAIRS = 1 << 18, 1 << 22

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_COUNTS = "lang string, source string, term string, n long, documents long"


def count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts ``lang, source, term, n, documents``; a group without terms has a row with a null term."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def flush():
        for (lang, source), (n, documents) in counts.items():
            terms = list(n)
            size = len(terms)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (size + 1)), pa.array([source] * (size + 1)), pa.array([None, *terms], pa.binary()).cast(pa.string()),
                 pa.array([0, *n.values()], pa.int64()), pa.array([0, *(documents[t] for t in terms)], pa.int64())],
                names=["lang", "source", "term", "n", "documents"],
            )

    for batch in batches:
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        for group, text in zip(groups, text_bytes(batch, "text"), strict=True):
            if group not in counts:
                counts[group] = Counter(), Counter()
            n, documents = counts[group]
            found, before = TERM.findall(text.lower()), len(n)
            n.update(found)
            documents.update(set(found))
            held += len(n) - before
            if held > HELD:
                yield from flush()
                counts, held = {}, 0
    yield from flush()


def skyband(n: list[int], total: list[int], term: list[str], k: int) -> list[int]:
    """Places of the rows dominated by fewer than ``k`` others: n not lower, total not higher, term earlier."""
    names = [t.encode() for t in term]
    order = sorted(range(len(n)), key=lambda i: (-n[i], total[i], names[i]))
    # Whoever dominates a row comes before it, and k rows that dominate it are in the skyband if k dominate it at all.
    # A row is out once k totals and terms, both among those kept, lie below its own.
    ranks = {name: r for r, name in enumerate(sorted(set(names)))}
    kept, totals, places = [], np.empty(64, np.int64), np.empty(64, np.int64)
    for i in order:
        own, size = ranks[names[i]], len(kept)
        if np.count_nonzero((totals[:size] <= total[i]) & (places[:size] <= own)) < k:
            if size == len(totals):
                totals, places = np.concatenate([totals, totals]), np.concatenate([places, places])
            totals[size], places[size] = total[i], own
            kept.append(i)
    return kept


def _skybands(k: int):
    """Rows sorted by group to the rows of each group's skyband; a group may go on over batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "term", "n", "total", "part")), strict=True)

        out = []
        for _, own in groupby(rows(), key=lambda r: r[:2]):
            held = []
            for row in own:
                held.append(row)
                if len(held) >= 1 << 14:  # what is dominated now stays so
                    held = _band(held, k)
            out += _band(held, k)
            if len(out) >= 1 << 13:
                yield _band_batch(out)
                out = []
        yield _band_batch(out)

    return run


def _band(rows: list[tuple], k: int) -> list[tuple]:
    return [rows[i] for i in skyband([r[3] for r in rows], [r[4] for r in rows], [r[2] for r in rows], k)]


def _band_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32())
    names = ["lang", "source", "term", "n", "total", "part"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


_BAND = "lang string, source string, term string, n long, total long, part int"


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)) of whole numbers up to 3 * 10^9."""
    return (p - q) ** 2 // (p + q)


def _share(n: Column, occurrences: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (occurrences + 2 * terms)), in decimals."""
    wide = "decimal(20,0)"
    dividend = (n.cast(wide) + F.lit(2).cast(wide)).cast(wide) * F.lit(SCALE).cast("decimal(10,0)")
    divisor = occurrences.cast(wide) + F.lit(2).cast("decimal(1,0)") * terms.cast(wide)
    return (F.call_function("div", dividend, divisor) + 1).cast("long")


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, lang, term), a language's groups first, to sums of f over the bucket's terms for each pair."""

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("bucket", "lang", "term", "source", "n", "p")), strict=True)

    def emit(lang, sources, sums):
        a, b = np.nonzero(np.triu(sums, 1))
        for at in range(0, len(a), 1 << 14):
            i, j = a[at : at + (1 << 14)], b[at : at + (1 << 14)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(i), pa.string()), pa.array([sources[x] for x in i], pa.string()), pa.array([sources[x] for x in j], pa.string()),
                 pa.array(sums[i, j], pa.int64())],
                names=["lang", "a", "b", "value"],
            )

    for (_, lang), own in groupby(rows(), key=lambda r: r[:2]):
        sources, none, number, sums, dense, terms = [], [], {}, None, [], 0
        for term, of_term in groupby(own, key=lambda r: r[2]):
            if term is None:
                for r in of_term:
                    number[r[3]] = len(sources)
                    sources.append(r[3])
                    none.append(r[5])
                none, size = np.array(none, np.int64), len(sources)
                sums = np.zeros((size, size), np.int64)
                chunk = max(1, min(CHUNK, HELD_PAIRS // size))
                dense = np.repeat(none[:, None], chunk, 1)
                continue
            for r in of_term:
                dense[number[r[3]], terms] = r[5]
            terms += 1
            if terms == dense.shape[1]:
                _add(sums, dense)
                dense, terms = np.repeat(none[:, None], dense.shape[1], 1), 0
        if terms:
            _add(sums, dense[:, :terms])
        if sums is not None:
            yield from emit(lang, sources, sums)


def _add(sums: np.ndarray, dense: np.ndarray) -> None:
    for i in range(len(sums) - 1):
        sums[i, i + 1 :] += divergence(dense[i], dense[i + 1 :]).sum(1)


def audit(documents: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_documents: int = MIN_DOCUMENTS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: all other sources of the language by value, and the first ``top`` terms."""
    spark = documents.sparkSession
    wide = width(spark)
    columns = {"text": text_col, "lang": lang_col, "source": source_col}
    read = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for name, c in columns.items()])
    partial = read.mapInArrow(count_terms, _COUNTS)
    # Dealt by term, so that the sum of a language needs no further shuffle.
    counted = partial.repartition(wide, "lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    of_term = Window.partitionBy("lang", "term")
    counts = stored(
        counted.withColumns({"total": F.sum("n").over(of_term), "held": F.sum("documents").over(of_term)})
        .where((F.col("held") >= min_documents) | F.col("term").isNull())
        .select("lang", "source", "term", "n", "total"),
        "counts",
    )
    terms = counts.where("term is not null")
    langs = terms.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.countDistinct("term").alias("kept"))
    found = terms.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = stored(
        counts.where("term is null").select("lang", "source").join(found, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("group_n", "lang_n", "kept")]),
        "groups",
    )

    band = terms.withColumn("part", F.spark_partition_id()).sortWithinPartitions("lang", "source").mapInArrow(_skybands(top), _BAND)
    band = stored(band, "band")
    parts = 1 + (band.agg(F.max("part").alias("n")).first()["n"] or 0)
    while parts > 1:
        parts = -(-parts // FAN_IN)
        band = band.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        band = band.repartition(wide, "lang", "source", "part").sortWithinPartitions("lang", "source", "part")
        band = band.mapInArrow(_skybands(top), _BAND)
    group_share, lang_share = _share(F.col("n"), F.col("group_n"), F.col("kept")), _share(F.col("total"), F.col("lang_n"), F.col("kept"))
    f = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("p") + F.col("q"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    first = (
        band.join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), group_share.alias("p"), lang_share.alias("q"))
        .where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), "item", f.alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= top)
    )

    shares = terms.join(groups, ["lang", "source"]).select("lang", "term", "source", "n", group_share.alias("p"))
    shares = shares.withColumn("bucket", F.pmod(F.xxhash64("lang", "term"), F.lit(wide)).cast("int"))
    nothing = groups.where("kept > 0").select(
        "lang", F.lit(None).cast("string").alias("term"), "source", F.lit(0).cast("long").alias("n"),
        _share(F.lit(0), F.col("group_n"), F.col("kept")).alias("p"), F.explode(F.sequence(F.lit(0), F.lit(wide - 1))).alias("bucket"),
    )
    sums = (
        shares.unionByName(nothing)
        .repartition(wide, "bucket")
        .sortWithinPartitions("bucket", "lang", "term", "source")
        .mapInArrow(_pair_sums, "lang string, a string, b string, value long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
    )
    both = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("pair"), "value").select("lang", "pair.source", "pair.item", "value")
    others = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source != item")
    pairs = (
        others.join(both, ["lang", "source", "item"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
    )
    return pairs.unionByName(first)
