"""Benchmark passages in documents, by a prefix-filtered set join.

A window is ``WINDOW`` consecutive words of an item, or the whole of a shorter item. Its tokens are its shingles of
``SHINGLE`` words, and a document contains the window only if it contains all of them: the prefix that
the filter needs is one token, the rarest of the corpus.

1. One pass over the documents keeps the positions of shingles that are in a filter of all the benchmark's
   shingles. The filter has a fixed size (``FILTER_BITS``), whatever the benchmark's.
2. Shingles are counted by the documents that hold them, over all documents; each window's rarest becomes its prefix, and
   a window with a shingle that no document holds is out. Equal windows of many items are one.
3. Positions of prefix tokens meet the windows. The window's length and the token's place in it bound where it starts
   in the document.
4. A candidate is verified shingle by shingle against the document's kept positions, which hold every shingle of
   every window, for ``STARTS`` starts of a document at a time. Items are joined to the windows found. Shingles are told by 64 bits each, eight of them for ten words.

Defined cases: a null or empty text has no words, is not contaminated and is in no window; repeated documents are judged
alike; repeated items and ids are merged by id; ids may be null (items without one count as one item, whose hits count but whose
id is not reported); an empty benchmark leaves all documents clean; very long texts are read whole; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radiolith.llm.common import free_name, keyed, stored, text_bytes

WINDOW, SHINGLE = 10, 3
FILTER_BITS = 1 << 24
#: Claims on a document are verified for so many starts at a time.
STARTS = 1 << 13

#: A-Z to lower case, every other byte of ASCII that is no letter or digit to a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class _Tokens(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_TOKENS = _Tokens()


def shingle_ids(words: list[bytes], size: int) -> np.ndarray:
    """An identifier of the ``size`` words from each position on."""
    tokens = np.fromiter(map(_TOKENS.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    if n < 1:
        return np.zeros(0, np.int64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ tokens[k : k + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """``item, window, words, size, shingles``: each window once per item, with its number of words and its shingles' ids.

    ``window`` is a digest that equal windows of all items share.
    """
    rows = benchmark.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, words, sizes, shingles = [], [], [], []
            for item, text in zip(batch.column("item").to_pylist(), text_bytes(batch, "text"), strict=True):
                found = words_of(text)
                if not found:
                    continue
                length = min(window, len(found))
                size = min(shingle, length)
                ids = shingle_ids(found, size)
                for start in range(len(found) - length + 1):
                    items.append(item)
                    words.append(length)
                    sizes.append(size)
                    shingles.append(ids[start : start + length - size + 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, batch.schema.field("item").type), pa.array(words, pa.int32()), pa.array(sizes, pa.int32()),
                 pa.array(shingles, pa.list_(pa.int64()))],
                names=["item", "words", "size", "shingles"],
            )

    kind = rows.schema["item"].dataType.simpleString()
    found = rows.mapInArrow(run, f"item {kind}, words int, size int, shingles array<long>").distinct()
    return found.withColumn("window", F.sha2(F.concat_ws(",", F.col("words").cast("string"), F.col("shingles").cast("array<string>")), 256))


def _filter(windows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """A filter of all shingles, as bytes, and the sizes that shingles have."""
    cell = F.pmod("id", F.lit(FILTER_BITS)) + 1
    ids = windows.select(F.explode("shingles").alias("id"))
    bits = ids.groupBy(F.bitmap_bucket_number(cell).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in bits.collect():  # at most FILTER_BITS / 8 bytes
        at = (row["part"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)
    return out, sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most SHINGLE


def contamination(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE) -> DataFrame:
    """Per document: id, ``text_key``, ``n_words``, ``n_hit`` (words inside a window's occurrence), ``items`` (ids of
    the items with an occurring window, sorted as strings) and ``n_items`` (their number, items without an id being one more)."""
    spark = documents.sparkSession
    windows = stored(item_windows(benchmark, item_col, item_text_col, window, shingle), "windows")
    bits, sizes = _filter(windows)
    sent = spark.sparkContext.broadcast(bits)
    rows = keyed(documents, id_col, text_col)
    shape = pa.struct([("at", pa.int32()), ("id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            counts, lengths, places, found = [], [], [], []
            for text in text_bytes(batch, "text"):
                words, total = words_of(text), 0
                for size in sizes:
                    ids = shingle_ids(words, size)
                    cell = ids % FILTER_BITS
                    hit = np.flatnonzero(known[cell >> 3] >> (cell & 7).astype(np.uint8) & 1)
                    places.append(hit)
                    found.append(ids[hit])
                    total += len(hit)
                counts.append(len(words))
                lengths.append(total)
            flat = [np.concatenate(p) if p else np.zeros(0, np.int64) for p in (places, found)]
            values = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(flat, shape, strict=True)], fields=list(shape))
            offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, values)],
                names=["id", "text_key", "n_words", "tokens"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(run, f"id {kind}, text_key long, n_words long, tokens array<struct<at: int, id: long>>")
    kept = stored(made.withColumn("doc", F.monotonically_increasing_id()), "shingles")

    held = kept.select(F.explode(F.array_distinct("tokens.id")).alias("id")).groupBy("id").agg(F.count("*").alias("df"))
    # A passage that many items share is looked for once.
    classes = windows.dropDuplicates(["window"]).select("window", "words", "size", "shingles")
    places = classes.select("window", "words", "size", "shingles", F.posexplode("shingles").alias("offset", "id"))
    ranked = places.join(held, "id", "left")
    prefixes = (
        ranked.groupBy("window")
        .agg(
            *[F.first(c).alias(c) for c in ("words", "size", "shingles")],
            F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "id", "offset")).alias("rarest"),
        )
        .where("rarest.df > 0")
        .select("window", "words", "size", "shingles", F.col("rarest.id").alias("id"), F.col("rarest.offset").alias("offset"))
    )
    wanted = prefixes.select("id").distinct()
    tokens = kept.select("doc", "n_words", F.explode("tokens").alias("t")).select("doc", "n_words", "t.at", "t.id")
    candidates = (
        tokens.join(wanted, "id", "left_semi").join(prefixes, "id")
        .withColumn("start", F.col("at") - F.col("offset"))
        .where("start >= 0 and start + words <= n_words")
        .select("doc", "window", "start", "words", "shingles")
    )
    # A document's claims are collected for a stretch of starts at a time, and verified against its own tokens.
    stretch = F.floor(F.col("start") / STARTS)
    asked = candidates.groupBy("doc", stretch.alias("stretch")).agg(F.collect_list(F.struct("window", "start", "words", "shingles")).alias("asked")).drop("stretch")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, found = [], []
            for held_tokens, claims in zip(*(batch.column(n).to_pylist() for n in ("tokens", "asked")), strict=True):
                at = {}
                for token in held_tokens:
                    at.setdefault(token["at"], set()).add(token["id"])
                ends, names = {}, set()
                for claim in claims:
                    start = claim["start"]
                    if all(s in at.get(start + k, ()) for k, s in enumerate(claim["shingles"])):
                        ends[start] = max(ends.get(start, 0), start + claim["words"])
                        names.add(claim["window"])
                spans.append(_merged(sorted(ends.items())))
                found.append(sorted(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(spans, pa.list_(pa.list_(pa.int32()))), pa.array(found, pa.list_(pa.string()))],
                names=["doc", "spans", "windows"],
            )

    checked = kept.select("doc", "tokens").join(asked, "doc").mapInArrow(verify, "doc long, spans array<array<int>>, windows array<string>")
    checked = stored(checked.where("size(spans) > 0"), "verified")
    # Merged spans of a stretch may still meet those of the next: words are counted where they first end.
    ordered = F.array_sort(F.flatten(F.collect_list("spans")))
    counted = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda done, s: F.struct(
            (done["n"] + F.greatest(s[1] - F.greatest(s[0], done["end"]), F.lit(0))).alias("n"), F.greatest(done["end"], s[1]).alias("end")
        ),
    )["n"]
    hits = checked.groupBy("doc").agg(counted.cast("long").alias("n_hit"))
    found = checked.select("doc", F.explode("windows").alias("window")).distinct()
    named = found.join(windows.select("window", F.col("item").cast("string").alias("item")), "window").select("doc", "item").distinct()
    names = named.groupBy("doc").agg(F.sort_array(F.collect_list("item")).alias("items"), F.count("*").alias("n_items"))
    verified = hits.join(names, "doc")
    return kept.select("doc", "id", "text_key", "n_words").join(verified, "doc", "left").select(
        F.col("id").alias(id_col),
        "text_key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
    )


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Sorted spans with those that meet joined."""
    out: list[list[int]] = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without a benchmark window, with all their columns."""
    key, mark = free_name(documents, "__doc"), free_name(documents, "__mark")
    hit = (
        contamination(documents, benchmark, id_col, text_col).where("n_hit > 0")
        .select(F.col(id_col).alias(key), F.col("text_key").alias(mark)).distinct()
    )
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    same = F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(text) == F.col(mark))
    return documents.join(hit, same, "left_anti")
