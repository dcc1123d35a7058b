"""Exact deduplication by two passes over a Bloom filter, in DataFrame operations only.

The first pass counts, for each of two hash functions, how many rows fall on each bit of a filter of
fixed size and keeps the bits hit twice. The second pass tests every row against those bits, which
are broadcast: their size is ``2 * filter_bits / 8`` bytes whatever the input. A row that misses one
of its bits has no equal and passes straight through; only the others shuffle. A fuller filter lets
more rows shuffle and never changes the result.

Defined cases: a null text counts as empty; empty texts are equal to one another and to texts of white
space alone; a null id sorts before all ids; rows that repeat the id of the row that stays, at its
length, carry the same verdict, and ``deduplicate`` leaves one of them; an empty table gives an empty
result; columns other than id and text are not read by ``exact_groups`` and are passed on, whatever
their names, by ``deduplicate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radiolith.llm.common import WHITE, cut, free_name

#: Bits of the filter of each hash function: 2 MB each.
FILTER_BITS = 1 << 24
_SEEDS = (11, 23)


def text_digest(text: Column) -> Column:
    """SHA-256 of the text without white space, lowercase hex."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, ""), 256)


def _cell(digest: Column, seed: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), digest), F.lit(bits)) + 1


def repeated_bits(digests: DataFrame, digest_col: str, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``seed, bucket, bits``: the filter's bits that two or more rows fall on, 4 KB a row."""
    cells = digests.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(s).alias("seed"), _cell(F.col(digest_col), s, filter_bits).alias("cell"))
                    for s in _SEEDS
                ]
            )
        ).alias("hit")
    )
    taken = cells.groupBy("hit.seed", "hit.cell").count().where("count > 1")
    return taken.groupBy("seed", F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")
    )


def flag_possible(rows: DataFrame, digest_col: str, bits: DataFrame, flag: str, filter_bits: int) -> DataFrame:
    """The rows with a boolean: false means that no other row has this digest."""
    kept, tests = rows.columns, []
    for seed in _SEEDS:
        bucket, bitmap = f"__bucket_{seed}", f"__bits_{seed}"
        part = bits.where(F.col("seed") == seed).select(F.col("bucket").alias(bucket), F.col("bits").alias(bitmap))
        cell = _cell(F.col(digest_col), seed, filter_bits)
        rows = rows.join(F.broadcast(part), F.bitmap_bucket_number(cell) == F.col(bucket), "left")
        at = F.bitmap_bit_position(cell)
        byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10)
        bit = F.call_function("shiftright", byte.cast("int"), (at % 8).cast("int")).bitwiseAND(F.lit(1))
        tests.append(F.coalesce(bit == 1, F.lit(False)))
    return rows.select(*[F.col(f"`{c}`") for c in kept], (tests[0] & tests[1]).alias(flag))


def _winners(possible: DataFrame, digest: str, length: str, key: str) -> DataFrame:
    """Of each digest: the longest text's row, then the smallest id, and how many rows there are."""
    return possible.groupBy(F.col(digest).alias("__digest")).agg(
        F.min(F.struct((-F.col(length)).alias("l"), F.col(key).alias("i"))).alias("__best"),
        F.count("*").alias("__size"),
    )


def exact_groups(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 filter_bits: int = FILTER_BITS) -> DataFrame:
    """Per row: ``id_col, keep_id, group_size, kept, text_sha256``; dropped rows too."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    digests = cut(
        documents.select(
            F.col(id_col).alias("id"), F.length(text).cast("long").alias("n_chars"), text_digest(text).alias("digest")
        )
    )
    flagged = flag_possible(digests, "digest", repeated_bits(digests, "digest", filter_bits), "possible", filter_bits)
    alone = flagged.where(~F.col("possible")).select(
        F.col("id").alias(id_col),
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    possible = flagged.where("possible")
    grouped = possible.join(_winners(possible, "digest", "n_chars", "id"), F.col("digest") == F.col("__digest"))
    return alone.unionByName(
        grouped.select(
            F.col("id").alias(id_col),
            F.col("__best.i").alias("keep_id"),
            F.col("__size").alias("group_size"),
            (F.col("id").eqNullSafe(F.col("__best.i")) & (F.col("n_chars") == -F.col("__best.l"))).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )
    )


def deduplicate(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                filter_bits: int = FILTER_BITS) -> DataFrame:
    """The rows that stay, with all their columns; rows without an equal are never shuffled."""
    digest, length, flag = (free_name(documents, n) for n in ("__sha", "__chars", "__possible"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = documents.withColumns({digest: text_digest(text), length: F.length(text).cast("long")})
    narrow = cut(rows.select(F.col(id_col).alias("id"), F.col(length).alias("chars"), F.col(digest).alias("sha")))
    bits = cut(repeated_bits(narrow, "sha", filter_bits))
    flagged = flag_possible(rows, digest, bits, flag, filter_bits)
    few = flag_possible(narrow, "sha", bits, "possible", filter_bits).where("possible")
    best = _winners(few, "sha", "chars", "id")
    stay = (
        flagged.where(F.col(flag))
        .join(best, F.col(digest) == F.col("__digest"))
        .where(F.col(id_col).eqNullSafe(F.col("__best.i")) & (F.col(length) == -F.col("__best.l")))
        .dropDuplicates([digest])
    )
    columns = [F.col(f"`{c}`") for c in documents.columns]
    return flagged.where(~F.col(flag)).select(*columns).union(stay.select(*columns))
