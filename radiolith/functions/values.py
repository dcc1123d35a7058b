"""Column functions on values: hashing, dates, text, number coercion.

All are compositions of built-in functions, so they stay inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EDGE_SPACE = r"\A[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+\z"
_NOT_SPACE = r"[^\s\x1c-\x1f\x85\p{Z}]"
# Characters are listed: the JVM looks them up in one table, ranges and classes one after the other.
_NOT_NUMERIC = r"[^0123456789+\-.eE \t\n\x0B\f\r]"


def salted_hash(value: Column, salt: str) -> Column:
    """First 16 hex digits of SHA-256 over value followed by salt; NULL stays NULL."""
    return F.substring(F.sha2(F.concat(value, F.lit(salt)), 256), 1, 16)


def md5_mod(value: Column, modulus: int) -> Column:
    """The MD5 digest, read as one 128-bit integer, modulo a small number.

    The digest is consumed as four 32-bit words, so 64-bit arithmetic is enough.
    """
    digest = F.md5(value)
    words = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]
    step = F.lit(2**32 % modulus)
    rest = words[0] % modulus
    for word in words[1:]:
        rest = (rest * step + word) % modulus
    return rest.cast("int")


def true_or_false(condition: Column) -> Column:
    """A condition with NULL read as false."""
    return F.coalesce(condition, F.lit(False))


def strip(value: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` removes spaces only)."""
    return F.regexp_replace(value, _EDGE_SPACE, "")


def is_blank(value: Column, dtype: T.DataType) -> Column:
    """NULL, empty text or an empty list."""
    if isinstance(dtype, T.StringType):
        return value.isNull() | (value == "")
    if isinstance(dtype, T.ArrayType):
        return value.isNull() | (F.size(value) == 0)
    return value.isNull()


def is_white(value: Column) -> Column:
    """Whether a text has no character but white space; false for NULL."""
    return true_or_false(~value.rlike(_NOT_SPACE))


def real_number(value: Column, dtype: T.DataType) -> Column:
    """Value as double; NULL where the text is no decimal number (no NaN, infinity or type suffix).

    A VARIANT counts as the text or number that it holds.
    """
    if isinstance(dtype, T.VariantType):
        value, dtype = F.try_variant_get(value, "$", "string"), T.StringType()
    if isinstance(dtype, T.StringType):
        value = F.when(~value.rlike(_NOT_NUMERIC), value)
    return value.try_cast("double")


def only_whole(number: Column) -> Column:
    """A double where it is a whole number, otherwise NULL. ``"1"`` and ``"1.0"`` both read as 1."""
    return F.when(number == F.floor(number), number)


def dicom_date(value: Column) -> Column:
    """``yyyyMMdd`` text as a date; NULL for anything that is no calendar date of year 1 or later.

    Goes through the ISO cast, which neither builds a formatter nor throws on bad input.
    """
    iso = F.concat_ws("-", F.substring(value, 1, 4), F.substring(value, 5, 2), F.substring(value, 7, 2))
    return F.when(value.rlike(r"\A[0-9]{8}\z") & ~F.startswith(value, F.lit("0000")), iso).try_cast("date")


def dicom_text(day: Column) -> Column:
    """A date of the years 1 to 9999 as ``yyyyMMdd`` text."""
    return F.translate(day.cast("string"), "-", "")


def iso_date(value: Column) -> Column:
    """``yyyy-MM-dd`` text as a date; NULL for anything that is no calendar date of year 1 or later."""
    shaped = value.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & ~F.startswith(value, F.lit("0000"))
    return F.when(shaped, value).try_cast("date")


def joined(flags: Sequence[tuple[Column, str]], separator: str = ",") -> Column:
    """The labels whose flag holds, in the given order, as one text."""
    return F.concat_ws(separator, *[F.when(flag, F.lit(label)) for flag, label in flags])


def labels(flags: Sequence[tuple[Column, str]]) -> Column:
    """The labels whose flag holds, in the given order, as an array."""
    if not flags:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(flag, F.lit(label)) for flag, label in flags]))


def with_computed(table: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated exactly once per row.

    A plain projection is copied into every filter on its result, so an expensive verdict
    would run once for the filter and again for the output. A one-row generator is no such
    projection: filters on its columns stay above it. The values are computed in a projection
    of their own below it, see ``apart``. A column of the same name is replaced.
    """
    computed = F.struct(*[value.alias(name) for name, value in columns.items()])
    held = table.select("*", F.array_repeat(computed, apart(F.lit(1))).alias("_computed"))
    return held.drop(*columns).select("*", F.inline_outer("_computed")).drop("_computed")


def apart(value: Column) -> Column:
    """The same value through a lambda.

    Spark generates one method for all projections of a stage, and the JVM interprets methods above 8000 bytes. A
    projection with a lambda in it ends the stage: its expressions are generated as many small methods.
    """
    return F.get(F.transform(F.array(value), lambda same: same), F.lit(0))
