"""Column functions on object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_of(uri: Column) -> Column:
    """``s3://bucket/key`` gives ``key``; plain keys and a URI without a key stay as they are."""
    plain = F.replace(uri, F.lit("s3://"), F.lit(""))
    return F.when(
        F.startswith(uri, F.lit("s3://")) & F.contains(plain, F.lit("/")),
        F.regexp_replace(plain, r"(?s)\A[^/]*/", ""),
    ).otherwise(uri)


def base_name(key: Column) -> Column:
    """The part after the last slash."""
    return F.substring_index(key, "/", -1)


def under(prefix: str, key: Column) -> Column:
    """The output key: prefix followed by the whole source key."""
    return F.concat(F.lit(prefix.rstrip("/") + "/"), key)


def decoded(key: Column) -> Column:
    """Undo URL encoding, with ``+`` for a space; a malformed key stays as it is."""
    return F.coalesce(F.try_url_decode(key), key)


def attachment(key: Column) -> Column:
    """Content disposition that offers the object under its base name."""
    return F.concat(F.lit('attachment; filename="'), base_name(key), F.lit('"'))
