"""Storage tiers and expiry by age."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_of(day: date | str) -> Column:
    return F.lit(day).cast("date")


def storage_tiers(listing: DataFrame, as_of: date | str, days: int = 90) -> DataFrame:
    """The tier of each object: infrequent access after ``days``, archive after twice as many."""
    age = F.datediff(_as_of(as_of), F.col("last_modified").cast("date"))
    tier = F.when(age >= 2 * days, "GLACIER").when(age >= days, "STANDARD_IA").otherwise("STANDARD")
    return listing.withColumn("age_days", age).withColumn("storage_class", tier)


def unexpired(logs: DataFrame, as_of: date | str, days: int = 90, column: str = "ts") -> DataFrame:
    """Log rows younger than ``days``. The bound is on the bare column, so it reaches the scan."""
    return logs.where(F.col(column) >= F.date_add(_as_of(as_of), 1 - days).cast("timestamp"))
