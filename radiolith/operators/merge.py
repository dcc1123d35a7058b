"""Merging side metadata into primary metadata, later sources overriding earlier ones; matching events to versions in time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merged_maps(*maps: Column) -> Column:
    """Union of maps. A key's last map wins, also when its value there is NULL."""

    def overlay(earlier: Column, later: Column) -> Column:
        return F.map_concat(F.map_filter(earlier, lambda key, _: ~F.map_contains_key(later, key)), later)

    return reduce(overlay, maps)


def latest_per_key(side: DataFrame, on: Sequence[str], order_by: str) -> DataFrame:
    """One row per key, the last by ``order_by``. Combines before the shuffle, so a hot key sends a row for each task."""
    values = [name for name in side.columns if name not in on]
    return (
        side.groupBy(*on)
        .agg(F.max_by(F.struct(*values), order_by).alias("_latest"))
        .select(*on, *[F.col(f"_latest.{name}").alias(name) for name in values])
    )


def merge_metadata(primary: DataFrame, sides: Sequence[tuple[DataFrame, str]], on: Sequence[str]) -> DataFrame:
    """Primary rows with the columns of each side laid over them, matched on the key columns.

    A side's columns override by presence: where the side has a row for the key its values
    count even if NULL. Each side comes with the column whose greatest value tells the row
    that counts for a key, so primary rows are never multiplied.
    """
    merged = primary
    for number, (repeated, order_by) in enumerate(sides):
        side = latest_per_key(repeated, on, order_by)
        values = [name for name in side.columns if name not in on]
        mark = f"_side_{number}"
        tagged = side.select(*on, F.struct(*values).alias(mark))
        joined = merged.join(tagged, list(on), "left")
        present = F.col(mark).isNotNull()
        columns = []
        for name in [*merged.columns, *[v for v in values if v not in merged.columns]]:
            if name not in values:
                columns.append(F.col(name))
            elif name in merged.columns:
                columns.append(F.when(present, F.col(f"{mark}.{name}")).otherwise(F.col(name)).alias(name))
            else:
                columns.append(F.col(f"{mark}.{name}").alias(name))
        merged = joined.select(*columns)
    return merged


def as_of(
    events: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    at: str = "at",
    version: str = "version",
    slice_of: str = "1 day",
) -> DataFrame:
    """Each event with the ``version`` of its key that was the latest at its time; NULL if there was none yet.

    Both tables have the key columns and ``at``; of versions at one time the greatest counts, and one at the event's own
    time holds. A key's time is cut into slices, within which events and versions are sorted together; the last version
    of a slice is carried to the next slices over one row for each. So a key that holds a large share of all rows is
    spread over its slices. Events without key or time, and versions without, match nothing.
    """
    names = [name for name in events.columns if name not in on]
    slice_start = F.window(at, slice_of)["start"]
    known = [F.col(name).isNotNull() for name in (*on, at)]
    complete = known[0]
    for condition in known[1:]:
        complete = complete & condition
    marked = versions.where(complete & F.col(version).isNotNull())
    left = events.where(complete).select(*on, slice_start.alias("_slice"), F.col(at).alias("_at"), F.lit(1).alias("_side"), F.struct(*names).alias("_event"), F.lit(None).cast(versions.schema[version].dataType).alias("_version"))
    right = marked.select(*on, slice_start.alias("_slice"), F.col(at).alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(left.schema["_event"].dataType).alias("_event"), F.col(version).alias("_version"))
    both = left.union(right)
    within = Window.partitionBy(*on, "_slice").orderBy("_at", "_side", "_version")
    sorted_both = both.withColumn("_own", F.last("_version", ignorenulls=True).over(within)).where("_side = 1")
    ends = both.groupBy(*on, "_slice").agg(F.max_by("_version", F.when(F.col("_side") == 0, F.struct("_at", "_version"))).alias("_end"))
    earlier = Window.partitionBy(*on).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(earlier)).where("_carried IS NOT NULL").drop("_end")
    found = sorted_both.join(carried, [*on, "_slice"], "left").select(
        *[F.col(name) if name in on else F.col(f"_event.{name}").alias(name) for name in events.columns],
        F.coalesce("_own", "_carried").alias(version),
    )
    without = events.where(~complete).withColumn(version, F.lit(None).cast(versions.schema[version].dataType))
    return found.unionByName(without)
