"""Structural check of an instance: required tags, modality, dimensions, pixel data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radiolith.functions.values import true_or_false
from radiolith.schemas import REQUIRED_TAGS, SUPPORTED_MODALITIES

SMALLEST_SIDE = 64


def structural_errors() -> list[tuple[Column, Column]]:
    """Condition and message of each error."""
    return [(F.col(tag).isNull(), F.lit(f"Missing required tag: {tag}")) for tag in REQUIRED_TAGS]


def structural_warnings() -> list[tuple[Column, Column]]:
    """Condition and message of each warning; a side of 0 counts as not found."""
    modality, rows, columns = F.col("Modality"), F.col("Rows"), F.col("Columns")
    sized = true_or_false((rows != 0) & (columns != 0))
    small = sized & ((rows < SMALLEST_SIDE) | (columns < SMALLEST_SIDE))
    return [
        (
            true_or_false((modality != "") & ~modality.isin(*SUPPORTED_MODALITIES)),
            F.concat(F.lit("Modality '"), modality, F.lit("' may not be fully supported")),
        ),
        (
            true_or_false(small),
            F.concat(
                F.lit("Image dimensions ("),
                rows.cast("string"),
                F.lit("x"),
                columns.cast("string"),
                F.lit(") are unusually small"),
            ),
        ),
        (~sized, F.lit("Image dimensions not found")),
        (~true_or_false(F.col("has_pixel_data")), F.lit("No pixel data found")),
    ]


def structural_check(instances: DataFrame, keep: Sequence[str] = ("path",)) -> DataFrame:
    """Errors and warnings of each instance; warnings never make it invalid."""

    def messages(entries: list[tuple[Column, Column]]) -> Column:
        return F.array_compact(F.array(*[F.when(flag, message) for flag, message in entries]))

    return instances.select(
        *keep,
        messages(structural_errors()).alias("errors"),
        messages(structural_warnings()).alias("warnings"),
    ).withColumn("is_valid", F.size("errors") == 0)
