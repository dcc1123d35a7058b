"""De-identification: remove, hash, shift and cap, with a report before and an audit row after.

The whole transform is one projection without a shuffle. Rows that cannot be treated
safely are set aside by ``failure`` and never leave with their original values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radiolith.functions.values import (
    dicom_date,
    dicom_text,
    labels,
    md5_mod,
    salted_hash,
    true_or_false,
    with_computed,
)
from radiolith.schemas import DATE_TAGS, DEID_METHOD, HASH_TAGS, INVENTORY_TAGS, REMOVE_TAGS
from radiolith.sources.header import NUMBERS

SHIFT_RANGE = 730
SHIFT_BACK = 365
OLDEST_SHOWN = 89
OLDEST_LABEL = "090Y"
#: Keys of ``tags`` that name a removed tag, as keyword and as number.
_REMOVED_KEYS = (
    *REMOVE_TAGS,
    *(f"{NUMBERS[t] >> 16:04x},{NUMBERS[t] & 0xFFFF:04x}" for t in REMOVE_TAGS if t in NUMBERS),
)

_SHIFT, _FAILURE = "date_shift_days", "failure"


def _checked(salt: str) -> str:
    if not salt:
        raise ValueError("a salt is required")
    return salt


def remove_tags(instances: DataFrame) -> DataFrame:
    """Drop the removal list, as columns and as keys of ``tags``."""
    left = instances.drop(*REMOVE_TAGS)
    if "tags" not in left.columns:
        return left
    return left.withColumn("tags", F.map_filter("tags", lambda key, _: ~key.isin(*_REMOVED_KEYS)))


def hash_tags(instances: DataFrame, salt: str) -> DataFrame:
    """Replace the hash-list tags by their salted hash; absent stays absent."""
    present = [tag for tag in HASH_TAGS if tag in instances.columns]
    return instances.withColumns({tag: salted_hash(F.col(tag), _checked(salt)) for tag in present})


def date_shift(patient_id: Column, salt: str, fixed: int | None = None) -> Column:
    """Days to shift a patient's dates by: the fixed number, 0 included, or one from -365 to 364."""
    if fixed is not None:
        return F.lit(fixed)
    seed = F.concat(F.coalesce(patient_id, F.lit("unknown")), F.lit(_checked(salt)))
    return md5_mod(seed, SHIFT_RANGE) - F.lit(SHIFT_BACK)


def shifted_day(value: Column, days: Column) -> Column:
    """A date tag as a date moved by days; NULL if it is no date."""
    return F.date_add(dicom_date(value), days)


def _shown_day(moved: Column, original: Column, on_bad_date: str) -> Column:
    """A moved date as text. A tag that was no date is kept, or dropped with ``on_bad_date="null"``."""
    if on_bad_date not in ("keep", "null"):
        raise ValueError(f"on_bad_date must be keep or null, not {on_bad_date!r}")
    shown = dicom_text(moved)
    return F.coalesce(shown, original) if on_bad_date == "keep" else shown


def _any_off_calendar(moved: Sequence[Column]) -> Column:
    """Whether one of a row's moved dates has left the years 1 to 9999."""
    first, last = F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date")
    off = F.lit(False)
    for day in moved:
        off = off | true_or_false(~day.between(first, last))
    return off


def capped_age(age: Column) -> Column:
    """Ages in years above 89 become ``090Y``; every other age stays."""
    return F.when(_years(age) > OLDEST_SHOWN, F.lit(OLDEST_LABEL)).otherwise(age)


def _years(age: Column) -> Column:
    return F.when(F.endswith(age, F.lit("Y")), F.regexp_replace(age, r"Y\z", "").try_cast("bigint"))


def age_unreadable(age: Column) -> Column:
    """An age in years without a number; such a row cannot be capped and fails."""
    return true_or_false(F.endswith(age, F.lit("Y")) & _years(age).isNull())


def cap_age(instances: DataFrame) -> DataFrame:
    return instances.withColumn("PatientAge", capped_age(F.col("PatientAge")))


def remove_private(instances: DataFrame) -> DataFrame:
    """Empty the vendor tags."""
    return instances.withColumn("private_tags", F.create_map().cast("map<string,string>"))


def remove_pixels(instances: DataFrame) -> DataFrame:
    """Drop pixel data and record its absence."""
    return instances.drop("pixel_data").withColumn("has_pixel_data", F.lit(False))


def _with_shift(instances: DataFrame, salt: str, fixed: int | None) -> tuple[DataFrame, dict[str, str]]:
    """Rows with ``date_shift_days`` and each date tag's moved date, and the names of the latter by tag.

    Each step is a projection of its own: the digest is computed once per row and each date
    is parsed once, although later steps use them several times.
    """
    moved = {tag: f"_moved_{tag}" for tag in DATE_TAGS if tag in instances.columns}
    shifted = instances.withColumn(_SHIFT, date_shift(F.col("PatientID"), salt, fixed))
    return shifted.withColumns({name: shifted_day(F.col(tag), F.col(_SHIFT)) for tag, name in moved.items()}), moved


def shift_dates(
    instances: DataFrame, salt: str, fixed: int | None = None, on_bad_date: str = "keep"
) -> DataFrame:
    """Shift the date tags of each row by its patient's days, kept as ``date_shift_days``.

    Where a date would leave the calendar, ``shift_failed`` is set and the row's date tags
    are NULL.
    """
    shifted, moved = _with_shift(instances, salt, fixed)
    checked = with_computed(shifted, shift_failed=_any_off_calendar([F.col(name) for name in moved.values()]))
    changed = {
        tag: F.when(~F.col("shift_failed"), _shown_day(F.col(name), F.col(tag), on_bad_date))
        for tag, name in moved.items()
    }
    return checked.withColumns(changed).drop(*moved.values())


def deidentify_all(
    instances: DataFrame,
    salt: str,
    fixed_shift: int | None = None,
    on_bad_date: str = "keep",
    private_tags: bool = True,
    pixel_data: bool = False,
    keep: Sequence[str] = (),
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """Every row de-identified, with ``date_shift_days`` and ``failure`` (NULL for success).

    The shift comes from the original patient id, so it is computed before the id is hashed.
    A failed row keeps only what is known of its file, its SOPInstanceUID and the columns in
    ``keep``. ``also`` are further columns over the original values, kept for every row: they are
    evaluated with the failure, in the same copy of the row.
    """
    age, also = F.col("PatientAge"), also or {}
    days = date_shift(F.col("PatientID"), salt, fixed_shift)
    moved = {tag: f"_moved_{tag}" for tag in DATE_TAGS if tag in instances.columns}
    shifted = {name: shifted_day(F.col(tag), days) for tag, name in moved.items()}
    # The first condition is looked at for every row, so a date is parsed once for the failure and for what is shown.
    bad_age, no_number = age_unreadable(age), F.lit("PatientAge is not a number of years")
    failure = F.when(
        _any_off_calendar(list(shifted.values())), F.when(bad_age, no_number).otherwise("date shift leaves the calendar")
    ).when(bad_age, no_number)
    computed = {**also, _SHIFT: days, **shifted, _FAILURE: failure}
    judged = with_computed(instances, **computed)
    changed = {tag: _shown_day(F.col(name), F.col(tag), on_bad_date) for tag, name in moved.items()}
    changed |= {tag: salted_hash(F.col(tag), salt) for tag in HASH_TAGS if tag in instances.columns}
    changed["PatientAge"] = capped_age(age)
    if private_tags and "private_tags" in instances.columns:
        changed["private_tags"] = F.create_map().cast("map<string,string>")
    if pixel_data and "has_pixel_data" in instances.columns:
        changed["has_pixel_data"] = F.lit(False)
    if "tags" in instances.columns:
        changed["tags"] = F.map_filter("tags", lambda key, _: ~key.isin(*_REMOVED_KEYS))
    changed["PatientIdentityRemoved"] = F.lit("YES")
    changed["DeidentificationMethod"] = F.lit(DEID_METHOD)

    dropped = {*REMOVE_TAGS, *moved.values(), "pixel_data" if pixel_data else ""}
    safe = {"path", "length", "modificationTime", "SOPInstanceUID", _SHIFT, _FAILURE, *keep, *also}
    columns = []
    for name in [c for c in judged.columns if c not in dropped] + [n for n in changed if n not in judged.columns]:
        value = changed.get(name, F.col(name) if name in judged.columns else None)
        columns.append((value if name in safe else F.when(F.col(_FAILURE).isNull(), value)).alias(name))
    return judged.select(*columns)


def deidentified(instances: DataFrame, salt: str, **options) -> DataFrame:
    """The rows that could be de-identified."""
    return deidentify_all(instances, salt, **options).where(F.col(_FAILURE).isNull()).drop(_FAILURE, _SHIFT)


def deid_failures(instances: DataFrame, salt: str, **options) -> DataFrame:
    """Path, SOPInstanceUID and reason of the rows that could not be de-identified."""
    everything = deidentify_all(instances, salt, **options)
    return everything.where(F.col(_FAILURE).isNotNull()).select("path", "SOPInstanceUID", _FAILURE)


def _present(instances: DataFrame, tags: Sequence[str]) -> list[tuple[Column, str]]:
    """A tag is present where it is not NULL; an empty value counts."""
    return [(F.col(tag).isNotNull(), tag) for tag in tags if tag in instances.columns]


def deid_report(instances: DataFrame, keep: Sequence[str] = ("path",)) -> DataFrame:
    """Per instance, before de-identification: which tags will be removed, hashed and shifted."""
    private = (
        F.coalesce(F.cardinality("private_tags"), F.lit(0)) if "private_tags" in instances.columns else F.lit(0)
    )
    found = instances.select(
        *keep,
        labels(_present(instances, REMOVE_TAGS)).alias("tags_to_remove"),
        labels(_present(instances, HASH_TAGS)).alias("tags_to_hash"),
        labels(_present(instances, DATE_TAGS)).alias("tags_to_shift"),
        private.alias("private_tags_count"),
    )
    everything = F.concat("tags_to_remove", "tags_to_hash", "tags_to_shift")
    return found.withColumn("phi_tags_present", everything).withColumn(
        "total_phi_elements", F.size("phi_tags_present")
    )


def phi_inventory(instances: DataFrame, keep: Sequence[str] = ("path",)) -> DataFrame:
    """Per instance: the identifying tags that are present and not empty."""
    filled = [(true_or_false(F.col(t) != ""), t) for t in INVENTORY_TAGS if t in instances.columns]
    return instances.select(*keep, labels(filled).alias("phi_tags"))


def phi_totals(instances: DataFrame) -> DataFrame:
    """Per tag of the policy: how many rows carry it. One pass, one partial row per task."""
    tags = [tag for tag in REMOVE_TAGS + HASH_TAGS + DATE_TAGS if tag in instances.columns]
    counted = instances.agg(*[F.count(tag).alias(tag) for tag in tags])
    return counted.unpivot([], tags, "tag", "row_count")


def audit_rows(
    instances: DataFrame,
    salt: str,
    user: str = "deidentification-service",
    private_tags_removed: bool = True,
    fixed_shift: int | None = None,
) -> DataFrame:
    """One audit record per instance. It names the patient by hash only, never in clear."""
    treated = deidentify_all(instances, salt, fixed_shift=fixed_shift)
    success = F.col(_FAILURE).isNull()
    return treated.select(
        F.lit(True).alias("audit_event"),
        F.lit("phi_deidentification").alias("event_type"),
        F.lit(user).alias("user"),
        F.concat(F.lit("DICOM:"), F.coalesce("SOPInstanceUID", F.lit("unknown"))).alias("resource"),
        F.lit("deidentify").alias("action"),
        F.when(success, "success").otherwise("failure").alias("result"),
        F.struct(
            F.coalesce("PatientID", F.lit("")).alias("hashed_patient_id"),
            F.col(_SHIFT),
            F.lit(private_tags_removed).alias("private_tags_removed"),
        ).alias("details"),
    )
