"""The rule catalogue and its evaluation.

A rule is data: code, field, message and the condition under which a row breaks it.
Evaluation is one expression over the row, so any number of rules costs one pass and no
shuffle; conditions are never NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiolith.functions.values import (
    dicom_date,
    is_white,
    iso_date,
    joined,
    real_number,
    strip,
    true_or_false,
    with_computed,
)

UID_TEXT = r"\A[0123456789.]+\z"  # listed, as the JVM looks a listed character up in a table
ISO_TIMESTAMP = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})\z"


class Fields:
    """The columns a rule may look at; a column the table lacks reads as NULL.

    ``prefix`` looks inside a struct column; ``names`` gives the table's names of the fields.
    A number that several rules ask for is the same expression, which Spark evaluates once a row.
    """

    def __init__(self, table: DataFrame, prefix: str = "", names: dict[str, str] | None = None) -> None:
        schema = table.schema[prefix].dataType if prefix else table.schema
        self.types = {field.name: field.dataType for field in schema.fields}
        self.prefix = prefix
        self.names = names or {}

    def __call__(self, field: str) -> Column:
        name = self.names.get(field, field)
        if name not in self.types:
            return F.lit(None).cast("string")
        return F.col(f"{self.prefix}.{name}" if self.prefix else name)

    def number(self, field: str) -> Column:
        """The field as double; NULL if it is no number."""
        kind = self.types.get(self.names.get(field, field), T.StringType())
        return real_number(self(field), kind)


@dataclass(frozen=True)
class Rule:
    code: str
    field: str
    message: str
    broken: Callable[[Fields], Column]


def _matches(code: str, field: str, pattern: str, message: str, required: bool = False) -> Rule:
    def broken(f: Fields) -> Column:
        return (f(field).isNull() if required else F.lit(False)) | true_or_false(~f(field).rlike(pattern))

    return Rule(code, field, message, broken)


def _length(code: str, field: str, least: int, most: int | None, required: bool = True) -> Rule:
    limits = f"at least {least}" if most is None else f"{least} to {most}"

    def broken(f: Fields) -> Column:
        size = F.char_length(f(field))
        outside = size < least if most is None else ~size.between(least, most)
        return (f(field).isNull() if required else F.lit(False)) | true_or_false(outside)

    return Rule(code, field, f"{field} must have {limits} characters", broken)


def _one_of(code: str, field: str, values: Sequence[str]) -> Rule:
    return Rule(
        code, field, f"{field} must be one of {', '.join(values)}", lambda f: true_or_false(~f(field).isin(*values))
    )


def _number(code: str, field: str, least: int, most: int | None = None, whole: bool = False, required: bool = False) -> Rule:
    kind = "a whole number" if whole else "a number"
    limits = f"of at least {least}" if most is None else f"from {least} to {most}"

    def broken(f: Fields) -> Column:
        number = f.number(field)
        inside = (number >= least) if most is None else number.between(least, most)
        if whole:
            inside = inside & (number == F.floor(number))
        wrong = ~true_or_false(inside)
        return wrong if required else f(field).isNotNull() & wrong

    return Rule(code, field, f"{field} must be {kind} {limits}", broken)


def _uid(code_text: str, code_dots: str, field: str) -> tuple[Rule, Rule]:
    return (
        _matches(code_text, field, UID_TEXT, f"{field} must consist of digits and dots", required=True),
        Rule(
            code_dots,
            field,
            f"{field} must not start or end with a dot or have two dots in a row",
            lambda f: true_or_false(
                F.startswith(f(field), F.lit(".")) | F.endswith(f(field), F.lit(".")) | F.contains(f(field), F.lit(".."))
            ),
        ),
    )


def _too_long(f: Fields) -> Column:
    return true_or_false(F.char_length(f("study_description")) > 64) | true_or_false(
        F.char_length(f("accession_number")) > 16
    )


def _too_old(f: Fields) -> Column:
    years = F.when(f("patient_age").rlike(r"\A[0-9]{3}Y\z"), F.substring(f("patient_age"), 1, 3).try_cast("int"))
    return true_or_false(years > 150)


def _no_timestamp(f: Fields) -> Column:
    value = F.when(f("created_at").rlike(ISO_TIMESTAMP), f("created_at"))
    # Seconds of 60 or offsets of 24 hours have the right shape but do not parse.
    return F.try_to_timestamp(value).isNull()


PATIENT = (
    _length("P1", "patient_id", 1, 64),
    Rule("P2", "patient_id", "patient_id must not be blank", lambda f: is_white(f("patient_id"))),
    _one_of("P3", "patient_sex", ("M", "F", "O")),
    _matches("P4", "patient_age", r"\A[0-9]{3}[DWMY]\z", "patient_age must be three digits and one of D, W, M, Y"),
    Rule("P5", "patient_age", "patient_age must not exceed 150 years", _too_old),
)
STUDY = (
    *_uid("S1", "S2", "study_instance_uid"),
    _matches("S3", "study_date", r"\A[0-9]{8}\z", "study_date must have eight digits"),
    Rule(
        "S4",
        "study_date",
        "study_date must be a calendar date",
        lambda f: true_or_false(f("study_date").rlike(r"\A[0-9]{8}\z")) & dicom_date(f("study_date")).isNull(),
    ),
    _matches("S5", "study_time", r"\A[0-9]{6}(\.[0-9]{1,6})?\z", "study_time must be HHMMSS with an optional fraction"),
    Rule("S6", "study_description", "study_description may have 64, accession_number 16 characters", _too_long),
)
SERIES = (
    *_uid("E1", "E2", "series_instance_uid"),
    _number("E3", "series_number", 0, 99999, whole=True),
    _length("E4", "series_description", 0, 64, required=False),
    _length("E5", "modality", 2, 16),
)
IMAGE = (
    _number("I1", "rows", 1, 65535, whole=True),
    _number("I2", "columns", 1, 65535, whole=True),
    _number("I3", "bits_allocated", 1, 64, whole=True),
    _number("I4", "bits_stored", 1, 64, whole=True),
    Rule("I5", "pixel_spacing", "pixel_spacing must have two elements", lambda f: true_or_false(F.size(f("pixel_spacing")) != 2)),
    Rule(
        "I6",
        "bits_stored",
        "bits_stored must not exceed bits_allocated",
        lambda f: true_or_false(f.number("bits_stored") > f.number("bits_allocated")),
    ),
)
CT = (
    _number("C1", "kvp", 0, 200),
    _number("C2", "slice_thickness", 0),
    _number("C3", "reconstruction_diameter", 0),
)
MR = (
    _number("M1", "repetition_time", 0),
    _number("M2", "echo_time", 0),
    _number("M3", "magnetic_field_strength", 0, 20),
)
INSTANCE = (
    _uid("N1", "N1", "sop_instance_uid")
    + _uid("N2", "N2", "sop_class_uid")
    + (_number("N3", "instance_number", 0, whole=True),)
)
CSV_RECORD = (
    _length("V1", "patient_id", 1, None),
    _matches("V2", "study_date", r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z", "study_date must be YYYY-MM-DD", required=True),
    Rule(
        "V3",
        "study_date",
        "study_date must be a calendar date",
        lambda f: true_or_false(f("study_date").rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z")) & iso_date(f("study_date")).isNull(),
    ),
    _length("V4", "modality", 2, None),
    _one_of("V5", "status", ("pending", "completed", "failed")),
)
DELIVERY_FILE = (
    _length("F1", "file_path", 1, None),
    _number("F2", "file_size", 0, whole=True, required=True),
    _length("F3", "checksum", 32, 64),
)
MANIFEST = (
    _length("D1", "manifest_id", 1, None),
    _length("D2", "patient_id", 1, None),
    _length("D3", "study_instance_uid", 1, None),
    Rule("D4", "created_at", "created_at must be an ISO 8601 timestamp with zone", _no_timestamp),
    _number("D5", "total_files", 0, whole=True, required=True),
    _number("D6", "total_size_bytes", 0, whole=True, required=True),
)


def broken_flags(family: Sequence[Rule], fields: Fields, applies: Column | None = None) -> list[tuple[Column, str]]:
    """Condition and code of each rule of a family; two rules with one code are one condition."""
    found: dict[str, Column] = {}
    for rule in family:
        broken = rule.broken(fields)
        found[rule.code] = found[rule.code] | broken if rule.code in found else broken
    return [(flag if applies is None else applies & flag, code) for code, flag in found.items()]


def cross_model_flags(modality: Column, ct_block: Column, mr_block: Column) -> list[tuple[Column, str]]:
    """A CT record must not carry an MR block, nor an MR record a CT block."""
    return [
        (true_or_false(modality == "CT") & mr_block.isNotNull(), "X1"),
        (true_or_false(modality == "MR") & ct_block.isNotNull(), "X2"),
    ]


ALL_RULES = (*PATIENT, *STUDY, *SERIES, *IMAGE, *CT, *MR, *INSTANCE, *CSV_RECORD, *DELIVERY_FILE, *MANIFEST)
_DETAILS = {rule.code: (rule.field, rule.message) for rule in reversed(ALL_RULES)} | {
    "X1": ("mr_metadata", "a CT record must not carry MR metadata"),
    "X2": ("ct_metadata", "an MR record must not carry CT metadata"),
    "D7": ("files", "total_files must equal the number of files"),
}


def with_verdict(table: DataFrame, flags: Sequence[tuple[Column, str]]) -> DataFrame:
    """Add ``error_codes`` (text, in catalogue order) and ``is_valid``.

    The flags are evaluated once, whatever is later filtered by the verdict. Numbers are read where the flags are, not in
    a projection of their own, which would copy every column of the row twice more.
    """
    judged = with_computed(table, error_codes=joined(flags))
    return judged.withColumn("is_valid", F.col("error_codes") == "")


def with_error_details(judged: DataFrame) -> DataFrame:
    """Spell the error codes out as ``errors``: rule, field and message. Valid rows get an empty list."""
    lookup = {
        index: F.create_map(*[F.lit(x) for code, detail in _DETAILS.items() for x in (code, detail[index])])
        for index in (0, 1)
    }
    spelled = F.transform(
        F.split("error_codes", ","),
        lambda code: F.struct(
            code.alias("rule"),
            F.try_element_at(lookup[0], code).alias("field"),
            F.try_element_at(lookup[1], code).alias("message"),
        ),
    )
    empty = F.array().cast("array<struct<rule:string,field:string,message:string>>")
    return judged.withColumn("errors", F.when(F.col("is_valid"), empty).otherwise(spelled))


def validate(table: DataFrame, *families: Sequence[Rule], names: dict[str, str] | None = None) -> DataFrame:
    """A table with the verdict of the given rule families, applied to every row."""
    fields = Fields(table, names=names)
    return with_verdict(table, [flag for family in families for flag in broken_flags(family, fields)])


def image_flags(fields: Fields) -> list[tuple[Column, str]]:
    """Image rules; a row without rows and columns has no image block to judge."""
    return broken_flags(IMAGE, fields, fields("rows").isNotNull() | fields("columns").isNotNull())


def modality_flags(fields: Fields) -> list[tuple[Column, str]]:
    """CT rules on CT rows and MR rules on MR rows."""
    return [
        flag
        for modality, family in (("CT", CT), ("MR", MR))
        for flag in broken_flags(family, fields, true_or_false(fields("modality") == modality))
    ]


def validate_metadata(metadata: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Verdict over extracted metadata of whole instances, or over instances with ``names`` of the tags.

    The cross-model rules cannot break here, as blocks are chosen by modality; records from
    elsewhere go through ``validate_records``.
    """
    return with_verdict(metadata, metadata_flags(metadata, names))


def metadata_flags(metadata: DataFrame, names: dict[str, str] | None = None) -> list[tuple[Column, str]]:
    """The rules of ``validate_metadata``, for a verdict that is computed with other columns."""
    fields = Fields(metadata, names=names)
    flags = [flag for family in (PATIENT, STUDY, SERIES) for flag in broken_flags(family, fields)]
    return flags + image_flags(fields) + modality_flags(fields) + broken_flags(INSTANCE, fields)


def side_metadata_flags(metadata: DataFrame, names: dict[str, str] | None = None) -> list[tuple[Column, str]]:
    """The rules of ``validate_side_metadata``."""
    fields = Fields(metadata, names=names)
    return [flag for family in (PATIENT, STUDY, SERIES, INSTANCE) for flag in broken_flags(family, fields)]


def validate_side_metadata(metadata: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Verdict over metadata from other sources: patient, study, series and instance only."""
    return with_verdict(metadata, side_metadata_flags(metadata, names))


def validate_records(records: DataFrame) -> DataFrame:
    """Verdict over nested records: every block's rules and the cross-model rules.

    Raw records (``extract.raw_records``) get the verdict of their flat metadata; in typed ones an unreadable number is
    already gone.
    """
    flags = []
    for name, family in (
        ("patient", PATIENT),
        ("study", STUDY),
        ("series", SERIES),
        ("image", IMAGE),
        ("ct_metadata", CT),
        ("mr_metadata", MR),
        ("instance", INSTANCE),
    ):
        optional = name in ("image", "ct_metadata", "mr_metadata")
        fields = Fields(records, name)
        flags += broken_flags(family, fields, F.col(name).isNotNull() if optional else None)
    flags += cross_model_flags(F.col("series.modality"), F.col("ct_metadata"), F.col("mr_metadata"))
    return with_verdict(records, flags)


def validate_cross_model(records: DataFrame) -> DataFrame:
    """Verdict of the cross-model rules over nested records."""
    return with_verdict(
        records, cross_model_flags(F.col("series.modality"), F.col("ct_metadata"), F.col("mr_metadata"))
    )


def validate_nested_manifests(manifests: DataFrame) -> DataFrame:
    """Verdict over manifests that carry their files as an array."""
    fields, files = Fields(manifests), F.col("files")
    flags = broken_flags(MANIFEST, fields)
    flags.append((~true_or_false(F.size(files) == fields.number("total_files")), "D7"))
    wrong_file = {
        "F1": F.exists(files, lambda x: ~true_or_false(F.char_length(x["file_path"]) >= 1)),
        "F2": F.exists(files, lambda x: ~true_or_false(x["file_size"] >= 0)),
        "F3": F.exists(files, lambda x: ~true_or_false(F.char_length(x["checksum"]).between(32, 64))),
    }
    flags += [(true_or_false(wrong), code) for code, wrong in wrong_file.items()]
    return with_verdict(manifests, flags)


def responses(judged: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """What a caller is told: status ``valid`` with ids, or ``invalid`` with the broken rules."""
    valid = F.col("is_valid")
    return judged.select(
        *keep,
        F.when(valid, "valid").otherwise("invalid").alias("status"),
        F.when(valid, strip(F.col("patient_id"))).alias("patient_id"),
        F.when(valid, F.col("study_instance_uid")).alias("study_uid"),
        F.when(valid, F.upper("modality")).alias("modality"),
        F.when(~valid, F.col("error_codes")).alias("error"),
        F.when(~valid, F.lit("ValidationError")).alias("error_type"),
    )


def split(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows. Write a routed table instead to pass over the input once."""
    return judged.where("is_valid"), judged.where("NOT is_valid")
