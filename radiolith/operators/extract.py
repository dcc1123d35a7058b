"""Metadata projections: tags to flat metadata, nested records, records and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiolith.functions.values import apart, is_blank, labels, only_whole, real_number, strip, with_computed
from radiolith.operators.structural import structural_errors, structural_warnings

# Metadata name of each base tag.
BASE_FIELDS = {
    "patient_id": "PatientID",
    "patient_name": "PatientName",
    "patient_birth_date": "PatientBirthDate",
    "patient_sex": "PatientSex",
    "patient_age": "PatientAge",
    "study_instance_uid": "StudyInstanceUID",
    "study_date": "StudyDate",
    "study_time": "StudyTime",
    "study_description": "StudyDescription",
    "accession_number": "AccessionNumber",
    "series_instance_uid": "SeriesInstanceUID",
    "series_number": "SeriesNumber",
    "series_description": "SeriesDescription",
    "modality": "Modality",
    "sop_instance_uid": "SOPInstanceUID",
    "sop_class_uid": "SOPClassUID",
    "instance_number": "InstanceNumber",
    "rows": "Rows",
    "columns": "Columns",
    "bits_allocated": "BitsAllocated",
    "bits_stored": "BitsStored",
    "pixel_spacing": "PixelSpacing",
}
CT_FIELDS = {
    "kvp": "KVP",
    "slice_thickness": "SliceThickness",
    "reconstruction_diameter": "ReconstructionDiameter",
}
MR_FIELDS = {
    "repetition_time": "RepetitionTime",
    "echo_time": "EchoTime",
    "magnetic_field_strength": "MagneticFieldStrength",
}
INTEGER_FIELDS = ("series_number", "instance_number", "rows", "columns", "bits_allocated", "bits_stored")


def base_metadata(instances: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 22 base fields under their metadata names, after the columns to keep."""
    return instances.select(*keep, *_base_columns())


def extract_metadata(instances: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Base fields and the fields of the row's modality; the test for CT and MR is case-sensitive."""
    return instances.select(*keep, *_base_columns(), *_modality_columns())


def modality_metadata(instances: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Only the modality-specific fields: CT rows have the CT ones, MR rows the MR ones."""
    return instances.select(*keep, F.col("Modality").alias("modality"), *_modality_columns())


def _base_columns() -> list[Column]:
    columns = []
    for name, tag in BASE_FIELDS.items():
        value = F.coalesce(F.col(tag), F.lit("")) if name == "patient_name" else F.col(tag)
        columns.append(value.alias(name))
    return columns


def _modality_columns() -> list[Column]:
    return [
        F.when(F.col("Modality") == modality, F.col(tag)).alias(name)
        for modality, fields in (("CT", CT_FIELDS), ("MR", MR_FIELDS))
        for name, tag in fields.items()
    ]


def tag_value(instances: DataFrame, tag: str, default: str | None = None) -> Column:
    """A tag's value or a default; an unknown keyword is looked up in ``tags``, never an error."""
    if tag in instances.columns:
        value = F.col(tag)
    elif "tags" in instances.columns:
        value = F.try_element_at(F.col("tags"), F.lit(tag))
    else:
        value = F.lit(None).cast("string")
    return value if default is None else F.coalesce(value, F.lit(default))


def normalized(metadata: DataFrame) -> DataFrame:
    """Patient id without surrounding white space, modality in upper case."""
    return metadata.withColumns({"patient_id": strip(F.col("patient_id")), "modality": F.upper("modality")})


def nested_records(metadata: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One typed record per row of flat metadata.

    ``image`` exists where rows or columns are set; ``ct_metadata`` and ``mr_metadata``
    where the modality matches and one of their fields is set. Numbers that cannot be read
    become NULL here and are reported by the rules over the flat metadata.
    """
    types = {field.name: field.dataType for field in metadata.schema.fields}
    numeric = (*INTEGER_FIELDS, *CT_FIELDS, *MR_FIELDS)
    numbers = with_computed(metadata, **{f"_number_{n}": real_number(F.col(n), types[n]) for n in numeric})

    def text(name: str) -> Column:
        return F.col(name).alias(name)

    def whole(name: str) -> Column:
        return only_whole(F.col(f"_number_{name}")).try_cast("int").alias(name)

    def real(name: str) -> Column:
        return F.col(f"_number_{name}").alias(name)

    def block(modality: str, fields: Sequence[str]) -> Column:
        present = (F.col("modality") == modality) & F.coalesce(*[F.col(f).cast("string") for f in fields]).isNotNull()
        return F.when(present, F.struct(*[real(f) for f in fields]))

    return numbers.select(
        *keep,
        F.struct(strip(F.col("patient_id")).alias("patient_id"), text("patient_sex"), text("patient_age")).alias("patient"),
        F.struct(
            *[text(n) for n in ("study_instance_uid", "study_date", "study_time", "study_description", "accession_number")]
        ).alias("study"),
        F.struct(
            text("series_instance_uid"),
            whole("series_number"),
            text("series_description"),
            F.upper("modality").alias("modality"),
        ).alias("series"),
        F.struct(text("sop_instance_uid"), text("sop_class_uid"), whole("instance_number")).alias("instance"),
        F.when(
            F.col("rows").isNotNull() | F.col("columns").isNotNull(),
            F.struct(
                whole("rows"), whole("columns"), whole("bits_allocated"), whole("bits_stored"), text("pixel_spacing")
            ),
        ).alias("image"),
        block("CT", list(CT_FIELDS)).alias("ct_metadata"),
        block("MR", list(MR_FIELDS)).alias("mr_metadata"),
    )


def raw_records(metadata: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The records of ``nested_records`` before typing: numbers are VARIANT values as they came, the id is unstripped.

    Rules over these see what the flat metadata says, so an unreadable number or an id that is too long is reported.
    ``typed_records`` makes numbers of them.
    """

    def block(modality: str, fields: Sequence[str]) -> Column:
        present = (F.col("modality") == modality) & F.coalesce(*[F.col(f).cast("string") for f in fields]).isNotNull()
        return F.when(present, F.struct(*[raw(f) for f in fields]))

    def raw(name: str) -> Column:
        return F.col(name).cast("variant").alias(name)

    study = ("study_instance_uid", "study_date", "study_time", "study_description", "accession_number")
    image = ("rows", "columns", "bits_allocated", "bits_stored")
    return metadata.select(
        *keep,
        F.struct("patient_id", "patient_sex", "patient_age").alias("patient"),
        F.struct(*study).alias("study"),
        F.struct(
            "series_instance_uid", raw("series_number"), "series_description", F.upper("modality").alias("modality")
        ).alias("series"),
        F.struct("sop_instance_uid", "sop_class_uid", raw("instance_number")).alias("instance"),
        F.when(
            F.col("rows").isNotNull() | F.col("columns").isNotNull(), F.struct(*[raw(n) for n in image], "pixel_spacing")
        ).alias("image"),
        block("CT", list(CT_FIELDS)).alias("ct_metadata"),
        block("MR", list(MR_FIELDS)).alias("mr_metadata"),
    )


def typed_records(records: DataFrame) -> DataFrame:
    """Raw records with numbers for their VARIANT values, NULL where a value is none, and a stripped patient id."""

    def typed(block: str, field: T.StructField) -> Column:
        value = F.col(f"{block}.{field.name}")
        if field.name == "patient_id":
            return strip(value).alias(field.name)
        if not isinstance(field.dataType, T.VariantType):
            return value.alias(field.name)
        number = real_number(value, field.dataType)
        return (only_whole(number).try_cast("int") if field.name in INTEGER_FIELDS else number).alias(field.name)

    columns, one_apart = [], False
    for column in records.schema.fields:
        if isinstance(column.dataType, T.StructType):
            own = F.struct(*[typed(column.name, field) for field in column.dataType.fields])
            block = F.when(F.col(column.name).isNotNull(), own)
            columns.append((block if one_apart else apart(block)).alias(column.name))
            one_apart = True
        else:
            columns.append(F.col(column.name))
    return records.select(*columns)


def row_records(table: DataFrame, name: str = "record") -> DataFrame:
    """Each row as one JSON record; empty cells stay as explicit nulls."""
    return table.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def summaries(instances: DataFrame, keep: Sequence[str] = ("path",)) -> DataFrame:
    """A readable summary of each instance with the outcome of the structural check."""

    def shown(tag: str) -> Column:
        return F.coalesce(F.col(tag).cast("string"), F.lit("None"))

    def section(title: str, entries: list[tuple[Column, Column]]) -> list[Column]:
        shown_any = entries[0][0]
        for flag, _ in entries[1:]:
            shown_any = shown_any | flag
        heading = F.when(shown_any, F.lit(f"\n{title}:"))
        return [heading] + [F.when(flag, F.concat(F.lit("  - "), message)) for flag, message in entries]

    errors, warnings = structural_errors(), structural_warnings()
    invalid = errors[0][0]
    for flag, _ in errors[1:]:
        invalid = invalid | flag
    lines = [
        F.lit("DICOM File Summary"),
        F.lit("=" * 50),
        F.concat(F.lit("Modality: "), shown("Modality")),
        F.concat(F.lit("Study UID: "), shown("StudyInstanceUID")),
        F.concat(F.lit("Series UID: "), shown("SeriesInstanceUID")),
        F.concat(F.lit("SOP Instance UID: "), shown("SOPInstanceUID")),
        F.concat(F.lit("Dimensions: "), shown("Rows"), F.lit("x"), shown("Columns")),
        F.when(invalid, "Valid: No").otherwise("Valid: Yes"),
        *section("Errors", errors),
        *section("Warnings", warnings),
    ]
    return instances.select(*keep, F.concat_ws("\n", *lines).alias("summary"))


def required_fields(table: DataFrame, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Which of the requested fields are present and which are missing, in request order.

    NULL, empty text and empty lists are missing, as is a field the table does not have.
    """
    types: dict[str, T.DataType] = {field.name: field.dataType for field in table.schema.fields}
    missing = [(is_blank(F.col(f), types[f]) if f in types else F.lit(True), f) for f in fields]
    return table.select(
        *keep,
        labels(missing).alias("missing_fields"),
        labels([(~flag, name) for flag, name in missing]).alias("present_fields"),
    ).withColumn("is_valid", F.size("missing_fields") == 0)
