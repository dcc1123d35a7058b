"""CSV, JSON and XML side files, read with declared schemas.

A missing path raises, as for any Spark reader. A malformed record is kept as a row whose
``_corrupt_record`` holds the text, unless ``mode="FAILFAST"`` asks for an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiolith.schemas import CSV_RECORD, JSON_STUDY, XML_STUDY

CORRUPT = "_corrupt_record"


def with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.names:
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = CSV_RECORD,
    delimiter: str = ",",
    encoding: str = "utf-8",
    mode: str = "PERMISSIVE",
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header row; blank cells are NULL. Quoted cells may hold line breaks, so a file is one task;
    where they do not, ``multi_line=False`` lets Spark split files."""
    return (
        spark.read.schema(with_corrupt(schema))
        .option("header", "true")
        .option("sep", delimiter)
        .option("encoding", encoding)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", "false")
        .option("multiLine", str(multi_line).lower())
        .csv(path)
    )


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType = JSON_STUDY,
    encoding: str = "utf-8",
    mode: str = "PERMISSIVE",
    one_per_line: bool = False,
) -> DataFrame:
    """JSON documents: an object is one row, an array is one row per element.

    A document file is read whole by one task; large collections should come as one
    document per line (``one_per_line``), which splits.
    """
    return (
        spark.read.schema(with_corrupt(schema))
        .option("multiLine", str(not one_per_line).lower())
        .option("encoding", encoding)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_xml(
    spark: SparkSession,
    path: str,
    schema: T.StructType = XML_STUDY,
    row_tag: str = "imaging_study",
    encoding: str = "utf-8",
    mode: str = "PERMISSIVE",
    whole_documents: bool = True,
) -> DataFrame:
    """XML elements named ``row_tag``, one row each. Attributes are fields with a leading underscore.

    A document file is read whole by one task; collections of elements without a common
    root (``whole_documents=False``) are split.
    """
    return (
        spark.read.format("xml")
        .schema(with_corrupt(schema))
        .option("rowTag", row_tag)
        .option("multiLine", str(whole_documents).lower())
        .option("encoding", encoding)
        .option("mode", mode)
        .option("attributePrefix", "_")
        .option("valueTag", "_VALUE")
        .option("nullValue", "")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .load(path)
    )


def parse_xml(text: Column, schema: T.StructType = XML_STUDY, legacy_leaf_attrs: bool = False) -> Column:
    """An XML element in a text column as a nested record.

    Repeated children are arrays; empty elements are NULL. With ``legacy_leaf_attrs`` an
    element that has text and attributes but no children gives its text only.
    """
    options = {"attributePrefix": "_", "valueTag": "_VALUE", "nullValue": "", "mode": "PERMISSIVE"}
    parsed = F.from_xml(text, schema.simpleString(), options)
    return _without_leaf_attrs(parsed, schema) if legacy_leaf_attrs else parsed


def _without_leaf_attrs(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _without_leaf_attrs(item, kind.elementType))
    if not isinstance(kind, T.StructType):
        return value
    children = [f for f in kind.fields if not f.name.startswith("_")]
    if "_VALUE" in kind.names and not children:
        return value["_VALUE"]
    parts = [_without_leaf_attrs(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
    return F.when(value.isNotNull(), F.struct(*parts))
