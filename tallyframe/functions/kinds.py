"""Column classification: metric kind, key columns, free-text columns."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F, types as T

CONTINUOUS = "continuous"
DATE = "date"
UNSTRUCTURED = "unstructured"
CATEGORICAL = "categorical"

# Type names per metric kind (warehouse names and Spark names).
CONTINUOUS_TYPES = (
    "integer", "bigint", "smallint", "numeric", "real", "double precision",
    "tinyint", "int", "decimal", "float", "double",
)
DATE_TYPES = (
    "date", "timestamp without time zone", "timestamp with time zone",
    "time without time zone", "time with time zone",
    "timestamp", "timestamp_ntz", "time",
)
UNSTRUCTURED_TYPES = ("text",)

# Columns that identify rather than measure.
KEY_NAMES = ("person_id", "visit_occurrence_id", "visit_detail_id")
KEY_SUFFIXES = ("_id", "_concept_id")

FREETEXT_NAME = r"(_text|_note)$"


def metric_kind(type_name: Column) -> Column:
    """Metric kind of a type name; parameters such as ``decimal(10,2)`` are ignored."""
    base = F.trim(F.regexp_replace(F.lower(type_name), r"\(.*\)", ""))
    return (
        F.when(base.isin(*CONTINUOUS_TYPES), CONTINUOUS)
        .when(base.isin(*DATE_TYPES), DATE)
        .when(base.isin(*UNSTRUCTURED_TYPES), UNSTRUCTURED)
        .otherwise(CATEGORICAL)
    )


def is_surrogate_key(column: Column, suffixes: Iterable[str] = KEY_SUFFIXES,
                     names: Iterable[str] = KEY_NAMES) -> Column:
    test = column.isin(*names)
    for suffix in suffixes:
        test = test | column.endswith(suffix)
    return test


def is_freetext(column: Column) -> Column:
    return column.rlike(FREETEXT_NAME)


def field_kind(field: T.StructField, override: str | None = None) -> str:
    """Kind of a schema field.  Spark has one string type, so free text needs an
    override or a telling name; everything not numeric, date or text is categorical."""
    if override:
        return override
    if isinstance(field.dataType, T.NumericType):
        return CONTINUOUS
    if re.sub(r"\(.*\)", "", field.dataType.simpleString()) in DATE_TYPES:
        return DATE
    if isinstance(field.dataType, T.StringType) and re.search(FREETEXT_NAME, field.name):
        # varchar/char fields of a table are declared categories even so
        if "__CHAR_VARCHAR_TYPE_STRING" not in field.metadata:
            return UNSTRUCTURED
    return CATEGORICAL


def name_is_surrogate_key(name: str, suffixes: Iterable[str] = KEY_SUFFIXES,
                          names: Iterable[str] = KEY_NAMES) -> bool:
    return name in set(names) or name.endswith(tuple(suffixes))


def name_is_freetext(name: str) -> bool:
    return re.search(FREETEXT_NAME, name) is not None
