"""Enrichment: categories, descriptions, sensitive columns, data source, inclusion text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.functions.predicates import stripped

OTHER = "Other"
TABLE_FIELDS = ("description", "inclusion_criteria", "data_source", "source_table")

# Tables whose rows are curated or computed, and the class per extraction type.
ENHANCED_TABLES = ("eosinophil_standardized", "standard_profile_data_model",
                   "dv_tokenized_profile_data", "infusion")
DERIVED_TABLES = ("cohort_patients",)
SOURCE_BY_EXTRACTION = {"structured": "Normalized", "unstructured": "NLP", "abstracted": "Abstracted"}
DEFAULT_SOURCE = "Normalized"

# Inclusion text of variables without criteria, per table.
INCLUSION_BY_TABLE = {
    "person": "One record is included for each patient in the cohort.",
    "location": "One record is included for each location referenced by a patient in the cohort.",
    "payer_plan_period": "One record is included for each insurance coverage window for each patient in the cohort.",
    "visit_occurrence": "One record is included for each visit recorded for each patient in the cohort.",
    "visit_detail": "One record is included for each visit-detail segment for each patient in the cohort.",
    "condition_occurrence": "One record is included for each diagnosis recorded for each patient in the cohort.",
    "drug_exposure": "One record is included for each medication exposure recorded for each patient in the cohort.",
    "procedure_occurrence": "One record is included for each procedure recorded for each patient in the cohort.",
    "measurement": "One record is included for each measurement recorded for each patient in the cohort.",
    "observation": "One record is included for each observation recorded for each patient in the cohort.",
    "note": "One record is included for each clinical note recorded for each patient in the cohort.",
    "note_nlp": "One record is included for each NLP-extracted concept identified within a clinical note.",
    "document": "One record is included for each document attached to a patient encounter.",
    "death": "One record is included for each patient with a recorded death.",
    "infusion": "One record is included for each infusion episode recorded for each patient in the cohort.",
}
INCLUSION_DEFAULT = "Records are included for each patient in the cohort."


def category_frame(spark: SparkSession, tables_by_category: Mapping[str, Iterable[str]]) -> DataFrame:
    """{category: [table, …]} as (table, category); the last mention of a table counts."""
    found = {t: c for c, tables in tables_by_category.items() for t in tables or ()}
    return spark.createDataFrame(sorted(found.items()), "table string, category string")


def description_frame(spark: SparkSession, descriptions: Mapping[str, Any]) -> DataFrame:
    """Table descriptions given as a plain text or a mapping, as four trimmed fields."""
    rows = []
    for table, entry in descriptions.items():
        if isinstance(entry, str):
            entry = {"description": entry}
        elif not isinstance(entry, Mapping):
            entry = {}
        rows.append((table, *[str(entry.get(f) or "").strip() for f in TABLE_FIELDS]))
    return spark.createDataFrame(rows, "table string, " + ", ".join(f"{f} string" for f in TABLE_FIELDS))


def column_description_frame(spark: SparkSession, descriptions: Mapping[str, str]) -> DataFrame:
    """{"table.column": text} as (table, column, description)."""
    rows = [(*k.split(".", 1), v) for k, v in descriptions.items()]
    return spark.createDataFrame(rows, "table string, column string, description string")


def sensitive_frame(spark: SparkSession, pairs: Mapping[str, Iterable[str]]) -> DataFrame:
    return spark.createDataFrame([(t, c) for t, cs in pairs.items() for c in cs or ()],
                                 "table string, column string")


def with_category(df: DataFrame, categories: DataFrame, overrides: DataFrame) -> DataFrame:
    """Category of the table: the cohort's own, else the shared map, else Other."""
    shared = categories.select("table", F.col("category").alias("__shared"))
    own = overrides.select("table", F.col("category").alias("__own"))
    return (df.join(shared, "table", "left").join(own, "table", "left")
            .withColumn("category", F.coalesce(F.expr("nullif(__own, '')"), F.expr("nullif(__shared, '')"),
                                               F.lit(OTHER)))
            .drop("__shared", "__own"))


def with_table_description(df: DataFrame, descriptions: DataFrame) -> DataFrame:
    joined = df.join(descriptions, "table", "left")
    for f in TABLE_FIELDS:
        joined = joined.withColumn(f, F.trim(F.coalesce(F.col(f), F.lit(""))))
    return joined


def with_column_description(df: DataFrame, descriptions: DataFrame) -> DataFrame:
    joined = df.join(descriptions, ["table", "column"], "left")
    return joined.withColumn("description", F.coalesce("description", F.lit("")))


def with_sensitive_flag(df: DataFrame, pairs: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """``pii``: the (table, column) pair is listed, or any pattern is found in the column name.

    All patterns are tried in one expression, so no row is joined with every pattern."""
    listed = pairs.select("table", "column").distinct().withColumn("__listed", F.lit(True))
    named = F.lit(False)
    for p in patterns:
        named = named | F.col("column").rlike(p)
    return (df.join(listed, ["table", "column"], "left")
            .withColumn("pii", F.coalesce("__listed", F.lit(False)) | F.coalesce(named, F.lit(False)))
            .drop("__listed"))


def with_field_type(df: DataFrame, inventory: DataFrame) -> DataFrame:
    """Physical type of the variable's column; empty when the column is unknown."""
    types = inventory.select("table", "column", F.col("data_type").alias("field_type"))
    return df.join(types, ["table", "column"], "left").withColumn(
        "field_type", F.coalesce("field_type", F.lit("")))


def data_source(extraction_type: Column, table: Column, explicit: Column,
                enhanced: Iterable[str] = ENHANCED_TABLES, derived: Iterable[str] = DERIVED_TABLES) -> Column:
    given = stripped(explicit)
    kind = F.lower(stripped(extraction_type))
    out = (F.when(given != "", given)
           .when(table.isin(*enhanced), "Enhanced")
           .when(table.isin(*derived), "Derived"))
    for name, label in SOURCE_BY_EXTRACTION.items():
        out = out.when(kind == name, label)
    return out.otherwise(DEFAULT_SOURCE)


def inclusion_text(criteria: Column, explicit: Column, table: Column,
                   defaults: Mapping[str, str] | None = None) -> Column:
    """Given text, else a default per table when there are no criteria, else empty."""
    defaults = INCLUSION_BY_TABLE if defaults is None else defaults
    given = stripped(explicit)
    lookup = F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv]) if defaults else None
    fallback = F.lit(INCLUSION_DEFAULT)
    if lookup is not None:
        fallback = F.coalesce(lookup[stripped(table)], fallback)
    return F.when(given != "", given).when(stripped(criteria) == "", fallback).otherwise("")


def extraction_type(kind: Column, pii: Column) -> Column:
    return (F.when(pii, "PII").when(kind == "unstructured", "Unstructured").otherwise("Structured"))


def exclude_list(config: Mapping[str, Any], candidates: Sequence[str | None],
                 audience: str = "customer", fallback: Iterable[str] = ()) -> set[str]:
    """Tables hidden from an audience.  The first candidate key with a configuration decides:
    ``exclude_tables`` replaces the global list, ``extra_exclude_tables`` adds to it."""
    general = (config.get(audience) or {}).get("exclude_tables")
    general = set(fallback if general is None else general)
    for key in candidates:
        own = ((config.get("cohorts") or {}).get(key) or {}).get(audience) if key else None
        if own:
            if "exclude_tables" in own:
                return set(own["exclude_tables"] or ())
            return general | set(own.get("extra_exclude_tables") or ())
    return general
