"""Views of a model per audience: which rows, which sections, which columns."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions import text
from tallyframe.operators.enrich import exclude_list
from tallyframe.plans.model import Model

# Sections shown per audience.
VISIBILITY = {
    "technical": {"summary": True, "tables": True, "columns": True, "variables": True},
    "sales": {"summary": True, "tables": True, "columns": False, "variables": True},
    "pharma": {"summary": True, "tables": False, "columns": False, "variables": True},
    "customer": {"summary": True, "tables": True, "columns": True, "variables": True},
}
STAKEHOLDERS = ("customer", "sales")
# Tables hidden from stakeholders when nothing is configured.
DEFAULT_EXCLUDES = ("standard_profile_data_model", "cohort_patients", "dv_tokenized_profile_data")

# Metrics of the summary, (key, title); titles are None where dates merge.
SUMMARY_TECHNICAL = (
    ("cohort", "Cohort"), ("provider", "Provider"), ("disease", "Disease"),
    ("display_name", "Display name"), ("schema_name", "Schema"), ("variant", "Variant"),
    ("patient_count", "Patient count"), ("table_count", "Table count"), ("column_count", "Column count"),
    ("min_date", None), ("max_date", None), ("years_of_data", None), (None, "Date coverage"),
    ("status", "Status"), ("generated_at", "Generated at"), ("git_sha", "Git SHA"),
    ("introspect_version", "Introspect version"), ("schema_snapshot_digest", "Schema snapshot"),
)
SUMMARY_CUSTOMER = (
    ("cohort", "Cohort"), ("provider", "Provider"), ("disease", "Disease"),
    ("display_name", "Display name"), ("schema_name", "Schema"),
    ("patient_count", "Patient count"), ("table_count", "Table count"),
    ("min_date", None), ("max_date", None), ("years_of_data", None), (None, "Date coverage"),
    ("generated_at", "Generated at"),
)
# Titles of the section columns, in order, with the model field behind each.
TABLES_TECHNICAL = (
    ("Table", "table"), ("Category", "category"), ("Description", "description"),
    ("Inclusion Criteria", "inclusion_criteria"), ("Data Source", "data_source"),
    ("Source Table", "source_table"), ("Rows", "row_count"), ("Columns", "column_count"),
    ("Patients", "patients_text"),
)
TABLES_CUSTOMER = (
    ("Table", "table"), ("Category", "category"), ("Description", "description"),
    ("Inclusion Criteria", "inclusion_criteria"), ("Rows", "row_count"), ("Columns", "column_count"),
    ("Patients", "patients_text"),
)
COLUMNS_TECHNICAL = (
    ("Category", "category"), ("Table(s)", "table"), ("Column", "column"),
    ("Description", "description"), ("Field Type", "data_type"), ("Nullable", "nullable"),
    ("Example", "example"), ("Coding Schema", "coding_schema"), ("Values", "values"),
    ("Distribution", "distribution"), ("Median (IQR)", "median_iqr"),
    ("Completeness", "completeness_text"), ("% Patient", "patient_text"),
    ("Data Source", "data_source"), ("PII", "pii_text"), ("Notes", "notes"),
)
COLUMNS_CUSTOMER = (
    ("Table(s)", "table"), ("Column", "column"), ("Description", "description"),
    ("Field Type", "data_type"),
)
VARIABLES_HEAD = (
    ("Category", "category"), ("Variable", "variable"), ("Description", "description"),
    ("Inclusion Criteria", "inclusion_criteria"), ("Table(s)", "table"), ("Column(s)", "column"),
    ("Criteria", "criteria"),
)
VARIABLES_TECHNICAL = VARIABLES_HEAD + (
    ("Field Type", "field_type"), ("Example", "example"), ("Coding Schema", "coding_schema"),
    ("Values", "values"), ("Distribution", "distribution"), ("Median (IQR)", "median_iqr"),
    ("Completeness", "completeness_text"), ("Implemented", "implemented"),
    ("% Patients With Value", "patient_text"), ("Data Source", "data_source"), ("Notes", "notes"),
)
VARIABLES_PHARMA = VARIABLES_HEAD + (
    ("Field Type", "field_type"), ("Example", "example"), ("Coding Schema", "coding_schema"),
    ("Observed Values", "observed_values"), ("Distribution", "distribution"),
    ("Median (IQR)", "median_iqr"), ("Implemented", "implemented"),
    ("% Patients With Value", "patient_text"), ("Data Source", "data_source"), ("Notes", "notes"),
)
VARIABLES_CUSTOMER = VARIABLES_HEAD + (
    ("Field Type", "field_type"), ("Example", "example"), ("Observed Values", "observed_values"),
    ("% Patients With Value", "patient_text"), ("Notes", "notes"),
)
VARIABLES_SALES = (
    ("Category", "category"), ("Variable", "variable"), ("Description", "description"),
    ("Observed Values", "observed_values"), ("Notes", "notes"), ("Type", "extraction_type"),
    ("Proposal", "proposal"), ("% Patients With Value", "patient_text"),
)
LAYOUTS = {
    "technical": (SUMMARY_TECHNICAL, TABLES_TECHNICAL, COLUMNS_TECHNICAL, VARIABLES_TECHNICAL),
    "pharma": (SUMMARY_TECHNICAL, TABLES_TECHNICAL, COLUMNS_TECHNICAL, VARIABLES_PHARMA),
    "customer": (SUMMARY_CUSTOMER, TABLES_CUSTOMER, COLUMNS_CUSTOMER, VARIABLES_CUSTOMER),
    "sales": (SUMMARY_CUSTOMER, TABLES_CUSTOMER, COLUMNS_CUSTOMER, VARIABLES_SALES),
}


def visible(audience: str, section: str) -> bool:
    return VISIBILITY[audience][section]


def drop_sensitive(df: DataFrame) -> DataFrame:
    return df.where(~F.col("pii"))


def drop_tables(df: DataFrame, excluded: set[str]) -> DataFrame:
    return df.where(~F.col("table").isin(sorted(excluded))) if excluded else df


def view(model: Model, audience: str, layout: dict | None = None) -> Model:
    """The model as one audience may see it; all steps are narrow filters.

    Everyone but technical loses sensitive rows; stakeholders also lose internal tables and,
    unless the model is a dry run, variables without data."""
    shown = VISIBILITY[audience]
    if audience == "technical":
        return model
    tables, columns, variables = model.tables, drop_sensitive(model.columns), drop_sensitive(model.variables)
    if audience in STAKEHOLDERS:
        spec = model.spec
        hidden = exclude_list(layout or {}, [spec.slug, spec.cohort, spec.schema_name],
                              fallback=DEFAULT_EXCLUDES)
        tables, columns, variables = (drop_tables(f, hidden) for f in (tables, columns, variables))
        if not model.dry_run:
            variables = variables.where("implemented = 'Yes'")
    return replace(
        model, tables=tables if shown["tables"] else tables.limit(0),
        columns=columns if shown["columns"] else columns.limit(0), variables=variables)


def _project(df: DataFrame, layout) -> DataFrame:
    return df.select(*[F.col(f"`{source}`").alias(title) for title, source in layout])


def coverage_line() -> Column:
    line = F.concat(F.col("min_date"), F.lit(" → "), F.col("max_date"), F.lit(" ("),
                    F.coalesce(F.col("years_of_data").cast("string"), F.lit("None")), F.lit(" years)"))
    return F.when(F.col("min_date").isNotNull(), line).otherwise(text.DASH)


def _pairs(summary: DataFrame, entries) -> DataFrame:
    """A one-row frame as ordered (metric, value) rows."""
    rows = [F.struct(F.lit(i).alias("position"), F.lit(name).alias("metric"), value.cast("string").alias("value"))
            for i, (name, value) in enumerate(entries)]
    return summary.select(F.inline(F.array(*rows)))


def summary_rows(model: Model, audience: str) -> DataFrame:
    """(position, metric, value) rows under the plain keys."""
    return _pairs(model.summary, [(k, F.col(k)) for k, _ in LAYOUTS[audience][0] if k])


def summary_titles(model: Model, audience: str) -> DataFrame:
    """The same under display titles, with the dates merged into one line."""
    return _pairs(model.summary, [(t, F.col(k) if k else coverage_line()) for k, t in LAYOUTS[audience][0] if t])


def tables_layout(tables: DataFrame, audience: str) -> DataFrame:
    patients = F.coalesce(F.col("subject_count").cast("string"), F.lit(text.DASH))
    return _project(tables.withColumn("patients_text", patients), LAYOUTS[audience][1])


def columns_layout(columns: DataFrame, audience: str) -> DataFrame:
    shown = (
        columns.withColumn("completeness_text", F.expr(text.percent("completeness_pct")))
        .withColumn("patient_text", F.expr(text.percent("patient_pct")))
        .withColumn("pii_text", F.when(F.col("pii"), "Yes").otherwise("")))
    return _project(shown, LAYOUTS[audience][2])


def variables_layout(variables: DataFrame, audience: str) -> DataFrame:
    shown = (
        variables.withColumn("completeness_text", F.expr(text.percent("completeness_pct")))
        .withColumn("patient_text", F.expr(text.percent("patient_pct"))))
    return _project(shown, LAYOUTS[audience][3])


def sections(model: Model, audience: str, layout: dict | None = None) -> dict[str, DataFrame]:
    """The visible sections of an audience, ready to be written."""
    seen = view(model, audience, layout)
    out = {"summary": summary_rows(seen, audience).orderBy("position").select("metric", "value")}
    for name, render, frame in (("tables", tables_layout, seen.tables),
                                ("columns", columns_layout, seen.columns),
                                ("variables", variables_layout, seen.variables)):
        if visible(audience, name):
            out[name] = render(frame, audience)
    return out
