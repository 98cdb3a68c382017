"""Measure every variable of a catalogue, one fused set of aggregates per source table."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from tallyframe.functions.errors import first_line, is_data_error, isolated
from tallyframe.functions import kinds, predicates as pr, text
from tallyframe.operators import enrich, measures as ms
from tallyframe.plans.profile import share_of_subjects
from tallyframe.sources.catalog import require_inlined
from tallyframe.sources import catalog as ct
from tallyframe.sources.registry import Registry, Table
from tallyframe.sources.sinks import materialize

VARIABLE_TOP = 10
DEFAULT_EXTRACTION = "Structured"
ALL_PARTS = frozenset({"counts", "dates", "top", "quartiles", "subjects"})

VARIABLE_COLUMNS = (
    "category", "variable", "description", "table", "column", "criteria", "n_scope", "n_nonnull",
    "completeness_pct", "implemented", "min_date", "max_date", "q1", "median", "q3", "top_values",
    "subject_count", "patient_pct", "extraction_type", "notes", "field_type", "free_text",
    "inclusion_criteria", "coding_schema", "data_source", "proposal", "error", "first_rank", "position",
)


@dataclass(frozen=True)
class Planned:
    """A catalogue row turned into a measure of its table, or the reason why it could not be."""
    key: str
    table: str
    measure: ms.Measure | None
    membership: tuple[str, list[str]] | None
    error: str


def prepare(catalog: DataFrame) -> DataFrame:
    """Defaults and derived fields of catalogue rows, without touching any data."""
    extraction = F.coalesce(F.expr("nullif(extraction_type, '')"), F.lit(DEFAULT_EXTRACTION))
    out = catalog
    for field in ("first_rank", "first_position"):
        if field not in out.columns:
            out = out.withColumn(field, F.col("layer_rank") if field == "first_rank" else F.col("position"))
    return (
        out
        .withColumn("variable", F.coalesce(F.expr("nullif(variable, '')"), F.col("column")))
        .withColumn("criteria", ct.effective_criteria(F.col("criteria"), F.col("match")))
        .withColumn("extraction_type", extraction)
        .withColumn("inclusion_criteria", enrich.inclusion_text(
            F.col("criteria"), F.col("inclusion_criteria"), F.col("table")))
        .withColumn("data_source", enrich.data_source(
            F.col("extraction_type"), F.col("table"), F.col("data_source")))
        .withColumn("coding_schema", pr.stripped(F.col("coding_schema")))
        .withColumn("proposal", pr.stripped(F.col("proposal")))
        .withColumns({f: F.coalesce(f, F.lit("")) for f in ("category", "description", "table", "column", "notes")})
        .withColumn("free_text", (F.lower("extraction_type") == "unstructured") | kinds.is_freetext(F.col("column")))
    )


def _type_of(table: Table, column: Column) -> T.DataType:
    return table.data.select(column).schema[0].dataType


def _is_long_set(row: Row) -> bool:
    """The predicate is a list of strings too long for an IN list."""
    match = row["match"]
    return (match is not None and bool(match["values"]) and not match["concept_ids"]
            and len(match["values"]) > pr.IN_LIST_LIMIT and bool((match["column"] or "").strip()))


def _sound_scope(table: Table, scope_text: str | None, membership):
    try:
        if membership:
            _type_of(table, pr.column(membership[0]))
            return None, membership, ""
        scope = pr.condition(scope_text)
        if scope is not None and not isinstance(_type_of(table, scope), T.BooleanType):
            return F.lit(False), None, f"criteria: not a condition: {scope_text}"
        return scope, None, ""
    except (AnalysisException, ParseException) as e:
        return F.lit(False), None, f"criteria: {first_line(e)}"


def _sound_value(table: Table, value_text: str | None, column: str):
    try:
        value = pr.expression(value_text) if value_text else pr.column(column)
        return value, _type_of(table, value), ""
    except (AnalysisException, ParseException) as e:
        return F.lit(None).cast("string"), T.StringType(), f"expression: {first_line(e)}"


def plan_variable(registry: Registry, key: str, row: Row, parts: Collection[str] = ALL_PARTS) -> Planned:
    """``row`` is a prepared catalogue row.  Analysis errors are recorded, not raised: a bad
    expression leaves the scope count, a bad predicate leaves nothing in scope."""
    name = row["table"] or ""
    table = registry.tables.get(name)
    if table is None:
        return Planned(key, name, None, None, f"unknown table: {name}")
    column = row["column"] or ""
    has_expression = bool((row["expression"] or "").strip())
    errors = []

    membership = None
    if _is_long_set(row):
        membership = (row["match"]["column"].strip(), row["match"]["values"])
    scope_text = None if membership else row["criteria"]
    value_text = row["expression"] if has_expression else None
    try:
        # one look at the schema settles a sound row
        value = pr.expression(value_text) if has_expression else pr.column(column)
        scope = pr.condition(scope_text)
        checked = table.data.select(value, *[c for c in (scope, membership and pr.column(membership[0]))
                                             if c is not None])
        data_type = checked.schema[0].dataType
        if scope is not None and not isinstance(checked.schema[1].dataType, T.BooleanType):
            raise ValueError
    except (AnalysisException, ParseException, ValueError):
        scope, membership, problem = _sound_scope(table, scope_text, membership)
        errors += [problem] if problem else []
        value, data_type, problem = _sound_value(table, value_text, column)
        errors += [problem] if problem else []
    if membership:
        scope = F.col(f"__in_{key}")

    kind = table.kind(column) if table.has_column(column) and not has_expression else kinds.CATEGORICAL
    dates = kind == kinds.DATE and not row["free_text"]
    measure = ms.Measure(
        key=key, value=value, data_type=data_type, scope=scope,
        dates=dates and "dates" in parts,
        top=0 if dates or row["free_text"] or "top" not in parts else VARIABLE_TOP,
        quartiles=kind == kinds.CONTINUOUS and not registry.is_surrogate_key(column) and "quartiles" in parts,
        subjects=table.subject_key is not None and "subjects" in parts,
    )
    return Planned(key, name, measure, membership, "; ".join(errors))


def _with_memberships(registry: Registry, name: str, planned: Sequence[Planned]) -> Table:
    """The table with a flag per long value set."""
    table = registry.tables[name]
    data = table.data
    for p in planned:
        if p.membership:
            values = registry.spark.createDataFrame([(v,) for v in p.membership[1]], "value string")
            data = pr.with_membership(data, p.membership[0], values, f"__in_{p.key}")
    return Table(name, data, table.subject_key, table.kinds, table.object_type)


def _isolated(registry: Registry, name: str, planned: Sequence[Planned], count: int,
              row_limit: int | None) -> tuple[list[DataFrame], dict[str, str]]:
    """Measure the variables of a table now: the measured parts, and the error of each variable whose rows fail."""
    def measured(some: Sequence[Planned]) -> DataFrame | None:
        table = _with_memberships(registry, name, some)
        parts = ms.measure_parts(table, [p.measure for p in some], count, row_limit)
        return materialize(ms.union_all(parts)) if parts else None

    found, faults = isolated(planned, measured)
    return [f for f in found if f is not None], {p.key: reason for p, reason in faults}


def variable_profile(registry: Registry, catalog: DataFrame, row_limit: int | None = None,
                     parts: Collection[str] = ALL_PARTS, isolate: bool = False) -> DataFrame:
    """One row per catalogue row with its measured statistics, in catalogue order.

    With ``isolate`` the statistics are computed now, and a variable that fails while rows are
    read (say, on a cast) is recorded with its error instead of failing the others.

    Completeness is non-null over scope (NULL without scope); the subject share is over all
    subjects of the cohort and only given for implemented variables."""
    spark = registry.spark
    prepared = prepare(require_inlined(catalog))
    rows = prepared.orderBy("first_rank", "first_position").collect()
    prepared = spark.createDataFrame(rows, prepared.schema) if rows else prepared
    planned = [plan_variable(registry, f"v{i:05d}", r, parts) for i, r in enumerate(rows)]

    used = sorted({p.table for p in planned if p.measure is not None})
    counts = registry.row_counts(used) if used else {}
    measured_parts = []
    failed: dict[str, str] = {}
    for name in used:
        own = [p for p in planned if p.table == name and p.measure is not None]
        if isolate:
            found, errors = _isolated(registry, name, own, counts[name], row_limit)
            measured_parts.extend(found)
            failed.update(errors)
        else:
            table = _with_memberships(registry, name, own)
            measured_parts.extend(ms.measure_parts(table, [p.measure for p in own], counts[name], row_limit))

    keyed = spark.createDataFrame(
        [(p.key, p.table, p.error or failed.get(p.key, ""), *r) for p, r in zip(planned, rows)],
        T.StructType([T.StructField("key", T.StringType()), T.StructField("__table", T.StringType()),
                      T.StructField("error", T.StringType()), *prepared.schema.fields])).drop("__table")
    measured = ms.combine(measured_parts)
    if measured is None:
        measured = spark.createDataFrame([], ms.STATISTICS)
    measured = measured.drop("table")
    joined = keyed.join(measured, "key", "left")

    total = registry.subject_total()
    zero = F.lit(0).cast("long")
    types = registry.inventory(counted=False)
    out = (
        joined
        .withColumn("n_scope", F.coalesce("n_scope", zero))
        .withColumn("n_nonnull", F.coalesce("n_nonnull", zero))
        .withColumn("completeness_pct", F.when(
            F.col("n_scope") > 0, F.lit(100.0) * F.col("n_nonnull") / F.col("n_scope")))
        .withColumn("implemented", F.when(F.col("n_nonnull") > 0, "Yes").otherwise("No"))
        .withColumn("subject_count", F.when(F.col("n_nonnull") > 0, F.col("subject_count")))
        .withColumn("patient_pct", share_of_subjects(F.col("subject_count"), total))
        .withColumn("position", F.col("first_position"))
    )
    return enrich.with_field_type(out, types).select(*VARIABLE_COLUMNS)


def dry_run(catalog: DataFrame) -> DataFrame:
    """The catalogue as an unmeasured variable profile: nothing implemented, no statistics."""
    empty = {f.name: F.lit(None).cast(f.dataType) for f in ms.STATISTICS.fields
             if f.name not in ("table", "key")}
    prepared = prepare(require_inlined(catalog)).withColumns(empty)
    return (prepared
            .withColumn("completeness_pct", F.lit(None).cast("double"))
            .withColumn("patient_pct", F.lit(None).cast("double"))
            .withColumn("implemented", F.lit("No"))
            .withColumn("field_type", F.lit(""))
            .withColumn("error", F.lit(""))
            .withColumn("position", F.col("first_position"))
            .select(*VARIABLE_COLUMNS))


def with_display(profile: DataFrame) -> DataFrame:
    """Add the text cells of a variable: labels, values, distribution, median, example."""
    ranged = text.date_range("min_date", "max_date")
    distribution = (
        f"case when n_nonnull <= 0 then '' when free_text then {text.free_text_note('n_nonnull')} "
        f"when min_date is not null then {ranged} else {text.variable_distribution('top_values', 'n_nonnull')} end")
    return profile.selectExpr(
        "*", f"{text.top_labels('top_values')} as top_value_labels", f"{distribution} as distribution",
        f"{text.variable_median('q1', 'median', 'q3')} as median_iqr",
    ).selectExpr(
        "*", "array_join(top_value_labels, ', ') as values",
        f"{text.observed_values('top_value_labels')} as observed_values",
        f"{text.example_value('get(top_value_labels, 0)', 'min_date')} as example")


def measured_profile(registry: Registry, catalog: DataFrame, row_limit: int | None = None,
                     parts: Collection[str] = ALL_PARTS) -> DataFrame:
    """The variable profile, computed and kept.  One run measures everything; only if that
    fails, variables are isolated to find the failing ones."""
    try:
        return materialize(variable_profile(registry, catalog, row_limit, parts))
    except Exception as e:
        if not is_data_error(e):
            raise
        return materialize(variable_profile(registry, catalog, row_limit, parts, isolate=True))
