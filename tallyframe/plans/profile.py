"""Profile every column of every table of a registry."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from tallyframe.functions import kinds
from tallyframe.functions.errors import is_data_error, isolated
from tallyframe.functions.labels import label
from tallyframe.functions.predicates import column as named
from tallyframe.operators import measures as ms
from tallyframe.sources.registry import INVENTORY, Registry, Table
from tallyframe.sources.sinks import materialize

# Number of top values per column.
SAMPLE_VALUES = 5
SAMPLE_VALUES_CONCEPT = 20
CONCEPT_NAME_SUFFIX = "_concept_name"

ALL_PARTS = frozenset({"nulls", "spread", "quartiles", "dates", "top", "subjects"})

PROFILE_COLUMNS = (
    "schema", "table", "column", "ordinal", "data_type", "kind", "nullable", "row_count",
    "null_count", "completeness_pct", *ms.NUMERIC_FIELDS, "min_date", "max_date",
    "top_values", "subject_count", "patient_pct", "error",
)
_MEASURED = {f.name: f.dataType for f in ms.STATISTICS.fields}
PROFILE_TYPES = {
    **{f.name: f.dataType for f in INVENTORY.fields},
    "null_count": T.LongType(), "completeness_pct": T.DoubleType(), "patient_pct": T.DoubleType(),
    "error": T.StringType(),
    **{c: _MEASURED[c] for c in PROFILE_COLUMNS if c in _MEASURED},
}


def column_measures(registry: Registry, table: Table, parts: frozenset[str] = ALL_PARTS,
                    basic: bool = False, sample_values: int = SAMPLE_VALUES,
                    sample_concept: int = SAMPLE_VALUES_CONCEPT) -> list[ms.Measure]:
    """What to measure per column: typed by kind, no numeric summary of keys (unless basic),
    no grouping of free text, no subject counts without a subject key."""
    out = []
    for field in table.data.schema.fields:
        kind = table.kind(field.name)
        numeric = kind == kinds.CONTINUOUS and (basic or not registry.is_surrogate_key(field.name))
        deep = not basic and field.name.endswith(CONCEPT_NAME_SUFFIX)
        top = (sample_concept if deep else sample_values) if kind == kinds.CATEGORICAL else 0
        out.append(ms.Measure(
            key=field.name, value=named(field.name), data_type=field.dataType,
            counts="nulls" in parts,
            spread=numeric and "spread" in parts,
            quartiles=numeric and "quartiles" in parts,
            dates=kind == kinds.DATE and "dates" in parts,
            top=top if "top" in parts else 0,
            subjects=not basic and table.subject_key is not None and "subjects" in parts,
        ))
    return out


def column_profile(registry: Registry, names: Iterable[str] | None = None,
                   parts: frozenset[str] | set[str] = ALL_PARTS, basic: bool = False,
                   sample_values: int = SAMPLE_VALUES, sample_concept: int = SAMPLE_VALUES_CONCEPT,
                   row_limit: int | None = None, isolate: bool = False) -> DataFrame:
    """One row per column with its statistics.

    Columns of an empty table are listed with zero counts and are not scanned; the
    share of subjects is taken over the cohort's subjects, not the table's.

    With ``isolate`` the statistics are computed now, and a column that fails while rows are read (a
    cast inside a view) has NULL statistics and the reason in ``error``, which is empty otherwise."""
    names = sorted(registry.tables if names is None else names)
    counts = registry.row_counts(names)
    parts_found, faults = [], {}
    for table in registry.select(names):
        wanted = column_measures(registry, table, frozenset(parts), basic, sample_values, sample_concept)
        if isolate:
            kept, failed = isolated(wanted, lambda some: [materialize(f) for f in _one_frame(
                ms.measure_parts(table, some, counts[table.name], row_limit))])
            parts_found.extend(f for frames in kept for f in frames)
            faults.update({(table.name, m.key): reason for m, reason in failed})
        else:
            parts_found.extend(ms.measure_parts(table, wanted, counts[table.name], row_limit))
    skeleton = registry.inventory(names).withColumnRenamed("column", "key")
    reasons = registry.spark.createDataFrame(
        [(*at, reason) for at, reason in faults.items()], "table string, key string, error string")
    skeleton = (skeleton.join(F.broadcast(reasons), ["table", "key"], "left") if faults
                else skeleton.withColumn("error", F.lit(None).cast("string")))
    merged = ms.combine(parts_found, skeleton, extra=[
        c for c in skeleton.columns if c not in ("table", "key")]).withColumnRenamed("key", "column")

    keyed = [t.name for t in registry.select(names) if t.subject_key]
    has_key = F.col("table").isin(keyed) if keyed else F.lit(False)
    total = registry.subject_total() if "subjects" in parts and not basic else None
    empty = F.col("row_count") == 0
    null_count = F.when(empty, F.lit(0).cast("long")).otherwise(F.col("row_count") - F.col("n_nonnull"))
    subjects = F.when(empty & has_key, F.lit(0).cast("long")).otherwise(F.col("subject_count"))
    return (
        merged
        .withColumn("null_count", null_count)
        .withColumn("completeness_pct", F.when(empty, 0.0).otherwise(
            (1 - F.col("null_count") / F.col("row_count")) * 100))
        .withColumn("subject_count", subjects)
        .withColumn("patient_pct", share_of_subjects(F.col("subject_count"), total))
        .withColumn("error", F.coalesce("error", F.lit("")))
        .select(*PROFILE_COLUMNS)
    )


def _one_frame(parts: list[DataFrame]) -> list[DataFrame]:
    return [ms.union_all(parts)] if parts else []


def measured_profile(registry: Registry, *args, **options) -> DataFrame:
    """The column profile, computed and kept: one run, and only if rows make it fail, columns are isolated to
    find the failing ones. Takes what ``column_profile`` takes."""
    try:
        return materialize(column_profile(registry, *args, **options))
    except Exception as e:
        if not is_data_error(e):
            raise
        return materialize(column_profile(registry, *args, **options, isolate=True))


def share_of_subjects(count, total: int | None):
    """Percent of the cohort's subjects; NULL when their number is unknown or zero."""
    if not total or total <= 0:
        return F.lit(None).cast("double")
    return F.lit(100.0) * count / F.lit(total)


def table_profile(registry: Registry, names: Iterable[str] | None = None) -> DataFrame:
    """Rows, columns and distinct subjects per table (NULL without key or rows)."""
    names = sorted(registry.tables if names is None else names)
    counts = registry.row_counts(names)
    spark = registry.spark
    base = spark.createDataFrame(
        [(registry.schema_name, n, counts[n], len(registry.tables[n].data.columns)) for n in names],
        "schema string, table string, row_count long, column_count int")
    keyed = [t for t in registry.select(names) if t.subject_key and counts[t.name] > 0]
    if not keyed:
        return base.withColumn("subject_count", F.lit(None).cast("long"))
    # distinct keys, then one count per table: both steps are combined map-side
    subjects = reduce(DataFrame.unionByName, [
        t.data.where(F.col(t.subject_key).isNotNull())
        .select(F.lit(t.name).alias("table"), F.col(t.subject_key).alias("subject"))
        .distinct().groupBy("table").agg(F.count(F.lit(1)).alias("subject_count"))
        for t in keyed
    ])
    # a keyed table whose key is NULL throughout has zero subjects
    found = base.join(subjects, "table", "left")
    known = F.col("table").isin([t.name for t in keyed])
    return found.withColumn(
        "subject_count", F.when(known, F.coalesce("subject_count", F.lit(0).cast("long")))
    ).select("schema", "table", "row_count", "column_count", "subject_count")


def tables_of(registry: Registry, profile: DataFrame) -> DataFrame:
    """The table profile read off a column profile with subject counts: the subjects of a table
    are the distinct values of its key column, so no table is scanned again."""
    keys = [(t.name, t.subject_key) for t in registry.tables.values() if t.subject_key]
    is_key = F.lit(False)
    for name, key in keys:
        is_key = is_key | ((F.col("table") == name) & (F.col("column") == key))
    subjects = F.max(F.when(is_key & (F.col("row_count") > 0), F.col("subject_count")))
    return profile.groupBy("schema", "table").agg(
        F.max("row_count").alias("row_count"), F.count(F.lit(1)).cast("int").alias("column_count"),
        subjects.alias("subject_count"))


def top_values(registry: Registry, names: Iterable[str], limit: int = SAMPLE_VALUES,
               concept_limit: int = SAMPLE_VALUES_CONCEPT, basic: bool = False) -> DataFrame:
    """(table, column, rank, value, n, pct_of_rows) of the categorical columns.

    The share is over all rows, NULLs included."""
    out = []
    counts = registry.row_counts(names)
    for table in registry.select(names):
        wanted = [m for m in column_measures(registry, table, frozenset({"top"}), basic, limit, concept_limit)
                  if m.top > 0]
        if wanted and counts[table.name]:
            out.append(ms.top_values(table, wanted).withColumn(
                "pct_of_rows", F.lit(100.0) * F.col("n") / F.lit(counts[table.name])))
    return reduce(DataFrame.unionByName, out).withColumnRenamed("key", "column")


def top_k(table: Table, column: str, k: int = SAMPLE_VALUES) -> DataFrame:
    """The k most frequent values of one column: partial top-k per task, then a merge."""
    value = label(named(column), table.data.schema[column].dataType)
    return (
        table.data.select(value.alias("value")).where(F.col("value").isNotNull())
        .groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value").limit(k)
    )
