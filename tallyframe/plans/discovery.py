"""Compare the values found in the data with the configured value sets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions import predicates as pr
from tallyframe.functions.errors import first_line, isolated
from tallyframe.functions.labels import label
from tallyframe.operators.measures import union_all
from tallyframe.sources import catalog as ct
from tallyframe.sources.registry import Registry, Table
from tallyframe.sources.sinks import materialize

NAMES, IDS = "names", "concept-ids"
NO_ID_PAIR = "no id/name column pair can be derived from the matcher column"

VARIABLE_FIELDS = ("var_key", "category", "variable", "table", "column", "source_pack",
                   "displayed_criteria", "scope_sql", "id_column", "name_column",
                   "configured_column", "skip_reason")
OBSERVED_SCHEMA = "var_key string, value string, id long, n long"


def targets(catalog: DataFrame, mode: str = NAMES, only_variable: str | None = None,
            registry: Registry | None = None) -> DataFrame:
    """One row per variable with its matcher, scope and skip reason.

    With a registry, unknown tables and predicates that do not resolve become skip reasons."""
    chosen = catalog
    if only_variable is not None:
        chosen = chosen.where(F.lower("variable") == only_variable.lower())
        if chosen.isEmpty():
            raise ValueError(f"no variable named {only_variable!r}")
    resolved = ct.resolve_scope(chosen)
    id_column, name_column = ct.id_and_name_columns(
        F.col("matcher_column"), F.col("column"), F.col("match.name_column"))
    skip = F.col("skip_reason")
    if mode == IDS:
        skip = F.when(skip != "", skip).when(id_column == "", NO_ID_PAIR).otherwise("")
    out = (
        resolved
        .withColumn("id_column", id_column).withColumn("name_column", name_column)
        .withColumn("skip_reason", skip)
        .withColumn("configured_column", pr.stripped(F.col("match.column")))
        .withColumn("display_column", F.coalesce("column", F.lit("")))
        .withColumn("column", F.coalesce(F.expr("nullif(matcher_column, '')"), "display_column"))
        .withColumn("variable", F.coalesce(F.expr("nullif(variable, '')"), "display_column"))
        .withColumn("source_pack", F.coalesce("layer", F.lit("")))
        .withColumn("var_key", F.format_string("%05d/%s/%s", F.col("position"), F.col("category"), F.col("variable")))
        .withColumn("configured_values", pr.configured_values(F.col("match")))
        .withColumn("configured_ids", pr.configured_ids(F.col("match")))
        .select(*VARIABLE_FIELDS, "configured_values", "configured_ids")
    )
    if registry is None:
        return out
    return _with_errors(registry, out, mode)


def _with_errors(registry: Registry, found: DataFrame, mode: str) -> DataFrame:
    """The catalogue is read on the driver here: its rows become parts of the plan."""
    rows = []
    for r in found.collect():
        reason = r["skip_reason"]
        if not reason:
            table = registry.tables.get(r["table"])
            if table is None:
                reason = f"unknown table: {r['table']}"
            else:
                try:
                    table.data.select(pr.condition(r["scope_sql"]), *[pr.column(c) for c in _group_columns(r, mode)])
                except (AnalysisException, ParseException) as e:
                    reason = first_line(e)
        rows.append((*[r[f] if f != "skip_reason" else reason for f in VARIABLE_FIELDS],
                     r["configured_values"], r["configured_ids"]))
    return registry.spark.createDataFrame(rows, found.schema)


def _group_columns(row, mode: str) -> list[str]:
    return [row["id_column"], row["name_column"]] if mode == IDS else [row["column"]]


def observed(registry: Registry, found: DataFrame, mode: str = NAMES) -> DataFrame:
    """(var_key, value, id, n): every value of the matcher under the variable's scope.

    All variables of a table share one scan; counts are combined map-side."""
    return _observed_rows(registry, [r for r in found.collect() if not r["skip_reason"]], mode)


def measured(registry: Registry, found: DataFrame, mode: str = NAMES) -> tuple[DataFrame, DataFrame]:
    """The variables and ``observed``, computed and kept. A variable that fails while rows are read (say, on a
    cast) gets the reason as its skip reason and has no observed values; the others are whole."""
    rows = found.collect()
    ready = sorted((r for r in rows if not r["skip_reason"]), key=lambda r: r["table"])
    seen, faults = isolated(ready, lambda some: materialize(_observed_rows(registry, some, mode)))
    reasons = {r["var_key"]: reason for r, reason in faults}
    if reasons:
        at = found.columns.index("skip_reason")
        found = registry.spark.createDataFrame(
            [(*r[:at], reasons.get(r["var_key"], r["skip_reason"]), *r[at + 1:]) for r in rows], found.schema)
    return found, union_all(seen) if seen else registry.spark.createDataFrame([], OBSERVED_SCHEMA)


def _observed_rows(registry: Registry, rows: list, mode: str) -> DataFrame:
    frames = []
    for name in sorted({r["table"] for r in rows}):
        table = registry.tables[name]
        own = [r for r in rows if r["table"] == name]
        frames.append(_observe_names(table, own) if mode == NAMES else _observe_ids(table, own))
    if not frames:
        return registry.spark.createDataFrame([], OBSERVED_SCHEMA)
    return union_all(frames)


def _scoped_label(table: Table, row, column: str) -> Column:
    kind = table.data.schema[column].dataType
    return F.when(pr.condition(row["scope_sql"]), label(pr.column(column), kind))


def _observe_names(table: Table, rows: list) -> DataFrame:
    wide = table.data.select(*[_scoped_label(table, r, r["column"]).alias(f"m{i}") for i, r in enumerate(rows)])
    long = wide.unpivot([], wide.columns, "slot", "value").where("value is not null")
    keys = F.create_map(*[F.lit(x) for i, r in enumerate(rows) for x in (f"m{i}", r["var_key"])])
    counted = long.groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(keys[F.col("slot")].alias("var_key"), "value",
                          F.lit(None).cast("long").alias("id"), "n")


def _observe_ids(table: Table, rows: list) -> DataFrame:
    entries = []
    for r in rows:
        entries.append(F.struct(
            F.lit(r["var_key"]).alias("var_key"),
            _scoped_label(table, r, r["name_column"]).alias("value"),
            pr.column(r["id_column"]).cast("long").alias("id")))
    long = table.data.select(F.inline(F.array(*entries))).where("value is not null and id is not null")
    return long.groupBy("var_key", "value", "id").agg(F.count(F.lit(1)).alias("n"))


def configured(found: DataFrame, mode: str = NAMES) -> DataFrame:
    """(var_key, value or id, position) of the configured sets of the variables not skipped."""
    ready = found.where("skip_reason = ''")
    if mode == IDS:
        return ready.select("var_key", F.posexplode("configured_ids").alias("position", "id"))
    return ready.select("var_key", F.posexplode("configured_values").alias("position", "value"))


def status(n: Column, position: Column) -> Column:
    return (F.when(n.isNotNull() & position.isNotNull(), "both")
            .when(n.isNotNull(), "missing").otherwise("stale"))


def partition_values(seen: DataFrame, wanted: DataFrame, by: Iterable[str] = ("var_key",)) -> DataFrame:
    """Outer comparison of observed (…, value, n) and configured (…, value, position) values:
    status both, missing (from the configuration) or stale.

    Both sides are already distinct per key, so no key is hot."""
    keys = [*by, "value"]
    return (seen.join(wanted, keys, "full_outer")
            .withColumn("status", status(F.col("n"), F.col("position")))
            .select(*keys, "n", "position", "status"))


def partition_ids(seen: DataFrame, wanted: DataFrame, by: Iterable[str] = ("var_key",)) -> DataFrame:
    """The same on integer ids; an observed id keeps its name(s)."""
    keys = [*by, "id"]
    return (seen.join(wanted, keys, "full_outer")
            .withColumn("status", status(F.col("n"), F.col("position")))
            .select(*keys, F.col("value").alias("name"), "n", "position", "status"))


def suggest_values(parts: DataFrame, by: Iterable[str] = ("var_key",)) -> DataFrame:
    """Proposed value set: observed values by count, then configured ones not seen, in their
    order.  A configured value is never dropped."""
    observed_first = F.when(F.col("n").isNotNull(), 0).otherwise(1)
    return (parts.withColumn("proposal_group", observed_first)
            .orderBy(*by, "proposal_group", F.desc_nulls_last("n"), F.col("position").asc_nulls_last(), "value"))


def suggest_ids(parts: DataFrame, by: Iterable[str] = ("var_key",)) -> DataFrame:
    """Proposed id set, one row per id, by its highest count; of several names the rarest is
    shown, which is the last one in count order."""
    rank = F.struct(-F.col("n"), F.col("name"))
    return (
        parts.groupBy(*by, "id")
        .agg(F.max("n").alias("n"), F.max_by("name", rank).alias("name"),
             F.min("position").alias("position"), F.count("n").alias("name_count"))
        .withColumn("status", status(F.col("n"), F.col("position")))
        .withColumn("proposal_group", F.when(F.col("n").isNotNull(), 0).otherwise(1))
        .orderBy(*by, "proposal_group", F.desc_nulls_last("n"), F.col("position").asc_nulls_last(), "id"))


def report(found: DataFrame, parts: DataFrame) -> DataFrame:
    """Counts per variable: configured, observed, both, missing, stale; skipped ones with the reason."""
    counted = parts.groupBy("var_key").agg(
        F.count_if(F.col("position").isNotNull()).alias("configured"),
        F.count_if(F.col("n").isNotNull()).alias("observed"),
        F.count_if(F.col("status") == "both").alias("both"),
        F.count_if(F.col("status") == "missing").alias("missing"),
        F.count_if(F.col("status") == "stale").alias("stale"),
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("rows_in_scope"))
    zero = F.lit(0).cast("long")
    scope = (F.when(F.col("scope_sql") == "", "none")
             .when(F.col("scope_sql") == F.col("displayed_criteria"), "same as criteria")
             .otherwise("broader than criteria"))
    joined = found.join(counted, "var_key", "left")
    for c in ("configured", "observed", "both", "missing", "stale", "rows_in_scope"):
        joined = joined.withColumn(c, F.coalesce(c, zero))
    return joined.withColumn("scope_label", scope).select(
        "category", "variable", "table", "column", "source_pack", "scope_label", "skip_reason",
        "configured", "observed", "both", "missing", "stale", "rows_in_scope")


def discover(registry: Registry, catalog: DataFrame, mode: str = NAMES,
             only_variable: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(variables, partition) of a whole catalogue; see ``report`` and ``suggest_*``.

    The data is read here, once; variables whose rows fail are skipped with the reason."""
    found, seen = measured(registry, targets(ct.require_inlined(catalog), mode, only_variable, registry), mode)
    wanted = configured(found, mode)
    parts = partition_ids(seen, wanted) if mode == IDS else partition_values(seen.drop("id"), wanted)
    labels = found.select("var_key", "category", "variable")
    return found, parts.join(labels, "var_key")
