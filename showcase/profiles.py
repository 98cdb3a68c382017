"""Scans and column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from showcase.inputs import (SCHEMA, SUBJECT_KEYS, TABLES, columns, is_key, retail, table, union, with_views)
from tallyframe.functions import kinds
from tallyframe.plans import batch, model as md, profile as pf
from tallyframe.sources.registry import Registry, Table, schema_object_counts

CORE = ("customer", "orders_n", "events_n", "lineitem", "documents", "part")
SUBJECTED = ("customer", "orders_n", "events_n")


def r4(*names):
    return {n: F.round(n, 4) for n in names}


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def label_sql(column: str, kind: str) -> str:
    """SQL text of a value's label."""
    if kind == "continuous":
        return (f"case when {column} = floor({column}) and abs({column}) < 1e15 "
                f"then cast(cast({column} as bigint) as varchar) else cast({column} as varchar) end")
    return f"cast({column} as varchar)"


def per_column(names, template, keep=lambda t, c, ty, k: True) -> str:
    return union(template.format(t=t, c=c, ty=ty, k=k) for t in names
                 for c, ty, k in columns(t) if keep(t, c, ty, k))


# ---- scans

def list_tables(spark, sf):
    return retail(spark, sf, *TABLES).list_tables()


LIST_TABLES = union(
    f"select 'retail' as schema, '{t}' as \"table\", 'TABLE' as object_type, {len(SCHEMA[t])} as column_count, "
    f"count(*) as row_count from {t}" for t in TABLES)

WEB = ("documents", "pages", "benchmark", "labels", "conversations", "embeddings")
SHOP = ("customer", "orders", "lineitem", "events", "events_n", "orders_n")


def object_counts(spark, sf):
    return schema_object_counts(spark, [
        retail(spark, sf, *SHOP, schema_name="shop"), retail(spark, sf, *WEB, schema_name="web"), "vacant"])


OBJECT_COUNTS = (
    "select 'shop' as schema, 4::bigint as table_count, 2::bigint as view_count, cast(("
    + " + ".join(f"(select count(*) from {t})" for t in SHOP) + ") as bigint) as row_count union all "
    "select 'web', 6, 0, cast((" + " + ".join(f"(select count(*) from {t})" for t in WEB) + ") as bigint) "
    "union all select 'vacant', 0, 0, 0")


def list_columns(spark, sf):
    return retail(spark, sf, *TABLES).inventory().withColumn("nullable", F.expr("if(nullable, 'YES', 'NO')"))


def _inventory_sql(fields: str) -> str:
    out = []
    for t in TABLES:
        rows = ", ".join(f"({q(c)}, {i}, {q(ty)}, {q(k)})" for i, (c, ty, k) in enumerate(SCHEMA[t], 1))
        out.append(f"select {fields.format(t=t)} from (values {rows}) as v(c, i, ty, k), "
                   f"(select count(*) as n from {t}) as x")
    return union(out)


LIST_COLUMNS = _inventory_sql(
    "'retail' as schema, '{t}' as \"table\", c as \"column\", i as ordinal, ty as data_type, k as kind, "
    "'YES' as nullable, n as row_count")


def metric_kind(spark, sf):
    found = retail(spark, sf, *TABLES).inventory()
    return found.select("table", "column", "data_type", kinds.metric_kind(F.col("data_type")).alias("metric_kind"),
                        "row_count")


METRIC_KIND = _inventory_sql(
    "'{t}' as \"table\", c as \"column\", ty as data_type, "
    "case when ty in ('int', 'bigint', 'double') then 'continuous' "
    "when ty = 'timestamp_ntz' then 'date' else 'categorical' end as metric_kind, n as row_count")


def surrogate_key_skip(spark, sf):
    found = pf.column_profile(retail(spark, sf, *CORE), parts={"spread"}).where("kind = 'continuous'")
    key = kinds.is_surrogate_key(F.col("column"), ("key", "_id"))
    return found.select("table", "column", key.cast("string").alias("is_key"),
                        F.round("mean", 4).alias("mean"))


SURROGATE = union(
    f"select '{t}' as \"table\", '{c}' as \"column\", '{str(is_key(c)).lower()}' as is_key, "
    + ("cast(any_value(null) as double)" if is_key(c) else f"round(avg({c}), 4)") + f" as mean from {t}"
    for t in CORE for c, _, k in columns(t) if k == "continuous")


def freetext_skip(spark, sf):
    found = pf.column_profile(retail(spark, sf, "notes"), parts={"nulls", "top"})
    return found.select("column", "kind", kinds.is_freetext(F.col("column")).cast("string").alias("free_text"),
                        "row_count", F.coalesce(F.size("top_values"), F.lit(0)).cast("long").alias("values_listed"))


FREETEXT = union([
    "select 'doc_id' as \"column\", 'continuous' as kind, 'false' as free_text, count(*) as row_count, "
    "0::bigint as values_listed from documents",
    "select 'note_text', 'unstructured', 'true', count(*), 0 from documents",
    "select 'origin_note', 'unstructured', 'true', count(*), 0 from documents",
    "select 'lang', 'categorical', 'false', count(*), least(5, count(distinct lang)) from documents"])


# ---- profile parts

def table_profile(spark, sf):
    return pf.table_profile(retail(spark, sf, *CORE, "region", "nobody"))


TABLE_PROFILE = union(
    f"select 'retail' as schema, '{t}' as \"table\", count(*) as row_count, {len(columns(t))} as column_count, "
    + (f"count(distinct {SUBJECT_KEYS[t]})" if t in SUBJECT_KEYS else "cast(null as bigint)")
    + f" as subject_count from {t}" for t in (*CORE, "region", "nobody"))


def null_counts(spark, sf):
    return pf.column_profile(retail(spark, sf, *CORE), parts={"nulls"}).select(
        "table", "column", "row_count", "null_count")


NULL_COUNTS = per_column(CORE, "select '{t}' as \"table\", '{c}' as \"column\", count(*) as row_count, "
                               "count(*) - count({c}) as null_count from {t}")


def completeness(spark, sf):
    found = pf.column_profile(retail(spark, sf, "orders_n", "events_n", "nobody"), parts={"nulls"})
    return found.select("table", "column", F.round("completeness_pct", 4).alias("completeness_pct"))


COMPLETENESS = per_column(
    ("orders_n", "events_n", "nobody"),
    "select '{t}' as \"table\", '{c}' as \"column\", "
    "coalesce(round(100.0 * count({c}) / nullif(count(*), 0), 4), 0.0) as completeness_pct from {t}")

NUMERIC = ("customer", "orders_n", "events_n", "lineitem", "part")


def _numeric(t, c, ty, k):
    return k == "continuous" and not is_key(c)


def continuous_summary(spark, sf):
    found = pf.column_profile(retail(spark, sf, *NUMERIC), parts={"spread"}).where("min_num is not null")
    return found.select("table", "column", "min_num", "max_num", F.round("mean", 4).alias("mean"),
                        F.round("std", 4).alias("std"))


CONTINUOUS = per_column(
    NUMERIC, "select '{t}' as \"table\", '{c}' as \"column\", min({c})::double as min_num, "
             "max({c})::double as max_num, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std from {t}",
    _numeric)


def _quartiles(spark, sf, row_limit):
    found = pf.column_profile(retail(spark, sf, *NUMERIC), parts={"quartiles"}, row_limit=row_limit)
    return found.where("median is not null").select(
        "table", "column", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")])


def quartiles(spark, sf):
    return _quartiles(spark, sf, None)


def quartiles_narrowed(spark, sf):
    """The path of large tables: rank brackets narrowed round by round."""
    return _quartiles(spark, sf, 0)


QUARTILES = per_column(
    NUMERIC, "select '{t}' as \"table\", '{c}' as \"column\", round(quantile_cont({c}, 0.25), 4) as q1, "
             "round(quantile_cont({c}, 0.5), 4) as median, round(quantile_cont({c}, 0.75), 4) as q3 from {t}",
    _numeric)

DATED = ("orders_n", "events_n", "lineitem")


def date_range(spark, sf):
    return pf.column_profile(retail(spark, sf, *DATED), parts={"dates"}).where("kind = 'date'").select(
        "table", "column", "min_date", "max_date")


DATE_RANGE = per_column(
    DATED, "select '{t}' as \"table\", '{c}' as \"column\", cast(min({c}) as varchar) as min_date, "
           "cast(max({c}) as varchar) as max_date from {t}", lambda t, c, ty, k: k == "date")

CATEGORIES = ("customer", "orders_n", "events_n", "lineitem", "part", "documents", "nation")


def _top_sql(names, limit: int = 5) -> str:
    counts = per_column(
        names, "select '{t}' as \"table\", '{c}' as \"column\", cast({c} as varchar) as value, count(*) as n, "
               "(select count(*) from {t}) as row_count from {t} where {c} is not null group by {c}",
        lambda t, c, ty, k: k == "categorical")
    return (f"select * from (select *, row_number() over (partition by \"table\", \"column\" "
            f"order by n desc, value) as rank from ({counts}) as c) as r where rank <= {limit}")


def top_values(spark, sf):
    return pf.top_values(retail(spark, sf, *CATEGORIES), CATEGORIES).select(
        "table", "column", F.col("rank").cast("long").alias("rank"), "value", "n")


TOP_VALUES = f'select "table", "column", rank, value, n from ({_top_sql(CATEGORIES)}) as t'


def value_distribution(spark, sf):
    return pf.top_values(retail(spark, sf, *CATEGORIES), CATEGORIES, limit=3).select(
        "table", "column", "value", F.round("pct_of_rows", 4).alias("pct_of_rows"))


VALUE_DISTRIBUTION = (f'select "table", "column", value, round(100.0 * n / row_count, 4) as pct_of_rows '
                      f'from ({_top_sql(CATEGORIES, 3)}) as t')


def top_k(spark, sf):
    return pf.top_k(retail(spark, sf, "orders").tables["orders"], "o_orderdate", 25)


TOP_K = ("select cast(o_orderdate as varchar) as value, count(*) as n from orders group by o_orderdate "
         "order by n desc, value limit 25")


def patient_count(spark, sf):
    registry = retail(spark, sf, "customer")
    return spark.createDataFrame([(registry.subject_total(),)], "patient_count long")


def subjects_per_table(spark, sf):
    return pf.table_profile(retail(spark, sf, *SUBJECTED)).select("table", "subject_count")


SUBJECTS = union(f"select '{t}' as \"table\", count(distinct {SUBJECT_KEYS[t]}) as subject_count from {t}"
                 for t in SUBJECTED)


def subject_completeness(spark, sf):
    found = pf.column_profile(retail(spark, sf, *SUBJECTED), parts={"subjects"})
    return found.select("table", "column", "subject_count", F.round("patient_pct", 4).alias("patient_pct"))


def _subject_sql(names) -> str:
    return union(
        f"select '{t}' as \"table\", '{c}' as \"column\", count(distinct {SUBJECT_KEYS[t]}) filter (where {c} is not null) "
        f"as subject_count, round(100.0 * count(distinct {SUBJECT_KEYS[t]}) filter (where {c} is not null) / "
        f"(select count(*) from customer), 4) as patient_pct from {t}" if t in SUBJECT_KEYS else
        f"select '{t}' as \"table\", '{c}' as \"column\", cast(null as bigint) as subject_count, "
        f"cast(null as double) as patient_pct from (select count(*) from {t}) as x"
        for t in names for c, _, _ in columns(t))


def subject_metrics_skip(spark, sf):
    found = pf.column_profile(retail(spark, sf, "customer", "events_n", "part", "lineitem"), parts={"subjects"})
    return found.select("table", "column", "subject_count", F.round("patient_pct", 4).alias("patient_pct"))


def empty_table_collapse(spark, sf):
    found = pf.column_profile(retail(spark, sf, "nobody", "region", "nation"))
    return found.select("table", "column", "row_count", "null_count", "completeness_pct",
                        F.coalesce(F.size("top_values"), F.lit(0)).cast("long").alias("values_listed"))


EMPTY = per_column(
    ("nobody", "region", "nation"),
    "select '{t}' as \"table\", '{c}' as \"column\", count(*) as row_count, count(*) - count({c}) as null_count, "
    "coalesce(100.0 * count({c}) / nullif(count(*), 0), 0.0) as completeness_pct, "
    "case when '{k}' = 'categorical' then least(5, count(distinct {c})) else 0 end as values_listed from {t}")


# ---- whole profiles

def _flat(found, subjects: bool):
    """Scalar fields of a profile, with the most frequent value."""
    out = found.select(
        "table", "column", "ordinal", "data_type", "kind", "row_count", "null_count",
        F.round("completeness_pct", 4).alias("completeness_pct"), "min_num", "max_num",
        *[F.round(c, 4).alias(c) for c in ("mean", "std", "q1", "median", "q3")],
        "min_date", "max_date", F.expr("top_values[0].value").alias("top_value"),
        F.expr("top_values[0].n").alias("top_n"), "subject_count",
        F.round("patient_pct", 4).alias("patient_pct"))
    return out if subjects else out.drop("subject_count", "patient_pct")


def _flat_sql(names, subjects: bool, basic: bool) -> str:
    out = []
    for t in names:
        for i, (c, ty, k) in enumerate(columns(t), 1):
            number = k == "continuous" and (basic or not is_key(c))
            num = (f"min({c})::double as min_num, max({c})::double as max_num, round(avg({c}), 4) as mean, "
                   f"round(stddev_samp({c}), 4) as std, round(quantile_cont({c}, 0.25), 4) as q1, "
                   f"round(quantile_cont({c}, 0.5), 4) as median, round(quantile_cont({c}, 0.75), 4) as q3"
                   if number else
                   "null::double as min_num, null::double as max_num, null::double as mean, null::double as std, "
                   "null::double as q1, null::double as median, null::double as q3")
            dates = (f"cast(min({c}) as varchar) as min_date, cast(max({c}) as varchar) as max_date"
                     if k == "date" else "null::varchar as min_date, null::varchar as max_date")
            counted = f"(select {c} as value, count(*) as n from {t} where {c} is not null group by {c}) as g"
            top = (f"(select value from {counted} order by n desc, value limit 1) as top_value, "
                   f"(select max(n) from {counted}) as top_n"
                   if k == "categorical" else "null::varchar as top_value, null::bigint as top_n")
            part = (f"select '{t}' as \"table\", '{c}' as \"column\", {i} as ordinal, '{ty}' as data_type, "
                    f"'{k}' as kind, count(*) as row_count, count(*) - count({c}) as null_count, "
                    f"round(100.0 * count({c}) / count(*), 4) as completeness_pct, {num}, {dates}, {top}")
            if subjects:
                key = SUBJECT_KEYS.get(t)
                hit = f"count(distinct {key}) filter (where {c} is not null)" if key else "null::bigint"
                part += (f", {hit} as subject_count, "
                         + (f"round(100.0 * {hit} / (select count(*) from customer), 4)" if key else "null::double")
                         + " as patient_pct")
            out.append(f"{part} from {t}")
    return union(out)


FULL = ("customer", "orders_n", "events_n", "lineitem", "documents", "part", "supplier", "nation", "region",
        "embeddings", "pages", "labels", "conversations", "benchmark")
BASIC = ("orders", "part", "documents", "labels", "events")


def full_profile(spark, sf):
    return _flat(pf.measured_profile(retail(spark, sf, *FULL)), True)


def basic_profile(spark, sf):
    return _flat(pf.measured_profile(retail(spark, sf, *BASIC), basic=True), False)


def profile_errors(spark, sf):
    """Two views with a column each that fails as its rows are read: the others keep their statistics."""
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "cast(o_orderpriority as int) as priority_no", "o_totalprice")
    parts = table(spark, sf, "part").selectExpr("p_brand", "p_size", "p_size / (p_size - p_size) as share")
    registry = Registry(spark, "s", [Table("orders", orders), Table("part", parts)])
    found = pf.measured_profile(registry, parts={"nulls", "spread"})
    return found.select("table", "column", "row_count", "null_count", "min_num", "max_num",
                        (F.col("error") != "").alias("failed"))


PROFILE_ERRORS = union([
    f"select '{t}' as \"table\", '{c}' as \"column\", count(*) as row_count, {nulls} as null_count, "
    f"{low} as min_num, {high} as max_num, {failed} as failed from {t}"
    for t, c, nulls, low, high, failed in (
        ("orders", "o_orderkey", "count(*) - count(o_orderkey)", "min(o_orderkey)::double", "max(o_orderkey)::double",
         "false"),
        ("orders", "priority_no", "null::bigint", "null::double", "null::double", "true"),
        ("orders", "o_totalprice", "count(*) - count(o_totalprice)", "min(o_totalprice)", "max(o_totalprice)", "false"),
        ("part", "p_brand", "count(*) - count(p_brand)", "null::double", "null::double", "false"),
        ("part", "p_size", "count(*) - count(p_size)", "min(p_size)::double", "max(p_size)::double", "false"),
        ("part", "share", "null::bigint", "null::double", "null::double", "true"))])


def basic_dictionary(spark, sf):
    """The plain dictionary's text cells, for columns whose texts SQL can state as well."""
    found = pf.column_profile(retail(spark, sf, "orders", "lineitem", "documents"), basic=True)
    return md.basic_dictionary(found).where("`Table(s)` <> ''")


def cells_sql(t: str, c: str, k: str, keys: bool = True) -> dict[str, str]:
    """Text cells of a column as scalar subqueries; without ``keys`` a key has no summary of its numbers."""
    from showcase.display import number_sql, percent_sql
    blank = "''"
    if k == "continuous" and (keys or not is_key(c)):
        shown = [number_sql(x) for x in (f"min({c})::double", f"max({c})::double", f"avg({c})", f"stddev_samp({c})")]
        quantile = [number_sql(f"quantile_cont({c}, {p})::double") for p in (0.25, 0.5, 0.75)]
        return dict(
            values=blank, example=f"(select {shown[0]} from {t})",
            distribution=f"(select 'Min: ' || {shown[0]} || ', Max: ' || {shown[1]} || ', Mean: ' || {shown[2]} || "
                         f"' (std: ' || {shown[3]} || ')' from {t})",
            median=f"(select 'Median: ' || {quantile[1]} || ' (IQR: ' || {quantile[0]} || '–' || {quantile[2]} "
                   f"|| ')' from {t})")
    if k == "date":
        return dict(values=blank, median=blank, example=f"(select min({c})::varchar from {t})",
                    distribution=f"(select 'Min: ' || min({c})::varchar || ', Max: ' || max({c})::varchar from {t})")
    if k == "categorical":
        top = (f"(select {c} as value, count(*) as n, (select count(*) from {t}) as total from {t} "
               f"where {c} is not null group by {c} order by n desc, value limit 5) as g")
        share = percent_sql("100.0::double * n / total")
        return dict(
            values=f"(select string_agg(value, ', ' order by n desc, value) from {top})", median=blank,
            example=f"(select value from {top} order by n desc, value limit 1)",
            distribution=f"(select string_agg(value || ': ' || n || ' (' || {share} || ')', '; ' "
                         f"order by n desc, value) from {top})")
    return dict(values=blank, distribution=blank, median=blank, example=blank)


def _dictionary_sql(names) -> str:
    from showcase.display import percent_sql
    out = []
    for t in names:
        for c, ty, k in columns(t):
            cells = cells_sql(t, c, k)
            kind = "Unstructured" if k == "unstructured" else "Structured"
            out.append(
                f"select '' as \"Category\", '{c}' as \"Variable\", '' as \"Description\", '{t}' as \"Table(s)\", "
                f"'{c}' as \"Column(s)\", '' as \"Criteria\", {cells['values']} as \"Values\", "
                f"{cells['distribution']} as \"Distribution\", {cells['median']} as \"Median (IQR)\", "
                f"{percent_sql(f'(select 100.0::double * count({c}) / count(*) from {t})')} "
                f"as \"Completeness\", '{kind}' as \"Extraction Type\", '' as \"Notes\"")
    return union(out)


def schema_sweep(spark, sf):
    def broken():
        return Registry.from_parquet(spark, "missing", f"{sf}/no_such_folder", ["nothing"])

    def brittle():
        return Registry(spark, "brittle", [Table("region", table(spark, sf, "region")), Table(
            "orders", table(spark, sf, "orders").selectExpr("cast(o_orderpriority as int) as priority_no"))])

    found, skipped = batch.schema_sweep(spark, {
        "brittle": brittle,
        "shop": lambda: retail(spark, sf, "orders", "events", schema_name="shop"),
        "missing": broken,
        "web": lambda: retail(spark, sf, "documents", "pages", schema_name="web"),
    }, parts={"nulls", "dates"})
    assert sorted(skipped) == ["brittle", "missing"]
    return found.select("schema", "table", "column", "row_count", "null_count", "min_date", "max_date")


SWEEP = union(
    f"select '{s}' as schema, '{t}' as \"table\", '{c}' as \"column\", count(*) as row_count, "
    f"count(*) - count({c}) as null_count, "
    + (f"cast(min({c}) as varchar) as min_date, cast(max({c}) as varchar) as max_date" if k == "date"
       else "null::varchar as min_date, null::varchar as max_date") + f" from {t}"
    for s, ts in (("shop", ("orders", "events")), ("web", ("documents", "pages")))
    for t in ts for c, _, k in columns(t))

QUERIES = {
    "list_tables": (list_tables, LIST_TABLES),
    "schema_object_counts": (object_counts, OBJECT_COUNTS),
    "list_columns": (list_columns, LIST_COLUMNS),
    "metric_kind": (metric_kind, METRIC_KIND),
    "surrogate_key_skip": (surrogate_key_skip, SURROGATE),
    "freetext_skip": (freetext_skip, FREETEXT),
    "table_profile": (table_profile, TABLE_PROFILE),
    "null_counts": (null_counts, NULL_COUNTS),
    "completeness": (completeness, COMPLETENESS),
    "continuous_summary": (continuous_summary, CONTINUOUS),
    "quartiles": (quartiles, QUARTILES),
    "quartiles_narrowed": (quartiles_narrowed, QUARTILES),
    "date_range": (date_range, DATE_RANGE),
    "top_values": (top_values, TOP_VALUES),
    "value_distribution": (value_distribution, VALUE_DISTRIBUTION),
    "top_k": (top_k, TOP_K),
    "patient_count": (patient_count, "select count(*) as patient_count from customer"),
    "subjects_per_table": (subjects_per_table, SUBJECTS),
    "subject_completeness": (subject_completeness, _subject_sql(SUBJECTED)),
    "subject_metrics_skip": (subject_metrics_skip, _subject_sql(("customer", "events_n", "part", "lineitem"))),
    "empty_table_collapse": (empty_table_collapse, EMPTY),
    "full_profile": (full_profile, _flat_sql(FULL, True, False)),
    "profile_errors": (profile_errors, PROFILE_ERRORS),
    "basic_profile": (basic_profile, _flat_sql(BASIC, False, True)),
    "basic_dictionary": (basic_dictionary, _dictionary_sql(("orders", "lineitem", "documents"))),
    "schema_sweep": (schema_sweep, SWEEP),
}
QUERIES = {k: (f, with_views(s)) for k, (f, s) in QUERIES.items()}
