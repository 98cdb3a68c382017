"""Predicates and measured variables."""

from __future__ import annotations

from pyspark.sql import functions as F

from showcase.inputs import SUBJECT_KEYS, columns, is_key, retail, table, union, with_views
from showcase.profiles import label_sql, q
from tallyframe.functions import predicates as pr
from tallyframe.operators import enrich
from tallyframe.plans import variables as vb
from tallyframe.sources import catalog as ct

# The demonstration catalogue.
DEMO = [
    dict(category="Visits", variable="Order Date", table="orders_n", column="o_orderdate",
         description="When the order was placed."),
    dict(category="Visits", variable="Order Priority", table="orders_n", column="o_orderpriority",
         criteria="o_orderstatus = 'F'", inclusion_criteria="Finished orders."),
    dict(category="Visits", variable="Order Value", table="orders_n", column="o_totalprice",
         criteria="o_orderpriority ILIKE '%urgent%' OR o_orderpriority ILIKE '%high%'",
         inclusion_criteria="Orders of high or urgent priority.", proposal="Standard"),
    dict(category="Visits", variable="Priority Prefix", table="orders_n", column="o_orderpriority",
         expression='LEFT("o_orderpriority"::text, 1)', data_source="Derived"),
    dict(category="Observations", variable="Purchase Value", table="events_n", column="value",
         match=dict(column="event_type", values=["purchase", "purchase"]), criteria="event_type ILIKE '%p%'",
         inclusion_criteria="Purchases only.", proposal="Custom"),
    dict(category="Observations", variable="Event Type", table="events_n", column="event_type",
         criteria="event_type NOT ILIKE '%sign%'", notes="Sign-ups are left out."),
    dict(category="Observations", variable="Ghost", table="events_n", column="value",
         criteria="event_type = 'refund'"),
    dict(category="Reports", variable="Note Text", table="documents", column="text", criteria="lang = 'en'",
         extraction_type="Unstructured"),
    dict(category="Items", variable="Return Flag", table="lineitem", column="l_returnflag",
         match=dict(column="l_linenumber", concept_ids=[1, 2, "3", "x", 2])),
    dict(category=None, variable="Market Segment", table="customer", column="c_mktsegment"),
    dict(category="Items", variable="Supplier", table="lineitem", column="l_suppkey"),
]
DEMO_TABLES = ("customer", "orders_n", "events_n", "lineitem", "documents")

# What the catalogue means in SQL: (scope, expression, kind of the expression, displayed criteria).
MEANING = {
    "Order Date": ("true", "o_orderdate", "date", ""),
    "Order Priority": ("o_orderstatus = 'F'", "o_orderpriority", "categorical", "o_orderstatus = 'F'"),
    "Order Value": ("(o_orderpriority ilike '%urgent%' or o_orderpriority ilike '%high%')", "o_totalprice",
                    "continuous", "o_orderpriority ILIKE '%urgent%' OR o_orderpriority ILIKE '%high%'"),
    "Priority Prefix": ("true", "left(o_orderpriority, 1)", "categorical", ""),
    "Purchase Value": ("event_type in ('purchase')", "value", "continuous", "\"event_type\" IN ('purchase')"),
    "Event Type": ("event_type not ilike '%sign%'", "event_type", "categorical", "event_type NOT ILIKE '%sign%'"),
    "Ghost": ("event_type = 'refund'", "value", "continuous", "event_type = 'refund'"),
    "Note Text": ("lang = 'en'", "text", "unstructured", "lang = 'en'"),
    "Return Flag": ("l_linenumber in (1, 2, 3)", "l_returnflag", "categorical", '"l_linenumber" IN (1, 2, 3)'),
    "Market Segment": ("true", "c_mktsegment", "categorical", ""),
    "Supplier": ("true", "l_suppkey", "continuous", ""),
}


def demo_catalog(spark):
    return ct.catalog_frame(spark, DEMO)


def demo_profile(spark, sf, parts=vb.ALL_PARTS, row_limit=None):
    return vb.variable_profile(retail(spark, sf, *DEMO_TABLES), demo_catalog(spark), row_limit, parts)


def _each(template, keep=lambda row, kind: True) -> str:
    """One SELECT per catalogue row; the template sees the row and its meaning."""
    out = []
    for row in DEMO:
        scope, expr, kind, shown = MEANING[row["variable"]]
        if not keep(row, kind):
            continue
        out.append(template(row, scope, expr, kind, shown))
    return union(out)


def _types(t, c):
    return next(ty for n, ty, _ in columns(t) if n == c)


def _id(row) -> str:
    return f"{q(row['category'] or '')} as category, {q(row['variable'])} as variable"


def number_wanted(row, kind) -> bool:
    return kind == "continuous" and not is_key(row["column"]) and not row.get("expression")


def _profile_row(row, scope, expr, kind, shown):
    key = SUBJECT_KEYS.get(row["table"])
    hit = f"{scope} and {expr} is not null"
    n = f"count(*) filter (where {hit})"
    if number_wanted(row, kind):
        numbers = ", ".join(f"round(quantile_cont({expr}, {p}) filter (where {hit}), 4) as {a}"
                            for a, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)))
    else:
        numbers = "null::double as q1, null::double as median, null::double as q3"
    dates = (f"cast(min({expr}) filter (where {hit}) as varchar) as min_date, "
             f"cast(max({expr}) filter (where {hit}) as varchar) as max_date"
             if kind == "date" else "null::varchar as min_date, null::varchar as max_date")
    subjects = (f"case when {n} > 0 then count(distinct {key}) filter (where {hit}) end" if key else "null::bigint")
    return (
        f"select {_id(row)}, '{row['table']}' as \"table\", '{row['column']}' as \"column\", {q(shown)} as criteria, "
        f"count(*) filter (where {scope}) as n_scope, {n} as n_nonnull, "
        f"round(100.0 * {n} / nullif(count(*) filter (where {scope}), 0), 4) as completeness_pct, "
        f"case when {n} > 0 then 'Yes' else 'No' end as implemented, {dates}, {numbers}, "
        f"{subjects} as subject_count, "
        + (f"round(100.0 * {subjects} / (select count(*) from customer), 4)" if key else "null::double")
        + f" as patient_pct, '{_types(row['table'], row['column'])}' as field_type from {row['table']}")


PROFILE = _each(_profile_row)


def variable_profile(spark, sf, parts=vb.ALL_PARTS):
    return demo_profile(spark, sf, parts).select(
        "category", "variable", "table", "column", "criteria", "n_scope", "n_nonnull",
        F.round("completeness_pct", 4).alias("completeness_pct"), "implemented", "min_date", "max_date",
        *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")], "subject_count",
        F.round("patient_pct", 4).alias("patient_pct"), "field_type")


def _slice(*names, rows=None, parts=()):
    def run(spark, sf):
        out = variable_profile(spark, sf, {"counts", *parts})
        if rows:
            out = out.where(rows)
        return out.select("category", "variable", *names)

    keep = f" where {rows}" if rows else ""
    return run, f"select category, variable, {', '.join(names)} from ({PROFILE}) as p{keep}"


def variable_top10(spark, sf):
    found = demo_profile(spark, sf, {"counts", "top"}).where("top_values is not null")
    each = found.select("category", "variable", "n_nonnull", F.posexplode("top_values").alias("pos", "t"))
    return each.select("category", "variable", (F.col("pos") + 1).cast("long").alias("rank"), "t.value", "t.n",
                       F.round(100.0 * F.col("t.n") / F.col("n_nonnull"), 4).alias("pct_of_nonnull"))


def _top_row(row, scope, expr, kind, shown):
    return (f"select {_id(row)}, {label_sql(expr, kind)} as value, count(*) as n from {row['table']} "
            f"where {scope} and {expr} is not null group by {expr}")


TOP10 = (
    "select category, variable, rank, value, n, round(100.0 * n / total, 4) as pct_of_nonnull from ("
    "select *, sum(n) over (partition by variable) as total, "
    "row_number() over (partition by variable order by n desc, value) as rank from ("
    + _each(_top_row, lambda row, kind: kind not in ("date", "unstructured")) + ") as c) as r where rank <= 10")


def variable_freetext(spark, sf):
    shown = vb.with_display(demo_profile(spark, sf, {"counts"}).where("free_text"))
    return shown.select("variable", "n_nonnull", "distribution", "values")


NOTE_TEXT = ("select format('{:,}', count(*)) || ' rows; values not aggregated (free text)' "
             "from documents where lang = 'en' and text is not null")
FREETEXT = ("select 'Note Text' as variable, count(*) as n_nonnull, format('{:,}', count(*)) || "
            "' rows; values not aggregated (free text)' as distribution, '' as values "
            "from documents where lang = 'en' and text is not null")


def variable_field_type(spark, sf):
    registry = retail(spark, sf, *DEMO_TABLES)
    found = demo_profile(spark, sf, {"counts"}).select("category", "variable", "table", "column", "n_nonnull")
    return enrich.with_field_type(found, registry.inventory()).select("variable", "field_type", "n_nonnull")


def expression_group_topn(spark, sf):
    found = demo_profile(spark, sf, {"counts", "top"}).where("variable = 'Priority Prefix'")
    return found.select("column", F.inline("top_values")).select("column", "value", "n")


EXPRESSION = ("select 'o_orderpriority' as \"column\", left(o_orderpriority, 1) as value, count(*) as n from orders_n "
              "where o_orderpriority is not null group by 1, 2 order by n desc, value limit 10")


# ---- predicates over rows

def criteria_filter(spark, sf):
    rows = table(spark, sf, "lineitem")
    fragment = """("l_returnflag" = 'R' OR l_discount > 0.05) AND l_quantity::text LIKE '1%'"""
    return rows.where(pr.condition(fragment)).select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


CRITERIA = ("select l_orderkey, l_linenumber, l_returnflag, l_quantity from lineitem "
            "where (l_returnflag = 'R' or l_discount > 0.05) and cast(l_quantity as varchar) like '1%'")


def ilike_any_filter(spark, sf):
    rows = table(spark, sf, "documents")
    fragment = "text ILIKE '%license%' OR text ILIKE '%the%and%of%' OR source ILIKE 'WEB%'"
    return rows.where(pr.condition(fragment)).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))


ILIKE = ("select lang, source, count(*) as n from documents where text ilike '%license%' or "
         "text ilike '%the%and%of%' or source ilike 'WEB%' group by lang, source")


def not_ilike_filter(spark, sf):
    rows = table(spark, sf, "conversations")
    return rows.where(pr.condition("text NOT ILIKE '%the%' AND role NOT ILIKE 'SYS%'")).select("conv_id", "turn", "role")


NOT_ILIKE = ("select conv_id, turn, role from conversations "
             "where text not ilike '%the%' and role not ilike 'SYS%'")


def equality_filter(spark, sf):
    rows = table(spark, sf, "events")
    return rows.where(pr.condition("event_type = 'purchase'")).select("event_id", "user_id", "value")


def nonnull_scope_counts(spark, sf):
    rows = table(spark, sf, "events_n")
    scope = pr.condition("event_type ILIKE '%i%'")
    return rows.groupBy("user_id").agg(
        F.count_if(scope).alias("n_scope"), F.count_if(scope & F.col("value").isNotNull()).alias("n_nonnull"))


NONNULL = ("select user_id, count(*) filter (where event_type ilike '%i%') as n_scope, "
           "count(*) filter (where event_type ilike '%i%' and value is not null) as n_nonnull "
           "from events_n group by user_id")

def match_values_filter(spark, sf):
    """A short set as IN list, and one that grows with the data as a semi join."""
    short = pr.match_filter(table(spark, sf, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY", "BUILDING", "it's"])
    rich = table(spark, sf, "customer").where("c_acctbal > 4000").select("c_name")
    return pr.match_filter(short, "c_name", rich).select("c_custkey", "c_name", "c_mktsegment")


MATCH_VALUES = ("select c_custkey, c_name, c_mktsegment from customer where c_mktsegment in ('BUILDING', 'MACHINERY', "
                "'it''s') and c_name in (select c_name from customer where c_acctbal > 4000)")


def match_ids_filter(spark, sf):
    """Ids given as text: integers count, the rest is dropped."""
    given = ct.catalog_frame(spark, [dict(match=dict(column="l_linenumber", values=["9"],
                                                     concept_ids=[1, "3", " 5 ", "x", 3, "2.5"]))])
    predicate = given.select(pr.match_sql(F.col("match")).alias("p")).first()["p"]
    return table(spark, sf, "lineitem").where(pr.condition(predicate)).groupBy("l_linenumber", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"))


MATCH_IDS = ("select l_linenumber, l_returnflag, count(*) as n from lineitem where l_linenumber in (1, 3, 5) "
             "group by l_linenumber, l_returnflag")


# ---- a catalogue derived from the parts: one row per part, as a table of any size

PART_ROWS = [
    "p_partkey as position",
    "case when p_size in (7, 14, 21, 28) then null else p_type end as category",
    "p_name || ' ' || p_brand as variable",
    "case when p_size < 20 then 'A item, TODO check' else p_name end as description",
    "case when p_size = 3 then '' else 'part' end as \"table\"",
    "case when p_size < 8 then 'value_as_number' when p_size < 16 then 'drug_concept_name' "
    "when p_size < 24 then 'start_date' when p_size < 32 then 'drug_concept_id' "
    "when p_size < 36 then '' else 'p_brand' end as \"column\"",
    "case when p_size = 40 then 'upper(p_brand)' end as expression",
    "case when p_retailprice < 950 then null when p_retailprice < 970 then 'observation_concept_name ILIKE ''%x%''' "
    "when p_retailprice < 980 then 'drug_concept_name = ''y''' when p_retailprice < 995 then "
    "'p_name ILIKE ''ring'' or p_name ILIKE ''small%''' else '  ' end as criteria",
    "case when p_brand < 'Brand#12' then 'Explained.' end as inclusion_criteria",
    "case when p_size < 10 then 'Unstructured' when p_size < 20 then 'abstracted' when p_size < 30 then '' "
    "when p_size < 40 then 'Other kind' else 'Structured' end as extraction_type",
    "case when p_size > 45 then 'Curated ' else null end as data_source",
    "case when p_brand = 'Brand#2' then 'custom' when p_brand = 'Brand#3' then 'Custom' end as proposal",
    "case when p_brand in ('Brand#1', 'Brand#2') then '' when p_brand < 'Brand#15' then 'drug_concept_id' "
    "when p_brand < 'Brand#2' then ' p_name ' else null end as match_column",
    "case when p_size in (5, 6, 12, 28) then 'label_text' when p_size = 30 then 'label text' end as name_column",
    "p_name as match_value_1", "p_brand as match_value_2",
    "case when p_retailprice > 960 then cast(p_size as varchar(9)) end as match_id",
]


def quoted(expression: str) -> str:
    return expression.replace('"table"', "`table`").replace('"column"', "`column`").replace("varchar(9)", "string")


def part_catalog(spark, sf):
    """Flat part rows in the shape of a catalogue with value sets."""
    flat = table(spark, sf, "part").selectExpr(*[quoted(e) for e in PART_ROWS])
    ids = F.when(F.col("match_id").isNotNull(), F.array("match_id", F.lit("x"), F.lit(" 7 "), "match_id"))
    match = F.struct(
        F.col("match_column").alias("column"), F.col("name_column"),
        F.array("match_value_1", "match_value_2", "match_value_1").alias("values"),
        F.lit(None).cast("string").alias("values_file"),
        ids.alias("concept_ids"))
    return flat.select(
        F.lit("parts").alias("layer"), F.lit(0).alias("layer_rank"), "position", "category", "variable",
        "description", "table", "column", "expression", "criteria", "inclusion_criteria", "extraction_type",
        F.lit(None).cast("string").alias("notes"), F.lit(None).cast("string").alias("coding_schema"),
        "data_source", "proposal", F.when(F.col("match_column").isNotNull(), match).alias("match"))


# the same rows with their compiled value set, in SQL
PART_CATALOG = f"""
parts as (select {', '.join(PART_ROWS)} from part),
compiled as (
  select *, trim(coalesce(match_column, '')) as mc,
    case when trim(coalesce(match_column, '')) = '' then ''
         when match_id is not null then '"' || trim(match_column) || '" IN (' ||
              case when match_id = '7' then '7' else match_id || ', 7' end || ')'
         else '"' || trim(match_column) || '" IN (''' || match_value_1 || ''', ''' || match_value_2 || ''')' end as match_sql
  from parts),
cat as (select *, case when match_sql <> '' then match_sql else trim(coalesce(criteria, '')) end as effective,
               trim(coalesce(criteria, '')) as broad from compiled)"""


def match_overrides_criteria(spark, sf):
    rows = part_catalog(spark, sf)
    return rows.select("position", ct.effective_criteria(F.col("criteria"), F.col("match")).alias("criteria"))


def has_scope(spark, sf):
    rows = part_catalog(spark, sf)
    return rows.select("position", ct.has_scope(F.col("criteria"), F.col("match")).alias("has_scope"))


def dry_run_variables(spark, sf):
    return vb.dry_run(part_catalog(spark, sf)).select(
        "position", "category", "variable", "table", "column", "criteria", "implemented", "n_nonnull",
        "completeness_pct", "extraction_type", "inclusion_criteria", "data_source", "proposal")


DEFAULT_INCLUSION = "Records are included for each patient in the cohort."
SOURCE_SQL = ("case when trim(coalesce(data_source, '')) <> '' then trim(data_source) "
              "else case lower(extraction_type) when 'unstructured' then 'NLP' when 'abstracted' then 'Abstracted' "
              "else 'Normalized' end end")
INCLUSION_SQL = (f"case when coalesce(inclusion_criteria, '') <> '' then inclusion_criteria "
                 f"when effective = '' then '{DEFAULT_INCLUSION}' else '' end")
DRY_RUN = (
    f"with {PART_CATALOG} select position, coalesce(category, '') as category, variable, \"table\", \"column\", "
    f"effective as criteria, 'No' as implemented, null::bigint as n_nonnull, null::double as completeness_pct, "
    f"case when coalesce(extraction_type, '') = '' then 'Structured' else extraction_type end as extraction_type, "
    f"{INCLUSION_SQL} as inclusion_criteria, {SOURCE_SQL} as data_source, coalesce(proposal, '') as proposal from cat")


def derive_data_source(spark, sf):
    rows = part_catalog(spark, sf)
    name = (F.when(F.col("column") == "drug_concept_name", "infusion")
            .when(F.col("column") == "start_date", "cohort_patients").otherwise("part"))
    return rows.select("position", enrich.data_source(
        F.col("extraction_type"), name, F.col("data_source")).alias("data_source"))


DERIVE_SOURCE = (
    f"with {PART_CATALOG} select position, case when trim(coalesce(data_source, '')) <> '' then trim(data_source) "
    f"when \"column\" = 'drug_concept_name' then 'Enhanced' when \"column\" = 'start_date' then 'Derived' "
    f"else case lower(extraction_type) when 'unstructured' then 'NLP' when 'abstracted' then 'Abstracted' "
    f"else 'Normalized' end end as data_source from cat")


def derive_inclusion(spark, sf):
    rows = part_catalog(spark, sf)
    name = F.when(F.col("column") == "p_brand", "death").otherwise("part")
    return rows.select("position", enrich.inclusion_text(
        ct.effective_criteria(F.col("criteria"), F.col("match")), F.col("inclusion_criteria"), name)
        .alias("inclusion_criteria"))


DERIVE_INCLUSION = (
    f"with {PART_CATALOG} select position, case when coalesce(inclusion_criteria, '') <> '' then inclusion_criteria "
    f"when effective <> '' then '' when \"column\" = 'p_brand' then "
    f"'One record is included for each patient with a recorded death.' else '{DEFAULT_INCLUSION}' end "
    f"as inclusion_criteria from cat")


def resolve_matcher(spark, sf):
    return ct.resolve_scope(part_catalog(spark, sf)).select("position", "matcher_column")


MATCHER_SQL = (
    "case when mc <> '' then mc when \"column\" = '' then '' when broad like 'observation_concept_name%' then 'observation_concept_name' "
    "when broad like 'drug_concept_name%' then 'drug_concept_name' "
    "when \"column\" in ('value_as_number', 'start_date') then '' else \"column\" end")


def resolve_scope(spark, sf):
    return ct.resolve_scope(part_catalog(spark, sf)).select(
        "position", "matcher_column", "scope_sql", "displayed_criteria", "skip_reason")


RESOLVE_SCOPE = (
    f"with {PART_CATALOG}, m as (select *, {MATCHER_SQL} as matcher_column, "
    f"case when broad <> '' then broad else match_sql end as scope_sql from cat) "
    f"select position, matcher_column, scope_sql, case when match_sql <> '' then match_sql else broad end "
    f"as displayed_criteria, case when \"table\" = '' then 'missing table' "
    f"when matcher_column = '' and \"column\" = '' then 'missing column' "
    f"when matcher_column = '' then 'column `' || \"column\" || '` is a value/date column; configure `match.column`' "
    f"when scope_sql = '' then 'neither criteria nor a value set: cannot scope a search without changing the "
    f"variable' else '' end as skip_reason from m")


def id_name_columns(spark, sf):
    rows = ct.resolve_scope(part_catalog(spark, sf))
    ids, names = ct.id_and_name_columns(F.col("matcher_column"), F.col("column"), F.col("match.name_column"))
    return rows.select("position", "matcher_column", ids.alias("id_column"), names.alias("name_column"))


ID_NAME = (
    f"with {PART_CATALOG}, m as (select *, {MATCHER_SQL} as matcher_column, "
    f"case when match_column is null then null else name_column end as override from cat) "
    f"select position, matcher_column, "
    f"case matcher_column when 'drug_concept_id' then 'drug_concept_id' when 'drug_concept_name' then 'drug_concept_id' "
    f"when 'observation_concept_name' then 'observation_concept_id' else '' end as id_column, "
    f"case when matcher_column in ('drug_concept_id', 'drug_concept_name', 'observation_concept_name') then "
    f"coalesce(override, case when matcher_column = 'drug_concept_id' then 'drug_concept_name' else matcher_column end) "
    f"else '' end as name_column from m")


QUERIES = {
    "criteria_filter": (criteria_filter, CRITERIA),
    "ilike_any_filter": (ilike_any_filter, ILIKE),
    "not_ilike_filter": (not_ilike_filter, NOT_ILIKE),
    "equality_filter": (equality_filter, "select event_id, user_id, value from events where event_type = 'purchase'"),
    "nonnull_scope_counts": (nonnull_scope_counts, NONNULL),
    "match_values_filter": (match_values_filter, MATCH_VALUES),
    "match_ids_filter": (match_ids_filter, MATCH_IDS),
    "match_overrides_criteria": (match_overrides_criteria,
                                 f"with {PART_CATALOG} select position, effective as criteria from cat"),
    "has_scope": (has_scope, f"with {PART_CATALOG} select position, effective <> '' as has_scope from cat"),
    "dry_run_variables": (dry_run_variables, DRY_RUN),
    "derive_data_source": (derive_data_source, DERIVE_SOURCE),
    "derive_inclusion": (derive_inclusion, DERIVE_INCLUSION),
    "resolve_matcher": (resolve_matcher, f"with {PART_CATALOG} select position, {MATCHER_SQL} as matcher_column from cat"),
    "resolve_scope": (resolve_scope, RESOLVE_SCOPE),
    "id_name_columns": (id_name_columns, ID_NAME),
    "expression_group_topn": (expression_group_topn, EXPRESSION),
    "variable_profile": (variable_profile, PROFILE),
    "variable_completeness": _slice("n_scope", "n_nonnull", "completeness_pct"),
    "variable_implemented": _slice("n_nonnull", "implemented"),
    "variable_date_range": _slice("min_date", "max_date", rows="field_type = 'timestamp_ntz'",
                                  parts=["dates"]),
    "variable_quartiles": _slice("q1", "median", "q3", rows="median is not null",
                                 parts=["quartiles"]),
    "variable_subject_pct": _slice("subject_count", "patient_pct", parts=["subjects"]),
    "variable_top10": (variable_top10, TOP10),
    "variable_freetext": (variable_freetext, FREETEXT),
    "variable_field_type": (variable_field_type,
                            f"select variable, field_type, n_nonnull from ({PROFILE}) as p"),
}
QUERIES = {k: (f, with_views(s)) for k, (f, s) in QUERIES.items()}
