"""Enrichment, the assembled model, audience views, roll-ups and batches."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from showcase.inputs import SUBJECT_KEYS, columns, retail, table, union, with_views
from showcase.profiles import cells_sql, q
from showcase.variables import DEFAULT_INCLUSION, DEMO, MEANING, NOTE_TEXT, PROFILE, TOP10, demo_catalog, demo_profile, number_wanted, \
    part_catalog, PART_CATALOG
from tallyframe.operators import enrich, rollups
from tallyframe.plans import audience as au, batch, model as md, profile as pf, release
from tallyframe.sources import catalog as ct, sinks
from tallyframe.sources.registry import Registry

TABLES = ("customer", "orders_n", "events_n", "lineitem", "documents", "nation", "region")
CONFIG = md.Enrichment(
    categories={"Visits": ["orders_n", "lineitem"], "Observations": ["events_n"], "Reports": ["documents"],
                "Geography": ["customer"]},
    table_descriptions={
        "customer": {"description": " One row per customer. ", "inclusion_criteria": "Everyone.",
                     "data_source": "Normalized", "source_table": "CUSTOMER"},
        "events_n": "What users did.", "lineitem": {"description": None}, "nation": None},
    column_descriptions={"customer.c_mktsegment": "Segment of the customer.", "events_n.value": "Amount.",
                         "events_n.nothing": "No such column."},
    sensitive_pairs={"customer": ["c_name"], "documents": ["text"]},
    sensitive_patterns=["_name$", "^url$"],
    date_candidates=[("events_n", "ts"), ("orders_n", "o_orderdate"), ("customer", "c_name"), ("lineitem", "l_shipdate")],
    layout={"customer": {"exclude_tables": ["region"]},
            "cohorts": {"retail_cohort": {"customer": {"extra_exclude_tables": ["nation"]}}}},
)
SPEC = md.CohortSpec.from_mapping(dict(
    cohort_name="retail_cohort", provider="Shop", disease="None", schema_name="retail",
    display_name="Retail", description=" Orders and events. ",
    category_rules={"Demographics": {"tables": ["customer"]}},
    known_limitations=[" Invented data. ", " "], sign_off={"reviewer": " R. Viewer "}), slug="retail")
STAMP = "2024-06-01T00:00:00+00:00"

CATEGORY = {"customer": "Demographics", "orders_n": "Visits", "lineitem": "Visits", "events_n": "Observations",
            "documents": "Reports", "nation": "Other", "region": "Other"}
DESCRIPTION = {"customer": ("One row per customer.", "Everyone.", "Normalized", "CUSTOMER"),
               "events_n": ("What users did.", "", "", "")}
HIDDEN = ("nation", "region")


def is_pii(t: str, c: str) -> bool:
    return (t, c) in {("customer", "c_name"), ("documents", "text")} or c.endswith("_name") or c == "url"


def _registry(spark, sf):
    return retail(spark, sf, *TABLES)


def _model(spark, sf, dry_run=False):
    return md.build_model(SPEC, _registry(spark, sf), demo_catalog(spark), CONFIG, dry_run,
                          generated_at=STAMP, revision="r1")


# ---- enrichment of measured frames

def enrich_category(spark, sf):
    found = pf.table_profile(_registry(spark, sf))
    return enrich.with_category(found, enrich.category_frame(spark, CONFIG.categories),
                                enrich.category_frame(spark, SPEC.category_rules)
                                ).select("table", "category", "row_count")


ENRICH_CATEGORY = union(f"select '{t}' as \"table\", '{CATEGORY[t]}' as category, count(*) as row_count from {t}"
                        for t in TABLES)


def enrich_table_desc(spark, sf):
    found = pf.table_profile(_registry(spark, sf))
    return enrich.with_table_description(found, enrich.description_frame(spark, CONFIG.table_descriptions)).select(
        "table", "row_count", *enrich.TABLE_FIELDS)


def _desc(t):
    d = DESCRIPTION.get(t, ("", "", "", ""))
    return ", ".join(f"{q(v)} as {f}" for v, f in zip(d, enrich.TABLE_FIELDS))


ENRICH_TABLE = union(f"select '{t}' as \"table\", count(*) as row_count, {_desc(t)} from {t}" for t in TABLES)


def enrich_column_desc(spark, sf):
    found = pf.column_profile(_registry(spark, sf), parts={"nulls"})
    return enrich.with_column_description(
        found, enrich.column_description_frame(spark, CONFIG.column_descriptions)
    ).select("table", "column", "description", "null_count")


ENRICH_COLUMN = union(
    f"select '{t}' as \"table\", '{c}' as \"column\", "
    f"{q(CONFIG.column_descriptions.get(f'{t}.{c}', ''))} as description, count(*) - count({c}) as null_count from {t}"
    for t in TABLES for c, _, _ in columns(t))


def pii_flag(spark, sf):
    found = pf.column_profile(_registry(spark, sf), parts={"nulls"})
    return enrich.with_sensitive_flag(found, enrich.sensitive_frame(spark, CONFIG.sensitive_pairs),
                                      CONFIG.sensitive_patterns).select("table", "column", "pii", "row_count")


PII_FLAG = union(f"select '{t}' as \"table\", '{c}' as \"column\", {str(is_pii(t, c)).lower()} as pii, "
                 f"count(*) as row_count from {t}" for t in TABLES for c, _, _ in columns(t))


def column_extraction_type(spark, sf):
    found = pf.column_profile(_registry(spark, sf), parts={"nulls"})
    flagged = enrich.with_sensitive_flag(found, enrich.sensitive_frame(spark, CONFIG.sensitive_pairs),
                                         CONFIG.sensitive_patterns)
    return flagged.select("table", "column", "row_count",
                          enrich.extraction_type(F.col("kind"), F.col("pii")).alias("extraction_type"))


EXTRACTION = union(
    f"select '{t}' as \"table\", '{c}' as \"column\", count(*) as row_count, "
    f"'{'PII' if is_pii(t, c) else 'Unstructured' if k == 'unstructured' else 'Structured'}' as extraction_type from {t}"
    for t in TABLES for c, _, k in columns(t))


def exclude_list_resolve(spark, sf):
    """Tables per configuration, with a flag for those hidden from customers."""
    found = pf.table_profile(_registry(spark, sf)).select("table", "row_count")
    layout = {"customer": {"exclude_tables": ["region", "documents"]},
              "cohorts": {"a": {"customer": {"exclude_tables": ["nation"]}},
                          "b": {"customer": {"extra_exclude_tables": ["nation"]}}, "c": {"customer": {}}}}
    cases = {"replace": ["a", "b"], "extend": [None, "b", "a"], "skip_empty": ["c", "b"], "global": ["z"]}
    out = None
    for name, candidates in cases.items():
        hidden = sorted(enrich.exclude_list(layout, candidates))
        part = found.select(F.lit(name).alias("case"), "table", F.col("table").isin(hidden).alias("hidden"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


_CASES = {"replace": ("nation",), "extend": ("region", "documents", "nation"),
          "skip_empty": ("region", "documents", "nation"), "global": ("region", "documents")}
EXCLUDES = union(f"select '{n}' as \"case\", '{t}' as \"table\", {str(t in hidden).lower()} as hidden, "
                 f"count(*) as row_count from {t}" for n, hidden in _CASES.items() for t in TABLES)


# ---- date coverage, digest, summary

def date_coverage(spark, sf):
    found = pf.column_profile(_registry(spark, sf), parts={"dates"})
    return md.date_coverage(found, CONFIG.date_candidates).select(
        "min_date", "max_date", "years_of_data", F.array_join("contributing_columns", ", ").alias("contributing"))


_BOUNDS = ("select least((select min(ts) from events_n), (select min(o_orderdate) from orders_n), "
           "(select min(l_shipdate) from lineitem)) as lo, greatest((select max(ts) from events_n), "
           "(select max(o_orderdate) from orders_n), (select max(l_shipdate) from lineitem)) as hi")
_YEARS = "round(date_diff('day', cast(lo as date), cast(hi as date)) / 365.25, 2)"
DATE_COVERAGE = (f"select cast(lo as varchar) as min_date, cast(hi as varchar) as max_date, {_YEARS} as years_of_data, "
                 f"'events_n.ts, orders_n.o_orderdate, lineitem.l_shipdate' as contributing from ({_BOUNDS}) as b")


def schema_digest(spark, sf):
    found = pf.column_profile(_registry(spark, sf), parts={"nulls"})
    total = found.agg(F.sum(F.expr("if(ordinal = 1, row_count, 0)")).alias("row_count"))
    return md.schema_digest(found).join(total)


_DIGEST_TEXT = "".join(f"{t}.{c}:{ty}\\n" for t, c, ty in sorted(
    (t, c, ty) for t in TABLES for c, ty, _ in columns(t)))
_ROWS = " + ".join(f"(select count(*) from {t})" for t in TABLES)
DIGEST_SQL = f"'sha256:' || sha256(e'{_DIGEST_TEXT}')"
SCHEMA_DIGEST = f"select {DIGEST_SQL} as digest, cast({_ROWS} as bigint) as row_count"


def cohort_summary(spark, sf):
    """The counts of the model's summary; nothing else of the model is measured."""
    model = md.build_model(SPEC, _registry(spark, sf), demo_catalog(spark), CONFIG, generated_at=STAMP,
                           revision="r1", parts={"nulls", "counts"})
    return model.summary.select("patient_count", F.col("table_count").cast("long").alias("table_count"),
                                F.col("column_count").cast("long").alias("column_count"))


COHORT_SUMMARY = (f"select (select count(*) from customer) as patient_count, {len(TABLES)}::bigint as table_count, "
                  f"{sum(len(columns(t)) for t in TABLES)}::bigint as column_count")


# ---- the model

def model_sort(spark, sf):
    """Tables of the model in order, and documents sorted by (source, lang) as a larger case."""
    rows = table(spark, sf, "documents").withColumn("category", F.concat(
        F.lit(" "), F.when(F.col("lang") == "en", F.upper("source")).otherwise(F.col("source"))))
    done = md.ordered(rows.select("category", "lang", "doc_id"), "category", "lang", "doc_id")
    return done.select(F.lower(F.trim("category")).alias("category_key"), "lang", "doc_id")


MODEL_SORT = ("select lower(source) as category_key, lang, doc_id from documents "
              "order by category_key, lang, cast(doc_id as varchar)")


def model_json(spark, sf):
    """Every record of the tables section as JSON text."""
    return md.records(_model(spark, sf)).where("section = 'tables'").select("section", "record", "json")


def _table_json(t):
    d = DESCRIPTION.get(t, ("", "", "", ""))
    subjects = f"cast(count(distinct {SUBJECT_KEYS[t]}) as varchar)" if t in SUBJECT_KEYS else "'null'"
    fields = "".join(f',"{f}":"{v}"' for f, v in zip(enrich.TABLE_FIELDS, d))
    return (f"select 'tables' as section, '{t}' as record, '{{\"table\":\"{t}\",\"category\":\"{CATEGORY[t]}\","
            f"\"row_count\":' || count(*) || ',\"column_count\":{len(columns(t))},\"subject_count\":' || {subjects} || "
            f"'{fields}}}' as json from {t}")


MODEL_JSON = union(_table_json(t) for t in TABLES)


def model_records(spark, sf):
    """Every field of every record of all four sections, read back from its JSON: (section, record, field, value)."""
    fields = F.from_json("json", "map<string,string>")
    return md.records(_model(spark, sf)).select("section", "record", F.explode(fields).alias("field", "value"))


def _fields(section, record, fields, source):
    """(section, record, field, value) rows of one SQL row of texts."""
    cells = ", ".join(f"struct_pack(f := '{name}', v := cast({value} as varchar))" for name, value in fields.items())
    return (f"select '{section}' as section, record, c.f as field, c.v as value from "
            f"(select {record} as record, unnest([{cells}]) as c {source}) as x")


def _records_sql():
    texts = {"cohort": "retail_cohort", "provider": "Shop", "disease": "None", "schema_name": "retail", "variant": "raw",
             "display_name": "Retail", "description": "Orders and events.", "status": "active", "generated_at": STAMP,
             "git_sha": "r1", "introspect_version": md.ENGINE_VERSION, "data_cutoff_date": "", "last_etl_run": "",
             "table_count": str(len(TABLES)), "column_count": str(sum(len(columns(t)) for t in TABLES)),
             "contributing_columns": '["events_n.ts","orders_n.o_orderdate","lineitem.l_shipdate"]',
             "known_limitations": '["Invented data."]', "sign_off": '{"reviewer":"R. Viewer"}'}
    summary = {**{k: q(v) for k, v in texts.items()}, "patient_count": "(select count(*) from customer)",
               "min_date": "cast(lo as varchar)", "max_date": "cast(hi as varchar)", "years_of_data": _YEARS,
               "schema_snapshot_digest": DIGEST_SQL}
    out = [_fields("summary", "'retail_cohort'", summary, f"from ({_BOUNDS}) as b")]
    for t in TABLES:
        known = {"table": q(t), "category": q(CATEGORY[t]), "row_count": "count(*)", "column_count": len(columns(t)),
                 "subject_count": f"count(distinct {SUBJECT_KEYS[t]})" if t in SUBJECT_KEYS else "null",
                 **dict(zip(enrich.TABLE_FIELDS, map(q, DESCRIPTION.get(t, ("", "", "", "")))))}
        out.append(_fields("tables", q(t), known, f"from {t}"))
        for c, ty, k in columns(t):
            cells, key = cells_sql(t, c, k, keys=False), SUBJECT_KEYS.get(t)
            kind = "PII" if is_pii(t, c) else "Unstructured" if k == "unstructured" else "Structured"
            out.append(_fields("columns", q(f"{t}/{c}"), {
                "category": q(CATEGORY[t]), "table": q(t), "column": q(c),
                "description": q(CONFIG.column_descriptions.get(f"{t}.{c}", "")), "data_type": q(ty),
                "values": cells["values"], "distribution": cells["distribution"], "median_iqr": cells["median"],
                "completeness_pct": f"(1 - (count(*) - count({c})) / count(*)::double) * 100",
                "patient_pct": f"100.0::double * count(distinct {key}) filter (where {c} is not null) / "
                               f"(select count(*) from customer)" if key else "null",
                "extraction_type": q(kind), "pii": q(str(is_pii(t, c)).lower()), "notes": "''", "nullable": "'Yes'",
                "example": cells["example"], "coding_schema": "''",
                "data_source": q("NLP" if kind == "Unstructured" else "Normalized")}, f"from {t}"))
    pairs = "select string_agg({0}, ',' order by rank) from top10 as t where t.variable = cells.variable"
    values = pairs.format("'{\"value\":\"' || value || '\",\"n\":' || n || '}'")
    labels = pairs.format("'\"' || value || '\"'")
    place = "case cells.variable " + " ".join(
        f"when {q(row['variable'])} then {{0[{i}]}}" for i, row in enumerate(DEMO)) + " end"
    told = lambda values: place.format([q(v) for v in values])
    same = ("table", "column", "category", "variable", "description", "criteria", "implemented", "notes", "field_type",
            "inclusion_criteria", "coding_schema", "data_source", "distribution", "median_iqr", "values",
            "observed_values", "example", "min_date", "max_date", "n_scope", "n_nonnull", "subject_count", "q1",
            "median", "q3")
    out.append(_fields("variables", "category || '/' || variable", {
        **{f: f'cells."{f}"' for f in same},
        "completeness_pct": "100.0::double * n_nonnull / nullif(n_scope, 0)",
        "patient_pct": "100.0::double * subject_count / (select count(*) from customer)",
        "top_values": f"(select '[' || ({values}) || ']')", "error": "''", "first_rank": "0",
        "top_value_labels": f"'[' || coalesce(({labels}), '') || ']'",
        "extraction_type": told([row.get("extraction_type", "Structured") for row in DEMO]),
        "proposal": told([row.get("proposal", "") for row in DEMO]),
        "free_text": told([str(row["variable"] == "Note Text").lower() for row in DEMO]),
        "pii": told([str(is_pii(row["table"], row["column"])).lower() for row in DEMO]),
        "position": told([str(i) for i in range(len(DEMO))])}, "from cells"))
    return _variable_cells_sql() + union(out)


def model_document(spark, sf):
    """The one-document form; SQL checks the counts of its records."""
    doc = md.document(_model(spark, sf))
    count = lambda name: F.size(F.from_json(F.get_json_object("json", f"$.{name}"), "array<string>")).cast("long")
    return doc.select(count("tables").alias("tables"), count("columns").alias("columns"),
                      count("variables").alias("variables"),
                      F.get_json_object("json", "$.summary.patient_count").cast("long").alias("patients"),
                      F.get_json_object("json", "$.summary.known_limitations[0]").alias("limitation"),
                      F.get_json_object("json", "$.summary.sign_off.reviewer").alias("reviewer"))


MODEL_DOCUMENT = (f"select {len(TABLES)}::bigint as tables, {sum(len(columns(t)) for t in TABLES)}::bigint as columns, "
                  f"{len(DEMO)}::bigint as variables, count(*) as patients, 'Invented data.' as limitation, "
                  f"'R. Viewer' as reviewer from customer")

AUDIENCES = ("technical", "pharma", "customer", "sales")


def _light_model(spark, sf):
    """Only what the audience filters look at: the model is measured once for four views."""
    registry, catalog = _registry(spark, sf), demo_catalog(spark)
    return md.build_model(SPEC, registry, catalog, CONFIG, generated_at=STAMP, revision="r1",
                          parts={"nulls", "counts", "subjects"})


def audience_filter(spark, sf):
    """Rows of columns and variables left per audience."""
    model = _light_model(spark, sf)
    out = None
    for a in AUDIENCES:
        seen = au.view(model, a, CONFIG.layout)
        both = seen.columns.select(F.lit("columns").alias("section"), F.concat_ws(".", "table", "column").alias("record"))
        both = both.unionByName(seen.variables.select(F.lit("variables").alias("section"), F.col("variable").alias("record")))
        part = both.select(F.lit(a).alias("audience"), "section", "record")
        out = part if out is None else out.unionByName(part)
    return out


def _audience_rows(a):
    out = []
    if au.VISIBILITY[a]["columns"]:
        out += [f"select '{a}' as audience, 'columns' as section, '{t}.{c}' as record"
                for t in TABLES for c, _, _ in columns(t)
                if a == "technical" or not (is_pii(t, c) or (a == "customer" and t in HIDDEN))]
    for row in DEMO:
        if a != "technical" and is_pii(row["table"], row["column"]):
            continue
        keep = ""
        if a in ("customer", "sales"):
            scope, expr, _, _ = MEANING[row["variable"]]
            keep = f" where exists (select 1 from {row['table']} where {scope} and {expr} is not null)"
        out.append(f"select '{a}' as audience, 'variables' as section, '{row['variable']}' as record{keep}")
    return union(out)


AUDIENCE_FILTER = union(_audience_rows(a) for a in AUDIENCES)


def audience_table_exclude(spark, sf):
    """Tables and their columns left after hiding internal tables."""
    registry = _registry(spark, sf)
    hidden = enrich.exclude_list(CONFIG.layout, [SPEC.slug, SPEC.cohort, SPEC.schema_name])
    found = au.drop_tables(pf.column_profile(registry, parts={"nulls"}), hidden)
    return found.groupBy("table").agg(F.count(F.lit(1)).alias("column_count"), F.max("row_count").alias("row_count"))


AUDIENCE_EXCLUDE = union(f"select '{t}' as \"table\", {len(columns(t))}::bigint as column_count, "
                         f"count(*) as row_count from {t}" for t in TABLES if t not in HIDDEN)


def audience_visibility(spark, sf):
    """Visible sections with their record counts, per audience."""
    model = _light_model(spark, sf)
    out = None
    for a in AUDIENCES:
        seen = au.view(model, a, CONFIG.layout)
        for name, frame in seen.sections().items():
            part = frame.agg(F.count(F.lit(1)).alias("records")).select(
                F.lit(a).alias("audience"), F.lit(name).alias("section"),
                F.lit(au.visible(a, name)).alias("visible"), "records")
            out = part if out is None else out.unionByName(part)
    return out


VISIBILITY = union(
    f"select '{a}' as audience, '{s}' as section, {str(v).lower()} as visible, "
    + ("1::bigint" if s == "summary" else
       "0::bigint" if not v else
       f"{len([t for t in TABLES if a not in au.STAKEHOLDERS or t not in HIDDEN])}::bigint" if s == "tables" else
       f"(select count(*) from ({AUDIENCE_FILTER}) as f where audience = '{a}' and section = '{s}')")
    + " as records" for a in AUDIENCES for s, v in au.VISIBILITY[a].items())


def audience_view(spark, sf):
    """The customer's view: variables with their coverage."""
    seen = au.view(_light_model(spark, sf), "customer", CONFIG.layout)
    return seen.variables.select("category", "variable", "implemented",
                                 F.round("completeness_pct", 4).alias("completeness_pct"))


AUDIENCE_VIEW = (f"select category, variable, implemented, completeness_pct from ({PROFILE}) as p "
                 f"where implemented = 'Yes' and variable <> 'Note Text'")


def layout_summary(spark, sf):
    model = _model(spark, sf)
    rows = None
    for a in ("technical", "customer"):
        for form, part in (("keys", au.summary_rows(model, a)), ("titles", au.summary_titles(model, a))):
            part = part.select(F.lit(a).alias("audience"), F.lit(form).alias("form"), "position", "metric", "value")
            rows = part if rows is None else rows.unionByName(part)
    return rows


def _summary_sql():
    known = {"cohort": "'retail_cohort'", "provider": "'Shop'", "disease": "'None'", "display_name": "'Retail'",
             "schema_name": "'retail'", "variant": "'raw'", "patient_count": "cast(n as varchar)",
             "table_count": f"'{len(TABLES)}'", "column_count": f"'{sum(len(columns(t)) for t in TABLES)}'",
             "min_date": "cast(lo as varchar)", "max_date": "cast(hi as varchar)",
             "years_of_data": f"cast({_YEARS} as varchar)", "status": "'active'", "generated_at": f"'{STAMP}'",
             "git_sha": "'r1'", "introspect_version": f"'{md.ENGINE_VERSION}'", "schema_snapshot_digest": DIGEST_SQL}
    line = f"cast(lo as varchar) || ' → ' || cast(hi as varchar) || ' (' || cast({_YEARS} as varchar) || ' years)'"
    out = []
    for a in ("technical", "customer"):
        entries = au.LAYOUTS[a][0]
        for form, shown in (("keys", [(k, k) for k, _ in entries if k]), ("titles", [(t, k) for k, t in entries if t])):
            out += [f"select '{a}' as audience, '{form}' as form, {i} as position, '{m}' as metric, "
                    f"{known[k] if k else line} as value from b" for i, (m, k) in enumerate(shown)]
    return f"with b as (select *, (select count(*) from customer) as n from ({_BOUNDS}) as x) " + union(out)


def _tables(spark, sf, config, own):
    registry = _registry(spark, sf)
    return md.tables_section(registry, pf.table_profile(registry), config, own)


def layout_tables(spark, sf):
    tables = _tables(spark, sf, CONFIG, enrich.category_frame(spark, SPEC.category_rules))
    return au.tables_layout(tables, "technical")


def _tables_layout_sql(fields):
    out = []
    for t in TABLES:
        d = DESCRIPTION.get(t, ("", "", "", ""))
        patients = f"cast(count(distinct {SUBJECT_KEYS[t]}) as varchar)" if t in SUBJECT_KEYS else "'—'"
        known = {"Table": q(t), "Category": q(CATEGORY[t]), "Description": q(d[0]), "Inclusion Criteria": q(d[1]),
                 "Data Source": q(d[2]), "Source Table": q(d[3]), "Rows": "count(*)",
                 "Columns": str(len(columns(t))), "Patients": patients}
        out.append("select " + ", ".join(f"{known[f]} as \"{f}\"" for f in fields) + f" from {t}")
    return union(out)


def layout_tables_customer(spark, sf):
    tables = _tables(spark, sf, CONFIG, enrich.category_frame(spark, SPEC.category_rules))
    return au.tables_layout(au.drop_tables(tables, set(HIDDEN)), "customer")


def layout_columns(spark, sf):
    """Technical layout of three tables, all sixteen columns."""
    registry = retail(spark, sf, "customer", "orders_n", "nation")
    found = pf.column_profile(registry)
    section = md.columns_section(registry, found, CONFIG, enrich.category_frame(spark, SPEC.category_rules))
    return au.columns_layout(section, "technical")


def _columns_layout_sql():
    from showcase.display import percent_sql
    out = []
    for t in ("customer", "orders_n", "nation"):
        key = SUBJECT_KEYS.get(t)
        for c, ty, k in columns(t):
            share = (percent_sql(f"(100.0::double * count(distinct {key}) filter (where {c} is not null) / "
                                 f"(select count(*) from customer))") if key else "'—'")
            # the share of missing rows is subtracted first, as in the profile
            complete = percent_sql(f"((1 - (count(*) - count({c})) / count(*)::double) * 100)")
            source = "NLP" if k == "unstructured" and not is_pii(t, c) else "Normalized"
            cells = cells_sql(t, c, k, keys=False)
            out.append(
                f"select '{CATEGORY[t]}' as \"Category\", '{t}' as \"Table(s)\", '{c}' as \"Column\", "
                f"{q(CONFIG.column_descriptions.get(f'{t}.{c}', ''))} as \"Description\", '{ty}' as \"Field Type\", "
                f"'Yes' as \"Nullable\", {cells['example']} as \"Example\", '' as \"Coding Schema\", "
                f"{cells['values']} as \"Values\", {cells['distribution']} as \"Distribution\", "
                f"{cells['median']} as \"Median (IQR)\", {complete} as \"Completeness\", {share} as \"% Patient\", "
                f"'{source}' as \"Data Source\", '{'Yes' if is_pii(t, c) else ''}' as \"PII\", '' as \"Notes\" from {t}")
    return union(out)


def layout_variables(spark, sf):
    """The sales layout: observed values and coverage."""
    model = md.build_model(SPEC, _registry(spark, sf), demo_catalog(spark), CONFIG, generated_at=STAMP,
                           revision="r1", parts={"nulls", "counts", "top", "subjects"})
    return au.variables_layout(au.view(model, "sales", CONFIG.layout).variables, "sales")


def _variables_layout_sql():
    rows = []
    for row in DEMO:
        if is_pii(row["table"], row["column"]):
            continue
        rows.append(f"({q(row['category'] or '')}, {q(row['variable'])}, {q(row.get('description', ''))}, "
                    f"{q(row.get('notes', ''))}, {q(row.get('extraction_type', 'Structured'))}, {q(row.get('proposal', ''))})")
    return (
        "select v.category as \"Category\", v.variable as \"Variable\", v.description as \"Description\", "
        "coalesce((select string_agg(value, chr(10) order by rank) from "
        f"({TOP10}) as t where t.variable = v.variable), '') as \"Observed Values\", v.notes as \"Notes\", "
        "v.kind as \"Type\", v.proposal as \"Proposal\", "
        "case when p.patient_pct is null then '—' else format('{:.1f}%', 100.0::double * p.subject_count / "
        "(select count(*) from customer)) end as \"% Patients With Value\" "
        f"from (values {', '.join(rows)}) as v(category, variable, description, notes, kind, proposal) "
        f"join ({PROFILE}) as p on p.variable = v.variable where p.implemented = 'Yes'")


OTHERS = ("technical", "pharma", "customer")


def layout_variables_others(spark, sf):
    """The layouts of the other audiences, cell by cell: (audience, variable, position, title, value)."""
    model = md.build_model(SPEC, _registry(spark, sf), demo_catalog(spark), CONFIG, generated_at=STAMP,
                           revision="r1")
    out = []
    for a in OTHERS:
        shown = au.variables_layout(au.view(model, a, CONFIG.layout).variables, a)
        cells = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("title"), F.col(f"`{c}`").alias("value"))
                 for i, c in enumerate(shown.columns)]
        out.append(shown.select(F.lit(a).alias("audience"), F.col("Variable").alias("variable"),
                                F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, out)


def _variable_cells_sql():
    """One row per variable of the demonstration catalogue with every text cell of its layouts."""
    from showcase.display import _plain_sql, percent_sql
    rows = []
    for row in DEMO:
        shown = MEANING[row["variable"]][3]
        inclusion = row.get("inclusion_criteria") or ("" if shown else DEFAULT_INCLUSION)
        kind = row.get("extraction_type", "Structured")
        source = row.get("data_source") or ("NLP" if kind == "Unstructured" else "Normalized")
        rows.append(f"({q(row['variable'])}, {q(row.get('description', ''))}, {q(inclusion)}, {q(source)}, "
                    f"{q(row.get('notes', ''))})")
    # quartiles to the last bit: the neighbours of the position are joined as lo + (hi - lo) * fraction
    lists = union(
        f"select {q(row['variable'])} as variable, list_sort(list({expr}::double) filter (where {scope} and {expr} is not "
        f"null)) as l from {row['table']}" for row in DEMO for scope, expr, kind, _ in [MEANING[row["variable"]]]
        if number_wanted(row, kind))
    place = "({0} * (len(l) - 1))".format
    joined = ", ".join(
        f"l[floor({place(f)})::bigint + 1] + (l[ceil({place(f)})::bigint + 1] - l[floor({place(f)})::bigint + 1]) * "
        f"({place(f)} - floor({place(f)})) as {a}" for a, f in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)))
    a, b, c = (_plain_sql(f"k.{x}") for x in ("median", "q1", "q3"))
    labels = "(select string_agg({0} order by rank) from top10 as t where t.variable = p.variable)"
    share = "value || ': ' || n || ' (' || format('{:.1f}%', 100.0::double * n / p.n_nonnull) || ')', '; '"
    return (
        f"with top10 as materialized ({TOP10}), measured as materialized ({PROFILE}), "
        f"quartile as (select variable, {joined} from ({lists}) as n), cells as materialized ("
        "select p.category, p.variable, v.description, v.inclusion_criteria, p.\"table\", p.\"column\", p.criteria, "
        "p.field_type, '' as coding_schema, p.n_scope, p.n_nonnull, p.subject_count, p.min_date, p.max_date, "
        "k.q1, k.median, k.q3, p.implemented, v.data_source, v.notes, "
        f"coalesce({labels.format('value, chr(44) || chr(32)')}, '') as \"values\", "
        f"coalesce({labels.format('value, chr(10)')}, '') as observed_values, "
        "coalesce((select value from top10 as t where t.variable = p.variable and rank = 1), min_date, '') as example, "
        f"case when p.variable = 'Note Text' then ({NOTE_TEXT}) when min_date is not null then 'Min: ' || min_date || "
        f"', Max: ' || max_date else coalesce({labels.format(share)}, '') end as distribution, "
        f"case when k.median is null then '' else 'Median: ' || {a} || ' (IQR: ' || {b} || '-' || {c} || ')' end as median_iqr, "
        f"{percent_sql('(100.0::double * p.n_nonnull / nullif(p.n_scope, 0))')} as completeness_text, "
        f"{percent_sql('(100.0::double * p.subject_count / (select count(*) from customer))')} as patient_text "
        f"from measured as p join (values {', '.join(rows)}) as v(variable, description, inclusion_criteria, "
        "data_source, notes) on v.variable = p.variable left join quartile as k on k.variable = p.variable) ")


def _variables_others_sql():
    pii = ", ".join(q(row["variable"]) for row in DEMO if is_pii(row["table"], row["column"])) or "''"
    keep = {"technical": "true", "pharma": f"variable not in ({pii})",
            "customer": f"variable not in ({pii}) and implemented = 'Yes'"}
    return _variable_cells_sql() + union(
        f"select '{a}' as audience, variable, {i} as position, {q(title)} as title, cast(\"{field}\" as varchar) as value "
        f"from cells where {keep[a]}" for a in OTHERS for i, (title, field) in enumerate(au.LAYOUTS[a][3]))


# ---- roll-ups

def coverage_rollup(spark, sf):
    found = rollups.coverage_rollup(demo_profile(spark, sf, {"counts"}))
    return found.select("category", "total", "implemented", F.round("implemented_pct", 4).alias("implemented_pct"),
                        F.round("avg_completeness", 4).alias("avg_completeness"))


COVERAGE_ROLLUP = (
    "select case when category = '' then 'Uncategorized' else trim(category) end as category, count(*) as total, "
    "count(*) filter (where implemented = 'Yes') as implemented, "
    "round(100.0 * count(*) filter (where implemented = 'Yes') / count(*), 4) as implemented_pct, "
    f"round(avg(100.0 * n_nonnull / n_scope) filter (where implemented = 'Yes'), 4) as avg_completeness "
    f"from ({PROFILE}) as p group by 1")


def hero_stats(spark, sf):
    registry = _registry(spark, sf)
    coverage = md.date_coverage(pf.column_profile(registry, parts={"dates"}), CONFIG.date_candidates)
    summary = coverage.withColumn("patient_count", F.lit(registry.subject_total()).cast("long"))
    found = rollups.hero_stats(summary, demo_profile(spark, sf, {"counts"}))
    return found.withColumn("variables_implemented_pct", F.round("variables_implemented_pct", 4))


HERO = (f"select (select count(*) from customer) as patients, (select {_YEARS} from ({_BOUNDS}) as b) as years_of_data, "
        "count(*) as variables_total, count(*) filter (where implemented = 'Yes') as variables_implemented, "
        "round(100.0 * count(*) filter (where implemented = 'Yes') / count(*), 4) as variables_implemented_pct "
        f"from ({PROFILE}) as p")


def category_counts(spark, sf):
    return rollups.category_counts(part_catalog(spark, sf))


# ---- batches

SMALL = [
    dict(category="A", variable="Clicks", table="events", column="value", criteria="event_type = 'click'"),
    dict(category="A", variable="Refunds", table="events", column="value", criteria="event_type = 'refund'"),
    dict(category="B", variable="Unknown", table="events", column="amount"),
    dict(category="B", variable="Elsewhere", table="nowhere", column="amount"),
]


def _jobs(sf):
    def spec(slug, schema):
        return md.CohortSpec(cohort=slug, provider="p", disease="d", schema_name=schema, slug=slug)

    def broken(spark):
        registry = Registry.from_parquet(spark, "broken", f"{sf}/no_such_folder", ["nothing"])
        return registry, demo_catalog(spark)

    return [
        batch.Job(spec("retail", "retail"), lambda spark: (retail(spark, sf, *TABLES), demo_catalog(spark))),
        batch.Job(spec("broken", "broken"), broken),
        batch.Job(spec("web", "web"), lambda spark: (retail(spark, sf, "events", "documents"), ct.catalog_frame(spark, SMALL))),
    ]


def batch_results(spark, sf):
    found = batch.batch_results(spark, _jobs(sf))
    # an error's text names the folder that is missing; its first word is the kind
    return found.select("cohort", "schema_name", "status", F.regexp_extract("error", r"^\w*", 0).alias("error"),
                        "patient_count", "table_count", "variables_total",
                        "variables_implemented", F.round("implemented_pct", 4).alias("implemented_pct"),
                        F.round("drop_pct", 4).alias("drop_pct"), "warning_count")


_IMPLEMENTED = f"(select count(*) from ({PROFILE}) as p where implemented = 'Yes')"
_CLICKS = "(select case when count(value) > 0 then 1 else 0 end from events where event_type = 'click')"
BATCH = (
    f"select cohort, schema_name, status, case when status = 'error' then 'AnalysisException' else '' end as error, "
    f"patient_count, table_count, total as variables_total, "
    f"done as variables_implemented, round(100.0 * done / nullif(total, 0), 4) as implemented_pct, "
    f"round(100.0 * (total - done) / nullif(total, 0), 4) as drop_pct, warnings as warning_count from ("
    f"select 'retail' as cohort, 'retail' as schema_name, 'ok' as status, (select count(*) from customer) as patient_count, "
    f"{len(TABLES)} as table_count, {len(DEMO)}::bigint as total, {_IMPLEMENTED} as done, 0::bigint as warnings union all "
    f"select 'broken', 'broken', 'error', null, 0, 0, 0, 0 union all "
    f"select 'web', 'web', 'ok', null, 2, 4, {_CLICKS}, 2) as b")


def high_drop_cohorts(spark, sf):
    found = rollups.high_drop(batch.batch_results(spark, _jobs(sf)))
    return found.select("cohort", F.round("drop_pct", 4).alias("drop_pct"))


def batch_totals(spark, sf):
    return rollups.batch_totals(batch.batch_results(spark, _jobs(sf)))


# ---- released models

def hard_fail_rules(spark, sf):
    """Rules failed by three cohorts as they are written: all customers, those with hardly any debts, and web events."""
    rich = Registry(spark, "rich", [replace(t, data=t.data.where("c_acctbal > 9999") if t.name == "customer" else t.data)
                                    for t in retail(spark, sf, "customer", "nation").tables.values()], "customer")
    cohorts = [(SPEC, retail(spark, sf, "customer", "nation")),
               (md.CohortSpec("rich", " ", "d", "rich", slug="rich"), rich),
               (md.CohortSpec("web", "", "", "web", slug="web", status="wip"), retail(spark, sf, "events"))]
    folder, found = f"{sinks.work_folder(spark)}/releases", []
    for spec, registry in cohorts:
        built = md.build_model(spec, registry, ct.catalog_frame(spark, SMALL), CONFIG, generated_at=STAMP, parts={"nulls", "subjects"})
        found.append(release.release(built, folder)[1])
    return reduce(DataFrame.unionByName, found)


HARD_RULES = (
    "select 'error' as severity, 'no_patients' as rule, 'rich' as \"key\", 'patient_count must be above 0' as message "
    "from (select count(*) as n from customer where c_acctbal > 9999) as a where n = 0 union all "
    "select 'error', 'no_patients', 'retail', 'patient_count must be above 0' "
    "from (select count(*) as n from customer) as b where n = 0 union all "
    "select 'error', 'blank_field', 'rich', 'provider must be told' union all "
    "select 'error', 'no_patients', 'web', 'patient_count must be above 0'")


# ---- comparing profiles

def profile_drift(spark, sf):
    """Completeness of orders and events before and after values went missing."""
    names = {"orders_n": "orders", "events_n": "events"}
    before = pf.column_profile(retail(spark, sf, "orders", "events"), parts={"nulls"})
    after = pf.column_profile(retail(spark, sf, "orders_n", "events_n", "part"), parts={"nulls"})
    after = after.replace(names, subset=["table"])
    found = rollups.profile_drift(before, after)
    return found.select("table", "column", "status", F.round("delta_pct", 4).alias("delta_pct"))


DRIFT = union([
    *[f"select '{a}' as \"table\", '{c}' as \"column\", case when count({c}) = count(*) then 'same' else 'changed' end "
      f"as status, round(100.0 * count({c}) / count(*) - 100.0, 4) as delta_pct from {b}"
      for a, b in (("orders", "orders_n"), ("events", "events_n")) for c, _, _ in columns(a)],
    *[f"select 'part', '{c}', 'added', null from (select count(*) from part) as x" for c, _, _ in columns("part")]])


def combined_profiles(spark, sf):
    shop = pf.column_profile(retail(spark, sf, "orders", "events"), parts={"nulls"})
    web = pf.column_profile(retail(spark, sf, "events_n", "pages"), parts={"nulls"})
    return batch.combined({"shop": shop, "web": web}).select("source", "table", "column", "row_count", "null_count")


COMBINED = union(f"select '{s}' as source, '{t}' as \"table\", '{c}' as \"column\", count(*) as row_count, "
                 f"count(*) - count({c}) as null_count from {t}"
                 for s, ts in (("shop", ("orders", "events")), ("web", ("events_n", "pages")))
                 for t in ts for c, _, _ in columns(t))

QUERIES = {
    "enrich_category": (enrich_category, ENRICH_CATEGORY),
    "enrich_table_desc": (enrich_table_desc, ENRICH_TABLE),
    "enrich_column_desc": (enrich_column_desc, ENRICH_COLUMN),
    "pii_flag": (pii_flag, PII_FLAG),
    "column_extraction_type": (column_extraction_type, EXTRACTION),
    "exclude_list_resolve": (exclude_list_resolve, EXCLUDES),
    "date_coverage": (date_coverage, DATE_COVERAGE),
    "schema_digest": (schema_digest, SCHEMA_DIGEST),
    "cohort_summary": (cohort_summary, COHORT_SUMMARY),
    "model_sort": (model_sort, MODEL_SORT),
    "model_json": (model_json, MODEL_JSON),
    "model_records": (model_records, _records_sql()),
    "model_document": (model_document, MODEL_DOCUMENT),
    "audience_filter": (audience_filter, AUDIENCE_FILTER),
    "audience_table_exclude": (audience_table_exclude, AUDIENCE_EXCLUDE),
    "audience_visibility": (audience_visibility, VISIBILITY),
    "audience_view": (audience_view, AUDIENCE_VIEW),
    "layout_summary": (layout_summary, _summary_sql()),
    "layout_tables": (layout_tables, _tables_layout_sql([t for t, _ in au.TABLES_TECHNICAL])),
    "layout_tables_customer": (layout_tables_customer,
                               f"select * from ({_tables_layout_sql([t for t, _ in au.TABLES_CUSTOMER])}) as t "
                               f"where \"Table\" not in ('nation', 'region')"),
    "layout_columns": (layout_columns, _columns_layout_sql()),
    "layout_variables": (layout_variables, _variables_layout_sql()),
    "layout_variables_others": (layout_variables_others, _variables_others_sql()),
    "coverage_rollup": (coverage_rollup, COVERAGE_ROLLUP),
    "hero_stats": (hero_stats, HERO),
    "category_counts": (category_counts, f"with {PART_CATALOG} select coalesce(category, '') as category, "
                                         f"count(*) as n from cat group by 1"),
    "batch_results": (batch_results, BATCH),
    "high_drop_cohorts": (high_drop_cohorts, f"select cohort, drop_pct from ({BATCH}) as b where drop_pct >= 25"),
    "batch_totals": (batch_totals, f"select count(*) as cohorts, count(*) filter (where status = 'ok') as ok, "
                                   f"count(*) filter (where status = 'error') as errors from ({BATCH}) as b"),
    "hard_fail_rules": (hard_fail_rules, HARD_RULES),
    "profile_drift": (profile_drift, DRIFT),
    "combined_profiles": (combined_profiles, COMBINED),
}
QUERIES = {k: (f, with_views(s)) for k, (f, s) in QUERIES.items()}
