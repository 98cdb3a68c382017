"""Row checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from showcase.inputs import table, union, with_views
from showcase.profiles import q
from showcase.variables import PART_CATALOG, part_catalog
from tallyframe.operators import checks as ck
from tallyframe.sources import catalog as ct

KEY = "position"


def found_sql(severity: str, rule: str, key: str, message: str, source: str) -> str:
    return (f"select '{severity}' as severity, '{rule}' as rule, cast({key} as varchar) as key, "
            f"{message} as message from {source}")


def check_duplicate_keys(spark, sf):
    lines = ck.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    talk = table(spark, sf, "conversations")
    doubled = talk.unionAll(talk.where("turn = 0"))
    return lines.unionByName(ck.duplicate_keys(doubled, ["conv_id", "turn"]))


DUPLICATES = union([
    found_sql("error", "duplicate_key", "l_orderkey || '/' || l_linenumber", "'appears ' || n || ' times'",
              "(select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1) as g"),
    found_sql("error", "duplicate_key", "conv_id || '/' || turn", "'appears ' || n || ' times'",
              "(select conv_id, turn, count(*) as n from (select conv_id, turn from conversations union all "
              "select conv_id, turn from conversations where turn = 0) as u group by 1, 2 having count(*) > 1) as g")])


def check_required(spark, sf):
    rows = ck.required_fields(part_catalog(spark, sf), KEY, ["table", "column", "category"])
    events = ck.required_fields(table(spark, sf, "events_n"), F.col("event_id"), ["event_type", "value"])
    return rows.unionByName(events)


REQUIRED = f"with {PART_CATALOG} " + union([
    *[found_sql("error", "required", "position", f"'missing {c}'", f"cat where trim(coalesce(\"{c}\", '')) = ''")
      for c in ("table", "column", "category")],
    *[found_sql("error", "required", "event_id", f"'missing {c}'", f"events_n where {c} is null")
      for c in ("event_type", "value")]])


def check_allowed_values(spark, sf):
    listed = ck.allowed_values(table(spark, sf, "events"), F.col("event_id"), "event_type",
                               ["click", "view", "purchase"])
    known = table(spark, sf, "part").where("p_size < 25").select("p_type")
    framed = ck.allowed_values(table(spark, sf, "part"), F.col("p_partkey"), "p_name",
                               table(spark, sf, "part").where("p_size > 47").select("p_name"))
    typed = ck.allowed_values(table(spark, sf, "part"), F.col("p_partkey"), "p_type", known)
    return listed.unionByName(framed).unionByName(typed)


ALLOWED = union([
    found_sql("warning", "allowed_values", "event_id", "'event_type: unexpected value ' || event_type",
              "events where event_type not in ('click', 'view', 'purchase')"),
    found_sql("warning", "allowed_values", "p_partkey", "'p_name: unexpected value ' || p_name",
              "part where p_name not in (select p_name from part where p_size > 47)"),
    found_sql("warning", "allowed_values", "p_partkey", "'p_type: unexpected value ' || p_type",
              "part where p_type not in (select p_type from part where p_size < 25)")])


def check_unsafe_patterns(spark, sf):
    return ck.unsafe_patterns(part_catalog(spark, sf), KEY)


UNSAFE = f"with {PART_CATALOG} " + union([
    found_sql("warning", "unsafe_pattern", "position", "'exact-match pattern ILIKE ''ring'' (no wildcards)'",
              "cat where criteria like 'p_name ILIKE%'"),
    found_sql("warning", "unsafe_pattern", "position", "'prefix-only pattern ILIKE ''small%'' (consider ''%...%'')'",
              "cat where criteria like 'p_name ILIKE%'")])

NAMES = ("red", "^small", "PANEL", "ing.*brand#2")


def check_missing_scope(spark, sf):
    return ck.missing_scope(part_catalog(spark, sf), KEY, patterns=NAMES)


MISSING_SCOPE = (f"with {PART_CATALOG} " + found_sql(
    "warning", "missing_scope", "position",
    "variable || ' has no criteria/match — would summarise every ' || \"column\" || ' row'",
    "cat where effective = '' and (" + " or ".join(f"regexp_matches(variable, '(?i){p}')" for p in NAMES) + ")"))

# the fixed rules plus some that ordinary prose trips over
PROSE_RULES = ck.TEXT_RULES + (
    (r"(?i)license", "license wording", ("license",)),
    (r"[A-Za-z0-9._]+@[A-Za-z0-9.]+", "e-mail address", ("@",)))


def check_text_rules(spark, sf):
    docs = ck.text_rules(table(spark, sf, "documents"), F.col("doc_id"), ["text", "source"], PROSE_RULES)
    talk = ck.text_rules(table(spark, sf, "conversations"), ck.row_key("conv_id", "turn"), ["text"], PROSE_RULES)
    parts = ck.text_rules(part_catalog(spark, sf), KEY, ["description", "notes", "inclusion_criteria"])
    return docs.unionByName(talk).unionByName(parts)


# Unicode's white space and word characters, spelled out for a dialect whose classes are ASCII
SPACE_SQL = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
WORD_SQL = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"


def _unicode_sql(pattern: str) -> str:
    """The pattern in explicit classes; a word boundary takes the character beside it, which is the same for a test."""
    flag = "(?i)" if pattern.startswith("(?i)") else ""
    body = pattern.removeprefix("(?i)")
    head, body = (f"(?:^|[^{WORD_SQL}])", body[2:]) if body.startswith(r"\b") else ("", body)
    tail, body = (f"(?:$|[^{WORD_SQL}])", body[:-2]) if body.endswith(r"\b") else ("", body)
    return flag + head + body.replace(r"\s", SPACE_SQL).replace(r"\w", f"[{WORD_SQL}]") + tail


def _rule_hits(source, field, rules):
    """The source's rows with the label of each rule that its field hits; constant patterns are compiled once."""
    tests = ", ".join(f"case when regexp_matches({field}, {q(_unicode_sql(p))}) then {q(label)} end"
                      for p, label, *_ in rules)
    return f"(select *, unnest([{tests}]) as label from {source}) as hits where label is not null"


def _text_rule(key, field, source, rules):
    return found_sql("warning", "text_rule", key, f"'{field} hits style denylist — ' || label",
                     _rule_hits(source, field, rules))


TEXT_RULES = f"with {PART_CATALOG} " + union([
    _text_rule("doc_id", "text", "documents", PROSE_RULES),
    _text_rule("doc_id", "source", "documents", PROSE_RULES),
    _text_rule("conv_id || '/' || turn", "text", "conversations", PROSE_RULES),
    _text_rule("position", "description", "cat", ck.TEXT_RULES),
    _text_rule("position", "inclusion_criteria", "cat", ck.TEXT_RULES)])


def check_text_rules_unicode(spark, sf):
    """The documents as a word processor leaves them: no-break spaces, and an accented letter glued to some words."""
    docs = table(spark, sf, "documents").select(
        "doc_id", F.translate("text", " ", "\u00a0").alias("wide"),
        F.replace("text", F.lit("a "), F.lit("a\u00e9 ")).alias("glued"))
    return ck.text_rules(docs, F.col("doc_id"), ["wide", "glued"], PROSE_RULES)


TEXT_RULES_UNICODE = ("with d as (select doc_id, replace(text, ' ', chr(160)) as wide, "
                      "replace(text, 'a ', 'a' || chr(233) || ' ') as glued from documents) " + union([
                          _text_rule("doc_id", "wide", "d", PROSE_RULES),
                          _text_rule("doc_id", "glued", "d", PROSE_RULES)]))


def check_id_name_mismatch(spark, sf):
    rows = part_catalog(spark, sf).withColumn(
        "variable", F.when(F.col("proposal").isNotNull(), F.concat("variable", F.lit(" (Concept ID)")))
        .otherwise(F.col("variable")))
    return ck.id_name_mismatch(rows, KEY)


ID_NAME = (f"with {PART_CATALOG} " + found_sql(
    "warning", "id_name_mismatch", "position", "variable || ' points at ID column ' || \"column\"",
    "cat where expression is null and \"column\" = 'drug_concept_id' and proposal is null"))


def check_int_list(spark, sf):
    """Every word of a conversation turn as an id: only numbers pass."""
    rows = table(spark, sf, "conversations").select(
        ck.row_key("conv_id", "turn").alias("k"),
        F.when(F.col("turn") < 2, F.array(F.col("conv_id").cast("string"), F.lit(" 12 ")))
        .otherwise(F.array(F.lit("7"), F.col("role"), F.lit("1.5"))).alias("ids"))
    return ck.int_list(rows, F.col("k"), "ids")


INT_LIST = found_sql("error", "int_list", "conv_id || '/' || turn",
                     "'ids entries must be integers, got ' || role || ', 1.5'", "conversations where turn >= 2")


def check_mutually_exclusive(spark, sf):
    rows = part_catalog(spark, sf)
    ids = F.coalesce(F.size("match.concept_ids"), F.lit(0)) > 0
    values = F.coalesce(F.size("match.values"), F.lit(0)) > 0
    return ck.mutually_exclusive(rows, KEY, ids, values, "concept_ids and values are both set")


EXCLUSIVE = f"with {PART_CATALOG} " + found_sql(
    "error", "mutually_exclusive", "position", "'concept_ids and values are both set'",
    "cat where match_column is not null and match_id is not null")


def check_suffix(spark, sf):
    rows = part_catalog(spark, sf)
    ids = F.coalesce(F.size("match.concept_ids"), F.lit(0)) > 0
    return ck.suffix(rows, KEY, F.col("match.column"), "_concept_id", ids)


SUFFIX = f"with {PART_CATALOG} " + found_sql(
    "warning", "suffix", "position", "mc || ' does not end with _concept_id'",
    "cat where match_id is not null and mc not in ('', 'drug_concept_id')")


def check_identifier(spark, sf):
    names = ck.identifier(part_catalog(spark, sf), KEY, F.col("match.name_column"))
    urls = ck.identifier(table(spark, sf, "pages"), F.col("page_id"), F.col("url"))
    langs = ck.identifier(table(spark, sf, "documents"), F.col("doc_id"), F.col("source"))
    return names.unionByName(urls).unionByName(langs)


IDENTIFIER = f"with {PART_CATALOG} " + union([
    found_sql("error", "identifier", "position", "'not a plain identifier: label text'",
              "cat where match_column is not null and name_column = 'label text'"),
    found_sql("error", "identifier", "page_id", "'not a plain identifier: ' || url",
              "pages where not regexp_full_match(url, '[A-Za-z_][A-Za-z0-9_]*')"),
    found_sql("error", "identifier", "doc_id", "'not a plain identifier: ' || source",
              "documents where not regexp_full_match(source, '[A-Za-z_][A-Za-z0-9_]*')")])


def check_enum(spark, sf):
    tags = ck.enum(part_catalog(spark, sf), KEY, F.col("proposal"))
    roles = ck.enum(table(spark, sf, "conversations"), ck.row_key("conv_id", "turn"), F.col("role"), ["user", "system"])
    return tags.unionByName(roles)


ENUM = f"with {PART_CATALOG} " + union([
    found_sql("error", "enum", "position", "'custom is not one of Standard, Custom'", "cat where proposal = 'custom'"),
    found_sql("error", "enum", "conv_id || '/' || turn", "role || ' is not one of user, system'",
              "conversations where role not in ('user', 'system')")])


def check_conditional_required(spark, sf):
    return ck.conditional_required(part_catalog(spark, sf), KEY, ct.has_scope(F.col("criteria"), F.col("match")),
                                   F.col("inclusion_criteria"), "inclusion_criteria")


CONDITIONAL = f"with {PART_CATALOG} " + found_sql(
    "error", "conditional_required", "position", "'criteria/match has no inclusion_criteria'",
    "cat where effective <> '' and coalesce(inclusion_criteria, '') = ''")

META = [
    "event_id",
    "case event_type when 'click' then '\"2024-01-01\"' when 'view' then '20240101' end as data_cutoff_date",
    "case when value > 50 then '[\"late\", \"sparse\"]' when value > 20 then props when value > 10 then '\"late\"' end as known_limitations",
    "case when event_type = 'signup' then '{\"reviewer\": \"R\"}' when event_type = 'error' then props "
    "when event_type = 'purchase' then '{\"reviewer\": \" \"}' when value > 60 then '\"R\"' end as sign_off",
]


def check_metadata_shape(spark, sf):
    rows = table(spark, sf, "events").selectExpr(*META)
    return ck.metadata_shape(rows, F.col("event_id"), ["data_cutoff_date"], ["known_limitations"], "sign_off")


METADATA = union([
    found_sql("error", "metadata_shape", "event_id", "'data_cutoff_date must be a string'",
              "events where event_type = 'view'"),
    found_sql("error", "metadata_shape", "event_id", "'known_limitations must be a list'",
              "events where value > 10 and value <= 50"),
    found_sql("error", "metadata_shape", "event_id", "'sign_off must be a mapping'",
              "events where event_type not in ('signup', 'error', 'purchase') and value > 60"),
    found_sql("error", "metadata_shape", "event_id", "'sign_off has no reviewer'",
              "events where event_type in ('error', 'purchase')")])


def check_missing_refs(spark, sf):
    """Line items whose part is unknown once some parts are withdrawn, and labels without document."""
    known = table(spark, sf, "part").where("p_size <> 13").select("p_partkey")
    lines = ck.missing_references(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey", known, "p_partkey")
    docs = table(spark, sf, "documents").where("lang <> 'de'")
    labels = ck.missing_references(table(spark, sf, "labels"), "quality", "doc_id", docs, "doc_id")
    return lines.unionByName(labels)


MISSING_REFS = union([
    "select distinct * from (" + found_sql(
        "error", "missing_reference", "l_orderkey", "'not found: ' || l_partkey",
        "lineitem where l_partkey not in (select p_partkey from part where p_size <> 13)") + ") as a",
    "select distinct * from (" + found_sql(
        "error", "missing_reference", "quality", "'not found: ' || doc_id",
        "labels where doc_id not in (select doc_id from documents where lang <> 'de')") + ") as b"])


def check_circular_refs(spark, sf):
    """Suppliers refer to each other through the nation table's numbering; some chains close."""
    edges = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("child"), (F.col("s_suppkey") / 4).cast("long").alias("parent"))
    return ck.circular_references(edges, "child", "parent")


CIRCULAR = """
with recursive edges as (select distinct cast(s_nationkey as bigint) as a, cast(floor(s_suppkey / 4) as bigint) as b
                         from supplier),
reach as (select a, b from edges union select r.a, e.b from reach as r join edges as e on r.b = e.a)
select distinct 'error' as severity, 'circular_reference' as rule, cast(a as varchar) as key,
       'circular include detected' as message from reach where a = b"""


def findings_summary(spark, sf):
    """Findings of the catalogue checks per category and severity, with totals."""
    rows = part_catalog(spark, sf)
    both = ck.required_fields(rows, KEY, ["table", "column"]).unionByName(
        ck.unsafe_patterns(rows, KEY)).unionByName(
        ck.enum(rows, KEY, F.col("proposal"))).unionByName(
        ck.text_rules(rows, KEY, ["description"]))
    return ck.summary(both, F.col("rule"))


SUMMARY = f"""
with {PART_CATALOG}, f as ({union([
    "select 'required' as scope, 'error' as severity from cat where \"table\" = ''",
    "select 'required', 'error' from cat where \"column\" = ''",
    "select 'unsafe_pattern', 'warning' from cat, (values (1), (2)) as two(i) where criteria like 'p_name ILIKE%'",
    "select 'enum', 'error' from cat where proposal = 'custom'",
    f"select 'text_rule', 'warning' from {_rule_hits('cat', 'description', ck.TEXT_RULES)}"])})
select coalesce(scope, 'total') as scope, count(*) filter (where severity = 'error') as errors,
       count(*) filter (where severity = 'warning') as warnings from f group by rollup (scope)"""


def check_catalog(spark, sf):
    """All checks of a catalogue at once: findings per rule."""
    found = ck.catalog_findings(part_catalog(spark, sf), KEY, ["ECONOMY", "STANDARD", "PROMO"])
    return found.groupBy("severity", "rule").agg(F.count(F.lit(1)).alias("n"))


CATALOG = f"""
with {PART_CATALOG} select severity, rule, count(*) as n from ({union([
    "select 'error' as severity, 'duplicate_key' as rule from cat group by category, variable having count(*) > 1",
    "select 'error', 'required' from cat where \"table\" = ''",
    "select 'error', 'required' from cat where \"column\" = ''",
    "select 'warning', 'allowed_values' from cat where category not in ('ECONOMY', 'STANDARD', 'PROMO')",
    "select 'warning', 'unsafe_pattern' from cat, (values (1), (2)) as two(i) where criteria like 'p_name ILIKE%'",
    "select 'warning', 'missing_scope' from cat where effective = '' and regexp_matches(variable, '(?i)"
    + "|".join(ck.CONCEPT_NAMES) + "')",
    "select 'error', 'int_list' from cat where match_column is not null and match_id is not null",
    "select 'error', 'mutually_exclusive' from cat where match_column is not null and match_id is not null",
    "select 'warning', 'suffix' from cat where match_id is not null and mc not in ('', 'drug_concept_id')",
    "select 'error', 'identifier' from cat where match_column is not null and name_column = 'label text'",
    "select 'error', 'enum' from cat where proposal = 'custom'",
    "select 'warning', 'id_name_mismatch' from cat where expression is null and \"column\" = 'drug_concept_id'",
    f"select 'warning', 'text_rule' from {_rule_hits('cat', 'description', ck.TEXT_RULES)}",
    f"select 'warning', 'text_rule' from {_rule_hits('cat', 'inclusion_criteria', ck.TEXT_RULES)}",
    "select 'error', 'conditional_required' from cat where effective <> '' and coalesce(inclusion_criteria, '') = ''"])}) as f
group by 1, 2"""

QUERIES = {
    "check_duplicate_keys": (check_duplicate_keys, DUPLICATES),
    "check_required": (check_required, REQUIRED),
    "check_allowed_values": (check_allowed_values, ALLOWED),
    "check_unsafe_patterns": (check_unsafe_patterns, UNSAFE),
    "check_missing_scope": (check_missing_scope, MISSING_SCOPE),
    "check_text_rules": (check_text_rules, TEXT_RULES),
    "check_text_rules_unicode": (check_text_rules_unicode, TEXT_RULES_UNICODE),
    "check_id_name_mismatch": (check_id_name_mismatch, ID_NAME),
    "check_int_list": (check_int_list, INT_LIST),
    "check_mutually_exclusive": (check_mutually_exclusive, EXCLUSIVE),
    "check_suffix": (check_suffix, SUFFIX),
    "check_identifier": (check_identifier, IDENTIFIER),
    "check_enum": (check_enum, ENUM),
    "check_conditional_required": (check_conditional_required, CONDITIONAL),
    "check_metadata_shape": (check_metadata_shape, METADATA),
    "check_missing_refs": (check_missing_refs, MISSING_REFS),
    "check_circular_refs": (check_circular_refs, CIRCULAR),
    "findings_summary": (findings_summary, SUMMARY),
    "check_catalog": (check_catalog, CATALOG),
}
QUERIES = {k: (f, with_views(s)) for k, (f, s) in QUERIES.items()}
