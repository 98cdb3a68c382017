"""Row checks.  Each returns findings (severity, rule, key, message) of any table."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.functions import predicates as pr
from tallyframe.sources.catalog import has_scope, require_inlined
from tallyframe.sources.sinks import discard, stored

ERROR, WARNING = "error", "warning"
FINDING_COLUMNS = ("severity", "rule", "key", "message")

# Names that promise one particular concept.
CONCEPT_NAMES = (
    "APOE", "amyloid", "tau", "GFAP", "neurofilament", "MoCA", "MMSE", "FAQ", "CDR", "ADAS",
    "Dementia Severity", "ARIA", "PET", "MRI", "EEG", "blood pressure", "heart rate",
)
# An id column, a name that says so, a plain identifier, the sales tags.
ID_COLUMN = r"(?i)(^|_)(concept_id|id)$"
ID_NAME = r"(?i)\b(id|concept\s*id|identifier)\b"
IDENTIFIER = r"^[A-Za-z_][A-Za-z0-9_]*$"
PROPOSALS = ("Standard", "Custom")
REQUIRED_COHORT_FIELDS = ("provider", "disease", "schema_name", "cohort_name")

# Wording that must not reach readers of the dictionary, as (pattern, label,
# lower-case words one of which every match contains; none where there is no such word).
TEXT_RULES = (
    (r"(?i)\b(adrd|aat|alzheimers|respiratory|copd|asthma|ckd|retinal|dr|amd|mash|ibd)_common\b",
     "pack-file reference", ("_common",)),
    (r"\b(MTC|RMN)\b", "cohort short-name (MTC / RMN)", ("mtc", "rmn")),
    (r"(?i)\bcohort[- ]defining\b", "pack mechanics: 'cohort-defining'", ("cohort",)),
    (r"(?i)\bcaptured\s+in\b", "pack mechanics: 'captured in'", ("captured",)),
    (r"(?i)\binherit(s|ed|ing)?\s+(from|by)\b", "pack mechanics: 'inherits from / inherited by'", ("inherit",)),
    (r"(?i)\bowned\s+here\b", "pack mechanics: 'owned here'", ("owned",)),
    (r"(?i)\bredacted\s+by\b", "pack mechanics: 'redacted by'", ("redacted",)),
    (r"(?i)\b(technical|sales|pharma)\s+audience\b", "audience tag in customer copy", ("audience",)),
    (r"(?i)\bfor\s+both\b", "pack mechanics: 'for both' (cohort-cross-reference)", ("both",)),
    (r"(?i)\bsurface\s+it\b", "pack mechanics: 'surface it'", ("surface",)),
    (r"\bILIKE\b", "SQL fragment: ILIKE", ("ilike",)),
    (r"\bSELECT\b", "SQL fragment: SELECT", ("select",)),
    (r"(?i)\sJOIN\s", "SQL fragment: JOIN", ("join",)),
    (r"(?i)\sFROM\s+\w+_\w+", "SQL fragment: FROM <table>", ("from",)),
    (r"\bextraction_type\b", "generator key 'extraction_type'", ("extraction_type",)),
    (r"\bvalue_as_concept_name\b", "generator column 'value_as_concept_name'", ("value_as_concept_name",)),
    (r"(?i)\bbanned\s+wildcard", "QA language: 'banned wildcard' (move to YAML comment)", ("banned",)),
    (r"(?i)\bcriteria\s+restricted", "QA language: 'criteria restricted' (move to YAML comment)", ("criteria",)),
    (r"(?i)\bearlier\s+draft", "QA language: 'earlier draft' (move to YAML comment)", ("earlier",)),
    (r"(?i)\bdeliberately\b", "QA language: 'deliberately' (move rationale to YAML comment)", ("deliberately",)),
    (r"\bTODO\b", "QA language: 'TODO' (move to YAML comment)", ("todo",)),
    (r"(?i)\bAND-qualifier\b", "QA language: 'AND-qualifier' (move SQL rationale to YAML comment)", ("and-qualifier",)),
    (r"(?i)\bdouble-?count\w*", "QA language: 'double count' (rephrase as a clinical caveat)", ("double",)),
    (r"`(value_as_(string|number|concept_name|datetime)|\w*_concept_(name|id)|drug_(concept_id|exposure)|"
     r"condition_occurrence|procedure_occurrence|observation|measurement|note_text|drug_concept_name)`",
     "backticked schema field in customer copy (rephrase using the clinical concept)", ("`",)),
    (r"\*\*[^*]+\*\*", "markdown emphasis '**...**' (drop or rephrase)", ("**",)),
    (r"(?i)\bImplemented\s*[:=]\s*(Yes|No)\b", "generator field 'Implemented: Yes/No' in customer copy", ("implemented",)),
    (r"\ba\s+[AEIOaeio]", "article-vowel mismatch ('a' before a/e/i/o-initial word — usually should be 'an')", ()),
    (r"(?i)\bmatches\s+the\s+.+?\s+family\b",
     "generic template: 'matches the X family' (rewrite as a clinical definition)", ("family",)),
    (r"(?i)\bmatches\s+an?\s+\w+.*\s+(drug|entry|report)\b",
     "auto-translated SQL phrasing ('matches a X drug / entry / report'); rewrite as a clinical definition", ("matches",)),
)


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def findings(df: DataFrame, severity: str, rule: str, key: Column | str, message: Column | str) -> DataFrame:
    message = F.lit(message) if isinstance(message, str) else message
    return df.select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"),
                     as_column(key).cast("string").alias("key"), message.alias("message"))


def row_key(*columns: str) -> Column:
    return F.concat_ws("/", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One finding per key that occurs more than once; counts are combined map-side."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return findings(counted, ERROR, "duplicate_key", row_key(*keys),
                    F.concat(F.lit("appears "), F.col("n").cast("string"), F.lit(" times")))


def required_fields(df: DataFrame, key: Column | str, fields: Sequence[str]) -> DataFrame:
    """One finding per row and field that is missing or blank."""
    missing = F.array(*[
        F.when(pr.blank(F.col(f"`{f}`").cast("string")), F.lit(f)) for f in fields])
    hit = df.select(as_column(key).alias("__key"), F.explode(F.filter(missing, lambda x: x.isNotNull())).alias("field"))
    return findings(hit, ERROR, "required", F.col("__key"), F.concat(F.lit("missing "), F.col("field")))


def allowed_values(df: DataFrame, key: Column | str, field: str, allowed: Iterable | DataFrame,
                   severity: str = WARNING) -> DataFrame:
    """Rows whose non-blank value is not in the allowed set (list, or one-column frame)."""
    value = F.col(f"`{field}`")
    present = df.where(~pr.blank(value.cast("string")))
    if isinstance(allowed, DataFrame):
        names = allowed.select(F.col(allowed.columns[0]).alias("__allowed")).distinct()
        bad = present.join(names, value == F.col("__allowed"), "left_anti")
    else:
        bad = present.where(~value.isin(list(allowed)))
    return findings(bad, severity, "allowed_values", key,
                    F.concat(F.lit(f"{field}: unexpected value "), value.cast("string")))


def unsafe_patterns(df: DataFrame, key: Column | str, criteria: str = "criteria") -> DataFrame:
    """ILIKE patterns without wildcard, or open at the end only; one finding per pattern."""
    patterns = F.regexp_extract_all(F.coalesce(F.col(criteria), F.lit("")), F.lit(pr.unicode_pattern(r"(?i)ILIKE\s*'([^']*)'")), F.lit(1))
    each = df.select(as_column(key).alias("__key"), F.explode(patterns).alias("p"))
    prefix_only = F.col("p").endswith("%") & ~F.col("p").startswith("%")
    message = (
        F.when(~F.col("p").contains("%"),
               F.concat(F.lit("exact-match pattern ILIKE '"), F.col("p"), F.lit("' (no wildcards)")))
        .when(prefix_only, F.concat(F.lit("prefix-only pattern ILIKE '"), F.col("p"),
                                    F.lit("' (consider '%...%')"))))
    flagged = each.withColumn("message", message).where("message is not null")
    return findings(flagged, WARNING, "unsafe_pattern", F.col("__key"), F.col("message"))


def any_pattern(value: Column, patterns: Iterable[str], ignore_case: bool = True) -> Column:
    flag = "(?i)" if ignore_case else ""
    return reduce(lambda a, b: a | b, [value.rlike(pr.unicode_pattern(flag + p)) for p in patterns])


def missing_scope(df: DataFrame, key: Column | str, name: str = "variable",
                  patterns: Iterable[str] = CONCEPT_NAMES) -> DataFrame:
    """Rows named after a specific concept that have neither criteria nor a value set."""
    open_rows = df.where(~has_scope(F.col("criteria"), F.col("match")))
    hit = open_rows.where(any_pattern(F.coalesce(F.col(name), F.lit("")), patterns))
    return findings(hit, WARNING, "missing_scope", key, F.concat(
        F.col(name), F.lit(" has no criteria/match — would summarise every "),
        F.coalesce(F.col("column"), F.lit("?")), F.lit(" row")))


def text_rules(df: DataFrame, key: Column | str, fields: Sequence[str],
               rules: Sequence[tuple] = TEXT_RULES, severity: str = WARNING) -> DataFrame:
    """One finding per row, field and rule found in the whole text, in a single scan.

    Rules are (pattern, label) or (pattern, label, words): a plain search for the words settles
    most rows before the pattern is tried. Patterns are read in Unicode (``predicates.unicode_pattern``);
    the words are looked up in lower case, where the long s and the dotless i are letters of their own.  The rules are expressions of one projection: rows
    are never joined with rules, and only texts with a hit leave the scan."""
    def hit(field: str, low: Column, pattern: str, label: str, words: Sequence[str] = ()) -> Column:
        found = F.col(field).rlike(pr.unicode_pattern(pattern))
        if words:
            found = reduce(lambda a, b: a | b, [low.contains(w) for w in words]) & found
        return F.when(found, F.struct(F.lit(field).alias("field"), F.lit(label).alias("label")))

    def hits(field: str) -> Column:
        # the lower-case text is bound once per row, not once per rule
        return F.flatten(F.transform(F.array(F.lower(F.col(field))), lambda low: F.filter(
            F.array(*[hit(field, low, *rule) for rule in rules]), lambda h: h.isNotNull())))

    found = df.select(as_column(key).alias("__key"), F.concat(*[hits(f) for f in fields]).alias("h"))
    each = found.where(F.size("h") > 0).select("__key", F.inline("h"))
    return findings(each, severity, "text_rule", F.col("__key"), F.concat(
        F.col("field"), F.lit(" hits style denylist — "), F.col("label")))


def id_name_mismatch(df: DataFrame, key: Column | str, name: str = "variable", column: str = "column",
                     expression: str = "expression", id_column: str = ID_COLUMN) -> DataFrame:
    """An id column under a name that does not say so; expressions are not judged."""
    target = pr.stripped(F.col(f"`{column}`"))
    hit = df.where((pr.stripped(F.col(expression)) == "") & (target != "") & target.rlike(id_column)
                   & ~F.coalesce(F.col(name), F.lit("")).rlike(pr.unicode_pattern(ID_NAME)))
    return findings(hit, WARNING, "id_name_mismatch", key, F.concat(
        F.coalesce(F.col(name), F.lit("")), F.lit(" points at ID column "), target))


def int_list(df: DataFrame, key: Column | str, items: str) -> DataFrame:
    """Rows whose list holds entries that are no integers."""
    bad = F.filter(F.col(items), lambda x: ~F.coalesce(F.trim(x), F.lit("")).rlike(r"^-?[0-9]+$"))
    hit = df.withColumn("__bad", bad).where(F.size("__bad") > 0)
    return findings(hit, ERROR, "int_list", key, F.concat(
        F.lit(f"{items} entries must be integers, got "), F.array_join("__bad", ", ", "NULL")))


def mutually_exclusive(df: DataFrame, key: Column | str, first: Column, second: Column, message: str) -> DataFrame:
    return findings(df.where(first & second), ERROR, "mutually_exclusive", key, message)


def suffix(df: DataFrame, key: Column | str, field: Column, ending: str, when: Column) -> DataFrame:
    """A field that should end with a suffix where another field is set."""
    value = pr.stripped(field)
    hit = df.where(when & (value != "") & ~value.endswith(ending))
    return findings(hit, WARNING, "suffix", key, F.concat(value, F.lit(f" does not end with {ending}")))


def identifier(df: DataFrame, key: Column | str, field: Column) -> DataFrame:
    """A field that, when present, must be a plain identifier."""
    hit = df.where(field.isNotNull() & ~pr.stripped(field).rlike(IDENTIFIER))
    return findings(hit, ERROR, "identifier", key, F.concat(F.lit("not a plain identifier: "), field))


def enum(df: DataFrame, key: Column | str, field: Column, allowed: Iterable[str] = PROPOSALS) -> DataFrame:
    value = pr.stripped(field)
    hit = df.where((value != "") & ~value.isin(*allowed))
    return findings(hit, ERROR, "enum", key, F.concat(
        value, F.lit(f" is not one of {', '.join(allowed)}")))


def conditional_required(df: DataFrame, key: Column | str, scoped: Column, field: Column, name: str) -> DataFrame:
    """A scoped row needs the field."""
    hit = df.where(scoped & (pr.stripped(field) == ""))
    return findings(hit, ERROR, "conditional_required", key, f"criteria/match has no {name}")


def metadata_shape(df: DataFrame, key: Column | str, strings: Sequence[str] = (), lists: Sequence[str] = (),
                   sign_off: str | None = None) -> DataFrame:
    """Optional metadata given as JSON text: dates are strings, lists are arrays, the sign-off
    is an object with a reviewer.  Absent (NULL) values pass."""
    checks = []

    def check(text: Column, good: Column, message: str) -> None:
        checks.append(F.when(text.isNotNull() & ~F.coalesce(good, F.lit(False)), F.lit(message)))

    for f in strings:
        text = F.trim(F.col(f))
        check(text, text.startswith('"') & text.endswith('"'), f"{f} must be a string")
    for f in lists:
        text = F.trim(F.col(f))
        check(text, text.startswith("[") & F.from_json(text, "array<string>").isNotNull(), f"{f} must be a list")
    if sign_off:
        text = F.trim(F.col(sign_off))
        is_object = text.startswith("{")
        reviewer = F.get_json_object(text, "$.reviewer")
        check(text, is_object, f"{sign_off} must be a mapping")
        checks.append(F.when(is_object & pr.blank(reviewer), F.lit(f"{sign_off} has no reviewer")))
    each = df.select(as_column(key).alias("__key"), F.explode(F.filter(F.array(*checks), lambda m: m.isNotNull())).alias("m"))
    return findings(each, ERROR, "metadata_shape", F.col("__key"), F.col("m"))


def missing_references(edges: DataFrame, source: str, target: str, known: DataFrame, known_key: str) -> DataFrame:
    """References whose target does not exist."""
    names = known.select(F.col(known_key).alias("__known")).distinct()
    hit = edges.join(names, F.col(target) == F.col("__known"), "left_anti").select(source, target).distinct()
    return findings(hit, ERROR, "missing_reference", F.col(source),
                    F.concat(F.lit("not found: "), F.col(target).cast("string")))


def _least_label(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, label, least): the least label of the nodes that reach a node over the edges (s, t), its own included.

    A round takes the labels of the nodes one step before and, as the node of a label reaches whom it labels, the
    label of that node too. So the stretch that a label stands for grows by a factor in each round."""
    def heard(now: DataFrame) -> DataFrame:
        step = edges.join(now.select(F.col("node").alias("s"), "least"), "s").select(F.col("t").alias("node"), "least")
        jump = (now.select("node", F.col("least.node").alias("by")).where("node <> by")
                .join(now.select(F.col("node").alias("by"), "least"), "by").select("node", "least"))
        best = step.unionByName(jump).groupBy("node").agg(F.min("least").alias("heard"))
        return now.join(best, "node", "left").select("node", "label", "before", F.least("least", "heard").alias("least"))

    now = stored(nodes.withColumn("least", F.col("label")))
    while True:
        after = stored(heard(heard(now.withColumn("before", F.col("least")))))  # two rounds at once
        discard(now)
        now = after
        if after.where("least <> before").isEmpty():
            return now


def strongly_connected(edges: DataFrame) -> DataFrame:
    """(node, group) of the nodes of edges (s, t) that lie on a cycle of several nodes; group is one of its nodes.

    Nodes get labels in a random order, anew in each pass. The least label that reaches a node forward splits the
    graph: no cycle leaves such a part. Within a part, the nodes from which its least label is reached are one
    strongly connected component. Components and edges between parts go, the rest is split in the next pass, so
    passes grow with the logarithm of the number of components. The state of a round is the edges and one row for
    each node."""
    given = edges
    edges = stored(edges.where("s <> t").distinct())
    found, turn = [], 0
    while True:
        # a node without a way in or without a way out lies on no cycle
        inner = edges.join(edges.select(F.col("s").alias("t")).distinct(), "t", "left_semi").join(
            edges.select(F.col("t").alias("s")).distinct(), "s", "left_semi").select("s", "t")
        inner = stored(inner)
        discard(edges)
        if inner.isEmpty():
            discard(inner)
            break
        nodes = inner.select(F.explode(F.array("s", "t")).alias("node")).distinct()
        nodes = nodes.select("node", F.struct(F.xxhash64("node", F.lit(turn)).alias("at"), "node").alias("label"))
        ahead = _least_label(inner, nodes)
        part = ahead.select("node", F.col("least").alias("part"))
        within = stored(inner.join(part.select(F.col("node").alias("s"), F.col("part").alias("from")), "s")
                        .join(part.select(F.col("node").alias("t"), F.col("part").alias("to")), "t")
                        .where(F.col("from") == F.col("to")).select("s", "t"))
        back = _least_label(within.select(F.col("t").alias("s"), F.col("s").alias("t")), nodes)
        grouped = stored(part.join(back.select("node", "least"), "node").where(F.col("part") == F.col("least"))
                         .select("node", F.col("part.node").alias("group")))
        several = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group")
        found.append(stored(grouped.join(several, "group").select("node", "group")))
        done = grouped.select(F.col("node").alias("s"))
        edges = stored(within.join(done, "s", "left_anti").join(done.withColumnRenamed("s", "t"), "t", "left_anti")
                       .select("s", "t"))
        discard(inner, ahead, within, back, grouped)
        turn += 1
    return reduce(DataFrame.unionByName, found) if found else given.select(
        F.col("s").alias("node"), F.col("t").alias("group")).where(F.lit(False))


def circular_references(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Nodes that lie on a reference cycle, that is, reach themselves: by an edge of their own, or as one of several
    nodes of a strongly connected component."""
    named = edges.select(F.col(source).alias("s"), F.col(target).alias("t")).where("s is not null and t is not null")
    own = named.where("s = t").select(F.col("s").alias("node"))
    looped = own.unionByName(strongly_connected(named).select("node")).distinct()
    return findings(looped, ERROR, "circular_reference", F.col("node"), "circular include detected")


def summary(found: DataFrame, scope: Column) -> DataFrame:
    """Findings per scope and severity, with a total row."""
    return (
        found.withColumn("scope", scope)
        .rollup("scope").agg(
            F.count_if(F.col("severity") == ERROR).alias("errors"),
            F.count_if(F.col("severity") == WARNING).alias("warnings"))
        .withColumn("scope", F.coalesce("scope", F.lit("total"))))


def catalog_findings(catalog: DataFrame, key: Column | str, known_categories: Iterable[str]) -> DataFrame:
    """Every check of a variable catalogue, as one findings frame."""
    ids = F.coalesce(F.size("match.concept_ids"), F.lit(0)) > 0
    require_inlined(catalog)
    values = F.coalesce(F.size("match.values"), F.lit(0)) > 0
    scoped = has_scope(F.col("criteria"), F.col("match"))
    listed = catalog.withColumn("concept_ids", F.col("match.concept_ids"))
    return reduce(DataFrame.unionByName, [
        duplicate_keys(catalog, ["category", "variable"]),
        required_fields(catalog, key, ["table", "column"]),
        allowed_values(catalog, key, "category", known_categories),
        unsafe_patterns(catalog, key),
        missing_scope(catalog, key),
        int_list(listed, key, "concept_ids"),
        mutually_exclusive(catalog, key, ids, values, "concept_ids and values are both set"),
        suffix(catalog, key, F.col("match.column"), "_concept_id", ids),
        identifier(catalog, key, F.col("match.name_column")),
        enum(catalog, key, F.col("proposal")),
        id_name_mismatch(catalog, key),
        text_rules(catalog, key, ["description", "notes", "inclusion_criteria"]),
        conditional_required(catalog, key, scoped, F.col("inclusion_criteria"), "inclusion_criteria"),
    ])


def cohort_findings(spark: SparkSession, cohort: Mapping[str, Any]) -> DataFrame:
    """Checks of one cohort's metadata: required fields, catalogue named, shapes."""
    shaped = ("data_cutoff_date", "last_etl_run", "known_limitations", "sign_off")
    plain = (*REQUIRED_COHORT_FIELDS, "variables_pack")
    values = [None if cohort.get(f) is None else str(cohort[f]) for f in plain]
    values += [None if cohort.get(f) is None else json.dumps(cohort[f]) for f in shaped]
    frame = spark.createDataFrame([tuple(values)], ", ".join(f"{f} string" for f in (*plain, *shaped)))
    key = F.coalesce("cohort_name", F.lit("?"))
    return reduce(DataFrame.unionByName, [
        required_fields(frame, key, REQUIRED_COHORT_FIELDS),
        metadata_shape(frame, key, shaped[:2], shaped[2:3], shaped[3]),
        findings(frame.where(pr.blank(F.col("variables_pack"))), WARNING, "no_catalogue", key,
                 "cohort has no variable catalogue"),
    ])
