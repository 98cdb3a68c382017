"""Model, audiences, roll-ups, sinks, batches and checks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import checks as ck, enrich, rollups
from tallyframe.plans import audience as au, batch, model as md
from tallyframe.sources import catalog as ct, sinks, warehouse
from tallyframe.sources.registry import Registry, Table

SPEC = md.CohortSpec.from_mapping(dict(cohort_name="demo_cohort", provider="P", disease="D", schema_name="demo",
                                       known_limitations=[" a ", " "], sign_off={"reviewer": " R "}), slug="demo")
CONFIG = md.Enrichment(categories={"Demographics": ["person"], "Vitals": ["measurement"]},
                       sensitive_pairs={"person": ["email"]}, sensitive_patterns=["^ssn$"])
CATALOG = [
    dict(category="Vitals", variable="Heart Rate", table="measurement", column="value", description="bpm"),
    dict(category="vitals", variable="blood Pressure", table="measurement", column="value", criteria="value < 0"),
    dict(category="Demographics", variable="Sex", table="person", column="sex", proposal="Standard"),
    dict(category="Demographics", variable="Age", table="person", column="age"),
    dict(category="Demographics", variable="Mail", table="person", column="email"),
    dict(category="Demographics", variable="Roster", table="cohort_patients", column="person_id"),
]


def demo(spark):
    person = spark.createDataFrame([(1, "F", 40, "a@b", None), (2, "M", None, "c@d", "1")],
                                   "person_id long, sex string, age int, email string, ssn string")
    measure = spark.createDataFrame([(1, 60.0), (1, 70.0)], "person_id long, value double")
    roster = spark.createDataFrame([(1,), (2,)], "person_id long")
    return Registry(spark, "demo", [Table("person", person, "person_id"), Table("measurement", measure, "person_id"),
                                    Table("cohort_patients", roster, "person_id")], subject_table="person")


@pytest.fixture(scope="module")
def model(spark):
    return md.build_model(SPEC, demo(spark), ct.catalog_frame(spark, CATALOG), CONFIG, generated_at="now")


def names(df, column):
    return [r[column] for r in df.select(column).collect()]


def test_order(model):
    assert names(model.variables, "variable") == ["Age", "Mail", "Roster", "Sex", "blood Pressure", "Heart Rate"]
    assert names(model.tables, "table") == ["person", "cohort_patients", "measurement"]


def test_summary(model):
    row = model.summary.first()
    assert (row["patient_count"], row["table_count"], row["column_count"]) == (2, 3, 8)
    assert row["known_limitations"] == ["a"] and row["sign_off"] == {"reviewer": "R"}
    assert row["schema_snapshot_digest"].startswith("sha256:") and row["min_date"] is None
    titles = {r["metric"]: r["value"] for r in au.summary_titles(model, "technical").collect()}
    assert titles["Date coverage"] == "—" and titles["Patient count"] == "2"


def test_digest_is_that_of_the_sorted_lines(spark, model):
    import hashlib
    columns = [("person", f.name, f.dataType.simpleString()) for f in demo(spark).tables["person"].data.schema.fields]
    columns += [("measurement", "person_id", "bigint"), ("measurement", "value", "double"),
                ("cohort_patients", "person_id", "bigint")]
    text = "".join(f"{t}.{c}:{ty}\n" for t, c, ty in sorted(columns))
    assert model.summary.first()["schema_snapshot_digest"] == "sha256:" + hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("audience, variables, columns, tables", [
    ("technical", 6, 8, 3), ("pharma", 5, 0, 0), ("customer", 3, 5, 2), ("sales", 3, 0, 2)])
def test_views(model, audience, variables, columns, tables):
    seen = au.view(model, audience)
    assert (seen.variables.count(), seen.columns.count(), seen.tables.count()) == (variables, columns, tables)


def test_dry_run_keeps_unimplemented(spark):
    dry = md.build_model(SPEC, demo(spark), ct.catalog_frame(spark, CATALOG), CONFIG, dry_run=True)
    assert au.view(dry, "customer").variables.count() == 4
    assert dry.tables.count() == 0 and dry.summary.first()["patient_count"] is None
    assert set(names(dry.variables, "implemented")) == {"No"}


def test_unknown_audience(model):
    with pytest.raises(KeyError):
        au.view(model, "press")
    with pytest.raises(KeyError):
        au.visible("press", "tables")


def test_layout_titles(model):
    count = {a: len(au.variables_layout(model.variables, a).columns) for a in au.VISIBILITY}
    assert count == {"technical": 18, "pharma": 17, "customer": 12, "sales": 8}
    assert au.variables_layout(model.variables, "sales").columns == [
        "Category", "Variable", "Description", "Observed Values", "Notes", "Type", "Proposal", "% Patients With Value"]
    assert "Criteria" not in au.variables_layout(model.variables, "sales").columns
    assert len(au.columns_layout(model.columns, "technical").columns) == 16
    assert au.columns_layout(model.columns, "customer").columns == ["Table(s)", "Column", "Description", "Field Type"]
    assert len(au.tables_layout(model.tables, "pharma").columns) == 9
    assert len(au.tables_layout(model.tables, "customer").columns) == 7
    assert au.summary_rows(model, "technical").count() == 17 and au.summary_rows(model, "sales").count() == 11


def test_sections_of_an_audience(model):
    assert list(au.sections(model, "pharma")) == ["summary", "variables"]
    rows = {r["Variable"]: r for r in au.sections(model, "sales")["variables"].collect()}
    assert rows["Sex"]["Observed Values"] == "F\nM" and rows["Sex"]["% Patients With Value"] == "100.0%"
    assert rows["Heart Rate"]["% Patients With Value"] == "50.0%"


def test_column_cells(model):
    rows = {(r["Table(s)"], r["Column"]): r for r in au.columns_layout(model.columns, "technical").collect()}
    assert rows["measurement", "value"]["Distribution"] == "Min: 60, Max: 70, Mean: 65 (std: 7.07)"
    assert rows["measurement", "value"]["Median (IQR)"] == "Median: 65 (IQR: 62.5–67.5)"
    assert rows["measurement", "value"]["Example"] == "60" and rows["measurement", "value"]["% Patient"] == "50.0%"
    assert (rows["person", "email"]["PII"], rows["person", "ssn"]["PII"], rows["person", "sex"]["PII"]) == ("Yes", "Yes", "")
    assert rows["person", "sex"]["Values"] == "F, M" and rows["person", "age"]["Completeness"] == "50.0%"


def test_basic_dictionary(spark):
    from tallyframe.plans.profile import column_profile
    found = md.basic_dictionary(column_profile(demo(spark), basic=True))
    assert len(found.columns) == 12 and found.count() == 8
    assert [r["metric"] for r in md.basic_summary(demo(spark), "c").collect()] == [
        "cohort", "patient_count", "table_count", "column_count"]


def test_rollup(spark):
    rows = [("Vitals", "Yes", 80.0), ("Vitals", "Yes", 60.0), ("Vitals", "No", 0.0), ("", "No", None),
            (None, "Yes", None), (" apple ", "Yes", 100.0), ("  ", "No", None)]
    df = spark.createDataFrame(rows, "category string, implemented string, completeness_pct double")
    found = [tuple(r) for r in rollups.coverage_rollup(df).collect()]
    assert found == [("", 1, 0, 0.0, None), ("apple", 1, 1, 100.0, 100.0), ("Uncategorized", 2, 1, 50.0, None),
                     ("Vitals", 3, 2, 100.0 * 2 / 3, 70.0)]


def test_hero_of_nothing(spark):
    summary = spark.createDataFrame([(None, None)], "patient_count long, years_of_data double")
    empty = spark.createDataFrame([], "implemented string")
    assert tuple(rollups.hero_stats(summary, empty).first()) == (None, None, 0, 0, 0.0)


def test_high_drop(spark):
    df = spark.createDataFrame([("a", "ok", 25.0), ("b", "ok", 24.9), ("c", "error", None), ("d", "ok", 80.0)],
                               "cohort string, status string, drop_pct double")
    assert names(rollups.high_drop(df), "cohort") == ["d", "a"]
    assert rollups.high_drop(df, dry_run=True).count() == 0


def test_excludes():
    layout = {"customer": {"exclude_tables": ["g"]}, "cohorts": {
        "slug": {"customer": {"extra_exclude_tables": ["x"]}}, "name": {"customer": {"exclude_tables": ["y"]}},
        "none": {"customer": {"exclude_tables": None}}}}
    assert enrich.exclude_list(layout, ["slug", "name"]) == {"g", "x"}
    assert enrich.exclude_list(layout, [None, "name", "slug"]) == {"y"}
    assert enrich.exclude_list(layout, ["none"]) == set()
    assert enrich.exclude_list(layout, ["else"]) == {"g"}
    assert enrich.exclude_list({}, ["else"], fallback=["f"]) == {"f"}
    assert enrich.exclude_list({"customer": {"exclude_tables": []}}, [], fallback=["f"]) == set()


def test_cohort_spec():
    assert SPEC.display_name == "demo_cohort" and SPEC.variant == "raw" and SPEC.status == "active"
    with pytest.raises(ValueError, match="provider"):
        md.CohortSpec.from_mapping(dict(cohort_name="x", disease="d", schema_name="s"))


def test_write_and_read_back(spark, model, tmp_path):
    out = str(tmp_path)
    paths = sinks.write_sections(au.sections(model, "customer"), out, "demo", "customer", "csv")
    assert paths["variables"].endswith("demo_dictionary_customer/variables")
    back = spark.read.csv(paths["variables"], header=True, multiLine=True, escape='"')
    assert back.count() == 3 and "Observed Values" in back.columns
    assert sinks.write_model_json(md.document(model), out, "demo", "customer") is None
    assert sinks.write_model_json(md.document(model), out, "demo", "sales") is None
    path = sinks.write_model_json(md.document(model), out, "demo")
    assert path.endswith("demo_dictionary/model")
    doc = json.loads(spark.read.text(path).first()[0])
    assert [v["variable"] for v in doc["variables"]] == names(model.variables, "variable")
    assert doc["summary"]["patient_count"] == 2 and len(doc["columns"]) == 8
    assert md.records(model).count() == 1 + 3 + 8 + 6


def test_a_failed_write_leaves_the_version_before(spark, tmp_path):
    out = str(tmp_path)
    good = spark.createDataFrame([(1, "x")], "a int, b string")
    assert sinks.read_sections(spark, out, "demo") == {}
    sinks.write_sections({"tables": good, "columns": good}, out, "demo")
    bad = spark.createDataFrame([("no number",)], "a string").select(F.expr("cast(a as int)").alias("a"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sinks.write_sections({"tables": good.unionByName(good), "columns": bad}, out, "demo")
    now = sinks.read_sections(spark, out, "demo")
    assert now["tables"].count() == 1 and now["columns"].collect() == good.collect()
    sinks.write_sections({"tables": good.unionByName(good)}, out, "demo", fmt="csv")
    now = sinks.read_sections(spark, out, "demo")
    assert list(now) == ["tables"] and now["tables"].count() == 2


def test_hard_rules_gate_the_release(spark, model, tmp_path):
    from dataclasses import replace

    from tallyframe.plans import release
    out = str(tmp_path)
    paths, found = release.release(model, out)
    assert found.count() == 0 and sinks.current_version(spark, out, "demo")["sections"] == paths
    nobody = replace(model, summary=model.summary.withColumn("patient_count", F.lit(None).cast("long")),
                     tables=model.tables.where("table = 'none'"), spec=replace(model.spec, status="wip"))
    hidden, found = release.release(nobody, out)
    assert sorted(r["rule"] for r in found.collect()) == ["empty_section", "no_patients"]
    assert sinks.current_version(spark, out, "demo")["sections"] == paths and hidden != paths


def test_batch(spark, tmp_path):
    def fail(spark):
        raise RuntimeError("no such schema")

    jobs = [batch.Job(md.CohortSpec("b", "p", "d", "bad", slug="bad"), fail),
            batch.Job(SPEC, lambda spark: (demo(spark), ct.catalog_frame(spark, CATALOG)))]
    rows = {r["cohort"]: r for r in batch.batch_results(spark, jobs).collect()}
    assert rows["bad"]["status"] == "error" and "no such schema" in rows["bad"]["error"]
    assert (rows["demo"]["variables_total"], rows["demo"]["variables_implemented"], rows["demo"]["patient_count"]) == (6, 5, 2)
    worse = ct.catalog_frame(spark, [dict(category="A", variable="V", table="person", column="age",
                                          criteria="cast(email as int) = 1"), CATALOG[2]])
    third = batch.Job(md.CohortSpec("w", "p", "d", "worse", slug="worse"), lambda spark: (demo(spark), worse))
    three = {r["cohort"]: r for r in batch.batch_results(spark, [*jobs, third]).collect()}
    assert (three["worse"]["status"], three["worse"]["variables_implemented"], three["worse"]["warning_count"]) == ("ok", 1, 1)
    assert three["demo"] == rows["demo"] and three["bad"]["status"] == "error"
    paths, errors = batch.write_batch(spark, jobs, str(tmp_path), ["technical", "sales"], CONFIG)
    assert list(errors) == ["bad"] and len(paths["demo"]) == 4 + 1 + 3
    dry = {r["cohort"]: r for r in batch.batch_results(spark, jobs, dry_run=True).collect()}
    assert (dry["demo"]["variables_implemented"], dry["demo"]["patient_count"]) == (0, None)


def test_jdbc_options():
    options = warehouse.jdbc_options({"host": "h"}, {"PGDATABASE": "d", "PGUSER": "u", "PGPASSWORD": "p", "PGHOST": "no"})
    assert options["url"] == "jdbc:postgresql://h:5432/d?sslmode=require" and options["user"] == "u"
    with pytest.raises(ValueError, match="password"):
        warehouse.jdbc_options({}, {"PGHOST": "h", "PGDATABASE": "d", "PGUSER": "u"})


def test_descriptions(spark):
    frame = enrich.description_frame(spark, {"a": " text ", "b": {"description": "x", "source_table": " S "}, "c": None})
    assert {r["table"]: (r["description"], r["source_table"]) for r in frame.collect()} == {
        "a": ("text", ""), "b": ("x", "S"), "c": ("", "")}


def test_catalogue_checks(spark):
    good = dict(category="Vitals", variable="Weight", table="m", column="value", criteria="x ILIKE '%w%'",
                inclusion_criteria="Weights.", proposal="Custom", match=None)
    ids = dict(column="drug_concept_id", concept_ids=[1, "2"])
    # variable: (what is changed in the good row, rules that must fire)
    cases = {
        "Weight": ({}, []),
        "Blank column": (dict(column=" "), ["required"]),
        "Category": (dict(category="Vital"), ["allowed_values"]),
        "Patterns": (dict(criteria="x ilike 'w' OR x ILIKE 'w%' OR x ILIKE '%w'"), ["unsafe_pattern"] * 2),
        "Blood Pressure": (dict(criteria=""), ["missing_scope"]),
        "Unexplained": (dict(inclusion_criteria=" "), ["conditional_required"]),
        "Tag": (dict(proposal="standard"), ["enum"]),
        "Drug": (dict(column="drug_concept_id"), ["id_name_mismatch"]),
        "Drug Concept ID": (dict(column="drug_concept_id"), []),
        "Upper": (dict(column="drug_id", expression="upper(drug_id)"), []),
        "Wording": (dict(notes="TODO: inherits from ckd_common"), ["text_rule"] * 4),
        "Ids": (dict(match=ids), []),
        "Bad ids": (dict(match={**ids, "concept_ids": [1, "x"]}), ["int_list"]),
        "Both": (dict(match={**ids, "values": ["a"]}), ["mutually_exclusive"]),
        "Ending": (dict(match={**ids, "column": "drug"}), ["suffix"]),
        "Label": (dict(match={**ids, "name_column": "a b"}), ["identifier"]),
    }
    rows = [{**good, "variable": name, **change} for name, (change, _) in cases.items()]
    rows += [{**good, "variable": "Twice"}] * 2
    found = ck.catalog_findings(ct.catalog_frame(spark, rows), F.col("variable"), ["Vitals"]).collect()
    fired = {}
    for r in found:
        fired.setdefault(r["key"], []).append(r["rule"])
    assert fired.pop("Vitals/Twice") == ["duplicate_key"]
    assert fired == {name: rules for name, (_, rules) in cases.items() if rules}
    errors = {"required", "conditional_required", "enum", "int_list", "mutually_exclusive", "identifier", "duplicate_key"}
    assert {r["rule"] for r in found if r["severity"] == "error"} == errors


RULE_HITS = [
    "see aat_common", "the MTC data", "a cohort-defining trait", "Captured  in notes", "inherited by", "owned here",
    "redacted by", "Sales audience", "for both", "surface it", "x ILIKE y", "SELECT x", "a join b", "x from drug_table",
    "extraction_type", "value_as_concept_name", "banned wildcards", "criteria restricted", "Earlier drafts",
    "Deliberately", "TODO", "and-qualifier", "doublecounted", "`drug_exposure`", "**bold**", "implemented: yes",
    "a Oxygen", "matches the statin family", "Matches an opioid drug",
]


def test_every_text_rule_fires(spark):
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(RULE_HITS)], "i int, t string")
    found = ck.text_rules(texts, "i", ["t"]).collect()
    hits = {(int(r["key"]), r["message"].split(" — ", 1)[1]) for r in found}
    assert all((i, ck.TEXT_RULES[i][1]) in hits for i in range(len(RULE_HITS)))
    clean = spark.createDataFrame([(0, "An MTCX unit of a urea test, joined from lists.")], "i int, t string")
    assert ck.text_rules(clean, "i", ["t"]).count() == 0


def test_words_never_hide_a_hit(spark):
    """With and without the word test the findings are the same."""
    texts = spark.createDataFrame([(i, t.upper() if i % 2 else t) for i, t in enumerate(RULE_HITS)], "i int, t string")
    plain = [rule[:2] for rule in ck.TEXT_RULES]
    assert sorted(ck.text_rules(texts, "i", ["t"]).collect()) == sorted(ck.text_rules(texts, "i", ["t"], plain).collect())


def test_cohort_checks(spark):
    good = dict(cohort_name="c", provider="p", disease="d", schema_name="s", variables_pack="v",
                data_cutoff_date="2026-04-15", known_limitations=["x"], sign_off={"reviewer": "R"})
    rules = lambda **change: sorted(r["message"] for r in ck.cohort_findings(spark, {**good, **change}).collect())
    assert rules() == []
    assert rules(provider="") == ["missing provider"]
    assert rules(data_cutoff_date=20260415) == ["data_cutoff_date must be a string"]
    assert rules(known_limitations="x") == ["known_limitations must be a list"]
    assert rules(sign_off="R") == ["sign_off must be a mapping"]
    assert rules(sign_off={"reviewer": " "}) == ["sign_off has no reviewer"]
    assert rules(variables_pack=None) == ["cohort has no variable catalogue"]


def test_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("c", "e"), ("e", "f"), ("x", "x"), ("g", None)],
                                  "s string, t string")
    assert sorted(names(ck.circular_references(edges, "s", "t"), "key")) == ["a", "b", "c", "x"]
    known = spark.createDataFrame([("a",), ("b",), ("c",), ("e",), ("x",)], "k string")
    found = ck.missing_references(edges, "s", "t", known, "k").collect()
    assert [(r["key"], r["message"]) for r in found if r["message"] == "not found: f"] == [("e", "not found: f")]


def test_between_cycles(spark, monkeypatch):
    """A node between two cycles is on none; a ring is read in rounds that grow with the logarithm of its length."""
    pairs = [("a", "b"), ("b", "a"), ("b", "m"), ("m", "c"), ("c", "d"), ("d", "c"), ("d", "z")]
    found = ck.circular_references(spark.createDataFrame(pairs, "s string, t string"), "s", "t")
    assert sorted(names(found, "key")) == ["a", "b", "c", "d"]
    tables, plain = [], ck.stored
    monkeypatch.setattr(ck, "stored", lambda df: tables.append(1) or plain(df))
    ring = [(i, (i + 1) % 400) for i in range(400)] + [(39, 5000)] + [(i, i + 1) for i in range(5000, 5004)]
    found = ck.circular_references(spark.createDataFrame(ring, "s long, t long"), "s", "t")
    assert sorted(int(x) for x in names(found, "key")) == list(range(400)) and len(tables) <= 60


def test_components_against_plain_version(spark):
    rng = random.Random(11)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(55)]
    reach = {(a, b) for a, b in edges}
    while True:
        more = reach | {(a, d) for a, b in reach for c, d in edges if b == c}
        if more == reach:
            break
        reach = more
    found = {r["node"]: r["group"] for r in ck.strongly_connected(spark.createDataFrame(edges, "s long, t long")).collect()}
    want = {a: {b for b in range(40) if (a, b) in reach and (b, a) in reach} | {a} for a in range(40)}
    want = {a: members for a, members in want.items() if len(members) > 1}
    assert found.keys() == want.keys()
    assert all({n for n, g in found.items() if g == found[a]} == want[a] for a in want)
    assert ck.strongly_connected(spark.createDataFrame([(1, 2), (2, 3), (3, 3)], "s long, t long")).count() == 0


def test_drift(spark):
    before = spark.createDataFrame([("t", "a", 50.0), ("t", "b", 10.0), ("t", "c", 1.0)], "table string, column string, completeness_pct double")
    after = spark.createDataFrame([("t", "a", 50.0), ("t", "b", 30.0), ("t", "d", 1.0)], "table string, column string, completeness_pct double")
    found = {r["column"]: (r["status"], r["delta_pct"]) for r in rollups.profile_drift(before, after).collect()}
    assert found == {"a": ("same", 0.0), "b": ("changed", 20.0), "c": ("removed", None), "d": ("added", None)}
