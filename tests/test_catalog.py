"""Catalogue rows, value sets, layers, discovery."""

import json

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import predicates as pr
from tallyframe.plans import discovery as dc, variables as vb
from tallyframe.sources import catalog as ct
from tallyframe.sources.registry import Registry, Table


def compiled(spark, match):
    frame = ct.catalog_frame(spark, [dict(match=match)])
    return frame.select(pr.match_sql(F.col("match"))).first()[0]


@pytest.mark.parametrize("match, expected", [
    (None, ""),
    (dict(values=["a"]), ""),
    (dict(column=" ", values=["a"]), ""),
    (dict(column="c"), ""),
    (dict(column="c", values=["O'Neil", "b", "O'Neil"]), "\"c\" IN ('O''Neil', 'b')"),
    (dict(column="c", values=["b"], concept_ids=[]), "\"c\" IN ('b')"),
    (dict(column="c", values=["b"], concept_ids=[3, "1", 3]), '"c" IN (3, 1)'),
    (dict(column="c", values=["b"], concept_ids=["x", None]), ""),
    (dict(column="c", concept_ids=["x", " 12 "]), '"c" IN (12)'),
])
def test_value_set_text(spark, match, expected):
    assert compiled(spark, match) == expected


def test_text_with_quotes_and_backslashes_selects_the_same_rows(spark):
    values = ["it's", "a\\b", 'say "x"', "100%", "plain"]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    for v in values:
        predicate = compiled(spark, dict(column="c", values=[v]))
        assert [r[0] for r in df.where(pr.condition(predicate)).collect()] == [v]


def test_dialect(spark):
    assert pr.to_spark_sql("""LEFT("zip"::text, 3) = '"x"::text'""") == "LEFT(`zip`::string, 3) = '\"x\"::text'"
    df = spark.createDataFrame([("90210",), (None,)], "zip string")
    assert df.select(pr.expression('LEFT("zip"::text, 3)')).first()[0] == "902"
    assert pr.condition("  ") is None


def test_long_and_short_sets_agree(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), F.concat(F.lit("v"), "id").alias("c"))
    wanted = [f"v{i}" for i in range(0, 4000, 3)]
    by_join = pr.match_filter(df, "c", wanted).count()
    by_list = pr.match_filter(df, "c", wanted[:900]).count()
    assert (by_join, by_list) == (len(wanted), 900)
    frame = spark.createDataFrame([(v,) for v in wanted + wanted[:5]], "x string")
    flagged = pr.with_membership(df, "c", frame, "hit")
    assert flagged.count() == 5000 and flagged.where("hit").count() == len(wanted)


def test_value_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("click\nrefund\n\n view \n")
    (tmp_path / "b.json").write_text(json.dumps({"values": ["x", "y"]}))
    (tmp_path / "c.json").write_text(json.dumps(["z", "view"]))
    rows = [dict(variable="a", match=dict(column="c", values=["view", "click", "view"], values_file="a.txt")),
            dict(variable="b", match=dict(column="c", values_file="b.json")),
            dict(variable="c", match=dict(column="c", values=["q"], values_file="c.json")),
            dict(variable="d", match=dict(column="c", values=["q"])), dict(variable="e")]
    merged = ct.inline_value_files(spark, ct.catalog_frame(spark, rows), str(tmp_path))
    found = {r["variable"]: r["match"]["values"] if r["match"] else None for r in merged.collect()}
    assert found == {"a": ["view", "click", "refund"], "b": ["x", "y"], "c": ["q", "z", "view"], "d": ["q"], "e": None}


def test_ordered_union_with_a_hot_value(spark):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("v"), (F.col("id") % 50).cast("string"))).alias("value"), F.col("id").alias("position"))
    first = spark.createDataFrame([("v7", 1), ("new", 0), (None, 2)], "value string, position long")
    found = [r["value"] for r in ct.ordered_union([first, hot]).orderBy("source_rank", "position").collect()]
    expected = ["new", "v7"] + [v for v in dict.fromkeys(
        "hot" if i % 3 == 0 else f"v{i % 50}" for i in range(30_000)) if v != "v7"]
    assert found == expected


LAYERS = {
    "base": {"variables": [dict(category="D", variable="Sex", notes="first"), dict(category="D", variable="Age")]},
    "disease": {"include": ["base"], "variables": [dict(category="M", variable="Drug", notes="shared")]},
    "local": {"include": ["disease"], "variables": [dict(category=" D ", variable="Sex", notes="own"),
                                              dict(category="M", variable="Extra")]},
}


def test_layers_override_in_place(spark):
    merged = ct.layered_catalog(spark, LAYERS, "local").collect()
    assert [(r["variable"], r["notes"], r["layer"]) for r in merged] == [
        ("Sex", "own", "local"), ("Age", None, "base"), ("Drug", "shared", "disease"), ("Extra", None, "local")]


def test_includes():
    assert ct.resolve_includes({"a": ["b", "c"], "b": ["d"], "c": ["d"], "d": []}, "a") == ["d", "b", "c", "a"]
    with pytest.raises(ValueError, match="circular"):
        ct.resolve_includes({"a": ["b"], "b": ["a"]}, "a")
    with pytest.raises(KeyError):
        ct.resolve_includes({"a": ["b"]}, "a")


@pytest.mark.parametrize("matcher, display, override, expected", [
    ("drug_concept_name", "", "", ("drug_concept_id", "drug_concept_name")),
    ("drug_concept_id", "drug_concept_name", "", ("drug_concept_id", "drug_concept_name")),
    ("observation_concept_id", "value_as_concept_name", "", ("observation_concept_id", "observation_concept_name")),
    ("drug_concept_id", "", "display_label", ("drug_concept_id", "display_label")),
    ("drug_concept_name", "", "label", ("drug_concept_id", "label")),
    ("zip", "zip", "label", ("", "")),
    ("", "", "", ("", "")),
])
def test_id_and_name_columns(spark, matcher, display, override, expected):
    df = spark.createDataFrame([(matcher, display, override)], "m string, d string, o string")
    pair = ct.id_and_name_columns(F.col("m"), F.col("d"), F.col("o"))
    assert tuple(df.select(*pair).first()) == expected


@pytest.mark.parametrize("row, matcher, scope, skip", [
    (dict(table="t", column="value_as_number", criteria="m_concept_name ILIKE '%x%'"), "m_concept_name",
     "m_concept_name ILIKE '%x%'", ""),
    (dict(table="t", column="value_as_number", criteria="x > 1"), "", "x > 1", "value/date column"),
    (dict(table="t", column="visit_start_date", criteria="x > 1"), "", "x > 1", "value/date column"),
    (dict(table="t", column="drug_concept_name"), "drug_concept_name", "", "cannot scope"),
    (dict(table="", column="c", criteria="x"), "c", "x", "missing table"),
    (dict(table="t", criteria="x"), "", "x", "missing column"),
    (dict(table="t", column="c", criteria="x = 1", match=dict(column="k", values=["v"])), "k", "x = 1", ""),
    (dict(table="t", column="c", match=dict(column="k", values=["v"])), "k", "\"k\" IN ('v')", ""),
    (dict(table="t", column="c", criteria="a_concept_name IN ('x')"), "a_concept_name", "a_concept_name IN ('x')", ""),
])
def test_scope(spark, row, matcher, scope, skip):
    found = ct.resolve_scope(ct.catalog_frame(spark, [row])).first()
    assert (found["matcher_column"], found["scope_sql"]) == (matcher, scope)
    assert skip in found["skip_reason"] and bool(skip) == bool(found["skip_reason"])


def test_partition_of_values(spark):
    rows = [("81", 100), ("325", 50), ("acid", 5)]
    data = spark.createDataFrame([(v,) for v, n in rows for _ in range(n)], "drug_concept_name string")
    registry = Registry(spark, "s", [Table("drug", data)])
    catalog = ct.catalog_frame(spark, [dict(
        category="M", variable="Aspirin", table="drug", column="drug_concept_name", criteria="TRUE",
        match=dict(column="drug_concept_name", values=["81", "325", "Old Label"]))])
    found, parts = dc.discover(registry, catalog)
    got = {r["value"]: (r["n"], r["status"]) for r in parts.collect()}
    assert got == {"81": (100, "both"), "325": (50, "both"), "acid": (5, "missing"), "Old Label": (None, "stale")}
    proposal = [r["value"] for r in dc.suggest_values(parts).collect()]
    assert proposal == ["81", "325", "acid", "Old Label"]
    line = dc.report(found, parts).first()
    assert (line["configured"], line["observed"], line["both"], line["missing"], line["stale"]) == (3, 3, 2, 1, 1)


def test_ids_keep_configured_and_name_the_rarest(spark):
    data = spark.createDataFrame([(1, "a")] * 5 + [(1, "b")] * 2 + [(2, "c")] * 3 + [(None, "d"), (3, None)],
                                 "x_concept_id int, x_concept_name string")
    registry = Registry(spark, "s", [Table("t", data)])
    catalog = ct.catalog_frame(spark, [dict(
        category="C", variable="V", table="t", column="x_concept_name", criteria="TRUE",
        match=dict(column="x_concept_id", concept_ids=[9, 2]))])
    _, parts = dc.discover(registry, catalog, dc.IDS)
    found = [(r["id"], r["name"], r["n"], r["status"]) for r in dc.suggest_ids(parts).collect()]
    assert found == [(1, "b", 5, "missing"), (2, "c", 3, "both"), (9, None, None, "stale")]


def test_only_variable(spark):
    catalog = ct.catalog_frame(spark, [dict(variable="A", table="t", column="c", criteria="x = 1")])
    assert dc.targets(catalog, only_variable="a").count() == 1
    with pytest.raises(ValueError):
        dc.targets(catalog, only_variable="b")


def test_dry_run_shows_the_strict_predicate(spark):
    catalog = ct.catalog_frame(spark, [
        dict(category="A", variable="B", table="infusion", column="c", criteria="c ILIKE '%x%'",
             match=dict(column="c", values=["x"]))])
    row = vb.with_display(vb.dry_run(catalog)).first()
    assert (row["criteria"], row["implemented"], row["completeness_pct"], row["values"], row["data_source"]) == (
        "\"c\" IN ('x')", "No", None, "", "Enhanced")


def test_unread_value_file_is_an_error(spark, tmp_path):
    from tallyframe.operators import checks
    from tallyframe.plans import discovery, variables
    from tallyframe.sources.registry import Registry, Table
    (tmp_path / "set.txt").write_text("b\n")
    rows = ct.catalog_frame(spark, [dict(variable="V", table="t", column="c",
                                         match=dict(column="c", values_file="set.txt"))])
    tables = Registry(spark, "s", [Table("t", spark.createDataFrame([("a",), ("b",)], "c string"))])
    for plan in (lambda: variables.variable_profile(tables, rows), lambda: variables.dry_run(rows),
                 lambda: discovery.discover(tables, rows), lambda: checks.catalog_findings(rows, "variable", [])):
        with pytest.raises(ValueError, match="values_file"):
            plan()
    read = ct.inline_value_files(spark, rows, str(tmp_path))
    found = variables.variable_profile(tables, read).first()
    assert (found["n_scope"], found["n_nonnull"]) == (1, 1)


def test_matcher_of_a_row_without_column(spark):
    rows = ct.catalog_frame(spark, [dict(variable="V", table="t", criteria="drug_concept_name ILIKE '%x%'")])
    found = ct.resolve_scope(rows).first()
    assert (found["matcher_column"], found["skip_reason"]) == ("", ct.NO_COLUMN)


def test_white_space_of_any_kind(spark):
    from tallyframe.functions import predicates as pr
    blanks = ["", " ", "\t\n", "\u00a0", "\u2003\r\n", "\x1f\u3000", None]
    df = spark.createDataFrame([(b,) for b in blanks] + [("\u00a0a b\u2028",)], "x string")
    found = df.select(pr.blank(F.col("x")), pr.stripped(F.col("x"))).collect()
    assert [tuple(r) for r in found] == [(True, "")] * len(blanks) + [(False, "a b")]


def test_only_data_errors_are_isolated(spark):
    from tallyframe.functions.errors import is_data_error
    with pytest.raises(Exception) as bad_cast:
        spark.createDataFrame([("x",)], "c string").select(F.col("c").cast("int") + F.expr("cast(c as int)")).collect()
    with pytest.raises(Exception) as bad_name:
        spark.range(1).select("nothing")
    assert is_data_error(bad_cast.value) and is_data_error(bad_name.value)
    assert not is_data_error(MemoryError()) and not is_data_error(RuntimeError("executor lost"))


def test_stages_that_fail_together_are_a_data_error(spark):
    from py4j.protocol import Py4JJavaError
    from tallyframe.functions.errors import first_line, is_data_error
    with pytest.raises(Exception) as one:
        spark.sql("select cast('x' as int) as v").collect()
    java = spark._jvm.java.lang
    several = Py4JJavaError("", java.RuntimeException("multiple failures", one.value._origin))
    assert is_data_error(several) and first_line(several).startswith("[CAST_INVALID_INPUT]")
    lost = Py4JJavaError("", java.RuntimeException("stage", java.RuntimeException("executor lost")))
    assert not is_data_error(lost)


def test_tables_that_fail_together_keep_their_sound_columns(spark):
    from tallyframe.plans import profile as pf
    from tallyframe.sources.registry import Registry, Table
    view = spark.range(4).repartition(4).selectExpr("id", "cast(concat('x', id) as int) as v")
    found = pf.measured_profile(Registry(spark, "s", [Table(f"t{i}", view) for i in range(4)]), parts={"nulls"})
    assert {(r["column"], r["null_count"], r["error"][:20]) for r in found.collect()} == {
        ("id", 0, ""), ("v", None, "[CAST_INVALID_INPUT]")}


def test_column_types_need_no_scan(spark):
    from tallyframe.plans import variables
    from tallyframe.sources.registry import Registry, Table
    frame = spark.createDataFrame([("a",)], "c string")
    tables = Registry(spark, "s", [Table("a", frame), Table("b", frame)])
    variables.variable_profile(tables, ct.catalog_frame(spark, [dict(variable="V", table="a", column="c")]))
    assert set(tables._row_counts) == {"a"}


@pytest.mark.parametrize("mode", [dc.NAMES, dc.IDS])
def test_a_variable_whose_rows_fail_is_skipped_alone(spark, mode):
    data = spark.createDataFrame([("a", "1", "5"), ("b", "2", "x"), ("a", "1", "7")],
                                 "k_concept_name string, k_concept_id string, amount string")
    tables = Registry(spark, "s", [Table("t", data), Table("u", data)])
    row = lambda name, table, criteria: dict(variable=name, table=table, column="k_concept_name", criteria=criteria)
    rows = ct.catalog_frame(spark, [
        row("first", "t", "TRUE"), row("cast", "t", "cast(amount as int) > 1"), row("second", "u", "amount <> '7'"),
        row("zero", "u", "1 / (length(amount) - 1) > 0"), row("nothing", "u", "no_such_column = 1")])
    found, parts = dc.discover(tables, rows, mode)
    reasons = {r["variable"]: r["skip_reason"] for r in found.collect()}
    assert [v for v, reason in reasons.items() if not reason] == ["first", "second"]
    assert "CAST_INVALID_INPUT" in reasons["cast"] and "DIVIDE_BY_ZERO" in reasons["zero"]
    value = "name" if mode == dc.IDS else "value"
    assert {(r["variable"], r[value]): r["n"] for r in parts.collect()} == {
        ("first", "a"): 2, ("first", "b"): 1, ("second", "a"): 1, ("second", "b"): 1}


def test_discovery_of_failing_variables_only(spark):
    data = spark.createDataFrame([("a", "x")], "k_concept_name string, amount string")
    rows = ct.catalog_frame(spark, [dict(variable="v", table="t", column="k_concept_name", criteria="cast(amount as int) > 1")])
    found, parts = dc.discover(Registry(spark, "s", [Table("t", data)]), rows)
    assert parts.count() == 0 and found.first()["skip_reason"]
    assert dc.report(found, parts).first()["observed"] == 0


def test_isolated_costs_one_run_when_sound():
    from tallyframe.functions.errors import isolated
    runs = []
    assert isolated(range(5), lambda some: runs.append(len(some)) or len(some)) == ([5], []) and runs == [5]
    with pytest.raises(RuntimeError):
        isolated([1, 2], lambda some: (_ for _ in ()).throw(RuntimeError("executor lost")))
    assert isolated([], len) == ([], [])
