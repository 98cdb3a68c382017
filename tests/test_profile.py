"""Column and variable profiles on literal frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from tallyframe.functions import kinds
from tallyframe.plans import model as md, profile as pf, variables as vb
from tallyframe.sources import catalog as ct
from tallyframe.sources.registry import Registry, Table


def people(spark, n=1000):
    return Table("person", spark.range(n).select(F.col("id").alias("person_id")), "person_id")


def registry(spark, *tables, total=1000):
    return Registry(spark, "s", [people(spark, total), *tables], subject_table="person")


def variable(spark, reg, **row):
    found = vb.variable_profile(reg, ct.catalog_frame(spark, [dict(category="C", variable="V", **row)]))
    return vb.with_display(found).first()


@pytest.mark.parametrize("name, kind", [
    ("integer", "continuous"), ("double precision", "continuous"), ("numeric(10,2)", "continuous"),
    ("decimal(5,1)", "continuous"), ("timestamp without time zone", "date"), ("date", "date"),
    ("time with time zone", "date"), ("text", "unstructured"), ("character varying(20)", "categorical"),
    ("boolean", "categorical"), ("uuid", "categorical"), ("array<int>", "categorical"), ("string", "categorical")])
def test_kind_of_type_name(spark, name, kind):
    df = spark.createDataFrame([(name,)], "t string")
    assert df.select(kinds.metric_kind(F.col("t"))).first()[0] == kind


def test_kind_of_field():
    field = lambda n, t: T.StructField(n, t)
    assert kinds.field_kind(field("x", T.DecimalType(5, 1))) == "continuous"
    assert kinds.field_kind(field("x", T.TimestampNTZType())) == "date"
    assert kinds.field_kind(field("note_text", T.StringType())) == "unstructured"
    assert kinds.field_kind(field("x", T.StringType()), "unstructured") == "unstructured"
    assert kinds.field_kind(field("x", T.BooleanType())) == "categorical"


def test_surrogate_keys():
    assert all(kinds.name_is_surrogate_key(c) for c in ("person_id", "drug_concept_id", "visit_detail_id", "note_id"))
    assert not any(kinds.name_is_surrogate_key(c) for c in ("year_of_birth", "valid", "identity"))


def test_subject_share_uses_the_cohort(spark):
    data = spark.range(200).select((F.col("id") % 50).alias("person_id"), F.lit("x").alias("c"))
    found = pf.column_profile(registry(spark, Table("t", data, "person_id")), ["t"]).where("column = 'c'").first()
    assert (found["subject_count"], found["patient_pct"]) == (50, 5.0)


def test_subject_share_unknown_or_empty(spark):
    data = spark.range(10).select(F.col("id").alias("person_id"))
    alone = Registry(spark, "s", [Table("t", data, "person_id")])
    assert pf.column_profile(alone).first()["patient_pct"] is None
    none = registry(spark, Table("t", data, "person_id"), total=0)
    assert pf.column_profile(none, ["t"]).first()["patient_pct"] is None
    empty = registry(spark, Table("t", data.where("person_id < 0"), "person_id"))
    row = pf.column_profile(empty, ["t"]).first()
    assert (row["row_count"], row["null_count"], row["completeness_pct"], row["patient_pct"]) == (0, 0, 0.0, 0.0)
    tables = {r["table"]: r["subject_count"] for r in pf.table_profile(empty).collect()}
    assert tables == {"person": 1000, "t": None}
    derived = {r["table"]: r["subject_count"] for r in pf.tables_of(empty, pf.column_profile(empty)).collect()}
    assert derived == tables


def test_column_depths_and_skips(spark):
    data = spark.range(100).select(
        F.col("id").alias("person_id"), F.concat(F.lit("c"), F.col("id") % 30).alias("drug_concept_name"),
        F.concat(F.lit("c"), F.col("id") % 30).alias("other"), F.lit("long").alias("note_text"),
        F.lit(None).cast("double").alias("nothing"), F.array(F.col("id") % 2).alias("flags"))
    rows = {r["column"]: r for r in pf.column_profile(registry(spark, Table("t", data, "person_id")), ["t"]).collect()}
    assert len(rows["drug_concept_name"]["top_values"]) == 20 and len(rows["other"]["top_values"]) == 5
    assert rows["note_text"]["top_values"] is None and rows["note_text"]["kind"] == "unstructured"
    assert rows["person_id"]["mean"] is None
    assert (rows["nothing"]["null_count"], rows["nothing"]["median"], rows["nothing"]["completeness_pct"]) == (100, None, 0.0)
    assert [tuple(v) for v in rows["flags"]["top_values"]] == [("[0]", 50), ("[1]", 50)]
    none = pf.column_profile(registry(spark, Table("t", data, "person_id")), ["t"], parts={"top"},
                             sample_values=0, sample_concept=0)
    assert none.where("top_values is not null").count() == 0


def test_single_row_has_no_deviation(spark):
    row = pf.column_profile(registry(spark, Table("t", spark.createDataFrame([(4.5,)], "v double"))), ["t"]).first()
    assert (row["mean"], row["std"], row["median"]) == (4.5, None, 4.5)


def test_numeric_variable(spark):
    # 800 values: quartiles 150, 170, 190 over 400 subjects; 200 rows in scope without a value
    values = [150.0] * 300 + [170.0] * 200 + [190.0] * 300
    rows = [(i % 400, "bp", v) for i, v in enumerate(values)] + [(900, "bp", None)] * 200 + [(1, "other", 1.0)] * 7
    data = spark.createDataFrame(rows, "person_id long, kind string, value_as_number double")
    row = variable(spark, registry(spark, Table("m", data, "person_id")), table="m", column="value_as_number",
                   criteria="kind = 'bp'")
    assert (row["n_scope"], row["n_nonnull"], row["completeness_pct"], row["patient_pct"]) == (1000, 800, 80.0, 40.0)
    assert row["median_iqr"] == "Median: 170 (IQR: 150-190)" and row["implemented"] == "Yes"
    assert row["distribution"] == "150: 300 (37.5%); 190: 300 (37.5%); 170: 200 (25.0%)"
    narrowed = vb.variable_profile(
        registry(spark, Table("m", data, "person_id")), ct.catalog_frame(spark, [dict(
            category="C", variable="V", table="m", column="value_as_number", criteria="kind = 'bp'")]), row_limit=0).first()
    assert (narrowed["q1"], narrowed["median"], narrowed["q3"]) == (150.0, 170.0, 190.0)


def test_date_variable(spark):
    days = [dt.date(2022, 1, 15), dt.date(2026, 3, 22), dt.date(2024, 1, 1), None]
    data = spark.createDataFrame([(i, days[i % 4]) for i in range(500)] , "person_id long, visit_start_date date")
    row = variable(spark, registry(spark, Table("v", data, "person_id")), table="v", column="visit_start_date")
    assert row["distribution"] == "Min: 2022-01-15, Max: 2026-03-22"
    assert (row["values"], row["median_iqr"], row["example"], row["patient_pct"]) == ("", "", "2022-01-15", 37.5)


@pytest.mark.parametrize("column, extraction", [("note_text", "Structured"), ("body", "Unstructured")])
def test_free_text(spark, column, extraction):
    data = spark.range(1230).select((F.col("id") % 40).alias("person_id"), F.col("id").cast("string").alias(column))
    row = variable(spark, registry(spark, Table("note", data, "person_id"), total=100), table="note", column=column,
                   extraction_type=extraction)
    assert row["distribution"] == "1,230 rows; values not aggregated (free text)"
    assert (row["top_values"], row["patient_pct"]) == (None, 40.0)


def test_expression(spark):
    data = spark.createDataFrame([("90210",)] * 40 + [("95014",)] * 30, "zip string")
    row = variable(spark, registry(spark, Table("location", data)), table="location", column="zip",
                   expression='LEFT("zip"::text, 3)')
    assert (row["values"], row["column"], row["field_type"]) == ("902, 950", "zip", "string")
    assert row["patient_pct"] is None and row["implemented"] == "Yes"


def test_expression_on_a_number_is_not_summarised(spark):
    data = spark.createDataFrame([(12,), (13,)], "zip int")
    row = variable(spark, registry(spark, Table("location", data)), table="location", column="zip", expression="zip + 1")
    assert (row["values"], row["median"], row["field_type"]) == ("13, 14", None, "int")


def test_null_criteria_rows_are_out_of_scope(spark):
    data = spark.createDataFrame([("a", 1.0), (None, 2.0), ("b", None)], "k string, v double")
    row = variable(spark, registry(spark, Table("t", data)), table="t", column="v", criteria="k IN ('a', 'b')")
    assert (row["n_scope"], row["n_nonnull"]) == (2, 1)


def test_unimplemented_and_errors(spark):
    data = spark.createDataFrame([(1, "a", 1.0)], "person_id long, k string, v double")
    reg = registry(spark, Table("t", data, "person_id"))
    rows = [dict(variable="ghost", table="t", column="v", criteria="k = 'z'"),
            dict(variable="column", table="t", column="w", criteria="k = 'a'"),
            dict(variable="criteria", table="t", column="v", criteria="nope = 1"),
            dict(variable="syntax", table="t", column="v", criteria="k = = 'a')"),
            dict(variable="number", table="t", column="v", criteria="v + 1"),
            dict(variable="table", table="u", column="v"),
            dict(variable="fine", table="t", column="v")]
    found = {r["variable"]: r for r in vb.variable_profile(reg, ct.catalog_frame(spark, rows)).collect()}
    assert len(found) == 7
    assert (found["ghost"]["implemented"], found["ghost"]["completeness_pct"], found["ghost"]["patient_pct"]) == ("No", None, None)
    assert (found["column"]["n_scope"], found["column"]["completeness_pct"]) == (1, 0.0)
    assert all(found[k]["n_scope"] == 0 for k in ("criteria", "syntax", "number", "table"))
    assert {k for k, r in found.items() if r["error"]} == {"column", "criteria", "syntax", "number", "table"}
    assert (found["fine"]["implemented"], found["fine"]["error"]) == ("Yes", "")


def test_long_value_set_in_a_variable(spark):
    data = spark.range(6000).select((F.col("id") % 100).alias("person_id"), F.concat(F.lit("v"), "id").alias("c"))
    row = variable(spark, registry(spark, Table("t", data, "person_id")), table="t", column="c",
                   match=dict(column="c", values=[f"v{i}" for i in range(0, 9000, 2)]))
    assert (row["n_scope"], row["n_nonnull"], row["subject_count"]) == (3000, 3000, 50)


def test_value_file_fills_a_variable(spark, tmp_path):
    (tmp_path / "set.txt").write_text("b\nc\n")
    data = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "c string")
    rows = ct.catalog_frame(spark, [dict(variable="V", table="t", column="c",
                                         match=dict(column="c", values=["a"], values_file="set.txt"))])
    rows = ct.inline_value_files(spark, rows, str(tmp_path))
    assert vb.variable_profile(registry(spark, Table("t", data)), rows).first()["n_nonnull"] == 3


def test_hot_subject_and_hot_value(spark):
    """A third of all rows share one subject and one value; counts stay whole."""
    data = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).cast("long").alias("person_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 1000)).alias("c"))
    rows = [(7 if i % 3 == 0 else i % 900, "hot" if i % 3 == 0 else f"v{i % 1000}") for i in range(90_000)]
    found = pf.column_profile(registry(spark, Table("t", data, "person_id")), ["t"]).where("column = 'c'").first()
    assert found["subject_count"] == len({p for p, _ in rows})
    counts = {}
    for _, c in rows:
        counts[c] = counts.get(c, 0) + 1
    best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:5]
    assert [tuple(v) for v in found["top_values"]] == best


def test_database_registry(spark):
    spark.sql("create database if not exists clinic")
    spark.sql("create table clinic.person (person_id bigint, code varchar(5), note_text varchar(9), story string) using parquet")
    spark.sql("insert into clinic.person values (1, 'a', 'x', 'long'), (2, 'b', 'y', 'longer')")
    spark.sql("create view clinic.adults as select person_id from clinic.person")
    reg = Registry.from_database(spark, "clinic", "person_id", {"person": {"story": "unstructured"}}, subject_table="person")
    assert {(t.name, t.object_type, t.subject_key) for t in reg.tables.values()} == {
        ("adults", "VIEW", "person_id"), ("person", "TABLE", "person_id")}
    assert [reg.tables["person"].kind(c) for c in ("person_id", "code", "note_text", "story")] == [
        "continuous", "categorical", "categorical", "unstructured"]
    assert reg.subject_total() == 2
    from tallyframe.sources.registry import database_object_counts
    listed = {r["schema"]: (r["table_count"], r["view_count"]) for r in database_object_counts(spark).collect()}
    assert listed["clinic"] == (1, 1) and listed["default"] == (0, 0)


def test_date_coverage(spark):
    visits = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2021, 6, 1),)], "visit_start_date date")
    drugs = spark.createDataFrame([(dt.datetime(2019, 1, 1, 8),)], "drug_exposure_start_date timestamp")
    reg = Registry(spark, "s", [Table("visit_occurrence", visits), Table("drug_exposure", drugs)])
    row = md.date_coverage(pf.column_profile(reg), md.DATE_CANDIDATES).first()
    assert row["contributing_columns"] == ["visit_occurrence.visit_start_date", "drug_exposure.drug_exposure_start_date"]
    assert (row["min_date"], row["max_date"], row["years_of_data"]) == ("2019-01-01 08:00:00", "2021-06-01", 2.41)
    none = md.date_coverage(pf.column_profile(registry(spark)), md.DATE_CANDIDATES).first()
    assert (none["min_date"], none["years_of_data"], none["contributing_columns"]) == (None, None, [])


def test_large_path_equals_the_small_one(spark):
    """Counts first, quartiles by narrowing, subjects only of partly filled columns."""
    data = spark.range(3000).select(
        (F.col("id") % 70).alias("person_id"), (F.col("id") * 0.5).alias("full"),
        F.when(F.col("id") % 70 < 20, F.col("id")).alias("some"), F.lit(None).cast("string").alias("none"),
        F.when(F.col("id") % 3 > 0, "x").alias("cat"), F.lit(dt.date(2024, 1, 1)).alias("day"))
    reg = registry(spark, Table("t", data, "person_id"))
    order = lambda df: sorted(df.collect(), key=lambda r: r["column"])
    small, large = order(pf.column_profile(reg, ["t"])), order(pf.column_profile(reg, ["t"], row_limit=0))
    assert small == large
    assert {r["column"]: r["subject_count"] for r in large} == {
        "person_id": 70, "full": 70, "some": 20, "none": 0, "cat": 70, "day": 70}
    rows = ct.catalog_frame(spark, [
        dict(variable="a", table="t", column="some", criteria="cat = 'x'"), dict(variable="b", table="t", column="none"),
        dict(variable="c", table="t", column="full"), dict(variable="d", table="t", column="full", criteria="full < 0")])
    assert vb.variable_profile(reg, rows).orderBy("variable").collect() == \
        vb.variable_profile(reg, rows, row_limit=0).orderBy("variable").collect()


def test_a_failing_cast_is_isolated(spark):
    data = spark.createDataFrame([(1, "7", 1.0), (2, "x", 2.0)], "person_id long, k string, v double")
    reg = registry(spark, Table("t", data, "person_id"))
    rows = ct.catalog_frame(spark, [
        dict(variable="bad", table="t", column="v", criteria="cast(k as int) = 7"),
        dict(variable="worse", table="t", column="v", expression="cast(k as int)"),
        dict(variable="good", table="t", column="v", criteria="try_cast(k as int) = 7")])
    found = {r["variable"]: r for r in vb.measured_profile(reg, rows).collect()}
    assert (found["good"]["n_nonnull"], found["good"]["error"]) == (1, "")
    assert all(found[v]["implemented"] == "No" and found[v]["error"] for v in ("bad", "worse"))


def test_time_of_day_is_a_date_kind():
    assert kinds.field_kind(T.StructField("x", T.TimeType())) == "date"


def test_a_column_whose_rows_fail_keeps_the_others(spark):
    data = spark.createDataFrame([(1, "7", 1.0), (2, "x", None)], "person_id long, k string, v double")
    view = data.selectExpr("person_id", "cast(k as int) as number", "v", "k")
    reg = registry(spark, Table("t", view, "person_id"), Table("u", data, "person_id"))
    found = {(r["table"], r["column"]): r for r in pf.measured_profile(reg).collect()}
    assert {k for k, r in found.items() if r["error"]} == {("t", "number")}
    assert "CAST_INVALID_INPUT" in found["t", "number"]["error"]
    assert (found["t", "number"]["row_count"], found["t", "number"]["null_count"]) == (2, None)
    assert found["t", "v"].asDict() == {**found["u", "v"].asDict(), "table": "t", "ordinal": 3}
    assert found["t", "k"]["subject_count"] == 2 and len(found) == 8


def test_a_schema_whose_rows_fail_is_skipped(spark):
    from tallyframe.plans import batch
    data = spark.createDataFrame([("7",), ("x",)], "k string")
    found, skipped = batch.schema_sweep(spark, {
        "good": lambda: registry(spark, Table("t", data)),
        "bad": lambda: registry(spark, Table("t", data.selectExpr("cast(k as int) as k"))),
        "fine": lambda: registry(spark, Table("t", data.selectExpr("k as c")))})
    assert [r["column"] for r in found.select("column").orderBy("column").collect()] == ["c", "k", "person_id", "person_id"]
    assert list(skipped) == ["bad"] and "CAST_INVALID_INPUT" in skipped["bad"]
    assert batch.schema_sweep(spark, {"bad": lambda: registry(spark, Table("t", data.selectExpr("cast(k as int) as k")))})[0] is None
