"""Display text against Python's own formatting."""

import random

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import text
from tallyframe.functions.labels import double_label


def short(f):
    return str(int(f)) if f == int(f) and abs(f) < 1e15 else f"{f:.3g}"


def test_numbers_like_python(spark):
    rng = random.Random(5)
    values = [0.5, 1958.33, 99.96, 999.6, 123456.7, 0.000123, -3.14159, 140.0, 0.0, 1.005, 12.35, 1.125, 1.135,
              1.235e15, 1.245e15, 1e15, 999.5, 9.995, 1e-5, 9.9995e-5, -0.25, 1.5e300, 2.5e-7]
    values += [round(rng.uniform(-1000, 1000), 3) for _ in range(3000)]
    values += [round(rng.uniform(0, 100), 2) for _ in range(3000)]
    values += [100.0 * a / b for a in range(400) for b in (400, 800, 16, 1000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.selectExpr("v", f"{text.number('v')} as s", f"{text.percent('v')} as p").collect()
    assert [(r.v, r.s) for r in rows if r.s != short(r.v)] == []
    assert [(r.v, r.p) for r in rows if abs(r.v) < 1e13 and r.p != f"{r.v:.1f}%"] == []


def test_missing_and_special(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "v double")
    assert [r[0] for r in df.selectExpr(text.number("v")).collect()] == ["—", "NaN", "Infinity", "-Infinity"]
    assert df.selectExpr(text.percent("v")).first()[0] == "—"


def test_distribution_texts(spark):
    df = spark.createDataFrame(
        [([("Female", 620), ("", 440), ("x" * 61, 1)], 1067)], "top array<struct<value:string,n:long>>, total long")
    column = df.selectExpr(text.value_distribution("top", "total")).first()[0]
    assert column == f"Female: 620 (58.1%); : 440 (41.2%); {'x' * 57}...: 1 (0.1%)"
    variable = df.selectExpr(text.variable_distribution("top", "total")).first()[0]
    assert variable == f"Female: 620 (58.1%); (null): 440 (41.2%); {'x' * 61}: 1 (0.1%)"
    assert df.selectExpr(text.values_cell("top")).first()[0].startswith("Female, , x")
    assert df.selectExpr(text.observed_values(text.top_labels("top"))).first()[0].split("\n")[1] == "(null)"
    assert df.selectExpr(text.distribution_cell("''", "top")).first()[0].startswith("Female: 620; : 440; ")


def test_empty_texts(spark):
    df = spark.createDataFrame([(None, 0, None, None)], "top array<struct<value:string,n:long>>, total long, a double, b string")
    row = df.selectExpr(text.value_distribution("top", "total"), text.numeric_summary("a", "a", "a", "a"),
                        text.median_iqr("a", "a", "a"), text.variable_median("a", "a", "a"),
                        text.date_range("b", "b"), text.values_cell("top")).first()
    assert list(row) == ["", "", "", "", "", ""]


def test_medians_and_ranges(spark):
    df = spark.createDataFrame([(150.0, 170.0, 190.5, None, "2022-01-15", "2026-03-22")],
                               "a double, b double, c double, std double, lo string, hi string")
    row = df.selectExpr(text.median_iqr("a", "b", "c"), text.variable_median("a", "b", "c"),
                        text.date_range("lo", "hi"), text.numeric_summary("a", "c", "b", "std")).first()
    assert list(row) == ["Median: 170 (IQR: 150–190)", "Median: 170 (IQR: 150-190.5)",
                         "Min: 2022-01-15, Max: 2026-03-22", "Min: 150, Max: 190, Mean: 170 (std: —)"]


def test_labels_of_doubles(spark):
    values = [5.0, 0.5, 12345678.91, 1e7, 1.234567891e7, -2.25, 1e15, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    expected = ["5", "0.5", "12345678.91", "10000000", "12345678.91", "-2.25", "1.0E15", "NaN"]
    assert [r[0] for r in df.select(double_label(F.col("v"))).collect()] == expected
    assert [r[0] for r in df.selectExpr(text.double_label("v")).collect()] == expected


def test_clean(spark):
    df = spark.createDataFrame([([" a ", "", "\n", "b\t"], {"k": " v ", "d": "x"})], "l array<string>, m map<string,string>")
    row = df.selectExpr(text.clean_list("l"), text.clean_map("m")).first()
    assert row[0] == ["a", "b"] and row[1] == {"k": "v", "d": "x"}


@pytest.mark.parametrize("pattern, text, hit", [
    (r"(?i)\bfor\s+both\b", "is for both arms", True), (r"(?i)\bfor\s+both\b", "for \x1cboth", True),
    (r"\bTODO\b", "éTODO", False), (r"\bTODO\b", "(TODO)", True),
    (r"a.+b", "a \u0085\rb", True), (r"a.+b", "a\nb", False), (r"^\w+$", "über_1", True),
    (r"[\s,]x", " x", True), (r"\\s", "a\\s", True), (r"\\s", "a\\ ", False)])
def test_patterns_are_unicode(spark, pattern, text, hit):
    from tallyframe.functions import predicates as pr
    from tallyframe.operators import checks as ck
    rows = spark.createDataFrame([(text,)], "t string")
    assert rows.select(F.col("t").rlike(pr.unicode_pattern(pattern))).first()[0] is hit
    assert ck.text_rules(rows, F.lit("k"), ["t"], [(pattern, "label")]).count() == int(hit)
