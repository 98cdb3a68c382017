"""Exact quantiles by narrowing, against numpy and the built-in percentile."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyframe.operators import quantiles as qs


@pytest.fixture
def narrow(monkeypatch):
    """Never sort a bracket: every value is found by narrowing alone."""
    monkeypatch.setattr(qs, "SORT_LIMIT", 0)
    monkeypatch.setattr(qs, "BUCKETS", 8)


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)


def expected(values):
    return [float(x) for x in np.quantile(np.array(values, dtype=float), [0.25, 0.5, 0.75])]


CASES = {
    "hot value": [7.0] * 400 + [random.Random(1).uniform(-5, 5) for _ in range(800)],
    "magnitudes": [10.0 ** e * s for e in range(-30, 30) for s in (1, -1, 3)],
    "close together": [1e9 + i * 1e-6 for i in range(500)],
    "one value": [4.25],
    "two values": [1.0, 2.0],
    "zeros": [0.0] * 10 + [-0.0] * 3 + [1e-300, -1e-300],
    "integers": list(range(1001)),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("limit", [0, 50, 20_000])
def test_against_numpy(spark, monkeypatch, name, limit):
    monkeypatch.setattr(qs, "SORT_LIMIT", limit)
    values = CASES[name]
    found = qs.order_statistics(frame(spark, values), {"v": F.col("v")})
    assert found["v"] == pytest.approx(expected(values), rel=1e-12, abs=1e-12)


def test_special_values_like_percentile(spark, narrow):
    values = [float("nan"), float("inf"), float("-inf"), -1e308, 1e308, 0.0, 5e-324, -3.0, 2.0]
    df = frame(spark, values)
    builtin = df.select(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
    assert qs.order_statistics(df, {"v": F.col("v")})["v"] == builtin


def test_many_keys_nulls_and_scopes(spark, narrow):
    rows = [(i % 3, None if i % 5 == 0 else i * 0.5) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, v double")
    found = qs.order_statistics(df, {
        "all": F.col("v"), "one": F.when(F.col("g") == 1, F.col("v")), "none": F.when(F.col("g") > 5, F.col("v")),
        "g": F.col("g")})
    assert set(found) == {"all", "one", "g"}
    assert found["one"] == pytest.approx(expected([v for g, v in rows if g == 1 and v is not None]))
    assert found["g"] == pytest.approx(expected([g for g, _ in rows]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60))
def test_any_list(spark, narrow, values):
    found = qs.order_statistics(frame(spark, values), {"v": F.col("v")})
    assert found["v"] == pytest.approx(expected(values), rel=1e-9, abs=1e-300)


def test_brackets_are_kept_instead_of_rescanned(spark, monkeypatch):
    monkeypatch.setattr(qs, "KEEP_FROM_ROWS", 100)
    monkeypatch.setattr(qs, "SORT_LIMIT", 10)
    rng = random.Random(3)
    values = [rng.lognormvariate(0, 3) for _ in range(20_000)]
    found = qs.order_statistics(frame(spark, values), {"v": F.col("v"), "w": -F.col("v")})
    assert found["v"] == pytest.approx(expected(values), rel=1e-12)
    assert found["w"] == pytest.approx(expected([-v for v in values]), rel=1e-12)


def test_sketch_and_one_pass_suffice(spark, monkeypatch):
    """The table is read twice, whatever the distribution: the narrowing over the whole table is never called for."""
    def rescanned(*_):
        raise AssertionError("the table is scanned again")

    monkeypatch.setattr(qs, "_long_values", rescanned)
    monkeypatch.setattr(qs, "SORT_LIMIT", 64)
    rng = random.Random(11)
    columns = {
        "lognormal": [rng.lognormvariate(0, 3) for _ in range(20_000)],
        "hot": [7.0] * 9_000 + [rng.uniform(0, 14) for _ in range(11_000)],
        "two": [0.0] * 5_000 + [1.0] * 15_000,
        "infinite": [float("inf")] * 6_000 + [float("-inf")] * 6_000 + [rng.gauss(0, 1) for _ in range(8_000)],
        "nan": [float("nan")] * 4_000 + [rng.gauss(0, 1) for _ in range(16_000)],
        "few": [rng.random() if i < 40 else None for i in range(20_000)],
    }
    rows = list(zip(*columns.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)
    found = qs.order_statistics(df, {c: F.col(c) for c in columns})
    for c in columns:
        builtin = df.select(F.percentile(c, F.array(*map(F.lit, qs.QUARTILES)))).first()[0]
        assert found[c] == pytest.approx(builtin, rel=1e-12, nan_ok=True), c


def test_a_wrong_sketch_is_found_out(spark, monkeypatch):
    monkeypatch.setattr(qs, "SORT_LIMIT", 8)
    monkeypatch.setattr(F, "percentile_approx", lambda c, qs_, accuracy: F.array(*[F.lit(3.5) for _ in qs_]))
    values = [float(i) for i in range(1000)]
    assert qs.order_statistics(frame(spark, values), {"v": F.col("v")})["v"] == expected(values)
