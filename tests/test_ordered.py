"""Distributed ranks, quantiles and adjustments against NumPy, with heavy ties and a hot group."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.operators import ordered


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", int(v), f"b{i:05d}") for i, v in enumerate(rng.geometric(0.2, 3000))]
    rows += [("cold", int(v), f"c{i:05d}") for i, v in enumerate(rng.integers(-50, 5000, 200))]
    return spark.createDataFrame(rows, "g string, v long, id string").cache()


def test_mid_ranks_sum_and_match_window(data):
    out = ordered.mid_rank(data, "g", "v").join(ordered.mid_rank(data, "g", "v", "w", bounded=True).select("id", "w"), "id")
    assert out.where("rank <> w").count() == 0
    for g, n, s in out.groupBy("g").agg(F.count("*"), F.sum("rank")).collect():
        assert s == n * (n + 1) / 2


def test_positions_match_window(data):
    out = ordered.positions(data, "g", "v", "id").join(ordered.positions(data, "g", "v", "id", "w", bounded=True).select("id", "w"), "id")
    assert out.count() == 3200 and out.where("position <> w").count() == 0


def test_quantiles(data):
    got = {r["g"]: (r["a"], r["b"], r["c"]) for r in ordered.quantiles(data, "g", "v", {"a": 0.025, "b": 0.5, "c": 0.9}).collect()}
    pdf = data.toPandas()
    for g, part in pdf.groupby("g"):
        assert np.allclose(got[g], np.quantile(part["v"], [0.025, 0.5, 0.9]))


def test_mad(data):
    r = {x["g"]: (x["centre"], x["mad"]) for x in ordered.mad_by(data, "g", "v").collect()}
    for g, part in data.toPandas().groupby("g"):
        m = part["v"].median()
        assert r[g] == pytest.approx((m, 1.4826 * (part["v"] - m).abs().median()))


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(1e-6, 1.0), min_size=1, max_size=40))
def test_bh_is_monotone_and_agrees(spark, ps):
    df = spark.createDataFrame([("x", float(p)) for p in ps], "g string, p double")
    a = sorted((r["p"], r["fdr"]) for r in ordered.bh_adjust(df, "g", "p").collect())
    b = sorted((r["p"], r["fdr"]) for r in ordered.bh_adjust(df, "g", "p", bounded=True).collect())
    assert np.allclose(a, b)
    f = [x[1] for x in a]
    assert all(y >= x - 1e-12 for x, y in zip(f, f[1:])) and all(q >= p - 1e-12 for p, q in a)
