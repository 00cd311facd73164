"""Local regression over all points: against direct fits at every point, hot groups, few points, ties."""

import numpy as np
import pytest

from tallyloom.operators import hvg


def direct(x, y, places, span=0.3):
    """Weighted quadratic fit at every place by itself."""
    q, out = min(len(x), max(3, int(span * len(x) + 1e-5))), []
    for at in places:
        d = np.abs(x - at)
        h = np.sort(d)[q - 1] * 1.0000001
        w = np.sqrt(np.clip(1 - (d / h) ** 3, 0, None) ** 3)
        out.append(np.linalg.lstsq(np.vander(x - at, 3, increasing=True) * w[:, None], y * w, rcond=1e-12)[0][0])
    return np.array(out)


def table(spark, groups):
    rows = [(b, i, 100, float(10.0**x), float(10.0**y)) for b, (xs, ys) in groups.items() for i, (x, y) in enumerate(zip(xs, ys))]
    return spark.createDataFrame(rows, "batch string, gene_id long, n_cells long, mean double, variance double")


def test_close_to_direct_fits(spark):
    rng = np.random.default_rng(3)
    groups = {}
    for b, n in (("hot", 4000), ("small", 300)):
        x = np.sort(rng.gamma(2.0, 1.0, n)) - 3
        groups[b] = (x, x + 0.4 * np.log1p(np.exp(2 * x)) + rng.normal(0, 0.1, n))
    got = hvg.variance_trend(table(spark, groups)).toPandas()
    for b, (x, y) in groups.items():
        est = got[got["batch"] == b].sort_values("gene_id")["estimated_variance"].to_numpy()
        off = np.abs(est - direct(x, y, x))
        # inside, the blended cubics stay within a tenth of the noise; the ends, with few points, within the noise
        inner = slice(len(x) // 20, -len(x) // 20)
        assert off[inner].max() < 0.01 and off.max() < 0.1, (b, off[inner].max(), off.max())


def test_group_of_any_size_has_few_borders(spark):
    n = 20_000
    points = spark.range(n).selectExpr("'all' batch", "id / 1000.0D _x", "sin(id / 3000.0D) _y")
    r = hvg.local_regression(points).collect()
    assert len(r) == 1 and 20 < len(r[0]["_curve"]) < 80
    x = np.arange(n) / 1000.0
    want = direct(x, np.sin(x / 3), [c["_at"] for c in r[0]["_curve"]])
    assert np.allclose([c["_val"] for c in r[0]["_curve"]], want, atol=1e-6)


@pytest.mark.parametrize("x, y, want", [
    ([1.0], [2.0], [2.0]),
    ([1.0, 2.0], [3.0, 5.0], [3.0, 5.0]),
    ([0.0] * 5, [1.0, 2.0, 3.0, 4.0, 5.0], [3.0] * 5),  # one place
    ([1.0] * 3, [2.0] * 3, [2.0] * 3),  # repeated points
])
def test_few_points_and_ties(spark, x, y, want):
    got = hvg.variance_trend(table(spark, {"b": (x, y)})).toPandas().sort_values("gene_id")["estimated_variance"]
    assert np.allclose(got, want, atol=0.3 if len(set(x)) == 2 else 1e-6), list(got)


def test_empty_and_constant(spark):
    t = table(spark, {"b": ([1.0], [1.0])})
    assert hvg.variance_trend(t.limit(0)).count() == 0
    r = hvg.variance_trend(t.selectExpr("batch", "gene_id", "n_cells", "mean", "0.0D variance")).collect()
    assert [x["estimated_variance"] for x in r] == [0.0]


def test_places_are_looked_for_once_a_row_and_groups_are_not_gathered(spark):
    rng = np.random.default_rng(5)
    x = np.sort(rng.normal(0, 1, 500))
    plan = hvg.variance_trend(table(spark, {"a": (x, x + rng.normal(0, 0.1, 500))}))._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("filter(") == 1  # it stood in the plan once for each use of a place
    assert "Exchange hashpartitioning" not in plan.executedPlan().toString()  # all points of a group went to one task
