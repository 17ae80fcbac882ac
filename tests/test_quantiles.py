"""Distributed exact order statistics against numpy."""

import numpy as np
import pytest

from churnlens.operators import quantiles as Q


def test_matches_numpy_with_refinement(spark):
    rng = np.random.default_rng(7)
    a = rng.normal(size=3000)
    b = np.round(rng.exponential(size=3000), 1)     # many ties
    rows = [(float(x), float(y) if i % 5 else None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double")
    long = Q._long_form(df, ["a", "b"])
    res = Q.kth_values(long, {"a": [0, 1499, 2999], "b": [0, 1000, 2399]}, accuracy=40)
    sa, sb = np.sort(a), np.sort(np.array([y for _, y in rows if y is not None]))
    assert res["a"] == {0: sa[0], 1499: sa[1499], 2999: sa[2999]}
    assert res["b"] == {0: sb[0], 1000: sb[1000], 2399: sb[2399]}


def test_interpolated_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,), (float("nan"),)], "x double")
    q = Q.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75])["x"]
    assert q == pytest.approx(list(np.quantile([1, 2, 3, 10], [0.25, 0.5, 0.75])))


def test_constant_and_empty(spark):
    df = spark.createDataFrame([(5.0, None)] * 100, "x double, y double")
    assert Q.exact_medians(df, ["x", "y"]) == {"x": 5.0, "y": None}


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.integers(-50, 50).map(float), st.floats(-1e6, 1e6, allow_nan=False)),
                min_size=1, max_size=400),
       st.lists(st.floats(0.0, 1.0), min_size=1, max_size=4))
def test_quantiles_property(spark, values, probs):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    long = Q._long_form(df, ["x"])
    n = len(values)
    ks = sorted({min(n - 1, int(p * (n - 1))) for p in probs})
    got = Q.kth_values(long, {"x": ks}, accuracy=5)["x"]
    s = np.sort(np.array(values))
    assert got == {k: s[k] for k in ks}
