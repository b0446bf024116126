"""Exact quantiles against numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbitgrain.operators.quantiles import exact_quantiles


def test_exact_quantiles(spark):
    rng = np.random.default_rng(5)
    groups = {"a": rng.normal(size=2000).tolist(), "b": [float(x) for x in rng.integers(0, 4, 501)], "c": [3.5], "d": [1.0, 2.0, None], "e": [None], "f": [7.0] * 100, "g": [0.0] * 999 + [1e12]}
    rows = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], "g string, x double").repartition(5)
    shares = [0.0, 0.02, 0.5, 0.98, 1.0]
    for accuracy in (100, 1000, 10_000):
        got = {r.g: r.q for r in exact_quantiles(rows, ["g"], "x", shares, accuracy).collect()}
        assert set(got) == set(groups) - {"e"}
        for g, q in got.items():
            assert q == pytest.approx(np.quantile([x for x in groups[g] if x is not None], shares).tolist())
    assert exact_quantiles(rows.limit(0), ["g"], "x", shares).count() == 0


def test_names_and_null_keys(spark):
    names = ["k", "v", "n", "lo", "bin", "m", "i", "q2", "at", "rank", "nth", "through", "w", "_v", "a b"]
    for name in names:
        rows = spark.createDataFrame([(None, 4.0), (None, 5.0), ("x", 1.0)], f"`{name}` string, x double")
        assert {r[0]: r.q for r in exact_quantiles(rows, [name], "x", [0.5]).collect()} == {None: [4.5], "x": [1.0]}
    assert exact_quantiles(rows, [], "x", [0.5]).first().q == [4.0]
    two = spark.createDataFrame([(None, 1, 2.0), (None, None, 3.0)], "v string, w int, x double")
    assert {(r.v, r.w): r.q for r in exact_quantiles(two, ["v", "w"], "x", [0.0, 1.0]).collect()} == {(None, 1): [2.0, 2.0], (None, None): [3.0, 3.0]}


def test_an_outlier_leaves_windows_small(spark):
    rows = spark.range(100_000).select(F.lit("g").alias("k"), (F.col("id") * F.col("id") % 100_003 + F.col("id") / 200_000).alias("v")).unionByName(spark.createDataFrame([("g", 1e30)], "k string, v double"))
    shares = [0.02, 0.5, 0.98]
    got = exact_quantiles(rows, ["k"], "v", shares)
    assert got.first().q == pytest.approx(np.quantile(rows.toPandas()["v"], shares).tolist())
    # what a window over a bracket gets
    assert rows.selectExpr("percentile_approx(v, array(0.4995, 0.5005), 10000) as c").selectExpr("c[0] as a", "c[1] as b").crossJoin(rows).filter("v between a and b").count() < 200
