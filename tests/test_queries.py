"""Every query of the reference's operators against its SQL in DuckDB."""

from __future__ import annotations

import glob
import math
import os

import pytest

from orbitgrain.plans import registry

QUERIES, ORACLES = registry.load()


@pytest.fixture(scope="module")
def duck(sf):
    import duckdb

    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    return round(x, 5) + 0.0 if isinstance(x, float) else x


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    expected = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert rows_of(df.collect(), df.columns) == rows_of(expected.fetchall(), expected.columns)


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLES)


def test_order_of_pieces(spark, sf, duck):
    df = QUERIES["o01_in_order"](spark, sf)
    assert [tuple(r) for r in df.collect()] == duck.sql(f"select {', '.join(df.columns)} from ({ORACLES['o01_in_order']})").fetchall()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1


def test_filters_reach_the_scan(spark, sf):
    plan = QUERIES["p02_time_range"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderdate" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderdate" in plan.replace("\n", "")


def test_set_fingerprint(spark, sf):
    import hashlib
    import json
    from collections import defaultdict

    from orbitgrain.plans.views import view

    groups = defaultdict(list)
    for r in view(spark, sf, "assets_v").collect():
        groups[r.item_id].append((r.asset_key, r.bytes))
    got = {r.product: r.fingerprint for r in QUERIES["a23_set_fingerprint"](spark, sf).collect()}
    for k, v in list(groups.items())[:50]:
        text = json.dumps([{"path": p, "size": s, "etag": "e"} for p, s in sorted(v)], separators=(",", ":"))
        assert got[k] == hashlib.sha256(text.encode()).hexdigest()
