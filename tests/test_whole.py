"""The operators at their own sizes, against the registered SQL."""

import os

import duckdb
import pytest

from holdlens.operators import signals
from holdlens.plans.oracles import ORACLES
from holdlens.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


def compare(spark, name):
    """The rows of a query, compared with its SQL."""
    db = duckdb.connect()
    for t in ("events", "lineitem", "customer", "nation"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    cursor = db.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    got = QUERIES[name](spark, FOLDER)
    assert got.columns == names
    key = lambda r: [(x is None, str(x)) for x in r if not isinstance(x, float)] + [(x is None, x or 0) for x in r if isinstance(x, float)]
    rows = sorted(map(tuple, got.collect()), key=key)
    want = sorted(cursor.fetchall(), key=key)
    assert len(rows) == len(want)
    for a, b in zip(rows, want, strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == (pytest.approx(y, rel=1e-6, abs=2e-6) if isinstance(x, float) else y)
    return rows


def test_own_sizes(spark):
    assert len({r[2] for r in compare(spark, "holdings_history_rank")}) == 30
    assert len({r[0] for r in compare(spark, "score_sparkline")}) > 50
    assert len(compare(spark, "sim_underlyings")) > 6 * 2400
    assert len({r[0] for r in compare(spark, "nested_holdings")}) > 20


def test_simulator_windows(spark):
    assert len(compare(spark, "nav_simulation")) == 6 * 251
    assert len(compare(spark, "synthetic_simulation")) == 252
    rows = compare(spark, "leverage_grid")
    assert len(rows) == 6 * 21 and {r[1] for r in rows} >= {-5.0, 5.0} and {r[-1] for r in rows} == {251}


def test_all_strategies(spark):
    five = {"hc_entry", "burst_trigger", "top10_score", "top10_velocity", "baseline"}
    some = {r[0] for r in compare(spark, "trade_stats")}
    for name in ("cumulative_returns", "return_at_date"):
        got = {r[0] for r in compare(spark, name)}
        assert got == some <= five and len(got) > 2


def test_whole_inputs(spark):
    rows = compare(spark, "backup_arbitration")
    assert {(r[0], r[3]) for r in rows} == {("view", "primary"), ("error", "primary"), ("click", "backup"), ("signup", "backup"), ("purchase", "backup")}
    assert "P" in {r[1] for r in compare(spark, "holdings_dedupe")}
    for name in ("sector_flow", "country_flow"):
        assert "Unknown" not in {r[0] for r in compare(spark, name)}


def test_unknown_metadata(spark):
    rows = spark.createDataFrame([("A",), ("B",)], "ticker string")
    known = spark.createDataFrame([("A", "Tech", "Chips", "US", 1.0)], "ticker string, sector string, industry string, country string, market_cap_usd double")
    got = {r["ticker"]: (r["sector"], r["country"]) for r in signals.with_metadata(rows, known).collect()}
    assert got == {"A": ("Tech", "US"), "B": ("Unknown", "Unknown")}
