"""Behaviour of cleaning, scoring, history and signals on literal rows."""

import datetime as dt
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from holdlens.config import DEFAULT, Config
from holdlens.operators import asof, backtest, deltas, ingest, markets, sanitize, scoring, signals, structure, temporal
from holdlens.schema import HOLDINGS

D0, D1 = dt.date(2026, 1, 1), dt.date(2026, 5, 1)


def holdings(spark, *rows):
    return spark.createDataFrame([(f, t, n, float(w) if w is not None else None, d, d) for f, t, n, w, d in rows], HOLDINGS)


def board(spark, *rows, **kw):
    return {r["ticker"]: r for r in scoring.compute_leaderboard(holdings(spark, *rows), DEFAULT, **kw)[0].collect()}


def clean(spark, *rows):
    return {r["ticker"]: r for r in sanitize.prepared(holdings(spark, *rows), DEFAULT).collect()}


def test_sanitizer(spark):
    got = clean(
        spark, ("QQQM", "USD", "Dollar", 0.1, D1), ("QQQM", "$usd", "x", 0.1, D1), ("QQQM", "Cash&Other", "Cash & Other", 0.1, D1), ("QQQM", "  ", "blank", 0.1, D1),
        ("QQQM", "CASHX", "Cashmere Corp", 0.1, D1), ("QQQM", "CE", "Cash & Equivalents", 0.1, D1), ("QQQM", "MM", "big money market fund", 0.1, D1),
        ("QQQM", "GOOG", "Alphabet C", 0.04, D1), ("QQQM", "GOOGL", "Alphabet A", 0.05, D1), ("QQQM", "8058 JP", "M", 0.1, D1), ("QQQM", "BRK-B", "B", 0.1, D1), ("NONE", "AAPL", "A", 0.1, D1),
    )
    assert set(got) == {"CASHX", "CE", "GOOGL", "8058.JP", "BRK.B"}
    assert got["GOOGL"]["weight"] == pytest.approx(0.09)


def test_no_renames_no_merge(spark):
    cfg = replace(DEFAULT, sanitizer=replace(DEFAULT.sanitizer, ticker_renames=()))
    rows = holdings(spark, ("QQQM", "8058 JP", "a", 0.1, D1), ("QQQM", "8058.JP", "b", 0.1, D1))
    assert sanitize.prepared(rows, cfg).count() == 2


def test_universe_and_config(tmp_path):
    assert len(DEFAULT.funds) == 21 and DEFAULT.fund_points()["FPXI"] == 60 and DEFAULT.tiers == ["Scout", "Quant", "Quality", "Trend", "Blob"]
    p = tmp_path / "c.yaml"
    p.write_text("etfs:\n  - {ticker: A, tier: Scout, points: 5}\nsanitizer:\n  ticker_renames: {X: Y}\nhistory:\n  delta_periods_days: [1, 7]\n")
    cfg = Config.from_yaml(str(p))
    assert cfg.funds[0].points == 5 and cfg.delta_periods_days == (1, 7) and cfg.leaderboard_lookback_days == 60 and cfg.sanitizer.ticker_renames == (("X", "Y"),)


def test_rank_multiplier(spark):
    got = spark.createDataFrame([(r,) for r in (1, 10, 11, 30, 31, 500, 5000)], "r int").select(scoring.rank_multiplier(F.col("r"), DEFAULT).alias("m"))
    assert [r["m"] for r in got.collect()] == [1.5, 1.5, 1.2, 1.2, 1.0, 1.0, 1.0]


def test_scores(spark):
    old = [("QQQM", "NVDA", "Nvidia", 0.09, D0)]
    assert board(spark, *old, ("QQQM", "NVDA", "Nvidia", 0.09, D1))["NVDA"]["final_score"] == 27
    gev = [(f, "GEV", "GE V", w, d) for f, w in (("FPX", 0.12), ("QMOM", 0.04), ("SPHQ", 0.05), ("SPMO", 0.03)) for d in (D0, D1)]
    row = board(spark, *gev)["GEV"]
    assert row["final_score"] == 1230 and row["flag"] == "HIGH_CONVICTION" and row["held_by"] == "FPX, QMOM, SPHQ, SPMO" and row["leaderboard_rank"] == 1


def test_new_bonus_and_flags(spark):
    rows = [("FPX", "OLD", "o", 0.5, D0), ("FPX", "OLD", "o", 0.5, D1), ("FPX", "X3", "x", 0.1, D1), ("COWZ", "OLD", "o", 0.5, D0), ("COWZ", "X2", "y", 0.1, D1)]
    latest = {(r["ETF_Ticker"], r["ticker"]): r for r in scoring.compute_leaderboard(holdings(spark, *rows), DEFAULT)[1].collect()}
    assert latest["FPX", "X3"]["is_new"] and latest["FPX", "X3"]["new_bonus"] == 200
    assert latest["COWZ", "X2"]["is_new"] and latest["COWZ", "X2"]["new_bonus"] == 0
    flags = board(spark, ("SPHB", "A", "a", 0.1, D1), ("COWZ", "A", "a", 0.1, D1), ("SPHB", "B", "b", 0.1, D1))
    assert flags["A"]["flag"] == "" and flags["B"]["flag"] == "SPECULATIVE_BETA"


def test_time_travel_and_stale_funds(spark):
    rows = [("FPX", "A", "a", 0.1, D0), ("COWZ", "B", "b", 0.1, D1)]
    assert set(board(spark, *rows, as_of=dt.date(2026, 2, 1))) == {"A"}
    assert set(board(spark, *rows)) == {"A", "B"}


def test_missing_columns_and_empty(spark):
    with pytest.raises(ValueError, match="missing required columns"):
        scoring.compute_leaderboard(spark.createDataFrame([("a",)], "ticker string"), DEFAULT)
    empty = scoring.compute_leaderboard(holdings(spark), DEFAULT)[0]
    assert empty.count() == 0 and "leaderboard_rank" in empty.columns
    assert board(spark, ("ZZZ", "A", "a", 0.1, D1), ("FPX", "B", None, 0.1, D1))["B"]["company"] is None


@pytest.fixture(scope="module")
def month(spark):
    days = [dt.date(2026, 4, 16) + dt.timedelta(days=i) for i in range(30)]
    rows = [(f, "GEV", "GE V", 0.1 + i / 1000, d) for i, d in enumerate(days) for f in ("FPX", "QMOM", "SPMO", "SPHQ")]
    rows += [("QQQM", "AAPL", "Apple", 0.08, d) for d in days[:20] + days[25:]]
    return holdings(spark, *rows).persist()


def test_panel_equals_single_dates(spark, month):
    panel = scoring.historical_leaderboards(month, DEFAULT)
    for day in (dt.date(2026, 4, 20), dt.date(2026, 5, 15)):
        one = scoring.compute_leaderboard(month, DEFAULT, as_of=day)[0]
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, panel.filter(F.col("snapshot_date") == day).drop("snapshot_date").collect()))
    assert panel.select("snapshot_date").distinct().count() == 30


def test_streaks_and_changelog(spark, month):
    panel = scoring.historical_leaderboards(month, DEFAULT).persist()
    streaks = temporal.streaks_and_deltas(panel).persist()
    got = {r["ticker"]: r for r in streaks.collect()}
    assert got["GEV"]["hc_streak"] == 30 and got["GEV"]["score_streak"] > 10 and got["AAPL"]["score_streak"] == 0
    log = temporal.changelog(panel, streaks, DEFAULT)
    assert log.columns == list(temporal.LOG)
    assert {r["change"] for r in log.collect()} <= {"entered_hc", "exited_hc", "biggest_gainers", "biggest_losers", "new_entrants"}


def test_trailing_run(spark):
    cases = [([1, 2, 3], 3), ([1, -1, -2], -2), ([1, 0], 0), ([], 0), ([0, 5], 1), ([-1], -1)]
    rows = spark.createDataFrame([(v, n) for v, n in cases], "v array<int>, n int").select(temporal.trailing_run(F.col("v")).alias("got"), "n")
    assert all(r["got"] == r["n"] for r in rows.collect())


def test_weight_flow(spark):
    days = [dt.date(2026, 4, 1) + dt.timedelta(days=i) for i in range(14)]
    rows = [("FPX", "X", "x", 0.001 + i * 0.0153, d) for i, d in enumerate(days)] + [("FPX", f"S{k}", "s", 0.02 + k / 200, d) for d in days for k in range(9)]
    got = {r["ticker"]: r for r in deltas.primary_period(deltas.rank_deltas(holdings(spark, *rows), DEFAULT), DEFAULT).collect()}
    assert got["X"]["weight_flow"] > 0 and got["S1"]["weight_flow"] == 0


def burst_of(spark, weight):
    days = [dt.date(2026, 3, 1) + dt.timedelta(days=i) for i in range(35)]
    rows = [("FPX", "X", "x", w, d) for i, d in enumerate(days) if (w := weight(i)) is not None] + [("FPX", f"S{k:02}", "s", 0.01, d) for d in days for k in range(80)]
    motion = signals.global_rank_motion(scoring.historical_leaderboards(holdings(spark, *rows), DEFAULT))
    return motion.filter((F.col("ticker") == "X") & (F.col("snapshot_date") == days[-1])).first()


def test_burst(spark):
    row = burst_of(spark, lambda i: 0.001 if i < 20 else 0.15)
    assert row["global_rank_peak_30d"] >= 40 and row["burst_30d"]


def test_burst_needs_coverage(spark):
    assert not burst_of(spark, lambda i: None if 5 < i < 21 else 0.15)["burst_30d"]


def test_burst_needs_duration(spark):
    assert not burst_of(spark, lambda i: 0.15 if i == 15 else 0.001)["burst_30d"]


def test_overlap_and_concentration(spark):
    latest = scoring.compute_leaderboard(holdings(spark, ("FPX", "A", "a", 0.1, D1), ("FPX", "B", "b", 0.1, D1), ("COWZ", "B", "b", 0.1, D1), ("XLG", "C", "c", 0.1, D1)), DEFAULT)[1]
    got = {(r["etf_a"], r["etf_b"]): r["jaccard"] for r in structure.fund_overlap(latest).collect()}
    assert got["FPX", "FPX"] == 1 and got["FPX", "COWZ"] == got["COWZ", "FPX"] == 0.5 and got["FPX", "XLG"] == 0
    assert all(0 <= r["top_etf_share"] <= 1 for r in signals.concentration(latest).collect())


@pytest.mark.parametrize(("direction", "want"), [("backward", [None, 1.0, 1.0, 3.0]), ("forward", [1.0, 1.0, 3.0, None]), ("nearest", [1.0, 1.0, 1.0, 3.0])])
def test_asof(spark, direction, want):
    day = lambda n: dt.date(2026, 1, n)
    left = spark.createDataFrame([("k", day(1), 0), ("k", day(2), 1), ("k", day(3), 2), ("k", day(9), 3), ("z", day(1), 4)], "k string, d date, i int")
    right = spark.createDataFrame([("k", day(2), 1.0), ("k", day(3), None), ("k", day(5), 3.0)], "k string, d date, v double")
    got = {r["i"]: r["v"] for r in asof.asof_join(left, right, by="k", on="d", value="v", direction=direction).collect()}
    assert [got[i] for i in range(4)] == want and got[4] is None


def test_trade_stats(spark):
    day = lambda n: dt.date(2026, 1, n)
    r = [(day(i + 1), v) for i, v in enumerate((-0.5, 0.2, -0.1, None))]
    trades = spark.createDataFrame([("s", d, "T", d, v) for d, v in r], "strategy string, date date, ticker string, exit_date date, return_pct double")
    got = backtest.trade_stats(trades).first()
    assert got["n_trades"] == 3 and got["win_rate"] == pytest.approx(0.3333) and got["max_drawdown"] == pytest.approx(-0.1)
    assert [x["total_return"] for x in backtest.cumulative_returns(trades).orderBy("exit_date").collect()] == [-0.5, -0.4, -0.46]


def test_series_stats(spark):
    close = [1.0, 2.0, 2.0, 3.0, None, 4.0]
    px = spark.createDataFrame([("S", dt.date(2026, 1, i + 1), c) for i, c in enumerate(close)], "symbol string, date date, close double")
    got = markets.series_stats(px).first()
    assert (got["close_today"], got["close_yesterday"], got["current_streak"], got["sessions_observed"], got["all_time_percentile"]) == (4, 3, 2, 5, 1)
    assert markets.price_log(px, 2).count() == 2


def test_keep_last(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)], "k string, seq int, v string")
    assert {r["k"]: r["v"] for r in ingest.keep_last(rows, ["k"], "seq").collect()} == {"a": "z", "b": None}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the test tables")
@pytest.mark.parametrize("name", ["leaderboard", "panel_scores", "score_streaks", "global_rank_panel_stats", "velocity", "hc_entry_trades", "series_stats", "fund_overlap", "rank_deltas_multi"])
def test_against_sql(spark, name):
    import duckdb

    from holdlens.plans import oracles, queries

    con, folder = duckdb.connect(), "/root/testdata/sf0.001"
    for t in ("events", "lineitem", "customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = queries.QUERIES[name](spark, folder)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({oracles.ORACLES[name]})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(repr, want))
