"""The assembled outputs: what a site, a back-test page and a market page read. Each is a DataFrame; jobs write them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import shared
from ..config import Config
from ..operators import backtest, deltas, markets, scoring, signals, structure, temporal
from ..operators.sanitize import prepared, scorable, with_dates

#: name -> (label, description) of the strategies of a back-test
STRATEGIES = {
    "hc_entry": ("HC Entry", "Buy on day ticker first enters HIGH_CONVICTION"),
    "burst_trigger": ("BURST Trigger", "Buy on day burst_30d first flips True"),
    "top10_score": ("Top-10 Score", "Buy top 10 by Final Alpha Score each Monday"),
    "top10_velocity": ("Top-10 Velocity", "Buy top 10 by Velocity Score each Monday"),
    "baseline": ("Baseline (SPX)", "Buy S&P 500 each Monday (benchmark)"),
}


def period_deltas(history: DataFrame, cfg: Config) -> DataFrame:
    """ticker, period, score_delta_pct for each period of the configuration and YTD, from one replay at the shifted dates."""
    last = history.agg(F.max(F.col("Holdings_As_Of").cast("date"))).scalar()
    periods = [(str(p), F.date_sub(last, int(p))) for p in cfg.delta_periods_days] + [("YTD", F.trunc(last, "year").cast("date"))]
    dates = history.sparkSession.range(1).select(F.explode(F.array_distinct(F.array(last, *[d for _, d in periods]))).alias("snapshot_date"))
    boards = shared.written(scoring.leaderboards(scoring.scored_holdings(scorable(history, cfg), dates, cfg), cfg), "period-boards")
    return signals.score_deltas_by_period(boards, periods, last)


def past_velocity(history: DataFrame, boards: DataFrame, cfg: Config) -> DataFrame:
    motion = deltas.motion_history(history, cfg, boards.select("snapshot_date").distinct())
    return shared.written(signals.velocity_history(boards, motion, temporal.score_streak_history(boards)), "velocity")


def summary(history: DataFrame, boards: DataFrame, cfg: Config, source: str = "") -> DataFrame:
    """One row: rows before and after cleaning, dates, funds, snapshots, flags of the last two snapshots, the configuration's main settings."""
    dated = with_dates(history)
    raw = dated.agg(
        F.count(F.lit(1)).alias("source_rows_raw"), F.max("Holdings_As_Of").alias("latest_holdings_as_of"), F.max("Date_Scraped").alias("latest_scrape_date"),
        F.array_sort(F.collect_set("ETF_Ticker")).alias("etfs"),
    )
    clean = prepared(history, cfg).agg(F.count(F.lit(1))).scalar()
    dates = boards.agg(F.array_sort(F.collect_set("snapshot_date"))).scalar()
    counts = F.struct("tickers", "high_conviction", "speculative_beta", "unflagged", "new_tickers")
    flags = structure.kpi_counts(boards).agg(F.array_sort(F.collect_list(F.struct("snapshot_date", counts.alias("n")))).alias("k"))
    settings = F.struct(
        F.array(*[F.struct(F.lit(f.ticker).alias("ticker"), F.lit(f.tier).alias("tier"), F.lit(f.points).alias("points")) for f in cfg.funds]).alias("etfs"),
        F.array(*[F.array(F.lit(float(a)), F.lit(b)) for a, b in cfg.rank_breakpoints]).alias("rank_breakpoints"), F.lit(cfg.new_lookback_days).alias("new_lookback_days"),
        F.lit(cfg.new_bonus_mult).alias("new_bonus_mult"), F.lit(cfg.high_conviction_min_etfs).alias("high_conviction_min_etfs"),
        F.array(*[F.lit(x) for x in cfg.sanitizer.blocked_tickers]).cast("array<string>").alias("blocked_tickers"),
        F.array(*[F.lit(x) for x in cfg.sanitizer.blocked_name_patterns]).cast("array<string>").alias("blocked_name_patterns"),
    )
    k = flags.select("k").scalar()
    return raw.select(
        F.current_timestamp().alias("generated_at"), F.lit(source).alias("source"), "source_rows_raw", clean.alias("source_rows_after_sanitize"), "latest_holdings_as_of", "latest_scrape_date", "etfs",
        dates.alias("snapshot_dates"), k.alias("k"), settings.alias("config"),
    ).select("*", F.element_at("k", -1)["n"].alias("today"), F.when(F.size("k") > 1, F.element_at("k", 1)["n"]).alias("yesterday")).drop("k")


def site(history: DataFrame, cfg: Config, metadata: DataFrame | None = None, source: str = "") -> dict[str, DataFrame]:
    """The documents of the site by name. The replay and the latest holdings are written once."""
    boards = shared.written(scoring.historical_leaderboards(history, cfg), "boards")
    latest = shared.written(scoring.compute_leaderboard(history, cfg)[1], "latest")
    changes, streaks = deltas.rank_deltas(history, cfg), temporal.streaks_and_deltas(boards)
    last = boards.agg(F.max("snapshot_date")).scalar()
    today = boards.filter(F.col("snapshot_date") == last).drop("snapshot_date")
    then = boards.filter(F.col("snapshot_date") == signals.nearest_snapshot(boards))
    ranks = signals.global_rank_motion(boards).filter(F.col("snapshot_date") == last)
    rows = signals.with_metadata(signals.classified(signals.velocity(today, signals.mean_motion(changes), ranks, streaks, then)), metadata)
    more = [streaks.drop("score_streak", "score_delta_pct"), signals.concentration(latest), signals.quality_change(boards, cfg), signals.period_map(period_deltas(history, cfg))]
    board = shared.written(reduce(lambda a, b: a.join(b, "ticker", "left"), more, rows), "board")
    past = past_velocity(history, boards, cfg)
    flags = boards.join(past.select("snapshot_date", "ticker", F.round("velocity_score", 1).alias("vs"), F.col("burst_30d").alias("burst")), ["snapshot_date", "ticker"], "left")
    entry = F.struct(F.col("snapshot_date").alias("d"), "flag", F.col("leaderboard_rank").alias("rank"), F.coalesce("vs", F.lit(0.0)).alias("vs"), F.coalesce("burst", F.lit(False)).alias("burst"))
    detail = structure.holdings_history(history, cfg, cfg.leaderboard_lookback_days)
    movers = board.filter("etf_count >= 2").orderBy(F.desc("velocity_score"), "ticker").limit(15)
    overlap = structure.fund_overlap(latest).groupBy(F.col("etf_a").alias("etf"), F.col("size_a").alias("size")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("etf_b").alias("etf"), "shared", "jaccard"))).alias("with")
    )
    return {
        "leaderboard": board, "flag_history": flags.groupBy("ticker").agg(F.array_sort(F.collect_list(entry)).alias("history")),
        "holdings_latest": structure.holdings_latest_wide(latest, changes, cfg), "changelog": temporal.changelog(boards, streaks, cfg),
        "top_velocity": movers.select(
            "ticker", "company", "velocity_score", "avg_rank_delta_7d", "global_rank_delta_30d", "global_rank_peak_30d", "etf_count_delta_30d", "burst_30d", "final_score", "etf_count", "tiers"
        ),
        "score_history": structure.score_sparkline(boards), "score_panel": boards.select("ticker", "snapshot_date", "final_score"), "holdings_history": detail,
        "holdings_by_etf": structure.nested_holdings(detail, board), "flow": structure.flow(board), "etf_overlap": overlap, "metadata": summary(history, boards, cfg, source),
    }


def back_test(history: DataFrame, prices: DataFrame, cfg: Config, hold_days: int = 30) -> dict[str, DataFrame]:
    """strategies: a row for each with its trades, cumulative returns and statistics; scatter. With fewer than two snapshots an error."""
    boards = shared.written(scoring.historical_leaderboards(history, cfg), "boards")
    if boards.select("snapshot_date").distinct().limit(2).count() < 2:
        raise ValueError("a back-test needs two snapshots at least")
    past = past_velocity(history, boards, cfg)
    found = [
        backtest.entries(boards, F.col("flag") == "HIGH_CONVICTION", "hc_entry"), backtest.entries(past, F.col("burst_30d"), "burst_trigger"), backtest.top_on_mondays(boards, "top10_score"),
        backtest.top_on_mondays(past, "top10_velocity", by="velocity_score", descending=True), backtest.baseline(boards),
    ]
    trades = shared.written(backtest.trades(reduce(DataFrame.unionByName, found), prices, hold_days), "trades")
    names = history.sparkSession.createDataFrame([(k, *v) for k, v in STRATEGIES.items()], "strategy string, label string, description string")
    gathered = lambda df, name, *columns: df.groupBy("strategy").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))
    parts = [
        gathered(trades, "trades", "date", "ticker", "entry", "exit", "exit_date", "return_pct", "days_held"),
        gathered(backtest.cumulative_returns(trades), "cumulative_returns", "exit_date", "ticker", "total_return"),
        backtest.trade_stats(trades).select("strategy", F.struct("n_trades", "win_rate", "avg_return", "max_drawdown", "sharpe").alias("stats")),
    ]
    rows = reduce(lambda a, b: a.join(b, "strategy", "left"), parts, names).withColumn("hold_days", F.lit(hold_days))
    return {"strategies": rows, "scatter": backtest.velocity_scatter(past, prices, hold_days)}


def market(series: DataFrame, underlyings: list[str]) -> dict[str, DataFrame]:
    """markets: a row for each series (symbol, label, kind, date, close) with statistics and log; sim_underlyings: the points of the given symbols."""
    points = series.select("symbol", "date", "close")
    stats = markets.series_stats(points)
    inner = F.struct(*[c for c in stats.columns if c != "symbol"]).alias("stats")
    log = markets.price_log(points)
    gathered = log.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct(*[c for c in log.columns if c != "symbol"]))).alias("log"))
    names = series.groupBy("symbol").agg(F.min("label").alias("label"), F.min("kind").alias("kind"))
    sim = markets.sim_underlyings(points.filter(F.col("symbol").isin(underlyings)))
    return {
        "markets": names.join(stats.select("symbol", inner), "symbol").join(gathered, "symbol", "left").orderBy("kind", "symbol"),
        "sim_underlyings": sim.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("d", "c"))).alias("points")),
    }
