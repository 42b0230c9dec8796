"""The registered queries of the engine, on the canonical inputs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning
from .. import shared
from ..operators import backtest, deltas, explore, ingest, markets, sanitize, scoring, signals, simulator, structure, temporal
from ..sources import readers, sinks
from . import documents
from . import fixtures as fx

CFG = fx.CFG_F1
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


# hazard rows: (fund, ticker, name, weight, as of, scraped)
HAZARDS = """
    ('COWZ', '000660', 'Hynix', 0.05, DATE '2026-05-01', DATE '2026-05-02'), ('COWZ', 'TPRO IM', 'Tech', 0.04, DATE '2026-05-01', DATE '2026-05-02'),
    ('COWZ', 'TPE: 2345', 'Topco, Ltd.', 0.03, DATE '2026-05-01', DATE '2026-05-02'), ('COWZ', '8058 JP', 'Mitsubishi', 0.02, DATE '2026-05-01', DATE '2026-05-02'),
    ('COWZ', '8058.JP', 'Mitsubishi Corp', 0.01, DATE '2026-05-01', DATE '2026-05-03'), ('QQQM', 'GOOG', NULL, 0.04, DATE '2026-05-01', DATE '2026-05-02'),
    ('QQQM', 'GOOGL', 'Alphabet', 0.05, DATE '2026-05-01', DATE '2026-05-04'), ('QQQM', '$USD', 'Dollar', 0.02, DATE '2026-05-01', DATE '2026-05-02'),
    ('QQQM', 'cash&other', 'Other', 0.02, DATE '2026-05-01', DATE '2026-05-02'), ('QQQM', ' ', 'Blank', 0.02, DATE '2026-05-01', DATE '2026-05-02'),
    ('QQQM', 'NaN', 'Not', 0.02, DATE '2026-05-01', DATE '2026-05-02'), ('QQQM', 'MMF', 'Some Money Market Fund', 0.02, DATE '2026-05-01', DATE '2026-05-02'),
    ('QQQM', 'X1', ' cash ', 0.02, DATE '2026-05-01', DATE '2026-05-02'), ('QQQM', 'TWD', 'CASH & EQUIVALENTS', 0.02, DATE '2026-05-01', DATE '2026-05-02'),
    ('QQQM', 'BRK/B', 'Berkshire', 0.06, DATE '2026-05-01', DATE '2026-05-02'), ('QQQM', 'BRK-B', 'Berkshire B', 0.01, DATE '2026-05-01', DATE '2026-05-02'),
    ('QQQM', '.A--B.', 'Dots', 0.0, DATE '2026-05-01', DATE '2026-05-02'), ('NOPE', 'AAPL', 'Apple', 0.5, DATE '2026-05-01', DATE '2026-05-02'),
    ('QQQM', 'NUL', 'No weight', NULL, DATE '2026-05-01', DATE '2026-05-02'), ('QQQM', 'NOD', 'No date', 0.1, NULL, DATE '2026-05-02')"""
WEIGHTS = "('A', 'x1', '4.5%'), ('A', 'x2', '1,234'), ('A', 'x3', 'n/a'), ('A', 'x4', NULL), ('B', 'y1', '0.05'), ('B', 'y2', '0.95%'), ('C', 'z1', '12.5'), ('C', 'z2', '0.5')"
#: Scraped tables: headers, rows.
HEADED = (
    ("Identifier, `Security Name`, `% TNA`", "('a1', 'Alpha', '60%'), ('a2', 'Beta', '1,000'), (NULL, 'None', 'x')"),
    ("`Security Type`, `Security Name`, Ticker, `Change %`, Weight", "('Stock', 'Gamma', 'b1', '3', '0.4'), ('Stock', 'Delta', 'b2', '4', '0.6')"),
    ("` SYMBOL `, Company", "('c1', 'Eps'), ('c2', NULL)"),
    ("Name, Weight", "('no ticker', '1')"),
)
LABELS = "('03-04-2026'), ('As of: 03/04/2026'), ('Date March 4, 2026'), ('as of 3/4/2026 close'), ('Dec 31, 2025'), ('none'), (NULL), ('as of 13/45/2026')"


#: The steps of the leverage slider.
LEVERAGES = [x / 2 for x in range(-10, 11)]


def _relative(column: str, digits: int = 9) -> Column:
    """A number rounded to so many significant digits: paths of high leverage differ by many powers of ten."""
    return F.format_string(f"%.{digits - 1}e", F.col(column).cast("double")).cast("double").alias(column)


def _hazards(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {HAZARDS} AS t(ETF_Ticker, ticker, name, weight, Holdings_As_Of, Date_Scraped)").withColumn("weight", F.col("weight").cast("double"))


def _boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replay, written once: what follows asks it for dates and rows again and again."""
    return shared.written(scoring.historical_leaderboards(fx.holdings_f1(spark, sf_dir), CFG), "boards")


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.compute_leaderboard(fx.holdings_f1(spark, sf_dir), CFG)[1]


def _deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deltas.rank_deltas(fx.holdings_f1(spark, sf_dir), CFG)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    boards = _boards(spark, sf_dir)
    last = boards.agg(F.max("snapshot_date")).scalar()
    today = boards.filter(F.col("snapshot_date") == last).drop("snapshot_date")
    then = boards.filter(F.col("snapshot_date") == signals.nearest_snapshot(boards))
    ranks = signals.global_rank_motion(boards).filter(F.col("snapshot_date") == last)
    rows = signals.velocity(today, signals.mean_motion(_deltas(spark, sf_dir)), ranks, temporal.streaks_and_deltas(boards), then)
    return signals.with_metadata(signals.classified(rows), fx.metadata_f6(spark, sf_dir))


def _history_velocity(spark: SparkSession, sf_dir: str, boards: DataFrame) -> DataFrame:
    """Velocity and burst at every snapshot, written once, for back-tests over the past."""
    history = fx.holdings_f1(spark, sf_dir)
    motion = deltas.motion_history(history, CFG, boards.select("snapshot_date").distinct())
    return shared.written(signals.velocity_history(boards, motion, temporal.score_streak_history(boards)), "velocity")


@query
def sanitize_holdings(spark, sf_dir):
    return sanitize.prepared(_hazards(spark), fx.DEFAULT).select("ETF_Ticker", "ticker", "name", F.round("weight", 6).alias("weight"), "Holdings_As_Of", "Date_Scraped")


@query
def holdings_dedupe(spark, sf_dir):
    merged = sanitize.merged(fx.holdings_f2(spark, sf_dir).withColumn("ticker", F.regexp_replace("ticker", r"\d$", "")), F.col("name"))
    return merged.select("ETF_Ticker", "ticker", "name", F.round("weight", 9).alias("weight"), "Holdings_As_Of")


@query
def parse_weights(spark, sf_dir):
    raw = spark.sql(f"SELECT * FROM VALUES {WEIGHTS} AS t(fund, Symbol, `% of Net Assets`)")
    out = ingest.standardised(raw, F.col("fund"), F.lit("2026-05-01").cast("date"), F.lit("2026-05-02").cast("date"))
    return out.select("ETF_Ticker", "ticker", F.round("weight", 9).alias("weight"))


@query
def parse_as_of_dates(spark, sf_dir):
    return spark.sql(f"SELECT * FROM VALUES {LABELS} AS t(label)").select("label", cleaning.as_of_date(F.col("label")).alias("as_of"))


@query
def backup_arbitration(spark, sf_dir):
    """All funds and days against a backup that is a day older for one fund, as old for another and a day newer for the others."""
    h = fx.holdings_f1(spark, sf_dir)
    backup = h.withColumn("Holdings_As_Of", F.date_add("Holdings_As_Of", F.when(F.col("ETF_Ticker") == "view", -1).when(F.col("ETF_Ticker") == "error", 0).otherwise(1)))
    return ingest.arbitrated(h, backup).select("ETF_Ticker", "ticker", "Holdings_As_Of", "origin")


@query
def keep_last_upsert(spark, sf_dir):
    return ingest.keep_last(fx.loads_f7(spark, sf_dir), ["event_type", "user_id", "day"], "load_seq")


@query
def new_data_check(spark, sf_dir):
    loads = fx.loads_f7(spark, sf_dir)
    return ingest.new_only(loads.filter("day >= DATE '2024-01-20'"), loads.filter("day < DATE '2024-01-25'"), ["event_type", "day"]).select("event_type", "day", "user_id", "load_seq")


@query
def latest_snapshot(spark, sf_dir):
    return _latest(spark, sf_dir).select("ETF_Ticker", "ticker", "Holdings_As_Of", F.round("weight", 9).alias("weight"))


@query
def rank_in_fund(spark, sf_dir):
    return _latest(spark, sf_dir).select("ETF_Ticker", "ticker", "rank", "rank_mult")


@query
def new_entrants_flag(spark, sf_dir):
    return _latest(spark, sf_dir).select("ETF_Ticker", "ticker", "is_new", "new_bonus")


@query
def scored_holdings(spark, sf_dir):
    return _latest(spark, sf_dir).select("ETF_Ticker", "ticker", "tier", "tier_points", F.round("weight_pct", 6).alias("weight_pct"), F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"))


@query
def leaderboard(spark, sf_dir):
    return scoring.compute_leaderboard(fx.holdings_f1(spark, sf_dir), CFG)[0]


@query
def leaderboard_volume(spark, sf_dir):
    return scoring.compute_leaderboard(fx.holdings_f2(spark, sf_dir), fx.CFG_F2)[0]


@query
def leaderboard_as_of(spark, sf_dir):
    import datetime

    return scoring.compute_leaderboard(fx.holdings_f1(spark, sf_dir), CFG, as_of=datetime.date(2024, 1, 15))[0]


@query
def conviction_flags(spark, sf_dir):
    return leaderboard(spark, sf_dir).groupBy("flag").agg(F.count(F.lit(1)).alias("n"), F.max("etf_count").alias("most_funds"))


@query
def panel_scores(spark, sf_dir):
    return _boards(spark, sf_dir).select("snapshot_date", "ticker", "final_score", "etf_count", "flag", "leaderboard_rank")


@query
def panel_scores_volume(spark, sf_dir):
    boards = scoring.historical_leaderboards(fx.holdings_f2(spark, sf_dir), fx.CFG_F2)
    return boards.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("tickers"), F.sum("final_score").alias("total_score"), F.count_if(F.col("flag") == "HIGH_CONVICTION").alias("high_conviction"))


@query
def score_panel_wide(spark, sf_dir):
    import datetime

    days = [datetime.date(2024, 1, d) for d in (1, 15, 30)]
    wide = temporal.score_panel(_boards(spark, sf_dir), days)
    return wide.select("ticker", *[F.col(f"`{d}`").alias(f"d{d:%Y%m%d}") for d in days])


@query
def flag_panel(spark, sf_dir):
    return temporal.flag_panel(_boards(spark, sf_dir))


@query
def flag_history_nested(spark, sf_dir):
    return structure.flag_history(_boards(spark, sf_dir)).select("ticker", F.explode("history").alias("h")).select("ticker", "h.d", "h.flag", "h.rank")


@query
def rank_deltas_multi(spark, sf_dir):
    return _deltas(spark, sf_dir).select("ETF_Ticker", "ticker", "period_days", "rank_now", "rank_then", "rank_delta")


@query
def weight_flow(spark, sf_dir):
    return deltas.primary_period(_deltas(spark, sf_dir), CFG).select("ETF_Ticker", "ticker", F.round("weight_now", 9).alias("weight_now"), F.round("weight_then", 9).alias("weight_then"), F.round("weight_flow", 6).alias("weight_flow"))


@query
def score_streaks(spark, sf_dir):
    return temporal.streaks_and_deltas(_boards(spark, sf_dir)).select("ticker", "score_today", "score_yesterday", "score_delta", "score_delta_pct", "score_streak", "days_observed")


@query
def hc_streaks(spark, sf_dir):
    return temporal.streaks_and_deltas(_boards(spark, sf_dir)).select("ticker", "hc_streak")


@query
def score_percentile(spark, sf_dir):
    return temporal.streaks_and_deltas(_boards(spark, sf_dir)).select("ticker", "score_percentile")


@query
def state_durations(spark, sf_dir):
    return temporal.state_durations(_boards(spark, sf_dir))


def _log(spark, sf_dir, kinds):
    boards = _boards(spark, sf_dir)
    return temporal.changelog(boards, temporal.streaks_and_deltas(boards), CFG).filter(F.col("change").isin(kinds)).select("change", "position", "ticker", "final_score", "etf_count", "score_delta")


@query
def changelog_hc(spark, sf_dir):
    return _log(spark, sf_dir, ["entered_hc", "exited_hc"])


@query
def changelog_movers(spark, sf_dir):
    return _log(spark, sf_dir, ["biggest_gainers", "biggest_losers"])


@query
def new_tickers_week(spark, sf_dir):
    return _log(spark, sf_dir, ["new_entrants"])


@query
def concentration(spark, sf_dir):
    return signals.concentration(_latest(spark, sf_dir))


@query
def score_decomposition(spark, sf_dir):
    return signals.score_decomposition(_latest(spark, sf_dir))


@query
def tier_breadth(spark, sf_dir):
    rows = leaderboard(spark, sf_dir)
    return rows.select("ticker", F.size(F.split("tiers", r" \+ ")).alias("tier_breadth"))


@query
def score_delta_periods(spark, sf_dir):
    history = fx.holdings_f1(spark, sf_dir)
    last = history.agg(F.max("Holdings_As_Of")).scalar()
    periods = [(str(p), F.date_sub(last, p)) for p in (1, 7, 14)]
    dates = spark.range(1).select(F.explode(F.array(last, *[d for _, d in periods])).alias("snapshot_date"))
    boards = scoring.leaderboards(scoring.scored_holdings(sanitize.scorable(history, CFG), dates, CFG), CFG)
    return signals.score_deltas_by_period(boards, periods, last)


@query
def ytd_delta(spark, sf_dir):
    history = fx.holdings_f1(spark, sf_dir)
    last = history.agg(F.max("Holdings_As_Of")).scalar()
    first = F.trunc(last, "year")
    dates = spark.range(1).select(F.explode(F.array(last, first)).alias("snapshot_date"))
    boards = scoring.leaderboards(scoring.scored_holdings(sanitize.scorable(history, CFG), dates, CFG), CFG)
    return signals.score_deltas_by_period(boards, [("YTD", first)], last)


@query
def global_rank_panel_stats(spark, sf_dir):
    return signals.global_rank_motion(_boards(spark, sf_dir)).select("snapshot_date", "ticker", "global_rank_delta_30d", "global_rank_peak_30d", "global_rank_best_30d", "coverage")


@query
def burst(spark, sf_dir):
    return signals.global_rank_motion(_boards(spark, sf_dir)).select("snapshot_date", "ticker", "sustained", "burst_30d")


@query
def velocity(spark, sf_dir):
    return _enriched(spark, sf_dir).select("ticker", "avg_rank_delta_7d", "avg_rank_delta_30d", "etf_count_30d_ago", "etf_count_delta_30d", "velocity_score")


@query
def top_velocity(spark, sf_dir):
    rows = _enriched(spark, sf_dir).filter("etf_count >= 2")
    return rows.orderBy(F.desc("velocity_score"), "ticker").limit(15).select("ticker", "velocity_score", "etf_count")


@query
def divergence_regime(spark, sf_dir):
    return _enriched(spark, sf_dir).select("ticker", "conviction_divergence", "momentum_regime", "tier_breadth")


@query
def stealth_accumulation(spark, sf_dir):
    return _enriched(spark, sf_dir).select("ticker", "stealth_accumulation")


@query
def quality_change(spark, sf_dir):
    return signals.quality_change(_boards(spark, sf_dir), CFG)


def _flow(spark, sf_dir, dimension):
    return structure.flow(_enriched(spark, sf_dir), (dimension,)).drop("dimension")


@query
def sector_flow(spark, sf_dir):
    return _flow(spark, sf_dir, "sector")


@query
def country_flow(spark, sf_dir):
    return _flow(spark, sf_dir, "country")


@query
def fund_overlap(spark, sf_dir):
    return structure.fund_overlap(_latest(spark, sf_dir))


@query
def fund_overlap_volume(spark, sf_dir):
    return structure.fund_overlap(shared.written(scoring.compute_leaderboard(fx.holdings_f2(spark, sf_dir), fx.CFG_F2)[1].select("ETF_Ticker", "ticker"), "latest"))


@query
def top_overlap_pairs(spark, sf_dir):
    return structure.top_overlap_pairs(structure.fund_overlap(_latest(spark, sf_dir))).select("etf_a", "etf_b", "shared", "jaccard")


@query
def holdings_history_rank(spark, sf_dir):
    return structure.holdings_history(fx.holdings_f1(spark, sf_dir), CFG)


@query
def holdings_latest_wide(spark, sf_dir):
    wide = structure.holdings_latest_wide(_latest(spark, sf_dir), _deltas(spark, sf_dir), CFG)
    return wide.select("ETF_Ticker", "ticker", "rank", "rank_delta", "rank_delta_1d", "rank_delta_14d", "rank_delta_30d")


@query
def score_sparkline(spark, sf_dir):
    return structure.score_sparkline(_boards(spark, sf_dir)).select("ticker", F.explode("points").alias("p")).select("ticker", "p.d", "p.s")


@query
def kpi_counts(spark, sf_dir):
    return structure.kpi_counts(_boards(spark, sf_dir))


STRATEGIES = ("hc_entry", "burst_trigger", "top10_score", "top10_velocity", "baseline")


def _trades(spark, sf_dir, *which):
    boards = _boards(spark, sf_dir)
    past = _history_velocity(spark, sf_dir, boards) if "top10_velocity" in which else signals.global_rank_motion(boards)
    found = {
        "hc_entry": lambda w: backtest.entries(boards, F.col("flag") == "HIGH_CONVICTION", w),
        "burst_trigger": lambda w: backtest.entries(past, F.col("burst_30d"), w),
        "top10_score": lambda w: backtest.top_on_mondays(boards, w),
        "top10_velocity": lambda w: backtest.top_on_mondays(past, w, by="velocity_score", descending=True),
        "baseline": lambda w: backtest.baseline(boards),
    }
    return backtest.trades(reduce(DataFrame.unionByName, [found[w](w) for w in which]), fx.prices_f3(spark, sf_dir), fx.HOLD_DAYS)


def _shown(trades: DataFrame) -> DataFrame:
    return trades.select("strategy", "date", "ticker", F.round("entry", 6).alias("entry"), F.round("exit", 6).alias("exit"), "exit_date", "return_pct")


@query
def hc_entry_trades(spark, sf_dir):
    return _shown(_trades(spark, sf_dir, "hc_entry"))


@query
def burst_trades(spark, sf_dir):
    return _shown(_trades(spark, sf_dir, "burst_trigger"))


@query
def top10_score_trades(spark, sf_dir):
    return _shown(_trades(spark, sf_dir, "top10_score"))


@query
def top10_velocity_trades(spark, sf_dir):
    return _shown(_trades(spark, sf_dir, "top10_velocity"))


@query
def baseline_trades(spark, sf_dir):
    return _shown(_trades(spark, sf_dir, "baseline"))


@query
def trade_stats(spark, sf_dir):
    return backtest.trade_stats(_trades(spark, sf_dir, *STRATEGIES))


@query
def cumulative_returns(spark, sf_dir):
    return backtest.cumulative_returns(_trades(spark, sf_dir, *STRATEGIES))


@query
def return_at_date(spark, sf_dir):
    done = backtest.cumulative_returns(_trades(spark, sf_dir, *STRATEGIES))
    return backtest.return_at_date(done, _boards(spark, sf_dir).select(F.col("snapshot_date").alias("date")))


def _scatter(spark, sf_dir):
    rows = _history_velocity(spark, sf_dir, _boards(spark, sf_dir))
    return backtest.velocity_scatter(rows, fx.prices_f3(spark, sf_dir), fx.HOLD_DAYS, most=None)


@query
def velocity_scatter(spark, sf_dir):
    return _scatter(spark, sf_dir)


@query
def scatter_regression(spark, sf_dir):
    return backtest.scatter_regression(_scatter(spark, sf_dir))


@query
def series_stats(spark, sf_dir):
    return markets.series_stats(fx.series_f4(spark, sf_dir))


@query
def series_stats_long(spark, sf_dir):
    return markets.series_stats(fx.series_f5(spark, sf_dir))


@query
def price_log(spark, sf_dir):
    return markets.price_log(fx.series_f5(spark, sf_dir))


@query
def price_bars(spark, sf_dir):
    return markets.bars(markets.price_log(fx.series_f4(spark, sf_dir)))


@query
def streak_runs(spark, sf_dir):
    return markets.returns(fx.series_f5(spark, sf_dir)).groupBy("symbol").agg(F.max("streak").alias("longest_up"), F.min("streak").alias("longest_down"))


@query
def series_search(spark, sf_dir):
    labels = spark.sql("SELECT * FROM VALUES ('click', 'Clicks', 'web'), ('view', 'Page views', 'web'), ('purchase', 'Purchases', 'shop'), ('signup', 'Sign-ups', 'shop') AS t(symbol, label, kind)")
    rows = markets.search(markets.with_labels(markets.series_stats(fx.series_f4(spark, sf_dir)), labels), text="C")
    return rows.select("symbol", "label", "kind", "sessions_observed", F.round(F.col("up_20d") / (F.col("up_20d") + F.col("down_20d")), 4).alias("up_ratio"))


@query
def sim_underlyings(spark, sf_dir):
    return markets.sim_underlyings(fx.series_f5(spark, sf_dir))


@query
def nav_simulation(spark, sf_dir):
    paths = simulator.simulate(simulator.daily_returns(fx.series_f5(spark, sf_dir)), [2.0])
    return paths.select("symbol", "leverage", "i", "date", _relative("nav"), _relative("underlying"))


@query
def synthetic_simulation(spark, sf_dir):
    paths = simulator.simulate(simulator.synthetic_returns(spark), [3.0])
    return paths.select("leverage", "i", F.round("nav", 6).alias("nav"), F.round("underlying", 6).alias("underlying"))


@query
def decay_metrics(spark, sf_dir):
    return simulator.summary(simulator.simulate(simulator.synthetic_returns(spark), [2.0])).drop("symbol")


@query
def leverage_grid(spark, sf_dir):
    rows = simulator.summary(simulator.simulate(simulator.daily_returns(fx.series_f5(spark, sf_dir)), LEVERAGES))
    return rows.select("symbol", "leverage", *[_relative(c) for c in ("etn_total_pct", "underlying_total_pct", "drag_pct", "sigma_d", "annual_decay")], "sessions")


@query
def nested_holdings(spark, sf_dir):
    history = fx.holdings_f1(spark, sf_dir)
    rows = structure.nested_holdings(structure.holdings_history(history, CFG), leaderboard(spark, sf_dir))
    return rows.select("ticker", F.explode("by_etf").alias("ETF_Ticker", "rows")).select("ticker", "ETF_Ticker", F.size("rows").alias("n"), F.element_at("rows", -1)["d"].alias("last_day"))


def _tables(spark: SparkSession) -> list[DataFrame]:
    """Scraped tables with headers of three kinds, and one that names no ticker."""
    return [spark.sql(f"SELECT * FROM VALUES {rows} AS t({heads})") for heads, rows in HEADED]


@query
def parse_headers(spark, sf_dir):
    day = F.lit("2026-05-01").cast("date")
    found = [ingest.standardised(t, F.lit(f"T{i}"), day, day) for i, t in enumerate(_tables(spark))]
    rows = reduce(DataFrame.unionByName, [f for f in found if f is not None])
    return rows.select("ETF_Ticker", "ticker", "name", F.round("weight", 9).alias("weight"))


@query
def vendor_payloads(spark, sf_dir):
    """F1's last day as vendors' JSON, read back; weights under half a millionth are dropped."""
    rows = fx.holdings_f1(spark, sf_dir)
    holding = F.struct(
        "ticker", F.concat("name", F.lit(" &amp; Co")).alias("issuerName"), F.lit(1.0).alias("units"), (F.col("weight") * 100).alias("percentageOfTotalNetAssets"),
        F.when(F.col("ETF_Ticker") == "error", "Futures").otherwise("Common Stock").alias("securityTypeName"), F.lit("c").alias("cusip"), F.lit(1.0).alias("marketValue"),
    )
    day = rows.groupBy("ETF_Ticker", "Holdings_As_Of").agg(F.collect_list(holding).alias("holdings"))
    payload = F.to_json(F.struct(F.col("Holdings_As_Of").cast("string").alias("effectiveBusinessDate"), F.size("holdings").alias("totalNumberOfHoldings"), "holdings"))
    return ingest.vendor_holdings(day.select(F.col("ETF_Ticker").alias("etf"), payload.alias("payload"))).select("ETF_Ticker", "ticker", "name", "weight", "Holdings_As_Of")


@query
def load_statuses(spark, sf_dir):
    """The last day's load of each fund against a history that lacks it for two funds; one fund asked for has sent nothing."""
    rows = fx.holdings_f1(spark, sf_dir)
    last = rows.agg(F.max("Holdings_As_Of")).scalar()
    known = rows.filter((F.col("Holdings_As_Of") < last) | ~F.col("ETF_Ticker").isin("view", "click"))
    return ingest.load_status(rows.filter(F.col("Holdings_As_Of") == last), known, ["signup", "purchase", "view", "click", "error", "none"])


@query
def series_refresh(spark, sf_dir):
    """F4 up to the 20th, then all observations as text, "." for closes under the series' mean."""
    rows = fx.series_f4(spark, sf_dir)
    mean = rows.groupBy("symbol").agg(F.avg("close").alias("mean"))
    observed = rows.join(mean, "symbol").select("symbol", "date", F.when(F.col("close") < F.col("mean"), ".").otherwise(F.col("close").cast("string")).alias("value"))
    return ingest.series_update(rows.filter("date <= DATE '2024-01-20'"), observed)


@query
def csv_round_trip(spark, sf_dir):
    """F1 written as CSV and read with the contract's schema."""
    path = shared.new_path(spark, "csv")
    fx.holdings_f1(spark, sf_dir).write.option("header", True).csv(path)
    rows = readers.holdings_csv(spark, path)
    return rows.groupBy("ETF_Ticker").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("ticker").alias("tickers"), F.max("Holdings_As_Of").alias("last_day"), F.round(F.sum("weight"), 6).alias("weight"))


@query
def archive_round_trip(spark, sf_dir):
    """Three days of F1 archived, the last one twice with half the funds: latest by fund, history by day."""
    root, rows = shared.new_path(spark, "archive"), shared.written(fx.holdings_f1(spark, sf_dir), "holdings")
    for day, funds in (("2024-01-28", ("view", "click", "error")), ("2024-01-29", ("view", "click")), ("2024-01-30", ("view", "click")), ("2024-01-30", ("view",))):
        sinks.archive_day(rows.filter((F.col("Holdings_As_Of") == F.lit(day).cast("date")) & F.col("ETF_Ticker").isin(*funds)), root, day)
    both = [spark.read.parquet(f"{root}/{name}").select(F.lit(name).alias("layout"), "ETF_Ticker", "ticker", "Holdings_As_Of") for name in ("latest", "history")]
    return both[0].unionByName(both[1]).groupBy("layout", "ETF_Ticker", "Holdings_As_Of").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def document_round_trip(spark, sf_dir):
    """Flag histories written as JSON documents and read back."""
    path = shared.new_path(spark, "documents")
    sinks.write_document(structure.flag_history(_boards(spark, sf_dir)), path)
    rows = spark.read.schema("ticker string, history array<struct<d: date, flag: string, rank: int>>").json(path)
    return rows.select("ticker", F.explode("history").alias("h")).select("ticker", "h.d", "h.flag", "h.rank")


@query
def summary_counts(spark, sf_dir):
    rows = documents.summary(fx.holdings_f1(spark, sf_dir), _boards(spark, sf_dir), CFG)
    return rows.select(
        "source_rows_raw", "source_rows_after_sanitize", "latest_holdings_as_of", F.size("etfs").alias("funds"), F.size("snapshot_dates").alias("snapshots"),
        F.col("today.high_conviction").alias("hc_today"), F.col("yesterday.high_conviction").alias("hc_yesterday"), F.col("today.unflagged").alias("unflagged_today"),
    )


@query
def score_delta_map(spark, sf_dir):
    """The map of all periods that a leaderboard record carries."""
    rows = signals.period_map(documents.period_deltas(fx.holdings_f1(spark, sf_dir), CFG))
    return rows.select("ticker", F.explode("score_deltas_by_period").alias("period", "score_delta_pct"))


@query
def series_kinds(spark, sf_dir):
    labels = spark.sql("SELECT * FROM VALUES ('click', 'Clicks', 'web'), ('view', 'Page views', 'web'), ('purchase', 'Purchases', 'shop'), ('signup', 'Sign-ups', 'shop') AS t(symbol, label, kind)")
    return markets.kind_counts(markets.with_labels(markets.series_stats(fx.series_f4(spark, sf_dir)), labels))


@query
def metadata_build(spark, sf_dir):
    """A metadata row for each of F2's tickers; the customers know some of the names."""
    known = fx.metadata_f6(spark, sf_dir).withColumn("ticker", F.regexp_replace("ticker", "^U", "P"))
    return ingest.ticker_metadata(fx.holdings_f2(spark, sf_dir), known).select("ticker", "sector", "industry", "country")


def _past(spark, sf_dir):
    boards = _boards(spark, sf_dir)
    past = _history_velocity(spark, sf_dir, boards)
    return boards.join(past.select("snapshot_date", "ticker", "burst_30d", "velocity_score"), ["snapshot_date", "ticker"])


@query
def watchlist_changes(spark, sf_dir):
    """All tickers are watched; the last visit was on the 20th."""
    rows = _past(spark, sf_dir)
    return explore.since_last_visit(rows, rows, F.lit("2024-01-20").cast("date"))


@query
def signal_timeline(spark, sf_dir):
    return explore.signal_timeline(_past(spark, sf_dir))


@query
def signal_days(spark, sf_dir):
    return explore.state_days(explore.signal_timeline(_past(spark, sf_dir)))


@query
def compare_top(spark, sf_dir):
    board = leaderboard(spark, sf_dir)
    return explore.compared(board, board.filter("etf_count >= 2")).select("place", "ticker", "final_score")


def _explained(spark, sf_dir):
    latest, boards = _latest(spark, sf_dir), _boards(spark, sf_dir)
    rows = _enriched(spark, sf_dir).join(signals.concentration(latest), "ticker").join(signals.quality_change(boards, CFG), "ticker")
    return rows.join(temporal.streaks_and_deltas(boards).select("ticker", "hc_streak"), "ticker")


@query
def explainer_lines(spark, sf_dir):
    return explore.explained(_explained(spark, sf_dir)).select("ticker", "sentence")


@query
def filter_chips(spark, sf_dir):
    rows = shared.written(_explained(spark, sf_dir), "explained")
    sets = {"velo": {"velo": True}, "burst": {"burst": True}, "quality": {"quality": True}, "spread": {"most_concentrated": 80}, "building": {"sector": "BUILDING", "most_concentrated": 80}}
    return reduce(DataFrame.unionByName, [explore.chips(rows, **o).select(F.lit(name).alias("chip"), "ticker") for name, o in sets.items()])


@query
def remaining_weight(spark, sf_dir):
    return explore.remaining_weight(_latest(spark, sf_dir), 10)


@query
def time_travel(spark, sf_dir):
    """Spark SQL over the registered views: the flags of one past day beside today's."""
    session = explore.register_views(_boards(spark, sf_dir), _latest(spark, sf_dir))
    return session.sql(
        "SELECT b.ticker, b.flag AS flag_then, b.leaderboard_rank AS rank_then, count(h.ETF_Ticker) AS funds_now FROM leaderboard b LEFT JOIN holdings h ON h.ticker = b.ticker "
        "WHERE b.snapshot_date = DATE '2024-01-15' GROUP BY b.ticker, b.flag, b.leaderboard_rank"
    )
