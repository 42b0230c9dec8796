"""Flows by dimension, overlaps of funds, nested payloads and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from .sanitize import parsed, sanitize


def flow(rows: DataFrame, dimensions: tuple[str, ...] = ("sector", "country"), least_etfs: int = 2) -> DataFrame:
    """dimension, label and sums over tickers of at least least_etfs funds: one pass for all dimensions.

    Velocity (2 digits) and weight (6 digits) are summed as decimals, so a sum doesn't depend on the order of its rows.
    """
    velocity, weight = F.col("velocity_score").cast("decimal(18,2)"), F.col("total_weight").cast("decimal(18,6)")
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("label")) for d in dimensions])).alias("g")
    flat = rows.filter(F.col("etf_count") >= least_etfs).select(pairs, "velocity_score", "total_weight", "burst_30d", "flag").select("g.*", "velocity_score", "total_weight", "burst_30d", "flag")
    return flat.groupBy("dimension", "label").agg(
        F.sum(velocity).cast("double").alias("net_velocity"), F.round(F.sum(velocity) / F.count(F.lit(1)), 2).cast("double").alias("avg_velocity"), F.count(F.lit(1)).alias("names"),
        F.round(F.sum(weight), 4).cast("double").alias("total_weight"), F.count_if("burst_30d").alias("burst_count"), F.count_if(F.col("flag") == "HIGH_CONVICTION").alias("hc_count"),
    )


def fund_overlap(latest: DataFrame) -> DataFrame:
    """etf_a, etf_b, size_a, size_b, shared, jaccard for every pair of funds, itself included.

    Tickers carry the set of funds that hold them, so the counts come from one aggregation per ticker and funds' pairs (a
    configuration-sized grid), not from a self join of holdings.
    """
    funds = latest.groupBy("ticker").agg(F.array_sort(F.collect_set("ETF_Ticker")).alias("funds"))
    shared = funds.select(F.explode("funds").alias("etf_a"), "funds").select("etf_a", F.explode("funds").alias("etf_b")).groupBy("etf_a", "etf_b").agg(F.count(F.lit(1)).alias("shared"))
    sizes = shared.filter("etf_a = etf_b").select(F.col("etf_a").alias("ETF_Ticker"), F.col("shared").alias("size"))  # what a fund shares with itself
    all_sizes = sizes.agg(F.collect_list(F.struct("ETF_Ticker", "size"))).scalar()
    grid = sizes.select(F.col("ETF_Ticker").alias("etf_a"), F.col("size").alias("size_a"), F.explode(all_sizes).alias("b"))
    grid = grid.select("etf_a", "size_a", F.col("b.ETF_Ticker").alias("etf_b"), F.col("b.size").alias("size_b"))
    rows = grid.join(shared, ["etf_a", "etf_b"], "left").withColumn("shared", F.coalesce("shared", F.lit(0).cast("bigint")))
    return rows.withColumn("jaccard", F.round(F.coalesce(F.try_divide(F.col("shared"), F.col("size_a") + F.col("size_b") - F.col("shared")), F.lit(0.0)), 4))


def top_overlap_pairs(overlap: DataFrame, n: int = 10) -> DataFrame:
    return overlap.filter("etf_a < etf_b").orderBy(F.desc("jaccard"), "etf_a", "etf_b").limit(n)


def flag_history(boards: DataFrame) -> DataFrame:
    """ticker, history: array of (d, flag, rank) by date."""
    return boards.groupBy("ticker").agg(F.array_sort(F.collect_list(F.struct(F.col("snapshot_date").alias("d"), "flag", F.col("leaderboard_rank").alias("rank")))).alias("history"))


def score_sparkline(boards: DataFrame, top: int = 200) -> DataFrame:
    """ticker, points: array of (d, s) by date, of the last snapshot's top tickers."""
    last = boards.agg(F.max("snapshot_date")).scalar()
    best = boards.filter((F.col("snapshot_date") == last) & (F.col("leaderboard_rank") <= top)).select("ticker")
    return boards.join(best, "ticker", "left_semi").groupBy("ticker").agg(F.array_sort(F.collect_list(F.struct(F.col("snapshot_date").alias("d"), F.col("final_score").alias("s")))).alias("points"))


def holdings_latest_wide(latest: DataFrame, deltas: DataFrame, cfg: Config) -> DataFrame:
    """The latest holdings with the primary period's rank_delta and weight_flow, and all other periods' as columns _<n>d."""
    main = cfg.rank_delta_lookback_days
    others = [p for p in cfg.delta_periods_days if p != main]
    at = lambda p, c: F.max(F.when(F.col("period_days") == p, F.col(c)))
    wide = deltas.groupBy("ETF_Ticker", "ticker").agg(
        at(main, "rank_delta").alias("rank_delta"), at(main, "weight_flow").alias("weight_flow"), *[at(p, c).alias(f"{c}_{p}d") for p in others for c in ("rank_delta", "weight_flow")]
    )
    columns = ["ETF_Ticker", "ticker", "name", "weight", "rank", "tier", "is_new", "rank_mult", "base_score", "new_bonus", "score", "Holdings_As_Of"]
    return latest.select(*columns).join(wide, ["ETF_Ticker", "ticker"], "left")


def holdings_history(history: DataFrame, cfg: Config, days: int = 120) -> DataFrame:
    """Sanitised rows of all funds, configured or not, of the last days, ranked within fund and date."""
    clean = sanitize(parsed(history), cfg)
    last = clean.agg(F.max("Holdings_As_Of")).scalar()
    order = Window.partitionBy("ETF_Ticker", "Holdings_As_Of").orderBy(F.desc("weight"), "ticker")
    return clean.filter(F.col("Holdings_As_Of") >= F.date_sub(last, days)).withColumn("rank", F.row_number().over(order)).select("ETF_Ticker", "ticker", "Holdings_As_Of", "rank", F.round("weight", 6).alias("weight"))


def nested_holdings(history: DataFrame, board: DataFrame, top: int = 300) -> DataFrame:
    """ticker, by_etf: map of fund -> array of (d, r, w) by date, of the top tickers."""
    best = board.filter(F.col("leaderboard_rank") <= top).select("ticker")
    rows = history.join(best, "ticker", "left_semi").groupBy("ticker", "ETF_Ticker").agg(
        F.array_sort(F.collect_list(F.struct(F.col("Holdings_As_Of").alias("d"), F.col("rank").alias("r"), F.col("weight").alias("w")))).alias("rows")
    )
    return rows.groupBy("ticker").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("ETF_Ticker", "rows")))).alias("by_etf"))


def kpi_counts(boards: DataFrame) -> DataFrame:
    """Flags and NEW tickers of each of the last two snapshots."""
    order = F.dense_rank().over(Window.orderBy(F.desc("snapshot_date")))
    dates = boards.select("snapshot_date").distinct().withColumn("back", order).filter("back <= 2")
    return boards.join(F.broadcast(dates), "snapshot_date").groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("tickers"), F.count_if(F.col("flag") == "HIGH_CONVICTION").alias("high_conviction"),
        F.count_if(F.col("flag") == "SPECULATIVE_BETA").alias("speculative_beta"), F.count_if(F.col("flag") == "").alias("unflagged"), F.count_if("any_new").alias("new_tickers"),
    )
