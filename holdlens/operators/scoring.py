"""Leaderboards: one plan for any number of snapshot dates.

A single date, the calendar of a look-back window and the shifted dates of period deltas are the same plan with another list of snapshots; every
ranking is partitioned by snapshot, so replaying a history is one distributed job.
"""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from .sanitize import cleaned, sanitize, scorable, with_dates


def rank_multiplier(rank: Column, cfg: Config) -> Column:
    first, *rest = [F.when(rank <= top, F.lit(m)) if not i else (top, m) for i, (top, m) in enumerate(cfg.rank_breakpoints)]
    return reduce(lambda c, b: c.when(rank <= b[0], F.lit(b[1])), rest, first).otherwise(F.lit(1.0))


def _lookup(key: Column, table: dict) -> Column:
    """A configuration table as a map literal: a look-up without a join."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def snapshot_calendar(raw: DataFrame, lookback_days: int | None) -> DataFrame:
    """snapshot_date: distinct as-of dates of the raw history, within lookback_days of the last one."""
    dates = raw.select(F.col("Holdings_As_Of").cast("date").alias("snapshot_date")).dropna().distinct()
    if lookback_days is None:
        return dates
    last = raw.agg(F.max(F.col("Holdings_As_Of").cast("date"))).scalar()
    return dates.filter(F.col("snapshot_date") >= F.date_sub(last, lookback_days))


def fund_dates(clean: DataFrame) -> DataFrame:
    """ETF_Ticker, dates: each fund's distinct dates as a sorted array."""
    return clean.groupBy("ETF_Ticker").agg(F.array_sort(F.collect_set("Holdings_As_Of")).alias("dates"))


def as_of_grid(clean: DataFrame, snapshots: DataFrame) -> DataFrame:
    """snapshot_date, ETF_Ticker, Holdings_As_Of: each fund's last date at or before each snapshot.

    A fund's distinct dates are one sorted array (days, not rows), so neither a range join nor a window over holdings is needed.
    """
    dates = fund_dates(clean)
    all_snaps = snapshots.agg(F.array_sort(F.collect_set("snapshot_date"))).scalar()
    grid = dates.withColumn("snapshot_date", F.explode(all_snaps))
    return grid.select(
        "snapshot_date", "ETF_Ticker", F.array_max(F.filter("dates", lambda d: d <= F.col("snapshot_date"))).alias("Holdings_As_Of")
    ).dropna()


def scored_holdings(rows: DataFrame, snapshots: DataFrame, cfg: Config) -> DataFrame:
    """Each fund's latest holdings at each snapshot with rank, NEW flag, tier, points and score. rows: scorable()."""
    clean = cleaned(rows, cfg)
    # the grid has a row for each of the configuration's funds and each snapshot day: small enough for a window and to be broadcast
    cutoff = F.date_sub(F.max("Holdings_As_Of").over(Window.partitionBy("snapshot_date")), cfg.new_lookback_days)
    grid = as_of_grid(clean, snapshots).withColumn("new_since", cutoff)
    seen = clean.groupBy("ETF_Ticker", "ticker").agg(F.min("Holdings_As_Of").alias("first_seen"))
    # of the names and weights only those of dates that a snapshot sees are cleaned, merged, ranked and scored
    wanted = sanitize(rows.join(F.broadcast(grid.select("ETF_Ticker", "Holdings_As_Of").distinct()), ["ETF_Ticker", "Holdings_As_Of"], "left_semi"), cfg)
    latest = wanted.join(F.broadcast(grid), ["ETF_Ticker", "Holdings_As_Of"]).join(seen, ["ETF_Ticker", "ticker"])
    in_fund = Window.partitionBy("snapshot_date", "ETF_Ticker").orderBy(F.desc("weight"), "ticker")
    tier, points = _lookup(F.col("ETF_Ticker"), cfg.fund_tiers()), _lookup(F.col("ETF_Ticker"), {k: float(v) for k, v in cfg.fund_points().items()})
    bonus_tier = F.col("tier").isin(list(cfg.new_bonus_tiers)) if cfg.new_bonus_tiers else F.lit(False)
    return (
        latest.withColumn("rank", F.row_number().over(in_fund))
        .withColumn("is_new", F.col("first_seen") >= F.col("new_since"))
        .withColumn("tier", tier).withColumn("tier_points", points)
        .withColumn("rank_mult", rank_multiplier(F.col("rank"), cfg))
        .withColumn("weight_pct", F.col("weight") * 100)
        .withColumn("base_score", F.col("weight_pct") * F.col("tier_points") * F.col("rank_mult"))
        .withColumn("new_bonus", F.when(F.col("is_new") & bonus_tier, F.col("tier_points") * cfg.new_bonus_mult).otherwise(0.0))
        .withColumn("score", F.col("base_score") + F.col("new_bonus"))
        .drop("first_seen", "new_since")
    )


def conviction_flag(etf_count: Column, tiers: Column, cfg: Config) -> Column:
    """tiers: array of distinct tiers."""
    has = lambda t: F.array_contains(tiers, t)
    return F.when(etf_count >= cfg.high_conviction_min_etfs, "HIGH_CONVICTION").when(
        has("Trend") & ~has("Quality") & ~has("Scout"), "SPECULATIVE_BETA"
    ).otherwise("")


def leaderboards(scored: DataFrame, cfg: Config) -> DataFrame:
    """One row for each snapshot and ticker, ranked within the snapshot. A fund has a ticker once in a snapshot, so counting rows counts funds."""
    board = scored.groupBy("snapshot_date", "ticker").agg(
        F.coalesce(F.min_by("name", F.when(F.col("name").isNotNull(), F.struct("ETF_Ticker", "rank"))), F.lit(None)).alias("company"),
        F.round(F.sum("score"), 6).alias("score"), F.count("ETF_Ticker").alias("etf_count"), F.sum("weight").alias("weight_sum"),
        F.array_join(F.array_sort(F.collect_set("ETF_Ticker")), ", ").alias("held_by"), F.array_sort(F.collect_set("tier")).alias("tier_list"),
        F.bool_or("is_new").alias("any_new"), F.min("rank").alias("best_rank"),
    )
    order = Window.partitionBy("snapshot_date").orderBy(F.desc("score"), F.desc("etf_count"), F.desc(F.round("weight_sum", 9)), "ticker")
    return board.withColumn("leaderboard_rank", F.row_number().over(order)).select(
        "snapshot_date", "ticker", "company", F.col("score").cast("bigint").alias("final_score"), "etf_count", F.round("weight_sum", 6).alias("total_weight"),
        "held_by", F.array_join("tier_list", " + ").alias("tiers"), "any_new", "best_rank",
        conviction_flag(F.col("etf_count"), F.col("tier_list"), cfg).alias("flag"), "leaderboard_rank",
    )


def compute_leaderboard(history: DataFrame, cfg: Config, *, as_of: datetime.date | None = None) -> tuple[DataFrame, DataFrame]:
    """(leaderboard, latest scored holdings) at one date; the last date of the history by default."""
    rows = scorable(history, cfg)
    if as_of is not None:
        rows = rows.filter(F.col("Holdings_As_Of") <= F.lit(as_of))
    snapshot = fund_dates(cleaned(rows, cfg)).agg(F.max(F.array_max("dates")).alias("snapshot_date"))
    latest = scored_holdings(rows, snapshot, cfg)
    return leaderboards(latest, cfg).drop("snapshot_date"), latest.drop("snapshot_date")


def historical_leaderboards(history: DataFrame, cfg: Config, *, lookback_days: int | None = -1) -> DataFrame:
    """The leaderboard at every snapshot of the look-back window, long form."""
    days = cfg.leaderboard_lookback_days if lookback_days == -1 else lookback_days
    calendar = snapshot_calendar(with_dates(history), days)  # of all rows, those without ticker or weight too
    return leaderboards(scored_holdings(scorable(history, cfg), calendar, cfg), cfg)
