"""Rank and weight changes of each holding against earlier snapshots of its fund."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from .sanitize import cleaned, prepared, sanitize, scorable
from .scoring import as_of_grid, fund_dates


def rank_deltas(history: DataFrame, cfg: Config, periods: tuple[int, ...] | None = None) -> DataFrame:
    """All periods in one job: ETF_Ticker, ticker, period_days, rank_now/then/delta, weight_now/then/flow.

    Then is the fund's last date at least period_days before its latest one, or its first date if there is none.
    """
    days = periods or cfg.delta_periods_days
    rows = scorable(history, cfg)
    in_fund = Window.partitionBy("ETF_Ticker", "Holdings_As_Of").orderBy(F.desc("weight"), "ticker")
    targets = fund_dates(cleaned(rows, cfg)).withColumn("period_days", F.explode(F.array(*[F.lit(int(p)) for p in days]))).select(
        "ETF_Ticker", "period_days", F.array_max("dates").alias("now"),
        F.coalesce(
            F.array_max(F.filter("dates", lambda d: d <= F.date_sub(F.array_max("dates"), F.col("period_days")))), F.array_min("dates")
        ).alias("then"),
    )
    # two dates at most for each of the configuration's funds and each period
    wanted = F.broadcast(targets.select("ETF_Ticker", F.explode(F.array("now", "then")).alias("Holdings_As_Of")).distinct())
    ranked = sanitize(rows.join(wanted, ["ETF_Ticker", "Holdings_As_Of"], "left_semi"), cfg).select(
        "ETF_Ticker", "ticker", "Holdings_As_Of", "weight", F.row_number().over(in_fund).alias("rank")
    )
    now = ranked.join(targets, (ranked.ETF_Ticker == targets.ETF_Ticker) & (ranked.Holdings_As_Of == targets.now)).select(
        ranked.ETF_Ticker, "ticker", "period_days", "then", F.col("rank").alias("rank_now"), F.col("weight").alias("weight_now")
    )
    then = ranked.select("ETF_Ticker", "ticker", F.col("Holdings_As_Of").alias("then"), F.col("rank").alias("rank_then"), F.col("weight").alias("weight_then"))
    return now.join(then, ["ETF_Ticker", "ticker", "then"], "left").select(
        "ETF_Ticker", "ticker", "period_days", "rank_now", "rank_then", (F.col("rank_then") - F.col("rank_now")).alias("rank_delta"), "weight_now", "weight_then",
        F.try_divide(F.col("weight_now") - F.col("weight_then"), F.nullif(F.col("weight_then"), F.lit(0.0))).alias("weight_flow"),
    )


def motion_history(history: DataFrame, cfg: Config, snapshots: DataFrame, days: int = 7) -> DataFrame:
    """snapshot_date, ticker, avg_rank_delta, avg_weight_flow: means over the funds that hold a ticker at a snapshot, against days before.

    A fund's earlier date depends on its date alone, so changes are found once for each fund and date and then dealt to the snapshots.
    """
    clean = prepared(history, cfg)
    in_fund = Window.partitionBy("ETF_Ticker", "Holdings_As_Of").orderBy(F.desc("weight"), "ticker")
    ranked = clean.select("ETF_Ticker", "ticker", "Holdings_As_Of", "weight", F.row_number().over(in_fund).alias("rank"))
    earlier = F.coalesce(F.array_max(F.filter("dates", lambda d: d <= F.date_sub("Holdings_As_Of", days))), F.array_min("dates"))
    targets = fund_dates(clean).withColumn("Holdings_As_Of", F.explode("dates")).select("ETF_Ticker", "Holdings_As_Of", earlier.alias("then"))
    grid = as_of_grid(clean, snapshots).join(targets, ["ETF_Ticker", "Holdings_As_Of"])
    was = ranked.select("ETF_Ticker", "ticker", F.col("Holdings_As_Of").alias("then"), F.col("rank").alias("rank_then"), F.col("weight").alias("weight_then"))
    both = ranked.join(grid, ["ETF_Ticker", "Holdings_As_Of"]).join(was, ["ETF_Ticker", "ticker", "then"], "left")
    flow = F.try_divide(F.col("weight") - F.col("weight_then"), F.nullif(F.col("weight_then"), F.lit(0.0)))
    return both.groupBy("snapshot_date", "ticker").agg(F.avg(F.col("rank_then") - F.col("rank")).alias("avg_rank_delta"), F.avg(flow).alias("avg_weight_flow"))


def primary_period(deltas: DataFrame, cfg: Config) -> DataFrame:
    """The table of the default look-back, or of the first period if that one isn't computed."""
    days = cfg.rank_delta_lookback_days if cfg.rank_delta_lookback_days in cfg.delta_periods_days else cfg.delta_periods_days[0]
    return deltas.filter(F.col("period_days") == days).drop("period_days")
