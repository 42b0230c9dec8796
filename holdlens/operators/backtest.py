"""Back-tests: signal sets of five strategies share one pair of as-of joins and one set of statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .asof import asof_join


def entries(boards: DataFrame, condition, strategy: str) -> DataFrame:
    """Tickers for which condition holds at a snapshot and didn't at the one before (absence counts as no; the first snapshot: all)."""
    calendar = boards.agg(F.array_sort(F.collect_set("snapshot_date"))).scalar()
    on = boards.filter(condition).select("ticker", "snapshot_date", F.array_position(calendar, F.col("snapshot_date")).alias("i"))
    before = F.lag("i").over(Window.partitionBy("ticker").orderBy("i"))
    return on.withColumn("p", before).filter("p IS NULL OR p < i - 1").select(F.lit(strategy).alias("strategy"), F.col("snapshot_date").alias("date"), "ticker")


def mondays(boards: DataFrame) -> DataFrame:
    return boards.filter(F.weekday("snapshot_date") == 0)


def top_on_mondays(boards: DataFrame, strategy: str, *, by: str = "leaderboard_rank", descending: bool = False, n: int = 10) -> DataFrame:
    order = Window.partitionBy("snapshot_date").orderBy(F.desc(by) if descending else F.asc(by), "ticker")
    rows = mondays(boards).filter(F.col(by).isNotNull())
    return rows.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= n).select(F.lit(strategy).alias("strategy"), F.col("snapshot_date").alias("date"), "ticker")


def baseline(boards: DataFrame, symbol: str = "SPX") -> DataFrame:
    return mondays(boards).select(F.lit("baseline").alias("strategy"), F.col("snapshot_date").alias("date")).distinct().withColumn("ticker", F.lit(symbol))


def trades(signals: DataFrame, prices: DataFrame, hold_days: int = 30) -> DataFrame:
    """Entry at the first close on or after the signal, exit hold_days later; no entry price: no trade; no exit or a price of 0: no return."""
    px = prices.select(F.col("symbol").alias("ticker"), F.col("date"), F.col("close").alias("px"))
    bought = asof_join(signals, px, by="ticker", on="date", value="px", direction="forward", out="entry").filter(F.col("entry").isNotNull())
    out = bought.withColumn("entry_date", F.col("date")).withColumn("date", F.date_add("date", hold_days))
    sold = asof_join(out, px, by="ticker", on="date", value="px", direction="forward", out="exit_raw")
    done = F.when(F.col("exit_raw") != 0, F.col("exit_raw"))
    return sold.select(
        "strategy", F.col("entry_date").alias("date"), "ticker", "entry", done.alias("exit"), F.col("date").alias("exit_date"),
        F.round(F.try_divide(done, F.nullif(F.col("entry"), F.lit(0.0))) - 1, 6).alias("return_pct"), F.lit(hold_days).alias("days_held"),
    )


def trade_stats(all_trades: DataFrame) -> DataFrame:
    """n_trades, win_rate, avg_return, max_drawdown, sharpe of each strategy; trades in order of (date, ticker)."""
    closed = all_trades.filter(F.col("return_pct").isNotNull())
    order = Window.partitionBy("strategy").orderBy("date", "ticker").rowsBetween(Window.unboundedPreceding, 0)
    curve = closed.withColumn("wealth", F.product(1 + F.col("return_pct")).over(order))
    fall = curve.withColumn("fall", F.try_divide(F.col("wealth"), F.nullif(F.max("wealth").over(order), F.lit(0.0))) - 1)
    stats = fall.groupBy("strategy").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("return_pct") > 0).cast("double")), 4).alias("win_rate"), F.round(F.avg("return_pct"), 4).alias("avg_return"),
        F.round(F.min("fall"), 4).alias("max_drawdown"),
        F.round(F.try_divide(F.avg("return_pct"), F.nullif(F.round(F.stddev_pop("return_pct"), 12), F.lit(0.0))) * F.sqrt(F.lit(12.0)), 3).alias("sharpe"),
    )
    every = all_trades.groupBy("strategy").agg(F.count(F.lit(1)).alias("all_trades"))
    return every.join(stats, "strategy", "left").select("strategy", F.coalesce("n", "all_trades").alias("n_trades"), "win_rate", "avg_return", "max_drawdown", "sharpe")


def cumulative_returns(all_trades: DataFrame) -> DataFrame:
    order = Window.partitionBy("strategy").orderBy("exit_date", "ticker", "date").rowsBetween(Window.unboundedPreceding, 0)
    closed = all_trades.filter(F.col("return_pct").isNotNull())
    return closed.select("strategy", "ticker", "exit_date", F.round(F.product(1 + F.col("return_pct")).over(order) - 1, 4).alias("total_return"))


def return_at_date(cumulative: DataFrame, dates: DataFrame) -> DataFrame:
    """strategy, date, total_return: each strategy's last value at or before each date (null before its first one)."""
    last = cumulative.groupBy("strategy", "exit_date").agg(F.max_by("total_return", "ticker").alias("total_return"))
    axis = dates.agg(F.array_sort(F.collect_set("date"))).scalar()
    grid = cumulative.select("strategy").distinct().withColumn("date", F.explode(axis))
    return asof_join(grid, last.withColumnRenamed("exit_date", "date"), by="strategy", on="date", value="total_return")


def velocity_scatter(scores: DataFrame, prices: DataFrame, hold_days: int = 30, most: int | None = 2000) -> DataFrame:
    """velocity_score against the realised return; a fixed sample of at most so many points (None: all), by a hash."""
    signals = scores.select(F.lit("scatter").alias("strategy"), F.col("snapshot_date").alias("date"), "ticker", "velocity_score")
    kept = ["strategy", "date", "ticker"]
    found = trades(signals.select(*kept), prices, hold_days).filter(F.col("return_pct").isNotNull()).join(signals, kept)
    points = found.select("ticker", "date", "velocity_score", F.col("return_pct").alias("realized_return"))
    return points if most is None else points.orderBy(F.xxhash64("ticker", "date"), "ticker", "date").limit(most)


def scatter_regression(points: DataFrame) -> DataFrame:
    """n, r2 (0 with fewer than 3 points or no variance), slope, intercept."""
    x, y = F.col("velocity_score"), F.col("realized_return")
    return points.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.when(F.count(F.lit(1)) >= 3, F.coalesce(F.nanvl(F.pow(F.corr(x, y), 2), F.lit(0.0)), F.lit(0.0))).otherwise(0.0), 4).alias("r2"),
        F.round(F.regr_slope(y, x), 6).alias("slope"), F.round(F.regr_intercept(y, x), 6).alias("intercept"),
    )
