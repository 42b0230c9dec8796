"""Statistics of price series (symbol, date, close)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pct(now: Column, base: Column) -> Column:
    return F.try_divide(now - base, F.abs(F.nullif(base, F.lit(0.0))))


def returns(prices: DataFrame) -> DataFrame:
    """Rows with a close, numbered from the last (back = 1), with the return against the close before and the signed run of equal signs."""
    by_day = Window.partitionBy("symbol").orderBy("date")
    rows = prices.filter(F.col("close").isNotNull()).select("symbol", F.col("date").cast("date").alias("date"), F.col("close").cast("double").alias("close"))
    rows = rows.withColumn("ret", _pct(F.col("close"), F.lag("close").over(by_day))).withColumn("sign", F.coalesce(F.signum("ret"), F.lit(0.0)).cast("int"))
    new = (F.col("sign") != F.lag("sign").over(by_day)).cast("int")
    rows = rows.withColumn("new", F.coalesce(new, F.lit(1))).withColumn("run", F.sum("new").over(by_day.rowsBetween(Window.unboundedPreceding, 0)))
    within = Window.partitionBy("symbol", "run").orderBy("date")
    back = Window.partitionBy("symbol").orderBy(F.desc("date"))
    return rows.withColumn("streak", F.row_number().over(within) * F.col("sign")).withColumn("back", F.row_number().over(back)).drop("new", "run", "sign")


def series_stats(prices: DataFrame) -> DataFrame:
    """The 15 statistics of each symbol in one aggregation after one sort."""
    rows = returns(prices).withColumn("last", F.max("date").over(Window.partitionBy("symbol")))
    rows = rows.withColumn("today", F.max_by("close", "date").over(Window.partitionBy("symbol")))
    before = lambda days: F.max_by("close", F.when(F.col("date") <= F.date_sub("last", days), F.col("date")))
    stats = rows.groupBy("symbol").agg(
        F.max("date").alias("last_date"), F.max("today").alias("close_today"), F.max(F.when(F.col("back") == 2, F.col("close"))).alias("close_yesterday"),
        before(7).alias("week"), before(30).alias("month"), F.min_by("close", F.when(F.year("date") == F.year("last"), F.col("date"))).alias("ytd"),
        F.min("close").alias("all_time_low"), F.max("close").alias("all_time_high"), F.count(F.lit(1)).alias("sessions_observed"),
        F.max_by("date", F.struct(-F.col("close"), "date")).alias("all_time_low_date"), F.max_by("date", F.struct("close", "date")).alias("all_time_high_date"),
        F.max(F.when(F.col("back") == 1, F.col("streak"))).alias("current_streak"),
        F.count_if((F.col("back") <= 20) & (F.col("ret") > 0)).alias("up_20d"), F.count_if((F.col("back") <= 20) & (F.col("ret") < 0)).alias("down_20d"),
        F.avg((F.col("close") <= F.col("today")).cast("double")).alias("pctl"),
    )
    now = F.col("close_today")
    return stats.select(
        "symbol", "last_date", F.round("close_today", 4).alias("close_today"), F.round("close_yesterday", 4).alias("close_yesterday"), F.round(_pct(now, F.col("close_yesterday")), 6).alias("day_pct"),
        F.round(_pct(now, F.col("week")), 6).alias("week_pct"), F.round(_pct(now, F.col("month")), 6).alias("month_pct"), F.round(_pct(now, F.col("ytd")), 6).alias("ytd_pct"),
        F.round("all_time_low", 4).alias("all_time_low"), "all_time_low_date", F.round("all_time_high", 4).alias("all_time_high"), "all_time_high_date", "sessions_observed",
        "current_streak", "up_20d", "down_20d", F.round("pctl", 4).alias("all_time_percentile"),
    )


def price_log(prices: DataFrame, n: int = 200) -> DataFrame:
    """The last n rows of each symbol: d, close, pct, streak and level (share of closes at or below)."""
    level = F.cume_dist().over(Window.partitionBy("symbol").orderBy("close"))
    rows = returns(prices).withColumn("level", level)
    return rows.filter(F.col("back") <= n).select("symbol", F.col("date").alias("d"), F.round("close", 4).alias("close"), F.round("ret", 6).alias("pct"), "streak", F.round("level", 4).alias("level"))


def with_labels(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """(symbol, label, kind) joined in; series without a label stay out."""
    return stats.join(labels, "symbol").orderBy("kind", "symbol")


def search(series: DataFrame, *, kind: str | None = None, text: str = "") -> DataFrame:
    rows = series if kind in (None, "all") else series.filter(F.col("kind") == kind)
    return rows.filter(F.contains(F.lower(F.col("symbol")), F.lit(text.lower())) | F.contains(F.lower(F.col("label")), F.lit(text.lower())))


def kind_counts(series: DataFrame) -> DataFrame:
    return series.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def bars(log: DataFrame, height: float = 22.0, floor: float = 2.0) -> DataFrame:
    """Bar heights: |pct| against the largest of the symbol."""
    top = F.max(F.abs("pct")).over(Window.partitionBy("symbol"))
    return log.select("symbol", "d", F.round(F.greatest(F.lit(floor), F.coalesce(F.try_divide(F.abs("pct"), F.nullif(top, F.lit(0.0))), F.lit(0.0)) * height), 4).alias("height"))


def sim_underlyings(prices: DataFrame, symbols: list[str] | None = None, n: int = 2520) -> DataFrame:
    rows = prices.filter(F.col("close").isNotNull())
    rows = rows.filter(F.col("symbol").isin(symbols)) if symbols else rows
    back = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("date")))
    return rows.withColumn("back", back).filter(F.col("back") <= n).select("symbol", F.col("date").cast("date").alias("d"), F.round("close", 4).alias("c"))
