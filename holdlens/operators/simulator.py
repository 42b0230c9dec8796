"""Leveraged products: compounded paths of daily returns for a whole grid of parameters in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def daily_returns(prices: DataFrame, days: int = 252) -> DataFrame:
    """symbol, i, date, r of the last days closes; returns that aren't finite are dropped, dates stay with their returns."""
    back = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("date")))
    rows = prices.filter(F.col("close").isNotNull()).withColumn("back", back).filter(F.col("back") <= days)
    by_day = Window.partitionBy("symbol").orderBy("date")
    before = F.lag("close").over(by_day)
    r = F.try_divide(F.col("close") - before, F.nullif(before, F.lit(0.0)))
    rows = rows.withColumn("r", r).filter(F.col("r").isNotNull() & ~F.isnan("r") & (F.abs("r") < float("inf")))
    return rows.select("symbol", F.row_number().over(by_day).alias("i"), F.col("date").cast("date").alias("date"), "r")


def synthetic_returns(spark: SparkSession, *, days: int = 252, volatility: float = 1.5, drift: float = 10.0) -> DataFrame:
    """The deterministic path: mean + sigma * sin(0.31 i), at least 21 days; volatility in % a day, drift in % a year."""
    rows = spark.range(max(21, days)).withColumnRenamed("id", "i")
    return rows.select(F.lit("SYNTHETIC").alias("symbol"), F.col("i"), F.lit(None).cast("date").alias("date"), (F.lit(drift / 100 / 252) + F.lit(volatility / 100) * F.sin(0.31 * F.col("i"))).alias("r"))


def simulate(returns: DataFrame, leverages: list[float], *, ter: float = 0.95, nav0: float = 100.0) -> DataFrame:
    """symbol, leverage, i, date, nav, underlying: products of daily factors (which may be 0 or less)."""
    rows = returns.withColumn("leverage", F.explode(F.array(*[F.lit(float(x)) for x in leverages])))
    path = Window.partitionBy("symbol", "leverage").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    grown = lambda f: F.lit(nav0) * F.product(f).over(path)
    return rows.select("symbol", "leverage", "i", "date", "r", grown(1 + F.col("leverage") * F.col("r") - F.lit(ter / 100 / 252)).alias("nav"), grown(1 + F.col("r")).alias("underlying"))


def summary(paths: DataFrame, *, nav0: float = 100.0) -> DataFrame:
    """Totals, drag against leverage times the underlying, volatility and the theoretical decay of each path."""
    end = paths.groupBy("symbol", "leverage").agg(
        F.max_by("nav", "i").alias("final_nav"), F.max_by("underlying", "i").alias("u"), F.stddev_pop("r").alias("s"), F.count(F.lit(1)).alias("sessions")
    )
    pct: Column = (F.col("final_nav") / nav0 - 1) * 100
    under: Column = (F.col("u") / nav0 - 1) * 100
    lev = F.col("leverage")
    return end.select(
        "symbol", "leverage", F.round(pct, 4).alias("etn_total_pct"), F.round(under, 4).alias("underlying_total_pct"), F.round(lev * under, 4).alias("expected_lev"),
        F.round(pct - lev * under, 4).alias("drag_pct"), F.round(F.col("s") * 100, 6).alias("sigma_d"), F.round(F.col("s") * F.sqrt(F.lit(252.0)) * 100, 4).alias("sigma_a"),
        F.round(0.5 * (lev * lev - F.abs(lev)) * F.col("s") * F.col("s") * 252 * 100, 6).alias("annual_decay"), F.round("final_nav", 4).alias("final_nav"), "sessions",
    )
