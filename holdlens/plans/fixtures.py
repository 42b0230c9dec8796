"""Canonical inputs derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import shared
from ..config import DEFAULT, Config, Fund

FUNDS_F1 = tuple(Fund(*f) for f in (("signup", "Scout", 40.0), ("purchase", "Quant", 40.0), ("view", "Quality", 30.0), ("click", "Trend", 10.0), ("error", "Blob", 2.0)))
CFG_F1: Config = replace(DEFAULT, funds=FUNDS_F1, quality_funds=("view", "signup"))
CFG_F2: Config = replace(DEFAULT, leaderboard_lookback_days=3700)
HOLD_DAYS = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The history that f derives, written once in an application: a history is a stored table, not a query over events."""
    known: dict[tuple[str, str], DataFrame] = {}

    @wraps(f)
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in known:
            known[key] = shared.written(f(spark, sf_dir), f.__name__)
        return known[key]

    return read


def _ordered_sum(column: str, key: list[str], order: list[str]) -> Column:
    """The sum over each key, added up in the given order."""
    return F.sum(column).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


@stored
def holdings_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five funds (event types) over 30 days; a holding's weight is its share of the day's value.

    Ranks compare weights to the last bit, so the sums are of a fixed order, whatever the layout of the table: a holding's values by event, a day's holdings by
    their first event. That is the order of a scan on one thread. Windows, not arrays: they spill.
    """
    key = ["ETF_Ticker", "ticker", "Holdings_As_Of"]
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("ETF_Ticker"), F.concat(F.lit("U"), F.col("user_id")).alias("ticker"), F.col("ts").cast("date").alias("Holdings_As_Of"), "event_id", "user_id", "value"
    )
    cells = rows.withColumn("v", _ordered_sum("value", key, ["event_id", "value"])).groupBy(*key).agg(
        F.max("v").alias("v"), F.min("user_id").alias("user_id"), F.min("event_id").alias("first_event")
    )
    total = _ordered_sum("v", ["ETF_Ticker", "Holdings_As_Of"], ["first_event", "ticker"])
    return cells.select("ETF_Ticker", "ticker", F.concat(F.lit("User "), F.col("user_id")).alias("name"), (F.col("v") / total).alias("weight"), "Holdings_As_Of", F.col("Holdings_As_Of").alias("Date_Scraped"))


@stored
def holdings_f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """21 funds over months of shipments: the volume fixture."""
    names = F.array(*[F.lit(f.ticker) for f in DEFAULT.funds])
    rows = table(spark, sf_dir, "lineitem").select(
        F.get(names, (F.col("l_suppkey") % 21).cast("int")).alias("ETF_Ticker"), F.concat(F.lit("P"), F.col("l_partkey")).alias("ticker"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("Holdings_As_Of"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("v"),
    )
    cells = rows.groupBy("ETF_Ticker", "ticker", "Holdings_As_Of").agg(F.sum("v").alias("v"))
    total = F.sum("v").over(Window.partitionBy("ETF_Ticker", "Holdings_As_Of"))
    return cells.select("ETF_Ticker", "ticker", F.col("ticker").alias("name"), (F.col("v") / total).alias("weight"), "Holdings_As_Of", F.col("Holdings_As_Of").alias("Date_Scraped"))


def prices_f3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, date, close of each user and of the index SPX (all users)."""
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("U"), F.col("user_id")).alias("symbol"), F.col("ts").cast("date").alias("date"), "value")
    both = e.unionByName(e.withColumn("symbol", F.lit("SPX")))
    return both.groupBy("symbol", "date").agg(F.avg("value").alias("close"))


def _close(value: Column) -> Column:
    """The mean to 4 digits; rounded as a decimal, since many means are ties, on whose side a sum of doubles ends by chance."""
    return F.round(F.avg(value).cast("decimal(24,8)"), 4).cast("double").alias("close")


def series_f4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("symbol"), F.col("ts").cast("date").alias("date")).agg(_close(F.col("value")))


def series_f5(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").groupBy(F.concat("l_returnflag", "l_linestatus").alias("symbol"), F.col("l_shipdate").cast("date").alias("date")).agg(_close(price))


def metadata_f6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sector and country of each customer."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, sf_dir, "customer").join(nations, "c_nationkey").select(
        F.concat(F.lit("U"), F.col("c_custkey")).alias("ticker"), F.col("c_mktsegment").alias("sector"), F.lit("Unknown").alias("industry"), F.col("n_name").alias("country"),
        F.col("c_acctbal").cast("double").alias("market_cap_usd"),
    )


def loads_f7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_type", "user_id", F.col("ts").cast("date").alias("day"), "value", F.col("event_id").alias("load_seq"))
