"""Cleaning a holdings history: guards, block lists, ticker rewriting, merging after renames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.cleaning import clean_ticker, name_allowed, renamed, ticker_allowed
from ..schema import KEY, validate_columns


def in_universe(df: DataFrame, cfg: Config) -> DataFrame:
    """Rows of configured funds. The list is the configuration's, so it is pushed to the scan as a filter."""
    return df.filter(F.col("ETF_Ticker").isin([f.ticker for f in cfg.funds]))


def with_dates(df: DataFrame) -> DataFrame:
    """The contract's columns, dates parsed leniently (null where they can't be)."""
    out = validate_columns(df)
    if dict(df.dtypes)["Holdings_As_Of"] == "string":
        out = out.withColumn("Holdings_As_Of", F.try_to_timestamp("Holdings_As_Of").cast("date"))
    return out.withColumn("Holdings_As_Of", F.col("Holdings_As_Of").cast("date"))


def parsed(df: DataFrame) -> DataFrame:
    """Dates parsed leniently; rows without date, ticker or weight dropped."""
    return with_dates(df).dropna(subset=["Holdings_As_Of", "ticker", "weight"])


def cleaned(df: DataFrame, cfg: Config) -> DataFrame:
    """Allowed rows with clean tickers. With renames, rows of one key aren't merged yet: raw_ticker is what merged() orders names by."""
    rules = cfg.sanitizer
    kept = df.filter(ticker_allowed(F.col("ticker"), rules) & name_allowed(F.col("name"), rules))
    clean = kept.withColumn("raw_ticker", F.col("ticker")).withColumn("ticker", clean_ticker(F.col("ticker"), rules)).filter("ticker != ''")
    return clean.withColumn("ticker", renamed(F.col("ticker"), rules)) if rules.ticker_renames else clean.drop("raw_ticker")


def unique(clean: DataFrame) -> DataFrame:
    """cleaned() rows, merged where they aren't yet."""
    return merged(clean, F.col("raw_ticker")) if "raw_ticker" in clean.columns else clean


def sanitize(df: DataFrame, cfg: Config) -> DataFrame:
    return unique(cleaned(df, cfg))


def merged(df: DataFrame, order: Column) -> DataFrame:
    """One row for each key: weights summed, the first name that isn't null by order, the latest scrape date."""
    named = F.when(F.col("name").isNotNull(), order)
    return df.dropna(subset=list(KEY)).groupBy(*KEY).agg(
        F.min_by("name", named).alias("name"), F.sum("weight").alias("weight"), F.max("Date_Scraped").alias("Date_Scraped")
    ).select("ETF_Ticker", "ticker", "name", "weight", "Holdings_As_Of", "Date_Scraped")


def scorable(history: DataFrame, cfg: Config) -> DataFrame:
    """History parsed and restricted to the universe; cleaned and merged by whoever needs it, after the dates are chosen."""
    return in_universe(parsed(history), cfg)


def prepared(history: DataFrame, cfg: Config) -> DataFrame:
    """History ready for scoring: parsed, restricted to the universe, sanitised."""
    return sanitize(scorable(history, cfg), cfg)
