"""Column contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame

HOLDINGS = "ETF_Ticker string, ticker string, name string, weight double, Holdings_As_Of date, Date_Scraped date"
REQUIRED = ("ETF_Ticker", "ticker", "name", "weight", "Holdings_As_Of", "Date_Scraped")
PRICES = "Date string, Open double, High double, Low double, Close double, Volume bigint"
METADATA = "ticker string, sector string, industry string, country string, market_cap_usd double"
KEY = ("ETF_Ticker", "ticker", "Holdings_As_Of")


def validate_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df
