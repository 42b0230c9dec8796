"""Standardising scraped tables and keeping the history unique."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import strip, unescaped, weight_number

# fixed values: words of headers; the first column whose header contains one of them becomes the contract's column
HEADER_WORDS = {
    "ticker": ("symbol", "identifier", "stock ticker", "ticker"),
    "name": ("security name", "company", "holding", "description", "name"),
    "weight": ("weighting", "% weight", "weight %", "% net assets", "% of net assets", "weight", "% tna", "% market value"),
}
# fixed values: kinds of securities that aren't holdings
SKIPPED_TYPES = (
    "cash & equivalents", "cash", "cash equivalent", "fx forward", "futures", "option", "swap", "repurchase agreement", "treasury bill", "money market fund, taxable",
    "money market fund",
)
VENDOR = (
    "effectiveDate string, effectiveBusinessDate string, totalNumberOfHoldings bigint, cusip string, holdings array<struct<ticker: string, issuerName: string, units: double, "
    "percentageOfTotalNetAssets: double, securityTypeName: string, cusip: string, marketValue: double>>"
)


def header_map(columns: list[str]) -> dict[str, str]:
    """Contract name -> given header. A column serves one contract name at most."""
    found: dict[str, str] = {}
    for name, words in HEADER_WORDS.items():
        for c in columns:
            # what an earlier contract name has taken goes by that name from then on
            own = next((n for n, h in found.items() if h == c), c.strip().lower())
            if any(w in own for w in words):
                found[name] = c
                break
    return found


def standardised(df: DataFrame, fund: Column, as_of: Column, scraped: Column) -> DataFrame | None:
    """A scraped table in contract form; None if no header names a ticker.

    Weights above 1 anywhere in a fund's table mean that it is in percent; without a weight column all weights are 0.
    """
    names = header_map(df.columns)
    if "ticker" not in names:
        return None
    at = lambda n: F.col(f"`{names[n]}`").cast("string") if n in names else F.lit(None).cast("string")
    rows = df.select(fund.alias("ETF_Ticker"), strip(at("ticker")).alias("ticker"), strip(at("name")).alias("name"), weight_number(at("weight")).alias("w"), as_of.alias("Holdings_As_Of"), scraped.alias("Date_Scraped"))
    top = F.max("w").over(Window.partitionBy("ETF_Ticker", "Holdings_As_Of"))
    return rows.withColumn("weight", F.when(top > 1, F.col("w") / 100).otherwise(F.col("w"))).select("ETF_Ticker", "ticker", "name", "weight", "Holdings_As_Of", "Date_Scraped")


def vendor_holdings(payloads: DataFrame) -> DataFrame:
    """(etf, payload JSON text) -> contract rows: no cash-like kinds, weights of more than 0, entities decoded."""
    p = payloads.select("etf", F.from_json("payload", VENDOR).alias("p"))
    rows = p.select("etf", F.coalesce("p.effectiveBusinessDate", "p.effectiveDate").alias("d"), F.explode("p.holdings").alias("h"))
    ticker = strip(F.coalesce("h.ticker", F.lit("")))
    weight = F.round(F.col("h.percentageOfTotalNetAssets") / 100, 6)
    kept = rows.filter(~strip(F.lower(F.coalesce("h.securityTypeName", F.lit("")))).isin(list(SKIPPED_TYPES)) & (ticker != "") & (F.lower(ticker) != "cash") & (weight > 0))
    return kept.select(F.col("etf").alias("ETF_Ticker"), ticker.alias("ticker"), unescaped(F.col("h.issuerName")).alias("name"), weight.alias("weight"), F.coalesce(F.try_to_timestamp("d").cast("date"), F.current_date()).alias("Holdings_As_Of"))


def vendor_rows(payloads: DataFrame) -> DataFrame:
    """All holdings of a payload with their 1-based position; a cusip other than the one asked for is an error."""
    p = payloads.select("etf", "cusip", F.from_json("payload", VENDOR).alias("p"))
    checked = p.withColumn("cusip", F.when(F.coalesce(F.col("p.cusip"), F.col("cusip")) == F.col("cusip"), F.col("cusip")).otherwise(F.raise_error(F.concat(F.lit("cusip mismatch for "), F.col("etf")))))
    rows = checked.select("etf", "cusip", "p.effectiveDate", "p.effectiveBusinessDate", "p.totalNumberOfHoldings", F.posexplode("p.holdings").alias("pos", "h"))
    return rows.select(
        F.col("effectiveDate").alias("effective_date"), F.col("effectiveBusinessDate").alias("effective_biz_date"), F.col("etf").alias("etf_ticker"), F.col("cusip").alias("etf_cusip"),
        F.col("totalNumberOfHoldings").alias("total_holdings"), (F.col("pos") + 1).alias("rank"), F.col("h.ticker").alias("ticker"), F.col("h.issuerName").alias("issuer_name"),
        F.col("h.units").alias("shares"), F.col("h.percentageOfTotalNetAssets").alias("pct_tna"), F.col("h.securityTypeName").alias("security_type"), F.col("h.cusip").alias("holding_cusip"),
        F.col("h.marketValue").alias("market_value_usd"),
    )


def arbitrated(primary: DataFrame, backup: DataFrame) -> DataFrame:
    """Of each fund the primary or the backup table: the backup if the primary is empty, or has fewer than 5 rows and the backup more, or
    if the backup is newer, unless it has at most 15 rows and the primary more than 15."""
    size = lambda df, n, d: df.groupBy("ETF_Ticker").agg(F.count(F.lit(1)).alias(n), F.max("Holdings_As_Of").alias(d))
    both = size(primary, "np", "dp").join(size(backup, "nb", "db"), "ETF_Ticker", "full").fillna(0, ["np", "nb"])
    newer = (F.col("db") > F.col("dp")) & ~((F.col("nb") <= 15) & (F.col("np") > 15))
    use = (F.col("np") == 0) | ((F.col("np") < 5) & (F.col("nb") > 5)) | F.coalesce(newer, F.lit(False))
    choice = both.select("ETF_Ticker", (use & (F.col("nb") > 0)).alias("use_backup"))
    pick = lambda df, want: df.join(choice.filter(F.col("use_backup") == want).select("ETF_Ticker"), "ETF_Ticker", "left_semi")
    return pick(primary, False).withColumn("origin", F.lit("primary")).unionByName(pick(backup, True).withColumn("origin", F.lit("backup")))


def keep_last(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """Of rows with equal keys the one loaded last. Each task keeps one row a key before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(sequence)).alias("r"))
    return last.select(*keys, *[F.col(f"r.`{c}`").alias(c) for c in rest])


def new_only(incoming: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys aren't known yet (idempotent appends and the new-data check)."""
    return incoming.join(known.select(*keys).distinct(), keys, "left_anti")


def load_status(incoming: DataFrame, known: DataFrame | None, asked: list[str], *, dry_run: bool = False) -> DataFrame:
    """fund, rows, status of each fund asked for: empty (no rows came), dry_run, skipped (its date is loaded already) or written."""
    spark = incoming.sparkSession
    funds = spark.createDataFrame([(f,) for f in asked], "ETF_Ticker string")
    came = incoming.groupBy("ETF_Ticker").agg(F.count(F.lit(1)).alias("rows"), F.max("Holdings_As_Of").alias("Holdings_As_Of"))
    rows = funds.join(came, "ETF_Ticker", "left")
    if known is None:
        rows = rows.withColumn("there", F.lit(False))
    else:
        dates = known.select("ETF_Ticker", "Holdings_As_Of").distinct().withColumn("there", F.lit(True))
        rows = rows.join(dates, ["ETF_Ticker", "Holdings_As_Of"], "left")
    status = F.when(F.col("rows").isNull(), "empty").when(F.lit(dry_run), "dry_run").when(F.coalesce("there", F.lit(False)), "skipped").otherwise("written")
    return rows.select("ETF_Ticker", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"), status.alias("status"))


def series_update(known: DataFrame | None, observations: DataFrame) -> DataFrame:
    """A series table with new observations (symbol, date, value as text): only days after the last known one, "." and what isn't a
    number left out, the last loaded row of a day staying. Columns symbol, date, close."""
    fresh = observations.select(
        "symbol", F.col("date").cast("date").alias("date"), F.when(F.col("value") != ".", F.col("value").try_cast("double")).alias("close"), F.monotonically_increasing_id().alias("load_seq")
    ).dropna(subset=["symbol", "date", "close"])
    if known is None:
        return keep_last(fresh, ["symbol", "date"], "load_seq").drop("load_seq")
    ends = known.groupBy("symbol").agg(F.max("date").alias("end"))
    later = fresh.join(ends, "symbol", "left").filter("end IS NULL OR date > end").drop("end")
    both = known.select("symbol", "date", "close", F.lit(-1).cast("bigint").alias("load_seq")).unionByName(later.select("symbol", "date", "close", "load_seq"))
    return keep_last(both, ["symbol", "date"], "load_seq").drop("load_seq")


def subset(df: DataFrame, column: str, wanted: list[str] | None, known: list[str]) -> DataFrame:
    """The rows of the wanted names, all of them if None; a name that isn't known is an error."""
    unknown = sorted(set(wanted or ()) - set(known))
    if unknown:
        raise ValueError(f"unknown: {', '.join(unknown)}")
    return df if wanted is None else df.filter(F.col(column).isin(wanted))


def ticker_metadata(history: DataFrame, known: DataFrame) -> DataFrame:
    """A metadata row for each ticker of a history; "Unknown" and no market value where the source has nothing on it."""
    rows = history.filter("ticker IS NOT NULL").select("ticker").distinct().join(known.dropDuplicates(["ticker"]), "ticker", "left")
    return rows.select("ticker", *[F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("Unknown")).alias(c) for c in ("sector", "industry", "country")], F.col("market_cap_usd").cast("double").alias("market_cap_usd"))
