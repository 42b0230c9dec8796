"""Entry points: python -m holdlens.jobs build|backtest|markets --source ... --output ..."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import DEFAULT, Config
from .operators.ingest import subset
from .plans import documents
from .sources import readers, sinks

#: Documents that are written as Parquet too.
TABLES = ("leaderboard", "score_panel", "holdings_history")


def history(spark: SparkSession, path: str) -> DataFrame:
    return readers.holdings_parquet(spark, path) if path.rstrip("/").endswith(".parquet") else readers.holdings_csv(spark, path)


def write(found: dict[str, DataFrame], output: str, tables: tuple[str, ...] = TABLES) -> None:
    """Each document as JSON lines in a folder of its name, and the tables as Parquet."""
    for name, df in found.items():
        sinks.write_document(df, f"{output}/{name}.json")
        if name in tables:
            sinks.write_parquet(df, f"{output}/{name}.parquet")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="holdlens", description=__doc__)
    jobs = p.add_subparsers(dest="job", required=True)
    for name in ("build", "backtest", "markets"):
        job = jobs.add_parser(name)
        job.add_argument("--source", required=True, help="history (CSV or Parquet), or the folder of the series")
        job.add_argument("--output", required=True, help="folder of the documents")
        if name != "markets":
            job.add_argument("--config", help="YAML; the default configuration without it")
            job.add_argument("--tickers", nargs="*", help="only these funds")
        if name == "build":
            job.add_argument("--metadata", help="CSV of sectors and countries")
        if name == "backtest":
            job.add_argument("--prices", required=True, help="folder of yf_<symbol>.parquet files")
            job.add_argument("--hold-days", type=int, default=30)
        if name == "markets":
            job.add_argument("--list", required=True, help="JSON lines of symbol, label, kind, prefix")
            job.add_argument("--only", nargs="*", help="only these symbols")
            job.add_argument("--underlyings", nargs="*", default=["SPX", "NDX"], help="symbols of the simulator")
    args = p.parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    if args.job == "markets":
        listed = [{k: v for k, v in r.asDict().items() if v is not None} for r in spark.read.schema("symbol string, label string, kind string, prefix string").json(args.list).collect()]
        rows = subset(readers.series_listed(spark, args.source, listed), "symbol", args.only, [x["symbol"] for x in listed])
        write(documents.market(rows, args.underlyings), args.output)
        return 0
    cfg = Config.from_yaml(args.config) if args.config else DEFAULT
    rows = subset(history(spark, args.source), "ETF_Ticker", args.tickers, [f.ticker for f in cfg.funds])
    if args.job == "build":
        write(documents.site(rows, cfg, readers.ticker_metadata(spark, args.metadata) if args.metadata else None, args.source), args.output)
    else:
        prices = readers.series_parquet(spark, args.prices)
        write(documents.back_test(rows, prices.select("symbol", F.col("date"), "close"), cfg, args.hold_days), args.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
