"""Sources, sinks and the streaming ingest."""

import json

import pytest
from pyspark.sql import functions as F

from holdlens import jobs
from holdlens.config import DEFAULT
from holdlens.operators import ingest
from holdlens.plans import documents
from holdlens.schema import HOLDINGS
from holdlens.sources import readers, sinks
from holdlens.streaming.ingest import read_history, stream_history

HEAD = "ETF_Ticker,ticker,name,weight,Holdings_As_Of,Date_Scraped\n"


def test_csv_keeps_tickers_as_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEAD + 'EEMO,000660,"Topco, Ltd.",0.0562,2026-05-01,2026-05-02\nEEMO,NA,x,0.1,2026-05-01,2026-05-02\n')
    rows = {r["ticker"]: r for r in readers.holdings_csv(spark, str(tmp_path)).collect()}
    assert rows["000660"]["name"] == "Topco, Ltd." and "NA" in rows


def test_preamble_and_html(spark, tmp_path):
    (tmp_path / "p.csv").write_text('Fund report\nas of today\nTicker,Name,Weight\nA,"Alpha\n, Inc",1.5%\n\nB,Beta\n')
    got = readers.csv_after_preamble(spark, str(tmp_path / "p.csv"), "t string, n string, w string").collect()
    assert [tuple(r) for r in got] == [("A", "Alpha\n, Inc", "1.5%"), ("B", "Beta", None)]
    page = "<table><tr><td>x</td></tr></table><table><tr><th>Ticker</th><th>Weight</th></tr><tr><td>A</td><td>1%</td></tr></table>"
    got = readers.html_tables(spark.createDataFrame([("f", page), ("g", None)], "k string, html string")).orderBy("row").collect()
    assert [r["cells"] for r in got] == [["Ticker", "Weight"], ["A", "1%"]]
    row = lambda *cells, tag="td": "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in cells) + "</tr>"
    plain = lambda n: "<table>" + row("a", "b", tag="th") + row("1", "2") * n + "</table>"
    late = "<table>" + row("My ticker symbol") + row("x") * 2 + row("% TNA", "Holding") + row("A", "B") + "</table>"
    pages = spark.createDataFrame([("small", plain(20)), ("large", plain(21)), ("longer", plain(26)), ("late", late)], "k string, html string")
    size = lambda kind: {k: sum(r["key"] == k for r in readers.html_tables(pages, kind=kind).collect()) for k in ("small", "large", "longer", "late")}
    assert size("generic") == {"small": 0, "large": 22, "longer": 27, "late": 0} and size("alpha") == {"small": 0, "large": 0, "longer": 27, "late": 0}
    assert size("first_row") == dict.fromkeys(("small", "large", "longer", "late"), 0) and size("first_rows")["late"] == 2


def test_series_and_targets(spark, tmp_path):
    spark.createDataFrame([("2026-01-02", 1.0, 2.0, 0.5, 1.5, 10)], "Date string, Open double, High double, Low double, Close double, Volume bigint").coalesce(1).write.parquet(str(tmp_path / "raw"))
    part = next((tmp_path / "raw").glob("part-*.parquet"))
    (tmp_path / "px").mkdir()
    (tmp_path / "px/yf_SPX.parquet").write_bytes(part.read_bytes())
    row = readers.series_parquet(spark, str(tmp_path / "px")).first()
    assert (row["symbol"], row["close"]) == ("SPX", 1.5)
    (tmp_path / "t.json").write_text(json.dumps([{"ticker": "A"}, {"ticker": "B", "enabled": False}]))
    assert [r["ticker"] for r in readers.scrape_targets(spark, str(tmp_path / "t.json")).collect()] == ["A"]


def test_vendor_payload(spark):
    h = lambda t, p, kind="Common Stock": {"ticker": t, "issuerName": "A &amp; B", "units": 1.0, "percentageOfTotalNetAssets": p, "securityTypeName": kind, "cusip": "c", "marketValue": 2.0}
    text = json.dumps({"effectiveDate": "2026-05-02", "effectiveBusinessDate": "2026-05-01", "cusip": "C1", "totalNumberOfHoldings": 4, "holdings": [h("A", 4.5), h("B", 0.0), h("", 1.0), h("D", 2.0, "Cash")]})
    df = spark.createDataFrame([("PIE", "C1", text)], "etf string, cusip string, payload string")
    rows = ingest.vendor_holdings(df).collect()
    assert [(r["ticker"], r["name"], r["weight"], str(r["Holdings_As_Of"])) for r in rows] == [("A", "A & B", 0.045, "2026-05-01")]
    assert [r["rank"] for r in ingest.vendor_rows(df).collect()] == [1, 2, 3, 4]
    with pytest.raises(Exception, match="cusip mismatch"):
        ingest.vendor_rows(df.replace("C1", "C2", "cusip")).collect()


def test_append_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([("A", "2026-05-01", 1.0)], "etf string, d string, w double")
    for _ in range(2):
        sinks.append_new(df, str(tmp_path / "t"), ["etf", "d"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    both = sinks.upserted(df, df.replace(1.0, 2.0), ["etf", "d"])
    assert [r["w"] for r in both.collect()] == [2.0]
    sinks.write_document(df.selectExpr("etf", "CAST(NULL AS INT) AS x"), str(tmp_path / "j"))
    assert json.loads("".join(p.read_text() for p in (tmp_path / "j").glob("part-*"))) == {"etf": "A", "x": None}


def test_stream_keeps_last(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i, w in enumerate((0.1, 0.2)):
        (tmp_path / f"in/{i}.csv").write_text(HEAD + f"EEMO,A,x,{w},2026-05-01,2026-05-02\n")
        stream_history(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert [r["weight"] for r in read_history(spark, str(tmp_path / "out")).collect()] == [0.2]


def test_headers(spark):
    assert ingest.header_map(["Identifier", "Security Name", "% TNA"]) == {"ticker": "Identifier", "name": "Security Name", "weight": "% TNA"}
    assert ingest.header_map(["Security Type", "Security Name", "Ticker", "Change %", "Weight"]) == {"ticker": "Ticker", "name": "Security Name", "weight": "Weight"}
    one = spark.createDataFrame([("a", "5%")], "Name string, Weight string")
    assert ingest.standardised(one, F.lit("X"), F.current_date(), F.current_date()) is None
    none = ingest.standardised(one.withColumnRenamed("Weight", "Symbol"), F.lit("X"), F.current_date(), F.current_date()).first()
    assert (none["ticker"], none["weight"]) == ("5%", 0.0)


def test_series_update_and_statuses(spark):
    known = spark.createDataFrame([("A", "2026-01-02", 1.0)], "symbol string, date string, close double").withColumn("date", F.col("date").cast("date"))
    new = spark.createDataFrame([("A", "2026-01-02", "9"), ("A", "2026-01-03", "."), ("A", "2026-01-04", "2.5"), ("B", "2026-01-01", "3"), ("B", "2026-01-05", "x"), ("B", None, "1")], "symbol string, date string, value string")
    got = sorted((r["symbol"], str(r["date"]), r["close"]) for r in ingest.series_update(known, new).collect())
    assert got == [("A", "2026-01-02", 1.0), ("A", "2026-01-04", 2.5), ("B", "2026-01-01", 3.0)]
    assert ingest.series_update(None, new.limit(0)).count() == 0
    rows = spark.createDataFrame([("X", "2026-01-02"), ("Y", "2026-01-02")], "ETF_Ticker string, Holdings_As_Of string")
    status = lambda **o: {r["ETF_Ticker"]: r["status"] for r in ingest.load_status(rows, rows.filter("ETF_Ticker = 'X'"), ["X", "Y", "Z"], **o).collect()}
    assert status() == {"X": "skipped", "Y": "written", "Z": "empty"} and status(dry_run=True) == {"X": "dry_run", "Y": "dry_run", "Z": "empty"}
    with pytest.raises(ValueError, match="unknown: Q"):
        ingest.subset(rows, "ETF_Ticker", ["X", "Q"], ["X", "Y"])
    assert ingest.subset(rows, "ETF_Ticker", ["X"], ["X", "Y"]).count() == 1
    meta = ingest.ticker_metadata(rows.withColumn("ticker", F.col("ETF_Ticker")), spark.createDataFrame([("X", "Tech", "", None, 5.0)], "ticker string, sector string, industry string, country string, market_cap_usd double"))
    assert {r["ticker"]: tuple(r)[1:] for r in meta.collect()} == {"X": ("Tech", "Unknown", "Unknown", 5.0), "Y": ("Unknown", "Unknown", "Unknown", None)}


def test_archive(spark, tmp_path):
    row = lambda day, w: spark.createDataFrame([("X", "A", day, w)], "ETF_Ticker string, ticker string, d string, w double")
    for day, w in (("2026-01-02", 0.1), ("2026-01-03", 0.2)):
        sinks.archive_day(row(day, w), str(tmp_path), day)
    assert [r["w"] for r in spark.read.parquet(str(tmp_path / "latest")).collect()] == [0.2]
    assert sorted(r["w"] for r in spark.read.parquet(str(tmp_path / "history")).collect()) == [0.1, 0.2]
    sinks.archive_day(row("2026-01-03", 0.3), str(tmp_path), "2026-01-03", backup=row("2026-01-03", 0.4))
    assert sorted(r["w"] for r in spark.read.parquet(str(tmp_path / "history")).collect()) == [0.1, 0.3]
    assert [r["w"] for r in spark.read.parquet(str(tmp_path / "backups")).collect()] == [0.4]


def test_jobs_write_documents(spark, tmp_path):
    rows = [HEAD]
    for i in range(12):
        for fund, ticker, w in (("CSD", "AAA", 0.5 + i / 100), ("QMOM", "AAA", 0.4), ("SPHQ", "AAA", 0.3), ("SPMO", "AAA", 0.2), ("SPMO", "BBB", 0.1)):
            rows.append(f"{fund},{ticker},{ticker} Inc,{w},2026-05-{i + 1:02d},2026-05-{i + 1:02d}\n")
    (tmp_path / "h.csv").write_text("".join(rows))
    assert jobs.main(["build", "--source", str(tmp_path / "h.csv"), "--output", str(tmp_path / "out")], spark) == 0
    read = lambda name: [json.loads(x) for p in (tmp_path / f"out/{name}.json").glob("part-*") for x in p.read_text().splitlines()]
    board = {r["ticker"]: r for r in read("leaderboard")}
    assert board["AAA"]["flag"] == "HIGH_CONVICTION" and set(board["AAA"]["score_deltas_by_period"]) >= {"7", "YTD"}
    (meta,) = read("metadata")
    assert meta["source_rows_raw"] == 60 and len(meta["snapshot_dates"]) == 12 and meta["today"]["tickers"] == 2 and meta["yesterday"]["high_conviction"] == 1
    assert spark.read.parquet(str(tmp_path / "out/leaderboard.parquet")).count() == 2
    px = spark.createDataFrame([(f"2026-05-{i + 1:02d}", 1.0, 1.0, 1.0, 10.0 + i, 1) for i in range(30)], "Date string, Open double, High double, Low double, Close double, Volume bigint")
    (tmp_path / "px").mkdir()
    for symbol in ("AAA", "SPX"):
        px.coalesce(1).write.parquet(str(tmp_path / f"raw-{symbol}"))
        (tmp_path / f"px/yf_{symbol}.parquet").write_bytes(next((tmp_path / f"raw-{symbol}").glob("part-*.parquet")).read_bytes())
    assert jobs.main(["backtest", "--source", str(tmp_path / "h.csv"), "--output", str(tmp_path / "bt"), "--prices", str(tmp_path / "px"), "--hold-days", "5"], spark) == 0
    strategies = {r["strategy"]: r for p in (tmp_path / "bt/strategies.json").glob("part-*") for r in map(json.loads, p.read_text().splitlines())}
    assert set(strategies) == set(documents.STRATEGIES) and strategies["hc_entry"]["trades"][0]["ticker"] == "AAA" and strategies["baseline"]["stats"]["n_trades"] > 0
    (tmp_path / "list.json").write_text('{"symbol": "SPX", "label": "Index", "kind": "indices"}\n{"symbol": "GONE", "label": "Gone", "kind": "fx"}\n{"symbol": "R1", "label": "Rate", "kind": "rates", "prefix": "fred_"}\n')
    assert jobs.main(["markets", "--source", str(tmp_path / "px"), "--output", str(tmp_path / "mk"), "--list", str(tmp_path / "list.json")], spark) == 0
    (series,) = [json.loads(x) for p in (tmp_path / "mk/markets.json").glob("part-*") for x in p.read_text().splitlines()]
    assert (series["symbol"], series["label"], series["stats"]["sessions_observed"], len(series["log"])) == ("SPX", "Index", 30, 30)
    with pytest.raises(ValueError, match="two snapshots"):
        documents.back_test(spark.read.schema(HOLDINGS).csv(str(tmp_path / "h.csv"), header=True).filter("Holdings_As_Of = '2026-05-01'"), spark.createDataFrame([], "symbol string, date date, close double"), DEFAULT)
