"""Sources: explicit schemas everywhere, so no pass over the data is spent on inference."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import HOLDINGS, METADATA, PRICES


def holdings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Tickers stay text, "NA" too; files of the five-column variant get a null as-of date."""
    return spark.read.schema(HOLDINGS).option("header", True).option("enforceSchema", False).option("nullValue", "").csv(path)


def legacy_holdings_csv(spark: SparkSession, path: str) -> DataFrame:
    five = HOLDINGS.replace("Holdings_As_Of date, ", "")
    return spark.read.schema(five).option("header", True).csv(path).withColumn("Holdings_As_Of", F.lit(None).cast("date")).select(*[c.split()[0] for c in HOLDINGS.split(", ")])


def holdings_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HOLDINGS).parquet(path)


def series_parquet(spark: SparkSession, folder: str, prefix: str = "yf_", value: str = "Close", *, skip_corrupt: bool = True) -> DataFrame:
    """symbol, date, close of all files <prefix><symbol>.parquet of a folder; only the two columns are read."""
    schema = PRICES if value == "Close" else f"Date string, {value} double"
    raw = spark.read.schema(schema).option("ignoreCorruptFiles", skip_corrupt).option("pathGlobFilter", f"{prefix}*.parquet").parquet(folder)
    name = F.regexp_extract(F.col("_metadata.file_name"), rf"^{prefix}(.+)\.parquet$", 1)
    return raw.select(name.alias("symbol"), F.try_to_timestamp("Date").cast("date").alias("date"), F.col(value).alias("close")).dropna()


def ticker_metadata(spark: SparkSession, path: str | None) -> DataFrame:
    return spark.read.schema(METADATA).option("header", True).csv(path) if path else spark.createDataFrame([], METADATA)


def scrape_targets(spark: SparkSession, path: str) -> DataFrame:
    """Enabled targets of a JSON list; enabled is true by default."""
    schema = "ticker string, cusip string, url string, scraper_type string, enabled boolean"
    return spark.read.schema(schema).json(path, multiLine=True).filter(F.coalesce("enabled", F.lit(True)))


def csv_after_preamble(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV files whose header, a line with Ticker or Symbol, comes within the first 20 lines, or else is the first line.

    schema names the columns in file order. A file is read as one text, so quoted line ends stay within their field; short rows end with nulls.
    """
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                lines = text.splitlines(keepends=True)
                head = next((i for i, x in enumerate(lines[:20]) if "Ticker" in x or "Symbol" in x), 0)
                rows += [r for r in csv.reader(io.StringIO("".join(lines[head:]), newline="")) if any(c.strip() for c in r)][1:]
            yield pa.RecordBatch.from_arrays([pa.array([[c or None for c in r] for r in rows], pa.list_(pa.string()))], ["cells"])

    found = spark.read.text(path, wholetext=True).mapInArrow(cells, "cells array<string>")
    return found.select(*[F.get("cells", F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(T.StructType.fromDDL(schema).fields)])


# fixed values: words of which a header has one, as a whole cell
FIRST_ROW_WORDS = ("ticker", "symbol", "holding", "identifier", "weighting", "cusip")
FIRST_ROWS_WORDS = ("ticker", "symbol", "holding", "identifier", "weight", "% of net assets", "% tna", "% market value")
#: kind -> (words of the header, rows below it that may be the header instead), or rows that a table must have more of
TABLE_KINDS = {"first_row": (FIRST_ROW_WORDS, 1), "first_rows": (FIRST_ROWS_WORDS, 5), "alpha": 25, "generic": 20}


def chosen_table(tables: list[list[tuple[bool, list[str]]]], kind: str) -> list[list[str]]:
    """The first table of that kind, header first; empty if there is none. A table's rows are (all cells are th, cells)."""
    rule = TABLE_KINDS[kind]
    for t in tables:
        headed = bool(t) and t[0][0]
        rows = [cells for _, cells in t]
        if isinstance(rule, int):
            if len(rows) - headed > rule:
                return rows
            continue
        words, below = rule
        for i in range(min(len(rows), below + headed)):
            if any(c.strip().lower() in words for c in rows[i]):
                return rows[i:]
    return []


def html_tables(pages: DataFrame, *, kind: str = "first_row") -> DataFrame:
    """(key, html) -> key, row, cells of the page's table of a kind (TABLE_KINDS); row 0 is its header.

    HTML isn't relational: the parser runs in Python, a batch of pages at a time.
    """
    if kind not in TABLE_KINDS:
        raise ValueError(f"kind must be one of {', '.join(TABLE_KINDS)}")

    class Tables(HTMLParser):
        def __init__(self) -> None:
            super().__init__()
            self.tables: list[list[tuple[bool, list[str]]]] = []
            self.cell: list[str] | None = None

        def handle_starttag(self, tag, attrs):
            if tag == "table":
                self.tables.append([])
            elif tag == "tr" and self.tables:
                self.tables[-1].append((True, []))
            elif tag in ("td", "th") and self.tables and self.tables[-1]:
                self.cell = []
                if tag == "td":
                    self.tables[-1][-1] = (False, self.tables[-1][-1][1])

        def handle_data(self, data):
            if self.cell is not None:
                self.cell.append(data)

        def handle_endtag(self, tag):
            if tag in ("td", "th") and self.cell is not None:
                self.tables[-1][-1][1].append(" ".join("".join(self.cell).split()))
                self.cell = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, numbers, cells = [], [], []
            for key, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parser = Tables()
                parser.feed(html or "")
                for i, row in enumerate(chosen_table(parser.tables, kind)):
                    keys.append(key)
                    numbers.append(i)
                    cells.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(numbers, pa.int32()), pa.array(cells, pa.list_(pa.string()))], ["key", "row", "cells"])

    return pages.select(F.col(pages.columns[0]).cast("string"), F.col(pages.columns[1])).mapInArrow(run, "key string, row int, cells array<string>")


def series_listed(spark: SparkSession, folder: str, listed: list[dict[str, str]]) -> DataFrame:
    """symbol, label, kind, date, close of the listed series (symbol, label, kind, prefix yf_ or fred_) whose files are in a folder; missing files are left out."""
    both = None
    for prefix, value in (("yf_", "Close"), ("fred_", "value")):
        own = [(x["symbol"], x["label"], x["kind"]) for x in listed if x.get("prefix", "yf_") == prefix]
        if not own:
            continue
        names = spark.createDataFrame(own, "symbol string, label string, kind string")
        try:
            rows = series_parquet(spark, folder, prefix, value).join(names, "symbol").select("symbol", "label", "kind", "date", "close")
        except AnalysisException:  # no file of that prefix
            continue
        both = rows if both is None else both.unionByName(rows)
    return both if both is not None else spark.createDataFrame([], "symbol string, label string, kind string, date date, close double")
