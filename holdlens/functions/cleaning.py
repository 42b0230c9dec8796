"""Column expressions that clean tickers, names, weights and dates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Sanitizer


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def ticker_allowed(ticker: Column, rules: Sanitizer) -> Column:
    """Not blank, not "nan" and not on the list, before any rewriting."""
    t = strip(ticker)
    blocked = [x.strip().lower() for x in rules.blocked_tickers]
    ok = ticker.isNotNull() & (t != "") & (F.lower(t) != "nan")
    return ok & ~F.lower(t).isin(blocked) if blocked else ok


def name_allowed(name: Column, rules: Sanitizer) -> Column:
    n = F.upper(F.coalesce(name, F.lit("")))
    ok = reduce(lambda a, p: a & ~F.contains(n, F.lit(p.upper())), rules.blocked_name_patterns, F.lit(True))
    exact = [x.strip().upper() for x in rules.blocked_name_exact]
    return ok & ~strip(n).isin(exact) if exact else ok


def clean_ticker(ticker: Column, rules: Sanitizer) -> Column:
    """Punctuation rewritten in order, runs of dots collapsed, dots stripped."""
    t = reduce(lambda c, r: F.replace(c, F.lit(r[0]), F.lit(r[1])), rules.ticker_replacements, strip(ticker))
    # a pattern costs much more than a search for two dots, which are rare
    return F.btrim(F.when(F.contains(t, F.lit("..")), F.regexp_replace(t, r"\.{2,}", ".")).otherwise(t), F.lit("."))


def renamed(ticker: Column, rules: Sanitizer) -> Column:
    """A clean ticker's present name."""
    return reduce(lambda c, r: c.when(ticker == r[0], F.lit(r[1])), rules.ticker_renames, F.when(F.lit(False), ticker)).otherwise(ticker)


def weight_number(text: Column) -> Column:
    """"4.5%" or "1,234" as a number; 0 where it isn't one."""
    return F.coalesce(F.regexp_replace(text, "[%,]", "").try_cast("double"), F.lit(0.0))


def as_of_date(text: Column) -> Column:
    """The first M/D/YYYY or Month D YYYY of a label such as "As of: March 4, 2026", or a label that is M-D-YYYY; null if there is none."""
    bare = F.trim(F.regexp_replace(text, r"(?i)as of|date|[:,-]", " "))
    found = F.regexp_extract(bare, r"(\d{1,2}/\d{1,2}/\d{4}|[A-Z][a-z]+\s+\d{1,2}\s+\d{4})", 1)
    clean = F.initcap(F.regexp_replace(F.when(found != "", found).otherwise(bare), r"\s+", " "))
    return F.coalesce(*[F.try_to_timestamp(clean, F.lit(f)).cast("date") for f in ("M/d/yyyy", "MMMM d yyyy", "MMM d yyyy", "M d yyyy")])


def holdings_label_date(html: Column) -> Column:
    """The date in "# of holdings (as of 3/4/2026)" of a page."""
    return F.try_to_timestamp(F.regexp_extract(html, r"(?i)# of holdings\s*\(as of\s*(\d{1,2}/\d{1,2}/\d{4})\)", 1), F.lit("M/d/yyyy")).cast("date")


def unescaped(text: Column) -> Column:
    """The common HTML entities as characters; & last."""
    # fixed values: the entities
    pairs = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)
