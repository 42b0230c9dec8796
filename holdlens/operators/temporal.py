"""Change over snapshots: streaks, percentiles, change logs. Input: long leaderboards (snapshot_date, ticker, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config


def last_snapshots(boards: DataFrame) -> DataFrame:
    """One row: today and yday, the last two snapshot dates, and their number."""
    dates = boards.agg(F.array_sort(F.collect_set("snapshot_date")).alias("d"))
    return dates.select(F.element_at("d", -1).alias("today"), F.get("d", F.size("d") - 2).alias("yday"), F.size("d").alias("n_snapshots"))


def _scalar(one: DataFrame, column: str) -> Column:
    return one.select(column).scalar()


def trailing_run(values: Column) -> Column:
    """Signed length of the run of equal signs that ends an array of differences; 0 if the last one is 0."""
    signs = F.transform(values, lambda x: F.signum(x).cast("int"))
    last = F.element_at(signs, -1)
    other = F.array_max(F.transform(signs, lambda s, i: F.when(s != last, i + 1).otherwise(F.lit(0))))
    return F.when(F.size(signs) == 0, F.lit(0)).otherwise((F.size(signs) - other) * last)


def score_panel(boards: DataFrame, dates: list | None = None) -> DataFrame:
    """Wide: a row for each ticker, a column for each snapshot. Pass the dates to spare the pass that finds them."""
    return boards.groupBy("ticker").pivot("snapshot_date", dates).agg(F.first("final_score"))


def flag_panel(boards: DataFrame) -> DataFrame:
    """Long, on the full calendar: the flag of each ticker at each snapshot, "" where it is absent."""
    calendar = boards.agg(F.array_sort(F.collect_set("snapshot_date"))).scalar()
    own = boards.groupBy("ticker").agg(F.map_from_entries(F.collect_list(F.struct("snapshot_date", "flag"))).alias("flags"))
    own = own.withColumn("cal", calendar)
    return own.select("ticker", F.explode(F.transform("cal", lambda d: F.struct(d.alias("snapshot_date"), F.coalesce(F.try_element_at("flags", d), F.lit("")).alias("flag")))).alias("x")).select(
        "ticker", "x.snapshot_date", "x.flag"
    )


def streaks_and_deltas(boards: DataFrame) -> DataFrame:
    """A row for each ticker; one aggregation gathers its observations (at most one for each snapshot)."""
    calendar = boards.agg(F.array_sort(F.collect_set("snapshot_date"))).scalar()
    own = boards.groupBy("ticker").agg(F.array_sort(F.collect_list(F.struct("snapshot_date", "final_score", "flag"))).alias("obs")).withColumn("cal", calendar)
    scores = F.transform("obs", lambda o: o["final_score"])
    diffs = F.transform(F.slice("s", 2, F.size("s")), lambda x, i: x - F.get("s", i))
    hc = F.transform(F.filter("obs", lambda o: o["flag"] == "HIGH_CONVICTION"), lambda o: o["snapshot_date"])
    gap = F.array_max(F.transform("cal", lambda d, i: F.when(F.array_contains("hc", d), 0).otherwise(i + 1)))
    own = own.withColumn("s", scores).withColumn("hc", hc).withColumn("here", F.element_at("obs", -1)["snapshot_date"] == F.element_at("cal", -1))
    own = own.withColumn("now", F.when(F.col("here"), F.element_at("s", -1))).withColumn("was", F.get("s", F.size("s") - 2))
    prior = F.when(F.col("here"), F.slice("s", 1, F.size("s") - 1)).otherwise(F.col("s"))
    own = own.withColumn("prior", prior).withColumn("delta", F.col("now") - F.col("was"))
    return own.select(
        "ticker", F.col("now").alias("score_today"), F.col("was").alias("score_yesterday"), F.col("delta").alias("score_delta"),
        F.round(F.try_divide(F.col("delta").cast("double"), F.nullif(F.col("was"), F.lit(0)).cast("double")), 4).alias("score_delta_pct"),
        trailing_run(diffs).alias("score_streak"), (F.size("cal") - gap).alias("hc_streak"), F.size("s").alias("days_observed"),
        F.when((F.size("prior") >= 3) & F.col("now").isNotNull(), F.round(F.size(F.filter("prior", lambda x: x < F.col("now"))) / F.size("prior"), 3)).alias("score_percentile"),
    )


def score_streak_history(boards: DataFrame) -> DataFrame:
    """snapshot_date, ticker, score_streak: the signed run of equal signs of score changes that ends at each observation."""
    own = Window.partitionBy("ticker").orderBy("snapshot_date")
    rows = boards.select("snapshot_date", "ticker", F.signum(F.col("final_score") - F.lag("final_score").over(own)).cast("int").alias("sign"))
    rows = rows.withColumn("run", F.sum(F.coalesce((F.col("sign") != F.lag("sign").over(own)).cast("int"), F.lit(1))).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    length = F.row_number().over(Window.partitionBy("ticker", "run").orderBy("snapshot_date"))
    return rows.select("snapshot_date", "ticker", F.coalesce(F.col("sign") * length, F.lit(0)).alias("score_streak"))


LOG = ("change", "position", "ticker", "company", "final_score", "etf_count", "tiers", "score_delta", "score_delta_pct", "score_streak")


def changelog(boards: DataFrame, streaks: DataFrame, cfg: Config) -> DataFrame:
    """change in entered_hc, exited_hc, biggest_gainers, biggest_losers, new_entrants, each with the top rows; empty with fewer than two snapshots."""
    ends = last_snapshots(boards)
    today, yday = _scalar(ends, "today"), _scalar(ends, "yday")
    info = ["ticker", "company", "final_score", "etf_count", "tiers"]
    now = boards.filter(F.col("snapshot_date") == today)
    was = boards.filter(F.col("snapshot_date") == yday)
    hc = F.col("flag") == "HIGH_CONVICTION"
    extra = streaks.select("ticker", "score_today", "score_delta", "score_delta_pct", "score_streak")
    old = boards.filter(F.col("snapshot_date") <= F.date_sub(today, 7)).select("ticker").distinct()
    sets = {
        "entered_hc": now.filter(hc).join(was.filter(hc).select("ticker"), "ticker", "left_anti").select(*info),
        "exited_hc": was.filter(hc).join(now.filter(hc).select("ticker"), "ticker", "left_anti").select(*info),
        "new_entrants": now.join(old, "ticker", "left_anti").select(*info),
    }
    movers = now.select(*info).join(extra, "ticker").filter("score_delta_pct IS NOT NULL AND score_today >= 20")
    parts = []
    for change, df in sets.items():
        parts.append((change, df.join(extra, "ticker", "left"), [F.desc("final_score"), F.asc("ticker")]))
    parts.append(("biggest_gainers", movers.filter("score_delta_pct > 0"), [F.desc("score_delta_pct"), F.asc("ticker")]))
    parts.append(("biggest_losers", movers.filter("score_delta_pct < 0"), [F.asc("score_delta_pct"), F.asc("ticker")]))
    out = None
    for change, df, order in parts:
        top = df.withColumn("change", F.lit(change)).withColumn("position", F.row_number().over(Window.partitionBy("change").orderBy(*order)))
        top = top.filter((F.col("position") <= cfg.changelog_top_n) & yday.isNotNull()).select(*LOG)
        out = top if out is None else out.unionByName(top)
    return out


def state_durations(boards: DataFrame) -> DataFrame:
    """Runs of equal state (flag, or Neutral) of each ticker over its observations: state, first and last day, number of snapshots."""
    order = Window.partitionBy("ticker").orderBy("snapshot_date")
    state = F.when(F.col("flag") == "", "Neutral").otherwise(F.col("flag"))
    rows = boards.withColumn("state", state).withColumn("start", (F.col("state") != F.lag("state").over(order)).cast("int"))
    rows = rows.withColumn("run", F.sum(F.coalesce("start", F.lit(1))).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("ticker", "run", "state").agg(F.min("snapshot_date").alias("first_day"), F.max("snapshot_date").alias("last_day"), F.count(F.lit(1)).alias("n_snapshots")).drop("run")
