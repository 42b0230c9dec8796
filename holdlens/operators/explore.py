"""What a reader does with the boards: watch lists, states, comparison, filters, sentences, views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: From this velocity score a ticker is in the state VELO.
VELO_FROM = 15.0


def since_last_visit(boards: DataFrame, watched: DataFrame, visit: Column) -> DataFrame:
    """What has happened to each watched ticker (column ticker) from the last snapshot at or before a visit to the last one.

    change: entered_hc, exited_hc, new_burst (as many as there are, a row each), or none. boards: rows of every snapshot with flag and burst_30d.
    """
    own = boards.join(watched.select("ticker").distinct(), "ticker", "left_semi").select("ticker", "snapshot_date", "flag", "burst_30d")
    last = boards.agg(F.max("snapshot_date")).scalar()
    then = boards.filter(F.col("snapshot_date") <= visit).agg(F.max("snapshot_date")).scalar()
    at = lambda day, c: F.max(F.when(F.col("snapshot_date") == day, F.col(c)))
    ends = own.groupBy("ticker").agg(
        (F.coalesce(at(then, "flag"), F.lit("")) == "HIGH_CONVICTION").alias("was_hc"), (F.coalesce(at(last, "flag"), F.lit("")) == "HIGH_CONVICTION").alias("is_hc"),
        F.coalesce(at(then, "burst_30d"), F.lit(False)).alias("was_burst"), F.coalesce(at(last, "burst_30d"), F.lit(False)).alias("is_burst"),
    )
    found = F.array_compact(F.array(
        F.when(F.col("is_hc") & ~F.col("was_hc"), F.lit("entered_hc")), F.when(F.col("was_hc") & ~F.col("is_hc"), F.lit("exited_hc")),
        F.when(F.col("is_burst") & ~F.col("was_burst"), F.lit("new_burst")),
    ))
    return ends.select("ticker", F.explode(F.when(F.size(found) == 0, F.array(F.lit("none"))).otherwise(found)).alias("change"))


def signal_state(velo_from: float = VELO_FROM) -> Column:
    """HC, BURST, VELO, SPEC or Neutral, the first that holds, of the columns flag, burst_30d and velocity_score."""
    return (
        F.when(F.col("flag") == "HIGH_CONVICTION", "HC").when(F.coalesce("burst_30d", F.lit(False)), "BURST")
        .when(F.coalesce("velocity_score", F.lit(0.0)) >= velo_from, "VELO").when(F.col("flag") == "SPECULATIVE_BETA", "SPEC").otherwise("Neutral")
    )


def signal_timeline(boards: DataFrame, days: int = 90) -> DataFrame:
    """Runs of equal state of each ticker over its observations of the last days: state, first and last day, number of snapshots, whether it still holds."""
    order = Window.partitionBy("ticker").orderBy("snapshot_date")
    last = boards.agg(F.max("snapshot_date")).scalar()
    rows = boards.filter(F.col("snapshot_date") >= F.date_sub(last, days)).withColumn("state", signal_state())
    rows = rows.withColumn("start", F.coalesce((F.col("state") != F.lag("state").over(order)).cast("int"), F.lit(1)))
    rows = rows.withColumn("run", F.sum("start").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = rows.groupBy("ticker", "run", "state").agg(F.min("snapshot_date").alias("first_day"), F.max("snapshot_date").alias("last_day"), F.count(F.lit(1)).alias("n_snapshots"))
    return runs.drop("run").withColumn("holds", F.col("last_day") == last)


def state_days(timeline: DataFrame) -> DataFrame:
    """Snapshots of each ticker in each state."""
    return timeline.groupBy("ticker", "state").agg(F.sum("n_snapshots").alias("n_snapshots"), F.count(F.lit(1)).alias("runs"))


def compared(board: DataFrame, pinned: DataFrame, n: int = 4) -> DataFrame:
    """The n pinned tickers (column ticker) with the highest scores, ties by ticker, in order."""
    own = board.join(pinned.select("ticker").distinct(), "ticker", "left_semi").orderBy(F.desc("final_score"), "ticker").limit(n)
    return own.withColumn("place", F.row_number().over(Window.orderBy(F.desc("final_score"), "ticker")))  # at most n rows


def chips(rows: DataFrame, *, sector: str | None = None, velo: bool = False, burst: bool = False, quality: bool = False, most_concentrated: int | None = None) -> DataFrame:
    """rows that pass every filter that is set; most_concentrated: the concentration score that may be reached."""
    tests = [
        None if sector is None else F.col("sector") == sector, F.col("velocity_score") >= VELO_FROM if velo else None, F.col("burst_30d") if burst else None,
        F.col("quality_adopted_30d") if quality else None, None if most_concentrated is None else F.col("concentration_score") <= most_concentrated,
    ]
    for t in tests:
        rows = rows if t is None else rows.filter(F.coalesce(t, F.lit(False)))
    return rows


def explained(rows: DataFrame) -> DataFrame:
    """rows with a sentence: funds and tiers, score change, burst or velocity, high-conviction streak, quality, concentration, stealth, divergence."""
    n = lambda c: F.col(c).cast("string")
    plural = lambda c, word: F.concat(n(c), F.lit(f" {word}"), F.when(F.col(c) == 1, "").otherwise("s"))
    signed = lambda c: F.concat(F.when(c >= 0, "+").otherwise("-"), F.abs(c).cast("string"))
    percent = F.round(F.col("score_delta_pct").cast("decimal(18,4)") * 100, 0).cast("bigint")
    parts = [
        F.concat(F.lit("Held by "), plural("etf_count", "ETF"), F.lit(" across "), plural("tier_breadth", "tier")),
        F.when(F.col("score_delta_pct").isNotNull(), F.concat(F.lit("Score "), signed(percent), F.lit("%"))),
        F.when(F.coalesce("burst_30d", F.lit(False)), F.concat(F.lit("BURST "), signed(F.col("global_rank_delta_30d")), F.lit(" ranks (best #"), n("global_rank_best_30d"), F.lit(")")))
        .when(F.col("velocity_score") >= VELO_FROM, F.concat(F.lit("VELO "), signed(F.round(F.col("velocity_score").cast("decimal(18,2)"), 0).cast("bigint")))),
        F.when(F.col("hc_streak") > 0, F.concat(F.lit("HC "), n("hc_streak"), F.lit("d"))),
        F.when(F.col("quality_adopted_30d"), "Quality+ in 30d"), F.when(F.col("quality_defected_30d"), "Quality- in 30d"),
        F.when(F.col("concentration_score") > 70, F.concat(F.lit("Concentrated "), n("concentration_score"), F.lit("%"))),
        F.when(F.col("stealth_accumulation"), "Stealth accumulation"),
        F.when(F.col("conviction_divergence") < 0, "Score up, rank down").when(F.col("conviction_divergence") > 0, "Score down, rank up"),
    ]
    return rows.withColumn("sentence", F.concat_ws(" · ", *parts))


def remaining_weight(latest: DataFrame, top: int = 50) -> DataFrame:
    """Of each fund the weight of its top holdings and what remains of 1."""
    sums = latest.groupBy("ETF_Ticker").agg(F.sum(F.when(F.col("rank") <= top, F.col("weight"))).alias("shown"), F.count_if(F.col("rank") <= top).alias("slices"))
    return sums.select("ETF_Ticker", "slices", F.round("shown", 6).alias("shown"), F.round(F.greatest(F.lit(0.0), 1 - F.col("shown")), 6).alias("remaining"))


def sorted_by(rows: DataFrame, column: str, *, descending: bool = True) -> DataFrame:
    """rows by a column, unknown values last, ties by ticker."""
    c = F.col(column)
    return rows.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last(), "ticker")


def register_views(boards: DataFrame, latest: DataFrame) -> SparkSession:
    """The views leaderboard (every snapshot, so any date can be asked for) and holdings, for spark.sql()."""
    boards.createOrReplaceTempView("leaderboard")
    latest.createOrReplaceTempView("holdings")
    return boards.sparkSession
