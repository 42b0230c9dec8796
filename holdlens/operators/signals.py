"""Signals derived from leaderboards and rank deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config


def concentration(latest: DataFrame) -> DataFrame:
    """top_etf_share and concentration_score: the largest fund's share of a ticker's score; 1 for a total of 0."""
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(F.try_divide(F.col("top"), F.nullif(F.col("total"), F.lit(0.0))), F.lit(1.0))))
    sums = latest.groupBy("ticker").agg(F.max("score").alias("top"), F.sum("score").alias("total"))
    return sums.select("ticker", F.bround(share, 3).alias("top_etf_share"), F.bround(F.round(share * 100, 6), 0).cast("int").alias("concentration_score"))


def score_decomposition(latest: DataFrame) -> DataFrame:
    """Each fund's share of a ticker's score, and Concentrated (70 % or more in one fund) or Diversified."""
    own = Window.partitionBy("ticker")
    share = F.try_divide(F.col("score"), F.nullif(F.sum("score").over(own), F.lit(0.0)))
    rows = latest.withColumn("raw_share", share)
    kind = F.when(F.max("raw_share").over(own) >= 0.7, "Concentrated").otherwise("Diversified")
    return rows.withColumn("kind", kind).select("ticker", "ETF_Ticker", F.round("score", 6).alias("score"), F.round("raw_share", 4).alias("share"), "kind")


def score_deltas_by_period(boards_at: DataFrame, periods: list[tuple[str, Column]], today: Column, *, cap: float = 10.0) -> DataFrame:
    """ticker, period, score_delta_pct from leaderboards at shifted dates; null without a base, clipped to +-cap."""
    now = boards_at.filter(F.col("snapshot_date") == today).select("ticker", F.col("final_score").cast("double").alias("cur"))
    at = F.array(*[F.struct(F.lit(k).alias("period"), d.alias("snapshot_date")) for k, d in periods])
    wanted = now.select("ticker", "cur", F.explode(at).alias("p")).select("ticker", "cur", "p.*")
    base = boards_at.select("ticker", "snapshot_date", F.col("final_score").cast("double").alias("prev"))
    pct = F.try_divide(F.col("cur") - F.col("prev"), F.abs(F.nullif(F.col("prev"), F.lit(0.0))))
    return wanted.join(base, ["ticker", "snapshot_date"], "left").select("ticker", "period", F.bround(F.greatest(F.lit(-cap), F.least(F.lit(cap), pct)), 4).alias("score_delta_pct"))


def period_map(deltas: DataFrame) -> DataFrame:
    """ticker, score_deltas_by_period: map of period -> change."""
    return deltas.groupBy("ticker").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("period", "score_delta_pct")))).alias("score_deltas_by_period"))


def mean_motion(deltas: DataFrame) -> DataFrame:
    """Mean rank delta over 7 and 30 days and weight flow over 7 days of each ticker; 0 if unknown."""
    at = lambda days, c: F.avg(F.when(F.col("period_days") == days, F.col(c)))
    return deltas.groupBy("ticker").agg(
        F.bround(F.coalesce(at(7, "rank_delta"), F.lit(0.0)), 2).alias("avg_rank_delta_7d"),
        F.bround(F.coalesce(at(7, "weight_flow"), F.lit(0.0)), 4).alias("avg_weight_flow_7d"),
        F.bround(F.coalesce(at(30, "rank_delta"), F.lit(0.0)), 2).alias("avg_rank_delta_30d"),
    )


def global_rank_motion(boards: DataFrame) -> DataFrame:
    """Of every snapshot and ticker: the 30 days of global ranks before it and what follows from them.

    One RANGE frame per ticker; coverage is against the calendar of the same 30 days. The snapshots' number in a window comes from the
    distinct dates, and the window's first date as well, so nothing is joined by range.
    """
    day = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date"))
    calendar = boards.agg(F.array_sort(F.collect_set("snapshot_date"))).scalar()
    rows = boards.select("snapshot_date", "ticker", "leaderboard_rank", day(F.col("snapshot_date")).alias("t"))
    whole = calendar.alias("whole")
    frame = Window.partitionBy("ticker").orderBy("t").rangeBetween(-30, 0)
    seen = rows.withColumn("obs", F.collect_list(F.struct("snapshot_date", "leaderboard_rank")).over(frame)).withColumn(
        "mid", F.expr("percentile(leaderboard_rank, 0.5) OVER (PARTITION BY ticker ORDER BY t RANGE BETWEEN 30 PRECEDING AND CURRENT ROW)")
    )
    seen = seen.select("*", whole)
    window = F.filter("whole", lambda d: (d <= F.col("snapshot_date")) & (d >= F.date_sub("snapshot_date", 30)))
    seen = seen.withColumn("cal", window)
    ranks = F.transform("obs", lambda o: o["leaderboard_rank"])
    first = F.get(F.filter("obs", lambda o: o["snapshot_date"] == F.get("cal", F.lit(0))), F.lit(0))["leaderboard_rank"]
    recent = F.filter("obs", lambda o: (o["snapshot_date"] >= F.get("cal", F.greatest(F.size("cal") - 10, F.lit(0)))) & (o["leaderboard_rank"] < F.col("mid")))
    enough = F.size("cal") >= 5
    peak = F.array_max(ranks) - F.array_min(ranks)
    coverage = F.size("obs") / F.size("cal")
    return seen.select(
        "snapshot_date", "ticker",
        F.when(enough, first - F.col("leaderboard_rank")).alias("global_rank_delta_30d"), F.when(enough, peak).alias("global_rank_peak_30d"),
        F.when(enough, F.array_min(ranks)).alias("global_rank_best_30d"), F.round(coverage, 4).alias("coverage"), F.size(recent).alias("sustained"),
        F.coalesce(enough & (peak >= 40) & (coverage >= 0.8) & (F.size(recent) >= 8), F.lit(False)).alias("burst_30d"),
    )


def nearest_snapshot(boards: DataFrame, days: int = 30) -> Column:
    """Scalar: the snapshot closest to days before the last one; ties to the earlier."""
    dates = boards.select("snapshot_date").distinct()
    last = boards.agg(F.max("snapshot_date")).scalar()
    gap = F.abs(F.datediff("snapshot_date", F.date_sub(last, days)))
    return dates.agg(F.min_by("snapshot_date", F.struct(gap, "snapshot_date"))).scalar()


def velocity(today: DataFrame, motion: DataFrame, ranks: DataFrame, streaks: DataFrame, then: DataFrame) -> DataFrame:
    """today's leaderboard with the velocity columns. then: the leaderboard ~30 days ago (ticker, etf_count)."""
    past = then.select("ticker", F.col("etf_count").alias("past_count"))
    rows = today.join(motion, "ticker", "left").join(ranks.drop("snapshot_date"), "ticker", "left").join(streaks.select("ticker", "score_streak", "score_delta_pct"), "ticker", "left").join(past, "ticker", "left")
    rows = rows.withColumn("etf_count_30d_ago", F.coalesce("past_count", "etf_count")).withColumn("etf_count_delta_30d", F.col("etf_count") - F.coalesce("past_count", "etf_count"))
    return rows.withColumn("velocity_score", velocity_score()).withColumn("burst_30d", F.coalesce("burst_30d", F.lit(False))).drop("past_count")


def velocity_score() -> Column:
    """The six terms, of columns of these names; unknown ones count as 0."""
    clip = lambda c, lo, hi: F.greatest(F.lit(lo), F.least(F.lit(hi), c))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    score = (
        0.5 * clip(zero("global_rank_delta_30d"), -200, 200) + 0.25 * clip(zero("global_rank_peak_30d"), 0, 200) + zero("avg_rank_delta_7d")
        + 20 * zero("avg_weight_flow_7d") + 5 * zero("etf_count_delta_30d") + clip(zero("score_streak"), -10, 10)
    )
    return F.bround(F.round(score, 6), 2)


def velocity_history(boards: DataFrame, motion: DataFrame, streaks: DataFrame) -> DataFrame:
    """Every snapshot's leaderboard with burst_30d and velocity_score, from that snapshot and earlier ones alone.

    boards: historical_leaderboards(); motion: deltas.motion_history() over 7 days; streaks: temporal.score_streak_history().
    """
    calendar = boards.agg(F.array_sort(F.collect_set("snapshot_date"))).scalar()
    gap = lambda d, day: F.struct(F.abs(F.datediff(d, F.date_sub(day, 30))).alias("gap"), d.alias("d"))
    days = boards.select("snapshot_date").distinct().withColumn("cal", calendar)
    near = F.array_min(F.transform(F.filter("cal", lambda d: d <= F.col("snapshot_date")), lambda d: gap(d, F.col("snapshot_date"))))["d"]
    then = boards.select(F.col("snapshot_date").alias("near"), "ticker", F.col("etf_count").alias("past_count"))
    counts = boards.select("snapshot_date", "ticker", "etf_count").join(days.select("snapshot_date", near.alias("near")), "snapshot_date").join(then, ["near", "ticker"], "left")
    counts = counts.select("snapshot_date", "ticker", (F.col("etf_count") - F.coalesce("past_count", "etf_count")).alias("etf_count_delta_30d"))
    means = motion.select(
        "snapshot_date", "ticker", F.bround(F.coalesce("avg_rank_delta", F.lit(0.0)), 2).alias("avg_rank_delta_7d"), F.bround(F.coalesce("avg_weight_flow", F.lit(0.0)), 4).alias("avg_weight_flow_7d")
    )
    key = ["snapshot_date", "ticker"]
    rows = global_rank_motion(boards).join(means, key, "left").join(streaks.select(*key, "score_streak"), key, "left").join(counts, key, "left")
    return rows.withColumn("velocity_score", velocity_score())


def regime(vel: Column, streak: Column) -> Column:
    return (
        F.when((vel > 15) & (streak > 3), "accelerating").when((vel > 5) & (streak > 0), "rising")
        .when((vel < -15) & (streak < -3), "declining").when((vel < -5) & (streak < 0), "weakening").otherwise("stable")
    )


def classified(rows: DataFrame) -> DataFrame:
    """Adds conviction_divergence, stealth_accumulation, momentum_regime and tier_breadth to velocity's result."""
    rank7, flow7 = F.coalesce("avg_rank_delta_7d", F.lit(0.0)), F.coalesce("avg_weight_flow_7d", F.lit(0.0))
    change, moved = F.coalesce("score_delta_pct", F.lit(0.0)), F.coalesce("global_rank_delta_30d", F.lit(0))
    return (
        rows.withColumn("conviction_divergence", F.when((change > 0) & (moved < 0), -1).when((change < 0) & (moved > 0), 1).otherwise(0))
        .withColumn("stealth_accumulation", F.coalesce((flow7 > 0.03) & (rank7 < 1) & (F.col("etf_count") >= 3), F.lit(False)))
        .withColumn("momentum_regime", regime(F.coalesce("velocity_score", F.lit(0.0)), F.coalesce("score_streak", F.lit(0))))
        .withColumn("tier_breadth", F.when(F.col("tiers") == "", 0).otherwise(F.size(F.split("tiers", r" \+ "))))
        .withColumn("gauge", F.when(F.col("score_streak") > 0, "↗").when(F.col("score_streak") < 0, "↘").otherwise("→"))
    )


def quality_change(boards: DataFrame, cfg: Config) -> DataFrame:
    """ticker, quality_adopted_30d, quality_defected_30d: quality funds that hold it now and didn't ~30 days ago, and the reverse."""
    last, then = boards.agg(F.max("snapshot_date")).scalar(), nearest_snapshot(boards)
    quality = F.array(*[F.lit(q) for q in cfg.quality_funds]) if cfg.quality_funds else F.array().cast("array<string>")
    held = lambda at, name: boards.filter(F.col("snapshot_date") == at).select("ticker", F.array_intersect(F.split("held_by", ", "), quality).alias(name))
    rows = held(last, "now").join(held(then, "was"), "ticker", "left").withColumn("was", F.coalesce("was", F.array().cast("array<string>")))
    return rows.select(
        "ticker", (F.size(F.array_except("now", "was")) > 0).alias("quality_adopted_30d"), (F.size(F.array_except("was", "now")) > 0).alias("quality_defected_30d")
    )


def with_metadata(board: DataFrame, metadata: DataFrame | None) -> DataFrame:
    """sector, industry, country ("Unknown" if unknown) and market_cap_usd. Catalyst broadcasts the dimension if its size allows."""
    if metadata is None:
        return board.select("*", *[F.lit("Unknown").alias(c) for c in ("sector", "industry", "country")], F.lit(None).cast("double").alias("market_cap_usd"))
    rows = board.join(metadata.select("ticker", "sector", "industry", "country", "market_cap_usd").dropDuplicates(["ticker"]), "ticker", "left")
    return rows.fillna("Unknown", ["sector", "industry", "country"])
