"""As-of joins: one union and one window, no range join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, *, by: str, on: str, value: str, direction: str = "backward", out: str | None = None) -> DataFrame:
    """left with the value of right at the last date <= on (backward), the first >= on (forward) or the closest one (nearest, ties to the earlier).

    Null where there is none or the key is unknown. Rows of right with a null value don't count. left's rows all stay, repeated ones too.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError("direction must be backward, forward or nearest")
    name = out or value
    keep = [c for c in left.columns if c not in (by, on)]
    a = left.select(F.col(by).alias("_k"), F.col(on).cast("date").alias("_t"), F.lit(1).alias("_side"), F.struct(F.lit(0).alias("_none"), *keep).alias("_row"), F.lit(None).cast("struct<d:date,v:double>").alias("_v"))
    b = right.filter(F.col(value).isNotNull()).select(
        F.col(by).alias("_k"), F.col(on).cast("date").alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(a.schema["_row"].dataType).alias("_row"),
        F.struct(F.col(on).cast("date").alias("d"), F.col(value).cast("double").alias("v")).alias("_v"),
    )
    both = a.unionByName(b)
    before = Window.partitionBy("_k").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("_k").orderBy("_t", F.desc("_side")).rowsBetween(0, Window.unboundedFollowing)
    past, coming = F.last("_v", ignorenulls=True).over(before), F.first("_v", ignorenulls=True).over(after)
    if direction == "backward":
        found = both.withColumn("_f", past)
    elif direction == "forward":
        found = both.withColumn("_f", coming)
    else:
        found = both.withColumn("_p", past).withColumn("_n", coming).withColumn(
            "_f", F.when(F.col("_n").isNull() | (F.datediff("_t", "_p.d") <= F.datediff("_n.d", "_t")), F.col("_p")).otherwise(F.col("_n"))
        )
    return found.filter("_side = 1").select(F.col("_k").alias(by), F.col("_t").alias(on), *[F.col(f"_row.{c}").alias(c) for c in keep], F.col("_f.v").alias(name))
