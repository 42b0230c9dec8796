"""K-d tree sharding: recursive splits at distributed weighted medians along the widest metadata dimension.

Items are groups of equal texts (they stay together), weighted by their bytes. The number of shards is given, or follows from the bytes
that a leaf may have. A node that must give k shards is split where its left side has the share of k // 2 of k; leaves are the shards. The median of every node of a level is
found together by radix refinement: each pass sums bytes per 2**10 bins of the still open range and picks the median's bin in a window over
each node's bins, so the driver sees a row for each node, whatever the number of rows. Ties along a dimension are broken by the group's hash, so a
constant dimension can be split too.

Defined results: a null text has no bytes (size 1) and counts as empty; null metadata counts as "" or 0; repeated rows are
items of their own in the same group; a null identifier stays null and takes a slot; an empty table gives no rows; further columns, whatever
their names, are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import numbered, written

BITS, STEP = 60, 10
#: Bits of a key that come from the dimension's value; the rest from the group's hash.
VALUE_BITS = 20


def _scaled(df: DataFrame, dims: list[str]) -> list[Column]:
    """Each dimension as a number from 0 to 1: strings by a hash, numbers by their range."""
    kinds = dict(df.dtypes)
    numbers = [d for d in dims if kinds[d] != "string"]
    edges = df.agg(*[f(d).alias(f"{n}_{d}") for d in numbers for n, f in (("lo", F.min), ("hi", F.max))]).first() if numbers else None
    out = []
    for d in dims:
        if d in numbers:
            lo, hi = edges[f"lo_{d}"] or 0.0, edges[f"hi_{d}"] or 0.0
            out.append((F.coalesce(F.col(d).cast("double"), F.lit(lo)) - F.lit(float(lo))) / F.lit(float(hi - lo) or 1.0))
        else:
            out.append(F.crc32(F.coalesce(F.col(d), F.lit("")).cast("binary")) / F.lit(float(1 << 32)))
    return out


def kd_tree(items: DataFrame, dims: list[str], shards: int) -> DataFrame:
    """items (grp bigint hash, weight, the dims) with a column shard from 0 to shards - 1."""
    spark = items.sparkSession
    scaled = _scaled(items, dims)
    low = F.shiftrightunsigned("grp", 64 - (BITS - VALUE_BITS))
    keys = [F.shiftleft(F.least(F.floor(s * (1 << VALUE_BITS)), F.lit((1 << VALUE_BITS) - 1)), BITS - VALUE_BITS) + low for s in scaled]
    rows = written(
        items.select("*", *[s.alias(f"_v{i}") for i, s in enumerate(scaled)], *[k.alias(f"_k{i}") for i, k in enumerate(keys)], F.lit(0).alias("_node")), "kd-items"
    )
    open_nodes = {0: (0, shards)}  # node -> first shard, number of shards
    next_node, done = 1, {}
    while any(k > 1 for _, k in open_nodes.values()):
        splitting = {n: s for n, s in open_nodes.items() if s[1] > 1}
        widths = {
            r["_node"]: r
            for r in rows.groupBy("_node").agg(
                F.sum("weight").alias("w"), *[(F.max(f"_v{i}") - F.min(f"_v{i}")).alias(f"d{i}") for i in range(len(dims))]
            ).collect()
        }
        splitting = {n: s for n, s in splitting.items() if n in widths}
        if not splitting:
            break
        dim = {n: max(range(len(dims)), key=lambda i: (widths[n][f"d{i}"], -i)) for n in splitting}
        goal = {n: widths[n]["w"] * (k // 2) / k for n, (_, k) in splitting.items()}
        prefix = dict.fromkeys(splitting, 0)
        left = dict.fromkeys(splitting, 0)
        key = F.when(F.lit(False), F.lit(0).cast("bigint"))
        chosen = spark.createDataFrame([(n, d) for n, d in dim.items()], "_node int, _dim int")
        keyed = rows.join(F.broadcast(chosen), "_node")
        for i in range(len(dims)):
            key = key.when(F.col("_dim") == i, F.col(f"_k{i}"))
        keyed = keyed.select("_node", "weight", key.alias("_key"))
        for bits in range(BITS - STEP, -1, -STEP):
            at = spark.createDataFrame([(n, prefix[n], left[n], float(goal[n])) for n in splitting], "_node int, _prefix bigint, _left bigint, _goal double")
            bins = (
                keyed.join(F.broadcast(at), "_node").filter(F.shiftright("_key", bits + STEP) == F.col("_prefix"))
                .groupBy("_node", "_left", "_goal", F.shiftright("_key", bits).alias("_bin")).agg(F.sum("weight").alias("w"))
            )
            upto = F.col("_left") + F.sum("w").over(Window.partitionBy("_node").orderBy("_bin"))
            bins = bins.withColumn("_upto", upto).withColumn("_pick", F.struct("_bin", (F.col("_upto") - F.col("w")).alias("_before"), "w"))
            # the first bin that reaches the goal, or else the last one
            picks = bins.groupBy("_node").agg(F.coalesce(F.min(F.when(F.col("_upto") >= F.col("_goal"), F.col("_pick"))), F.max("_pick")).alias("p")).collect()
            last = {}
            for r in picks:
                prefix[r["_node"]], left[r["_node"]], last[r["_node"]] = r["p"]["_bin"], r["p"]["_before"], r["p"]["w"]
            for n in splitting:
                if bits == 0 and abs(left[n] + last[n] - goal[n]) <= abs(left[n] - goal[n]):
                    prefix[n] += 1  # the group on the edge goes left
        cuts = []
        for n, (first, k) in splitting.items():
            cuts.append((n, dim[n], prefix[n], next_node, next_node + 1))
            open_nodes[next_node], open_nodes[next_node + 1] = (first, k // 2), (first + k // 2, k - k // 2)
            del open_nodes[n]
            next_node += 2
        cut = spark.createDataFrame(cuts, "_node int, _dim int, _edge bigint, _left int, _right int")
        key = F.when(F.lit(False), F.lit(0).cast("bigint"))
        for i in range(len(dims)):
            key = key.when(F.col("_dim") == i, F.col(f"_k{i}"))
        moved = rows.join(F.broadcast(cut), "_node", "left")
        node = F.when(F.col("_edge").isNull(), F.col("_node")).when(key < F.col("_edge"), F.col("_left")).otherwise(F.col("_right"))
        rows = moved.withColumn("_to", node).drop("_node", "_dim", "_edge", "_left", "_right").withColumnRenamed("_to", "_node")
        if len(splitting) * 2 < shards:
            rows = written(rows, "kd-level")
    leaf = spark.createDataFrame([(n, first) for n, (first, _) in open_nodes.items()], T.StructType([T.StructField("_node", T.IntegerType()), T.StructField("shard", T.IntegerType())]))
    return rows.join(F.broadcast(leaf), "_node").drop("_node", *[f"_{c}{i}" for i in range(len(dims)) for c in "vk"])


def shard(docs: DataFrame, *, shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text", dims: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: every row in the shard of its group, numbered there without gaps.

    shards: their number; target_bytes: leaves are split until their mean size is at most that (a leaf exceeds it by ties and large groups only).
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("grp"), *[F.col(d).cast("string").alias(f"m_{d}") for d in dims],
        ),
        "shard-rows",
    )
    groups = rows.groupBy("grp").agg(
        F.sum("size").alias("weight"), F.log2(F.min("size")).alias("length"), *[F.min(f"m_{d}").alias(f"m_{d}") for d in dims]
    )
    if shards is None:
        shards = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    placed = kd_tree(groups, [*[f"m_{d}" for d in dims], "length"], shards).select("grp", "shard")
    placed = written(placed, "shard-groups")  # apart, so that a group of very many rows can be split between tasks of the join
    found = rows.select("doc_id", "size", "text_crc32", "grp").join(placed, "grp").drop("grp")
    return numbered(found, ["shard"], ["doc_id", "text_crc32"], "slot")
