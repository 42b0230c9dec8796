"""Exact top-k inner products by branch and bound over one ball tree per shard.

Equal vectors are one point that keeps its k + 1 smallest identifiers: no answer needs more of them, since ties
go to smaller identifiers and at most one of them is the query itself. Points are dealt into shards of bounded size by a hash and
queries into blocks; a task builds the shard's tree and searches it for its block. Nodes are visited in the order of the
bound q.c + |q| r, and a node is skipped when its bound is below the query's current kth score. That score is shared from wave to
wave: the first wave searches one shard, its kth scores start the search of all other shards.

Defined results: vectors that are null or hold null or non-finite components take no part, neither do queries of that
kind; vectors of another length than the query's are no candidates; scores tie to the smaller identifier; repeated rows count once
for each identifier; a vector without identifier takes no part; an empty table gives no rows; further columns, whatever their names, are
never read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Points of a shard, queries of a block, points of a leaf.
SHARD, BLOCK, LEAF = 16384, 2048, 64


class BallTree:
    """Nodes as arrays: centre, radius, children or a slice of the points."""

    def __init__(self, x: np.ndarray) -> None:
        self.order = np.arange(len(x))
        self.centres, self.radii, self.kids, self.slices = [], [], [], []
        stack = [(0, len(x), None)]
        while stack:
            lo, hi, parent = stack.pop()
            own = x[self.order[lo:hi]]
            centre = own.mean(axis=0)
            far = ((own - centre) ** 2).sum(axis=1)
            me = len(self.centres)
            self.centres.append(centre)
            # rounding must not make a bound too small
            self.radii.append(float(np.sqrt(far.max())) * (1 + 1e-9) + 1e-6)
            self.kids.append([])
            self.slices.append((lo, hi))
            if parent is not None:
                self.kids[parent].append(me)
            if hi - lo > LEAF:
                a = own[far.argmax()]
                b = own[((own - a) ** 2).sum(axis=1).argmax()]
                along = own @ (a - b)
                mid = (hi - lo) // 2
                self.order[lo:hi] = self.order[lo:hi][np.argpartition(along, mid)]
                stack += [(lo, lo + mid, me), (lo + mid, hi, me)]
        self.centres = np.array(self.centres)
        self.radii = np.array(self.radii)

    def search(self, x: np.ndarray, lists: list[list[int]], q: np.ndarray, own: int, k: int, floor: float) -> list[tuple[int, int]]:
        """The k best (score, id); floor: a kth score that another shard has reached."""
        norm = float(np.sqrt(q @ q)) * (1 + 1e-9)
        bounds = self.centres @ q + norm * self.radii + 1e-6
        best: list[tuple[int, int]] = []  # a heap of (score, -id)
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            kth = max(floor, best[0][0]) if len(best) == k else floor
            if -bound < kth:
                break
            if self.kids[node]:
                for kid in self.kids[node]:
                    if bounds[kid] >= kth:
                        heapq.heappush(heap, (-bounds[kid], kid))
                continue
            lo, hi = self.slices[node]
            points = self.order[lo:hi]
            scores = x[points] @ q
            for p, s in zip(points[scores >= kth].tolist(), scores[scores >= kth].tolist(), strict=True):
                for i in lists[p]:
                    if i == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (int(s), -i))
                    elif (int(s), -i) > best[0]:
                        heapq.heapreplace(best, (int(s), -i))
                    else:
                        break
        return [(s, -i) for s, i in best]


FOUND = "query_id bigint, vec_id bigint, score bigint"


def _search(k: int):
    def run(key: tuple, points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(points) and len(queries):
            x = np.stack(points["v"].to_list()).astype(np.float64)
            lists = [sorted(map(int, i)) for i in points["ids"]]
            tree = BallTree(x)
            for own, v, floor in zip(queries["vec_id"], queries["v"], queries["floor"], strict=True):
                rows += [(own, i, s) for s, i in tree.search(x, lists, np.asarray(v, np.float64), int(own), k, float(floor))]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    return run


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    v = F.transform(F.col(vec_col).cast("array<double>"), lambda x: F.floor(x * scale))
    whole = F.forall(F.col(vec_col).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & whole & (F.size(vec_col) > 0)).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def top_k(vectors: DataFrame, is_query, *, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank from 1, vec_id, score: each query's k largest inner products with all other vectors."""
    rows = written(quantised(vectors, id_col, vec_col, scale), "topk-vectors")
    # the smallest identifiers of equal vectors: each task keeps its own k + 1 before the shuffle
    nth = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    points = written(few.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).withColumn("dim", F.size("v")), "topk-points")
    queries = written(rows.filter(is_query(F.col("vec_id"))).dropDuplicates(["vec_id", "v"]).withColumn("dim", F.size("v")), "topk-queries")
    n_shards = max(1, -(-points.count() // SHARD))
    n_blocks = max(1, -(-queries.count() // BLOCK))
    points = points.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(n_shards)).cast("int"))
    blocks = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))

    def wave(shards: list[int], floors: DataFrame | None) -> DataFrame:
        mine = points.filter(F.col("shard").isin(shards)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        asked = blocks.join(floors, "vec_id", "left").fillna(float("-inf"), "floor") if floors is not None else blocks.withColumn("floor", F.lit(float("-inf")))
        asked = asked.withColumn("shard", F.explode(F.array(*[F.lit(s) for s in shards])))
        key = ["shard", "block", "dim"]
        return mine.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(_search(k), FOUND)

    found = written(wave([0], None), "topk-first")
    if n_shards > 1:
        by_score = found.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
        floors = by_score.filter(F.size("s") >= k).select(F.col("query_id").alias("vec_id"), F.get("s", F.lit(k - 1)).cast("double").alias("floor"))
        found = found.unionByName(wave(list(range(1, n_shards)), floors))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
