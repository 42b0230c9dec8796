"""Packing documents into sequences by cutting-stock column generation.

A document's tokens are cut into full pieces of the sequence length and one rest. Rests are counted by length, in steps of
`unit` tokens rounded up, so the histogram has at most capacity / unit types whatever the corpus. On that histogram a
linear program over patterns is solved by column generation: a revised simplex whose columns are priced by a knapsack
dynamic program. Patterns are rounded down, the few rests left over are packed best-fit decreasing, and the patterns are then dealt
out to documents ranked within each type: a piece's sequence follows from its type and rank alone.

Defined results: null text counts as empty, which is the end token alone; texts longer than a sequence fill sequences of their
own; repeated rows are packed each; a null identifier is kept as null; an empty table gives no rows; further columns are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, slices, small_batches, written
from .tokens import encoder

#: Bytes of texts that are encoded together.
BLOCK_BYTES = 32 << 20


def pieces(tokenizer_json: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_json).encode
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, "text", BLOCK_BYTES):
            rows = []
            doc_ids = batch.column(0).to_pylist()
            for doc_id, ids in zip(doc_ids, encode(batch.column(1).to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    raw = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, start, len(raw) // 4, zlib.crc32(raw), n, *([raw] if with_ids else [])))
            columns = list(zip(*rows, strict=True)) or [()] * (6 if with_ids else 5)
            kinds = [pa.int64()] * 5 + [pa.binary()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names[: len(columns)])

    return run


def cutting_stock(demand: dict[int, int], capacity: int, *, most_rounds: int = 4000) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """[(pattern, times)]: pattern = ((size, count), ...) within capacity; each size is covered exactly demand times.

    most_rounds only bounds the simplex: a program stopped early has more padding, not fewer items.
    """
    sizes = np.array(sorted(s for s, d in demand.items() if d > 0))
    if not len(sizes):
        return []
    d = np.array([demand[int(s)] for s in sizes], float)
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / (capacity // sizes))
    x = inverse @ d
    for _ in range(most_rounds):
        y = inverse.sum(axis=0)
        # knapsack: the best value within each capacity
        best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for w in range(int(sizes[0]), capacity + 1):
            fits = int(np.searchsorted(sizes, w, "right"))
            values = best[w - sizes[:fits]] + y[:fits]
            i = int(values.argmax())
            if values[i] > best[w - 1] + 1e-12:
                best[w], choice[w] = values[i], i
            else:
                best[w] = best[w - 1]
        if best[capacity] <= 1 + 1e-7:
            break
        column, w = np.zeros(m), capacity
        while w > 0:
            if choice[w] < 0:
                w -= 1
            else:
                column[choice[w]] += 1
                w -= int(sizes[choice[w]])
        direction = inverse @ column
        ratio = np.where(direction > 1e-9, x / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        step = ratio[out]
        x -= step * direction
        x[out] = step
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot
        basis[:, out] = column
    found, left = [], {int(s): demand[int(s)] for s in sizes}
    for p in np.argsort(-x):
        column = basis[:, p].astype(int)
        used = np.flatnonzero(column)
        times = min([int(x[p] + 1e-6), *(left[int(sizes[i])] // int(column[i]) for i in used)])
        if times > 0:
            found.append((tuple((int(sizes[i]), int(column[i])) for i in used), times))
            for i in used:
                left[int(sizes[i])] -= times * int(column[i])
    # the rest, at most a few items for each pattern: fill one sequence after the other with the largest that fit
    while any(left.values()):
        room, pattern = capacity, []
        for s in sorted(left, reverse=True):
            n = min(left[s], room // s)
            if n:
                pattern.append((s, n))
                room -= n * s
        times = min(left[s] // n for s, n in pattern)
        for s, n in pattern:
            left[s] -= n * times
        found.append((tuple(pattern), times))
    return found


def intervals(patterns: list, first_sequence: int = 0) -> dict[int, np.ndarray]:
    """type -> rows (first rank, count in the pattern, first sequence, slot of the first one), by first rank."""
    rank: dict[int, int] = {}
    rows: dict[int, list] = {}
    at = first_sequence
    for pattern, times in patterns:
        slot = 0
        for size, n in pattern:
            rows.setdefault(size, []).append((rank.get(size, 0), n, at, slot))
            rank[size] = rank.get(size, 0) + n * times
            slot += n
        at += times
    return {s: np.array(r, np.int64) for s, r in rows.items()}


def assign(plan: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.column("type").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, slot = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
            for t in np.unique(kind):
                rows, own = plan[int(t)], kind == t
                at = rows[np.searchsorted(rows[:, 0], rank[own], "right") - 1]
                over = rank[own] - at[:, 0]
                sequence[own], slot[own] = at[:, 2] + over // at[:, 1], at[:, 3] + over % at[:, 1]
            yield batch.append_column("sequence_id", pa.array(sequence)).append_column("slot", pa.array(slot))

    return run


def pack(
    docs: DataFrame, *, tokenizer_json: str, capacity: int = 2048, end_id: int = 1, unit: int = 8, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for)."""
    small_batches(docs.sparkSession)
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + (", ids binary" if with_ids else "")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    cut = texts.mapInArrow(pieces(tokenizer_json, capacity, end_id, with_ids), schema)
    typed = written(cut.withColumn("type", F.ceil(F.col("length") / unit).cast("long")), "packing-pieces")
    histogram = {r["type"]: r["n"] for r in typed.groupBy("type").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = intervals(cutting_stock(histogram, capacity // unit))
    ranked = numbered(typed, ["type"], ["doc_id", "start", "ids_crc32"], "rank")
    ranked = ranked.select(*[c for c in typed.columns if c != "type"], "type", "rank")
    placed = ranked.mapInArrow(assign(plan), schema + ", type bigint, rank bigint, sequence_id bigint, slot bigint")
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])
    )
