"""Byte-level BPE encoding and decoding.

Python only cuts texts into the pattern's matches and numbers the distinct ones of a file split; each distinct word is an entry of a row of words.
The encoding itself is a fold by Spark's higher-order functions over the word's byte array: each step merges the first adjacent
pair of the lowest rank, which it looks up in the rank map. Decoding concatenates the ids' binary pieces.
No shuffle: a split's words come before the documents that need them, and documents are put together again in the task that read them.

The rank map is bounded by the vocabulary: it has each pair of ids whose bytes together are a token; the value is that token's id, which is also its
rank. It reaches the fold as the result of a scalar subquery, so it is a literal of the physical plan that each task gets once.
Written as a Catalyst literal, its several hundred thousand elements would be printed and compared at each step of planning.

Long words: a fold copies its state, so time grows by the square of the length. A match of LONG bytes or more is cut wherever no token
spans the place, since no merge can cross it. Of what still is so long (a run of one character, say) the state is an array of
chunks of about the square root of the length with their minimum each, and a step rebuilds the three chunks around its pair.

Memory: a worker holds the distinct words of its split up to WORD_BYTES, then begins a new block; texts pass in slices.

Defined results: null text counts as empty and has no ids; a null identifier stays null; repeated rows are encoded one by one; empty tables
give no rows; further columns, whatever their names, are never read. Special tokens' strings are ordinary text.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Container, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, small_batches
from .tokens import torn

#: Bits of an id, of which all are set in none, and of a place within a word; a rank stands above both.
ID_BITS, PLACE_BITS = 17, 28
ID_MASK, RANK_SHIFT = (1 << ID_BITS) - 1, ID_BITS + PLACE_BITS
#: Larger than any rank, and so in a state's element.
NONE = 1 << (ID_BITS + RANK_SHIFT)
#: Words of a row, bytes of distinct words that a block holds, words of documents that are put together at once.
ROW_WORDS, WORD_BYTES, TOGETHER = 64, 16 << 20, 1 << 20
#: Bytes from which a word's state is cut into chunks.
LONG = 512


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file's token bytes -> id. The file is part of the installed package, on the driver."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def rank_map(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, cells, pairs): cells[starts[left] + right] = rank * 2**RANK_SHIFT + left for each mergeable pair of ids.

    pairs[256 * left + right] is the rank of two bytes' token at its place in a state, or NONE.

    The rows of all left ids lie over one another in one array, each moved to a place where none of its cells is taken.
    """
    rows: dict[int, list[tuple[int, int]]] = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                rows.setdefault(left, []).append((right, rank))
    size, window = max(ranks.values()) + 1, 4096
    starts = np.zeros(size, np.int64)
    cells = np.full(2 * size + window, -1, np.int64)
    first: dict[int, int] = {}  # number of pairs -> where the search for the last row with so many ended
    for left, row in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
        rights, start = [r for r, _ in row], first.get(len(row), 0)
        while True:
            if start + size + window > len(cells):
                cells = np.concatenate([cells, np.full(size, -1, np.int64)])
            free = cells[start + rights[0] : start + rights[0] + window] < 0
            for r in rights[1:]:
                free &= cells[start + r : start + r + window] < 0
            if free.any():
                break
            start += window
        first[len(row)] = start
        starts[left] = start + int(free.argmax())
        for r, rank in row:
            cells[starts[left] + r] = (rank << RANK_SHIFT) + left
    pairs = np.full(1 << 16, NONE, np.int64)
    for token, rank in ranks.items():
        if len(token) == 2:
            pairs[256 * token[0] + token[1]] = rank << RANK_SHIFT
    return starts, cells[: int(np.flatnonzero(cells >= 0).max(initial=-1)) + 1], pairs


def constants(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """One row: starts, cells and pairs of the rank map, single (byte -> its id), pieces (id -> the token's bytes)."""
    starts, cells, pairs = rank_map(ranks)
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    columns = {"starts": starts, "cells": cells, "pairs": pairs, "single": np.array([ranks[bytes([b])] for b in range(256)], np.int64)}
    return spark.createDataFrame(pa.table({k: one(pa.array(v)) for k, v in columns.items()} | {"pieces": one(pa.array(pieces, pa.binary()))}))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once; unlike transform(), aggregate() makes no copy of what body gives."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda a, _: a, body)


def merge_fold(word: Column, starts: Column, cells: Column, pairs: Column, single: Column) -> Column:
    """The ids of one word from its bytes (array<int>).

    The state has a number for each id: the rank of its pair with the next id, its place and itself, in this order of bits. So the least
    number is the first pair of the lowest rank. A step merges that pair and looks up the two ranks that change. A sentinel comes first.
    """
    big = lambda v: F.lit(v).cast("bigint")
    none, mask, low = big(NONE), big(ID_MASK), big((1 << RANK_SHIFT) - 1)
    own = lambda e: e.bitwiseAND(mask)
    unranked = lambda e: e.bitwiseAND(low)

    def rank(a: Column, b: Column) -> Column:
        """At its place in the state; none if either id is null or they don't merge."""
        return _let(F.get(cells, (F.get(starts, a.cast("int")) + b).cast("int")), lambda cell: F.when(own(cell) == a, cell - a).otherwise(none))

    def merge(state: Column, p: Column, m: Column, after: Column) -> Column:
        """state with the elements p (which is m, counted from 1) and p + 1 merged; after: the element p + 2."""
        new, before = F.shiftright(m, RANK_SHIFT), F.get(state, p - 2)
        merged = rank(new, own(after)) + unranked(m) - own(m) + new
        return F.flatten(F.array(F.slice(state, F.lit(1), p - 2), F.array(rank(own(before), new) + unranked(before), merged), F.slice(state, p + 2, F.size(state))))

    def step(state: Column, _: Column) -> Column:
        joined = lambda m: _let(F.array_position(state, m).cast("int"), lambda p: merge(state, p, m, F.get(state, p + 1)))
        return _let(F.array_min(state), lambda m: F.when(m >= none, state).otherwise(joined(m)))

    chunk = lambda c: F.struct(F.array_min(c).alias("m"), c.alias("c"))
    elements = lambda c: F.coalesce(c.getField("c"), F.array().cast("array<bigint>"))

    def chunk_step(state: Column, _: Column) -> Column:
        def rebuilt(least: Column, j: Column) -> Column:
            near = lambda k: elements(F.get(state, j + k))
            around = F.struct(near(-2).alias("a"), least.getField("c").alias("b"), near(0).alias("d"))

            def split(w: Column) -> Column:
                a, b, p = F.size(w.getField("a")), F.size(w.getField("b")), F.array_position(w.getField("b"), least.getField("m")).cast("int")
                whole = F.flatten(F.array(w.getField("a"), w.getField("b"), w.getField("d")))
                # the second of the pair may be the last element of all three chunks
                made = _let(whole, lambda x: merge(x, a + p, least.getField("m"), F.coalesce(F.get(x, a + p + 1), F.get(near(1), F.lit(0)))))
                left = b - F.when(p < b, 1).otherwise(0)
                cut = lambda x: F.array(F.slice(x, F.lit(1), a), F.slice(x, a + 1, left), F.slice(x, a + left + 1, F.size(x)))
                return F.transform(F.filter(_let(made, cut), lambda c: F.size(c) > 0), chunk)

            return F.flatten(F.array(F.slice(state, F.lit(1), F.greatest(j - 2, F.lit(0))), _let(around, split), F.slice(state, j + 2, F.size(state))))

        joined = lambda least: _let(F.array_position(state, least).cast("int"), lambda j: rebuilt(least, j))
        return _let(F.array_min(state), lambda least: F.when(least.getField("m") >= none, state).otherwise(joined(least)))

    n = F.size(word)
    packed = F.transform(word, lambda a, i: F.coalesce(F.get(pairs, a * 256 + F.get(word, i + 1)), none) + ((i + 1) * big(1 << ID_BITS) + F.get(single, a)))
    start = F.concat(F.array(big(NONE + ID_MASK)), packed)
    steps = F.sequence(F.lit(2), n)
    finish = lambda s: F.transform(F.slice(s, F.lit(2), F.size(s)), own)
    width = F.ceil(F.sqrt(n)).cast("int")
    chunks = _let(start, lambda s: F.transform(F.sequence(F.lit(0), (n / width).cast("int")), lambda k: chunk(F.slice(s, k * width + 1, width))))
    chunks = F.filter(chunks, lambda c: F.size(c.getField("c")) > 0)
    long = F.aggregate(steps, chunks, chunk_step, lambda s: finish(F.flatten(F.transform(s, lambda c: c.getField("c")))))
    return F.when(n < 2, F.transform(word, lambda a: F.get(single, a))).when(n < LONG, F.aggregate(steps, start, step, finish)).otherwise(long)


class Numbers(dict):
    """word -> its number; the words that were new are in fresh."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


def segments(word: bytes, starts: frozenset[bytes], tokens: Container[bytes]) -> list[bytes]:
    """The word, cut at each place between two characters that no token spans; starts: the beginnings of all tokens.

    Each intermediate result of merging is a token, so a merge across a place needs a token that spans it.
    """
    out, begin, far = [], 0, 0
    for p in range(len(word)):
        if p and far <= p and word[p] & 0xC0 != 0x80:
            out.append(word[begin:p])
            begin = p
        end = p + 1
        while word[p:end] in starts:
            if end > far and word[p:end] in tokens:
                far = end
            if end == len(word):
                break
            end += 1
    return [*out, word[begin:]]


CUT = "block int, words array<array<int>>, id bigint, codes binary"


def cut(pattern: str, ranks: dict[bytes, int]):
    """Makes the function that numbers the distinct matches of a split: rows of words, then the documents as numbers of words.

    A text is cut at its spaces first: the pattern never matches across a single space between two
    characters that aren't white space, so each part, with its space, is matched alone, and each distinct part once
    per slice. A text with a white-space run that this would tear is one part.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        starts: frozenset[bytes] = frozenset()
        names = [x.split()[0] for x in CUT.split(", ")]
        kinds = [pa.int32(), pa.list_(pa.list_(pa.int32())), pa.int64(), pa.binary()]
        words, held, block = Numbers(), 0, 0

        def made(n: int, **columns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, k)) for c, k in zip(names, kinds, strict=True)], names)

        for batch in slices(batches, "text"):
            if held > WORD_BYTES:
                words, held, block = Numbers(), 0, block + 1
            texts = [t or "" for t in batch.column("text").to_pylist()]
            apart = [torn(t) for t in texts]
            units = pc.split_pattern(pa.array(["" if x else t for t, x in zip(texts, apart, strict=True)], pa.string()), " ")
            edges = units.offsets.to_numpy()
            flat = units.flatten()
            coded, firsts = flat.dictionary_encode(), flat.take(pa.array(edges[:-1])).to_pylist()
            heads: dict[str, int] = {}
            codes = coded.indices.to_numpy().copy()
            codes[edges[:-1]] = [
                len(coded.dictionary) + heads.setdefault(t if x else first, len(heads)) for t, x, first in zip(texts, apart, firsts, strict=True)
            ]
            parts, ends = array("i"), array("i", [0])
            for part in chain((" " + u for u in coded.dictionary.to_numpy(zero_copy_only=False)), heads):
                matches = find(part)
                if len(part) >= LONG // 4 and any(len(w.encode()) >= LONG for w in matches):
                    starts = starts or frozenset(t[:i] for t in ranks for i in range(1, len(t) + 1))
                    matches = [s.decode() for w in matches for s in (segments(w.encode(), starts, ranks) if len(w.encode()) >= LONG else [w.encode()])]
                parts.extend([words[w] for w in matches])
                ends.append(len(parts))
            if words.fresh:
                own = pa.array(words.fresh, pa.string())
                at = np.frombuffer(own.buffers()[1], np.int32)[: len(own) + 1]
                raw = np.frombuffer(own.buffers()[2], np.uint8)[: at[-1]]
                held += len(raw)
                outer = np.append(np.arange(0, len(own), ROW_WORDS), len(own)).astype(np.int32)
                inner = pa.ListArray.from_arrays(pa.array(at), pa.array(raw.astype(np.int32)))
                n = len(outer) - 1
                yield made(n, block=pa.array(np.full(n, block, np.int32)), words=pa.ListArray.from_arrays(pa.array(outer), inner))
                words.fresh = []
            found = pa.ListArray.from_arrays(pa.array(np.array(ends)), pa.array(np.array(parts))).take(pa.array(codes))
            numbers, at = found.values.to_numpy(), found.offsets.to_numpy()[edges]
            numbers = np.ascontiguousarray(numbers[at[0] : at[-1]], np.int32)
            places = ((at - at[0]) * 4).astype(np.int32)
            n = len(texts)
            binary = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(places), pa.py_buffer(numbers)])
            yield made(n, block=pa.array(np.full(n, block, np.int32)), id=batch.column("id"), codes=binary)

    return rows


class Coded:
    """The encoded and decoded words of a block, by number."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.decoded: list[pa.Array] = []

    def add(self, rows: pa.RecordBatch) -> None:
        words, decoded = rows.column("tokens").flatten().flatten()
        at = words.offsets
        values = words.values.slice(at[0].as_py(), at[-1].as_py() - at[0].as_py()).to_numpy(zero_copy_only=False).astype("<u4")
        self.ids.append(pa.ListArray.from_arrays(pc.subtract(at, at[0]), pa.array(values)))
        self.decoded.append(decoded)

    def of(self, codes: np.ndarray, edges: np.ndarray) -> tuple[list[bytes], list[bytes]]:
        """ids_le and decoded bytes of each document; edges: where its numbers begin in codes, and the end."""
        if len(self.ids) > 1:
            self.ids, self.decoded = [pa.concat_arrays(self.ids)], [pa.concat_arrays(self.decoded)]
        if not len(codes):
            return [b""] * (len(edges) - 1), [b""] * (len(edges) - 1)
        words, decoded = self.ids[0].take(pa.array(codes)), self.decoded[0].take(pa.array(codes))
        values, at = words.values.to_numpy(), words.offsets.to_numpy()[edges].tolist()
        places, raw = np.frombuffer(decoded.buffers()[1], np.int32)[decoded.offset : decoded.offset + len(codes) + 1][edges].tolist(), decoded.buffers()[2]
        cut = lambda x, at: [bytes(x[a:b]) for a, b in zip(at, at[1:], strict=False)]
        return cut(memoryview(np.ascontiguousarray(values)).cast("B"), [4 * a for a in at]), cut(memoryview(raw) if raw else memoryview(b""), places)


def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents: number of ids, ids as little-endian unsigned 32-bit bytes, decoded bytes. A block's words come before its documents."""
    block, coded = -1, Coded()
    for batch in batches:
        is_word = pc.is_valid(batch.column("tokens")).to_numpy(zero_copy_only=False)
        blocks = batch.column("block").to_numpy()
        edges = np.flatnonzero(np.concatenate([[True], (is_word[1:] != is_word[:-1]) | (blocks[1:] != blocks[:-1])])).tolist()
        for a, b in zip(edges, [*edges[1:], batch.num_rows], strict=True):
            rows = batch.slice(a, b - a)
            if blocks[a] != block:
                block, coded = blocks[a], Coded()
            if is_word[a]:
                coded.add(rows)
                continue
            for some in slices(iter([rows]), "codes", 4 * TOGETHER):
                raw = some.column("codes").to_pylist()
                ids_le, decoded = coded.of(np.frombuffer(b"".join(raw), np.int32), np.cumsum([0, *(len(x) // 4 for x in raw)]))
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), pa.array([len(x) // 4 for x in ids_le], pa.int64()), pa.array(ids_le, pa.binary()), pa.array(decoded, pa.binary())],
                    ["doc_id", "n_tokens", "ids_le", "decoded"],
                )


def encode(docs: DataFrame, *, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_le (little-endian unsigned 32-bit ids), decoded (bytes of the ids decoded)."""
    small_batches(docs.sparkSession)
    fixed = constants(docs.sparkSession, ranks)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.mapInArrow(cut(pattern, ranks), CUT)
    # one reference to the constants: the optimizer puts the subquery in its place
    rows = rows.withColumn("fixed", fixed.select(F.struct("*")).scalar())
    joined = lambda ids, pieces: F.aggregate(ids, F.lit(b""), lambda s, i: F.concat(s, F.get(pieces, i.cast("int"))))

    def coded(fixed: Column) -> Column:
        def word(w: Column, starts: Column, cells: Column, pairs: Column, single: Column, pieces: Column) -> Column:
            return _let(merge_fold(w, starts, cells, pairs, single), lambda ids: F.struct(ids.alias("ids"), joined(ids, pieces).alias("decoded")))

        def bound(names: tuple[str, ...], *values: Column) -> Column:
            if names:
                return _let(fixed.getField(names[0]), lambda v: bound(names[1:], *values, v))
            return F.transform("words", lambda w: word(w, *values))

        return bound(("starts", "cells", "pairs", "single", "pieces"))

    return rows.select("block", "id", "codes", _let(F.col("fixed"), coded).alias("tokens")).mapInArrow(join_up, "doc_id bigint, n_tokens bigint, ids_le binary, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
