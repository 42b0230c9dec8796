"""N-gram Jaccard join by vertical partitioning.

The global n-gram order is the order of the n-grams' 64-bit hashes; ranges of it are the fragments. Documents of equal sets are one
class. The steps, each of them exact:

1. Shared n-grams. Every class gives the first half of its set (in the global order) to the fragments. A fragment holds all
   occurrences of its n-grams, so it counts for each class how many of them another class has too. By the prefix
   argument, a class with a link has at least need(n) of them in its half; summed over the fragments, the others drop out.
   A task counts n-grams that several of its own classes share itself and sends one marker for all of them, so a passage that a third of
   the corpus holds reaches its fragment once per block.
2. Leaders. Classes that remain meet at the smallest class with the same min-hash: one pair per class and key, never all pairs of a
   group. A pair's overlap is counted in each fragment apart and summed per pair. Links make components.
3. Rest. Step 1 again with components for classes: who shares need(n) n-grams with *other* components may still have
   an uncounted link. Those get new leaders; what is left after that meets at prefixes over n-grams that differ
   in component, the rarest first, and pairs whose parities differ too much for a link are left out. First each class meets one class of each of its n-grams,
   then all pairs of components that are still apart meet; of two components the pair that differs least is counted first. So no link between components
   is lost, and pairs inside one are never listed.

Defined results: words are runs of other characters than [\\x20\\x09-\\x0D], A-Z in lower case; fewer words than n are one n-gram; null, empty and
blank texts have an empty set and link with nothing; equal sets always link; repeated rows belong to one class; the component is the
smallest identifier (null last); an empty table gives no rows; further columns are never read. N-grams and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, drop_written, near, release, shuffle_partitions, slices, small_batches, written

U = np.uint64
#: Bytes of text that are hashed together.
CHUNK = 1 << 20
#: Entries that a fragment should hold.
FRAGMENT = 500_000
#: Fragments in which a pair's overlap is counted.
PAIR_FRAGMENTS = 4
#: Members of a leader that are compared in one part.
SALT_ROWS = 2000
KEYS_PER_ROUND, ROUNDS = 2, 3
#: Classes of an n-gram that its other classes meet in a round, rounds before all meet.
HEADS, HEAD_ROUNDS = 4, 4
#: Words of 64 bits of a signature; a power of two.
SIGNATURE = 16


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Hasher:
    """Distinct n-gram hashes of texts, by prefix sums over bytes."""

    def __init__(self, n: int) -> None:
        self.n = n
        lower = np.arange(256)
        lower[65:91] += 32
        self.table = mix(lower.astype(U) + U(0x9E3779B97F4A7C15))
        self.blank = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
        self.grow(CHUNK)
        self.place = mix(np.arange(1, n + 2).astype(U) * U(0xD1B54A32D192ED03)) | U(1)

    def grow(self, size: int) -> None:
        base, inverse = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
        self.powers = np.cumprod(np.full(size, base, U))
        self.inverses = np.cumprod(np.full(size, inverse, U))

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the words in bytes."""
        full = ~self.blank[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], full, [False]]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            return starts, np.zeros(0, U)
        if len(data) > len(self.powers):
            self.grow(len(data))
        sums = np.concatenate([np.zeros(1, U), np.cumsum(self.table[data] * self.powers[: len(data)])])
        return starts, mix((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(U))

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The sorted distinct n-gram hashes of each text."""
        raw = [(t or "").encode() for t in texts]
        out: list[np.ndarray] = []
        i = 0
        while i < len(raw):
            j, size = i, 0
            while j < len(raw) and (j == i or size + len(raw[j]) < CHUNK):
                size += len(raw[j]) + 1
                j += 1
            out += self._some(raw[i:j])
            i = j
        return out

    def _some(self, raw: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b" ".join(raw), np.uint8)
        starts, hashes = self.words(data) if len(data) else (np.zeros(0, int), np.zeros(0, U))
        at = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
        cut = np.searchsorted(starts, at)
        n, m = self.n, len(hashes)
        grams = np.zeros(max(0, m - n + 1), U)
        for k in range(n):
            grams += hashes[k : m - n + 1 + k] * self.place[k] if m >= n else 0
        grams = mix(grams)
        out = []
        for a, b in zip(cut, cut[1:], strict=False):
            if b - a >= n:
                out.append(np.unique(grams[a : b - n + 1]))
            elif b > a:
                own = hashes[a:b]
                out.append(mix((own * self.place[: b - a]).sum(keepdims=True) + np.array([b - a], U) * self.place[n:]))
            else:
                out.append(np.zeros(0, U))
        return out


def class_of(grams: np.ndarray) -> int:
    """The hash of a set."""
    if not len(grams):
        return 0
    total = mix(grams + U(0x1234567)).sum(keepdims=True) + mix(grams ^ U(0x7654321 << 20)).sum(keepdims=True) * U(3)
    return int(mix(total + U(len(grams))).astype(np.int64)[0])


def needed(n, percent: int):
    """The least overlap of a set of n with any set it links to."""
    return -(-n * percent // 100)


def half(n: int, percent: int) -> int:
    """Length of the prefix that a class gives to the fragments."""
    return n - needed(n, percent) + max(1, n // 4)


def need(n: int, percent: int) -> int:
    """Common n-grams that two linked sets have at least within both of their prefixes."""
    return max(1, needed(n, percent) // 4)


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(a.astype(np.int64), pa.int64())


def described(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n, cls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(n)
        for batch in slices(batches, "text"):
            sets = hasher.sets(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) for s in sets], pa.int64())], ["doc_id", "n", "cls"]
            )

    return docs.mapInArrow(run, "doc_id bigint, n bigint, cls bigint")


ENTRIES = "frag int, kind int, hashes binary, codes binary, keys binary, labels binary"
KINDS = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
#: A fragment's row names an n-gram by the low half of its hash; the fragment follows from the high half.
LOW = U(0xFFFFFFFF)


def _grouped(hashes: np.ndarray, codes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries by n-gram: hashes, codes, where each n-gram begins, whether its codes have several labels."""
    order = np.argsort(hashes, kind="stable")
    hashes, codes = hashes[order], codes[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    own = labels[codes]
    return hashes, codes, first, np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first)


def _dealt(sets: list[np.ndarray], keys: np.ndarray, labels: np.ndarray, fragments: int, percent: int) -> Iterator[pa.RecordBatch]:
    """A block's entries by fragment; n-grams under several labels of the block are counted here and sent as one marker.

    A row has the n-grams of one fragment, 4 bytes each, with a code of 2 or 4 bytes into the row's own keys and labels.
    """
    same = labels is keys
    keys, at = np.unique(keys, return_index=True)
    prefixes, labels = [sets[i][: half(len(sets[i]), percent)] for i in at], labels[at]
    lens = np.array([len(p) for p in prefixes])
    if not lens.sum():
        return
    h, code, first, many = _grouped(np.concatenate(prefixes), np.repeat(np.arange(len(keys), dtype=np.int32), lens), labels)
    in_many = np.repeat(many, np.diff(first, append=len(h)))
    counts = np.bincount(code[in_many], minlength=len(keys))
    rows: list[tuple] = []
    if counts.any():
        found = np.flatnonzero(counts)
        rows.append((int(mix(h[:1])[0] % U(fragments)), 1, b"", b"", keys[found].tobytes(), counts[found].astype(np.int64).tobytes()))
    for kind, x, c in ((0, h[~in_many], code[~in_many]), (2, h[first[many]], None)):
        frag = ((x >> U(32)) * U(fragments) >> U(32)).astype(np.int64)
        edges = np.searchsorted(frag, np.arange(fragments + 1))
        for f in np.unique(frag).tolist():
            lo, hi = edges[f], edges[f + 1]
            low = (x[lo:hi] & LOW).astype("<u4").tobytes()
            if c is None:
                rows.append((f, kind, low, b"", b"", b""))
                continue
            own, codes = np.unique(c[lo:hi], return_inverse=True)
            codes = codes.astype("<u2" if len(own) <= 1 << 16 else "<u4").tobytes()
            rows.append((f, kind, low, codes, keys[own].tobytes(), b"" if same else labels[own].tobytes()))
    columns = list(zip(*rows, strict=True))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, KINDS, strict=True)], [x.split()[0] for x in ENTRIES.split(", ")])


def _count_shared(parts: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        entries = rows[rows["kind"] == 0]
        tables = [np.frombuffer(k, np.int64) for k in entries["keys"]]
        names = [np.frombuffer(lab, np.int64) if lab else k for lab, k in zip(entries["labels"], tables, strict=True)]
        ids, first, code_of = np.unique(np.concatenate([*tables, np.zeros(0, np.int64)]), return_index=True, return_inverse=True)
        labels, at, codes = np.concatenate([*names, np.zeros(0, np.int64)])[first], 0, []
        for k, c, h in zip(tables, entries["codes"], entries["hashes"], strict=True):
            codes.append(code_of[at : at + len(k)].astype(np.int32)[np.frombuffer(c, "<u2" if len(c) * 2 == len(h) else "<u4")])
            at += len(k)
        counted = [(np.frombuffer(k, np.int64), np.frombuffer(n, np.int64)) for k, n in zip(rows.loc[rows["kind"] == 1, "keys"], rows.loc[rows["kind"] == 1, "labels"], strict=True)]
        if codes:
            # a class that several blocks have counts once
            pairs = np.unique(np.frombuffer(b"".join(entries["hashes"]), "<u4").astype(U) << U(32) | np.concatenate(codes).astype(U))
            marked = np.unique(np.frombuffer(b"".join(rows.loc[rows["kind"] == 2, "hashes"]), "<u4"))
            h, code, first, shared = _grouped(pairs >> U(32), (pairs & LOW).astype(np.int32), labels)
            shared |= np.isin(h[first].astype("<u4"), marked)
            n = np.bincount(code[np.repeat(shared, np.diff(first, append=len(h)))], minlength=len(ids))
            counted.append((ids[n > 0], n[n > 0]))
        release()
        key, n = _summed(np.concatenate([k for k, _ in counted] or [np.zeros(0, np.int64)]), np.concatenate([n for _, n in counted] or [np.zeros(0, np.int64)]))
        # packed by the part that sums them up: a row for each part, not for each class and fragment
        return _packed(key, n, (mix(key.astype(U)) % U(parts)).astype(np.int64))

    return run


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(key, return_inverse=True)
    return found, np.bincount(at, weights=n, minlength=len(found)).astype(np.int64)


def _packed(key: np.ndarray, n: np.ndarray, part: np.ndarray) -> pd.DataFrame:
    order = np.argsort(part, kind="stable")
    key, n, part = key[order], n[order], part[order]
    found, first = np.unique(part, return_index=True)
    edges = [*first.tolist(), len(part)]
    return pd.DataFrame({
        "part": found, "keys": [key[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)],
        "counts": [n[a:b].astype("<u4").tobytes() for a, b in zip(edges, edges[1:], strict=False)],
    })


def _add_up(rows: pd.DataFrame) -> pd.DataFrame:
    key, n = _summed(np.frombuffer(b"".join(rows["keys"]), np.int64), np.frombuffer(b"".join(rows["counts"]), "<u4"))
    return pd.DataFrame({"key": key, "shared": n})


def shared_counts(entries: DataFrame, parts: int) -> DataFrame:
    """key, shared: at least the number of the key's entries that another label has too.

    It is more if a key is in several blocks or halves of hashes are equal; the counts only choose what is looked at more closely.
    """
    counted = entries.groupBy("frag").applyInPandas(_count_shared(parts), "part bigint, keys binary, counts binary")
    return counted.groupBy("part").applyInPandas(_add_up, "key bigint, shared bigint")


def _fragments(entries: int, spark) -> int:
    return max(shuffle_partitions(spark), -(-entries // FRAGMENT))


def _reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, label of edges (a, b) that one task holds."""
    ends = [np.stack([batch.column("a").to_numpy(), batch.column("b").to_numpy()]) for batch in batches]
    nodes, at = np.unique(np.concatenate([*ends, np.zeros((2, 0), np.int64)], axis=1), return_inverse=True)
    a, b = at.reshape(2, -1)
    label = np.arange(len(nodes))
    while (label[a] != label[b]).any():
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while (label[label] != label).any():
            label = label[label]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], ["node", "label"])


def components(edges: DataFrame, one_task: int = BROADCAST_ROWS) -> DataFrame:
    """node, label (the smallest node reachable), of edges (a, b). Few edges are labelled by one task; of more, labels spread to neighbours and jump to labels' labels."""
    if edges.count() <= one_task:
        return written(edges.select("a", "b").coalesce(1).mapInArrow(_reached, "node bigint, label bigint"), "labels")
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        better = written(labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old")), "labels")
        jump = better.select(F.col("node").alias("label"), F.col("label").alias("far"))
        after = written(better.join(jump, "label").select("node", F.least("label", "far").alias("label"), "old"), "labels")
        changed = after.filter("label != old").limit(1).count()
        drop_written(better)
        drop_written(labels)
        labels = after.select("node", "label")
        if not changed:
            return labels


PAIR = "l bigint, f int, salt int, is_x int, x bigint, n bigint, hashes binary"


def _cut_pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each side's set, cut into fragments of the global order."""
    for batch in batches:
        out: list[tuple] = []
        for l, salt, is_x, x, n, raw in zip(*(batch.column(c).to_pylist() for c in ("l", "salt", "is_x", "x", "n", "hashes")), strict=True):
            h = np.frombuffer(raw, U)
            edges = np.searchsorted(h, np.arange(PAIR_FRAGMENTS + 1).astype(U) * U((1 << 64) // PAIR_FRAGMENTS - 1))
            edges[-1] = len(h)
            out += [(l, f, salt, is_x, x, n, h[a:b].tobytes()) for f, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
        columns = list(zip(*out, strict=True)) or [()] * 7
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in PAIR.split(", ")])


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlaps within a fragment: a leader's part comes before those of its members."""
    own, own_n, whose = np.zeros(0, U), 0, None
    for batch in batches:
        found: list[tuple] = []
        for l, f, salt, is_x, x, n, raw in zip(*(batch.column(c).to_pylist() for c in ("l", "f", "salt", "is_x", "x", "n", "hashes")), strict=True):
            h = np.frombuffer(raw, U)
            if not is_x:
                own, own_n, whose = h, n, (l, f, salt)
            elif whose == (l, f, salt) and len(own) and len(h):
                at = np.searchsorted(own, h)
                hits = int((own[np.minimum(at, len(own) - 1)] == h).sum())
                if hits:
                    found.append((x, l, n, own_n, hits))
        columns = list(zip(*found, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["x", "l", "nx", "nl", "part"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, l) that link: overlaps are counted in each fragment apart and summed per pair."""
    pairs = written(pairs, "join-pairs")
    size = pairs.groupBy("l").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("int").alias("salts"))
    some, n_pairs = sets.select("cls", "n", "hashes"), pairs.count()
    members = some.withColumnRenamed("cls", "x").join(near(pairs.join(size, "l"), n_pairs), "x").select(
        "l", F.pmod(F.xxhash64("x"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("is_x"), "x", "n", "hashes"
    )
    leaders = some.withColumnRenamed("cls", "l").join(near(size, n_pairs), "l").select(
        "l", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("is_x"), F.col("l").alias("x"), "n", "hashes"
    )
    parts = members.unionByName(leaders).mapInArrow(_cut_pair, PAIR)
    met = parts.repartition("l", "f", "salt").sortWithinPartitions("l", "f", "salt", "is_x").mapInArrow(_partial, "x bigint, l bigint, nx bigint, nl bigint, part bigint")
    # the sizes come with the parts, so the sets aren't joined once more
    overlap = met.groupBy("x", "l").agg(F.sum("part").alias("o"), F.max("nx").alias("nx"), F.max("nl").alias("nl"))
    return overlap.filter(
        F.col("o") * 100 >= (F.col("nx") + F.col("nl") - F.col("o")) * percent
    ).select(F.col("x").alias("a"), F.col("l").alias("b"))


def _min_hashes(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mix(np.arange(seed * KEYS_PER_ROUND + 1, (seed + 1) * KEYS_PER_ROUND + 1).astype(U) * U(0x632BE59BD9B4E019))
        for batch in batches:
            sets = [np.frombuffer(r, U) for r in batch.column("hashes").to_pylist()]
            keys = [[int(mix(s ^ k).min().astype(np.int64)) for k in seeds] for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), batch.column("comp"), batch.column("n"), pa.array(keys, pa.list_(pa.int64()))], ["cls", "comp", "n", "keys"])

    return run


def led(sets: DataFrame, seed: int, percent: int) -> DataFrame:
    """Pairs (x, l): each class with the smallest and the largest class of its min-hash keys, where components differ and lengths fit."""
    keyed = sets.mapInArrow(_min_hashes(seed), "cls bigint, comp bigint, n bigint, keys array<bigint>").select("cls", "comp", "n", F.posexplode("keys").alias("j", "key"))
    keyed = written(keyed, "join-keys")
    heads = keyed.groupBy("j", "key").agg(F.min(F.struct("cls", "comp", "n")).alias("lo"), F.max(F.struct("cls", "comp", "n")).alias("hi")).filter("lo.cls != hi.cls")
    met = keyed.join(heads, ["j", "key"]).select("cls", "comp", "n", F.explode(F.array("lo", "hi")).alias("h"))
    fits = (F.col("n") * 100 >= F.col("h.n") * percent) & (F.col("h.n") * 100 >= F.col("n") * percent)
    return met.filter((F.col("comp") != F.col("h.comp")) & fits).select(F.col("cls").alias("x"), F.col("h.cls").alias("l")).distinct()


def prefixed(sets: DataFrame, percent: int) -> DataFrame:
    """Of each class the first n-grams among those that several components have, the rarest first: cls, comp, n, h, rest, alone, s0, s1, ...

    Two classes of different components that link have one of these in common. rest: n-grams of that kind from this one on; alone: the class's
    n-grams that no other component has; s0, s1, ...: parities of the others, dealt into 64 * SIGNATURE bits.
    """

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "hashes"):
            sets = [np.frombuffer(r, np.int64) for r in batch.column("hashes").to_pylist()]
            lens = [len(s) for s in sets]
            repeated = [pa.array(np.repeat(batch.column(c).to_numpy(), lens), pa.int64()) for c in ("cls", "comp", "n")]
            yield pa.RecordBatch.from_arrays([*repeated, pa.array(np.concatenate([*sets, np.zeros(0, np.int64)]))], ["cls", "comp", "n", "h"])

    rows = sets.mapInArrow(grams, "cls bigint, comp bigint, n bigint, h bigint")
    spread = rows.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("df")).filter("lo != hi").select("h", "df")
    of_class = Window.partitionBy("cls")
    bit = F.expr("shiftleft(1L, CAST(h & 63 AS INT))")
    signature = [F.bit_xor(F.when(F.shiftright("h", 6).bitwiseAND(F.lit(SIGNATURE - 1)) == k, bit).otherwise(F.lit(0).cast("bigint"))).over(of_class).alias(f"s{k}") for k in range(SIGNATURE)]
    among = rows.join(spread, "h").select(
        "*", F.row_number().over(of_class.orderBy("df", "h")).alias("i"), F.count(F.lit(1)).over(of_class).alias("t"), *signature
    )
    return among.filter(F.col("i") <= F.col("t") - F.ceil(F.col("n") * percent / 100) + 1).select(
        "cls", "comp", "n", "h", (F.col("t") - F.col("i") + 1).alias("rest"), (F.col("n") - F.col("t")).alias("alone"), *[f"s{k}" for k in range(SIGNATURE)]
    )


def _met(prefix: DataFrame, other: DataFrame, same: Column, percent: int) -> DataFrame:
    """x, l, differ, comp_x, comp_l: rows of both that meet and can link; other's columns begin with l.

    A pair's symmetric difference has the n-grams that either has alone, and at least as many others as the parities differ. A pair is left
    out only where that is more than a link allows, or where sizes or what is left of either don't allow one.
    """
    n, ln = F.col("n"), F.col("ln")
    # from the first n-gram that a linked pair has in common, either side has at least the whole overlap left
    least = F.ceil((n + ln) * percent / (100 + percent) - 1e-9)
    fits = (n * 100 >= ln * percent) & (ln * 100 >= n * percent)
    differ = F.col("alone") + F.col("lalone")  # at least so many n-grams are in one of the two only
    for c in range(SIGNATURE):
        differ += F.bit_count(F.col(f"s{c}").bitwiseXOR(F.col(f"ls{c}")))
    close = differ * (100 + percent) <= (n + ln) * (100 - percent)
    met = prefix.join(other, same & (F.col("comp") != F.col("lcomp")) & fits & (F.least("rest", "lrest") >= least) & close)
    return met.select(F.col("cls").alias("x"), F.col("lcls").alias("l"), differ.alias("differ"), F.col("comp").alias("comp_x"), F.col("lcomp").alias("comp_l")).distinct()


def met_by_prefix(prefix: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that can link."""
    other = prefix.select(*[F.col(c).alias(f"l{c}") for c in prefix.columns])
    return _met(prefix, other, (F.col("h") == F.col("lh")) & (F.col("cls") > F.col("lcls")), percent)


def led_by_prefix(prefix: DataFrame, seed: int, percent: int) -> DataFrame:
    """Of those pairs the ones with HEADS classes of each n-gram, picked by a hash: HEADS rows for each prefix row at most, never a group's pairs."""
    own = F.struct(*[c for c in prefix.columns if c != "h"])
    picked = F.array_distinct(F.array(*[F.min_by(own, F.xxhash64("cls", F.lit(seed * HEADS + k))) for k in range(HEADS)]))
    heads = prefix.groupBy("h").agg(picked.alias("l")).select(F.col("h").alias("lh"), F.explode("l").alias("l"))
    heads = heads.select("lh", *[F.col(f"l.{c}").alias(f"l{c}") for c in prefix.columns if c != "h"])
    return _met(prefix, heads, F.col("h") == F.col("lh"), percent)


def by_prefix(sets: DataFrame, percent: int) -> DataFrame:
    return met_by_prefix(written(prefixed(sets, percent), "join-prefix"), percent)


def join(docs: DataFrame, *, n: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id reachable by links of Jaccard similarity percent / 100 or more."""
    return _joined(docs, n=n, percent=percent, id_col=id_col, text_col=text_col)[0].drop("cls")


def _joined(docs: DataFrame, *, n: int, percent: int = 75, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """join() with the class of each row, and the components of classes that were looked at (cls, comp)."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = written(described(texts, n), "join-documents")
    classes = written(found.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")), "join-classes")
    fragments = _fragments((classes.agg(F.sum("n")).first()[0] or 0) // 2, spark)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(n)
        for batch in slices(batches, "text"):
            sets = hasher.sets(batch.column(0).to_pylist())
            keys = np.array([class_of(s) for s in sets], np.int64)
            yield from _dealt(sets, keys, keys, fragments, percent)

    shared = shared_counts(texts.select("text").mapInArrow(prefixes, ENTRIES), fragments)
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) / 4))
    left = written(classes.join(shared, F.col("cls") == F.col("key")).filter(F.col("shared") >= least).select("cls", "rep", "n"), "join-left")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(n)
        for batch in slices(batches, "text"):
            sets = hasher.sets(batch.column("text").to_pylist())
            cls = batch.column("cls").to_pylist()
            mine = [(c, len(s), s.tobytes()) for c, s in zip(cls, sets, strict=True) if class_of(s) == c]
            columns = list(zip(*mine, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["cls", "n", "hashes"])

    n_left = left.count()
    chosen = texts.join(near(left.select("rep", "cls"), n_left), F.col("doc_id").eqNullSafe(F.col("rep"))).select("cls", "text")
    sets = written(chosen.mapInArrow(whole, "cls bigint, n bigint, hashes binary"), "join-sets")
    if not sets.groupBy("cls").count().filter("count > 1").isEmpty():  # rows of one identifier with one set
        sets = written(sets.dropDuplicates(["cls"]), "join-sets")
    comps = written(sets.select("cls", F.col("cls").alias("comp")), "join-components")
    edges = None

    def absorb(new: DataFrame) -> bool:
        """Takes in new links; whether there were any."""
        nonlocal edges, comps
        new = written(new, "join-edges")
        if new.isEmpty():
            return False
        edges = new if edges is None else edges.unionByName(new)
        comps = written(
            sets.select("cls").join(components(edges), F.col("cls") == F.col("node"), "left").select("cls", F.coalesce("label", "cls").alias("comp")), "join-components"
        )
        return True

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "hashes"):
            own = [np.frombuffer(r, U) for r in batch.column("hashes").to_pylist()]
            yield from _dealt(own, batch.column("cls").to_numpy(), batch.column("comp").to_numpy(), fragments, percent)

    open_sets = sets
    for seed in range(ROUNDS):
        linked = absorb(verified(led(open_sets.join(near(comps, n_left), "cls"), seed, percent), sets, percent))
        with_comp = open_sets.join(near(comps, n_left), "cls")
        other = shared_counts(with_comp.mapInArrow(across, ENTRIES), fragments)
        other = written(other, "join-shared")
        still = open_sets.join(near(other, n_left), F.col("cls") == F.col("key")).filter(F.col("shared") >= least)
        before, open_sets = open_sets, written(still.select("cls", "n", "hashes"), "join-open")
        if seed:
            drop_written(before)
        if open_sets.isEmpty() or not linked:
            break
    if not open_sets.isEmpty():
        prefix, first = written(prefixed(open_sets.join(near(comps, n_left), "cls"), percent), "join-prefix"), comps

        def present(df: DataFrame, *sides: str) -> DataFrame:
            """df, labelled by the components as they are now."""
            moved = first.withColumnRenamed("comp", "was").join(near(comps, n_left), "cls").filter("was != comp").select("was", "comp").distinct()
            for side in sides:
                now = near(moved.select(F.col("was").alias(f"was_{side}"), F.col("comp").alias("now")), n_left)
                df = df.join(now, F.col(side) == F.col(f"was_{side}"), "left").withColumn(side, F.coalesce("now", side)).drop("now", f"was_{side}")
            return df

        def closest(candidates: DataFrame) -> DataFrame:
            """Of two components the pair that differs least: a link makes the others needless."""
            two = F.least("comp_x", "comp_l").alias("a"), F.greatest("comp_x", "comp_l").alias("b")
            return candidates.groupBy(*two).agg(F.min(F.struct("differ", "x", "l")).alias("p")).select("p.x", "p.l")

        for seed in range(HEAD_ROUNDS):
            if not absorb(verified(closest(led_by_prefix(present(prefix, "comp"), seed, percent)), sets, percent)):
                break
        candidates, first = written(met_by_prefix(present(prefix, "comp"), percent), "join-candidates"), comps
        chosen = written(closest(candidates), "join-chosen")
        if absorb(verified(chosen, sets, percent)):
            rest = present(candidates.join(near(chosen, chosen.count()), ["x", "l"], "left_anti"), "comp_x", "comp_l")
        else:
            rest = candidates.join(near(chosen, chosen.count()), ["x", "l"], "left_anti")
        absorb(verified(rest.filter("comp_x != comp_l").select("x", "l"), sets, percent))
    drop_written(sets)

    by_class = classes.join(comps, "cls", "left").select("cls", "rep", F.coalesce("comp", "cls").alias("comp"))
    first = by_class.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = by_class.join(first, "comp").select("cls", "component_id")
    return found.join(named, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "cls"
    ), comps


def keep_one(docs: DataFrame, *, n: int = 5, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that stay, with all their columns: of each component one row with its smallest identifier.

    Of a component's rows that repeat its smallest identifier the one with the least text stays. Rows without words stay, and so do
    the rows of a component that has no identifier at all.
    """
    names = docs.columns
    found, comps = _joined(docs, n=n, id_col=id_col, text_col=text_col, **options)
    stay = written(found.filter("doc_id <=> component_id").select(F.col("doc_id").alias("stays"), "cls"), "join-stay")
    key, flag = F.col(f"`{id_col}`").cast("long"), _free("kept", names)
    kept = docs.join(stay.select(F.col("stays").alias(flag)).distinct(), key.eqNullSafe(F.col(flag)), "left_semi")
    unclear = written(stay.groupBy("stays").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1 OR stays IS NULL").select(F.col("stays").alias(flag)), "join-unclear")
    if unclear.isEmpty():
        return kept
    # identifiers with several rows, and null: rows are told apart by their sets
    text = F.col(f"`{text_col}`").cast("string")
    several = kept.join(unclear, key.eqNullSafe(F.col(flag)), "left_semi").select(key.alias("doc_id"), text.alias("text"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(n)
        for batch in slices(batches, "text"):
            yield batch.append_column("cls", pa.array([class_of(s) for s in hasher.sets(batch.column("text").to_pylist())], pa.int64()))

    told = several.mapInArrow(classes, T.StructType([*several.schema.fields, T.StructField("cls", T.LongType())]))
    told = told.join(comps.withColumnRenamed("cls", "c"), F.col("cls") == F.col("c"), "left").withColumn("comp", F.coalesce("comp", "cls"))
    alone = F.col("cls") == 0  # no words
    one = told.filter(~alone & F.col("doc_id").isNotNull()).groupBy("doc_id", "comp").agg(F.min_by("row", "text").alias("row")).select("row.*")
    unnamed = told.filter(F.col("doc_id").isNull() & ~alone).join(stay.filter("stays IS NULL").select(F.col("cls").alias("c2")).distinct(), F.col("cls") == F.col("c2"), "left_semi")
    clear = kept.join(unclear, key.eqNullSafe(F.col(flag)), "left_anti")
    return clear.unionByName(one).unionByName(told.filter(alone).select("row.*")).unionByName(unnamed.select("row.*"))


def _free(name: str, taken: list[str]) -> str:
    """A column name that isn't taken."""
    while name in taken:
        name = f"_{name}"
    return name
