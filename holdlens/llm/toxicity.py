"""Toxicity: a counterfactual-regularised logistic classifier.

Features of a text are the presence of words and of word beginnings (3 to 6 letters). Everything is learnt from a bounded sample of
labelled rows (sample_rows), of which only numbers of features reach the driver: the vocabulary keeps the features whose frequency differs most
between the labels; the weights are fitted by proximal gradient descent with an L1 penalty. For every sentence
of the sampled texts that names an identity term, and for neutral sentences made from a few templates, each term is swapped for
the others of its group and the change of the score is penalised (squared change of the log odds), so that naming a
group doesn't raise the score by itself. Equal changes are counted in the tasks; all of them count, with their number as weight.

Scoring is one pass of Arrow kernels over slices of texts: distinct words of a slice are looked up once.

Defined results: a null or empty text has no features and gets the score of the bias; a row without a label, or whose label is
null, isn't learnt from; equal labels of one document count once, of different ones each counts; of rows with one identifier the least
text is learnt from and every one is scored; a null identifier is scored, not learnt from, and never held out; without both labels the score is the share
of label 1 (0 if there are no labels); an empty table gives no rows; further columns, whatever their names, are never read. Whole texts
are read, never prefixes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_written, release, slices, small_batches, written

#: Groups of identity terms; a term is swapped for the others of its group.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "trans", "nonbinary"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("gay", "lesbian", "straight", "bisexual"),
    ("immigrant", "refugee", "citizen", "foreigner"),
    ("disabled", "deaf", "blind", "elderly", "young"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
)
#: Neutral sentences that only name a group.
TEMPLATES = ("i am {}", "my friend is {}", "{} people live here", "the {} community met today")
_GROUP = {t: g for g in IDENTITY_TERMS for t in g}
NO_LETTER, SENTENCE_END = r"[^\p{L}]+", r"[.!?\n]+"
BEGINNINGS = (3, 4, 5, 6)
#: Bytes of texts whose words are looked up together; distinct words of which a worker keeps the features.
SLICE, SEEN = 2 << 20, 100_000
#: Entries of a matrix that a step of the fit takes at once.
STEP_ENTRIES = 1 << 20


def features(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in BEGINNINGS if len(word) >= n)] if word else []


def word_lists(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of the texts, and for each word of each text, in order, its number and the text's."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), NO_LETTER)
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))


def expanded(words: list[str], code: np.ndarray, row: np.ndarray, numbers: Callable[[str], list[int]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text and feature of its words: number of the feature and of the text, no pair twice, by text; n: above all numbers."""
    own = [numbers(w) for w in words]
    lengths = np.array([len(x) for x in own], np.int64)
    flat, starts = np.array([i for x in own for i in x], np.int64), np.cumsum(lengths) - lengths
    some = lengths[code] > 0
    code, row = code[some], row[some]
    many = lengths[code]
    within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    pairs = np.unique(np.repeat(row, many) * n + flat[np.repeat(starts[code], many) + within])
    return pairs % n, pairs // n


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each slice: feature, rows with it and label 0, rows with it and label 1."""
    for batch in slices(batches, "text", SLICE):
        index: dict[str, int] = {}
        words, code, row = word_lists(batch.column("text"))
        numbers = [[index.setdefault(f, len(index)) for f in features(w)] for w in words]
        feature, row = expanded(words, code, row, dict(zip(words, numbers, strict=True)).__getitem__, max(len(index), 1))
        y = batch.column("y").to_numpy()[row]
        n = np.bincount(feature, minlength=len(index)), np.bincount(feature, weights=y, minlength=len(index)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(index), pa.string()), pa.array(n[0] - n[1], pa.int64()), pa.array(n[1], pa.int64())], ["feature", "n0", "n1"])


def vocabulary(rows: DataFrame, total: tuple[int, int], size: int, least: int) -> list[str]:
    """The features whose shares of rows differ most between the labels (z of two proportions), over all rows (text, y)."""
    n = rows.mapInArrow(_frequencies, "feature string, n0 bigint, n1 bigint").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    p0, p1, p = F.col("n0") / total[0], F.col("n1") / total[1], (F.col("n0") + F.col("n1")) / (total[0] + total[1])
    z = F.abs(p1 - p0) / F.sqrt(p * (1 - p) * (1 / total[0] + 1 / total[1]) + F.lit(1e-12))
    chosen = n.filter(F.col("n0") + F.col("n1") >= least).select("feature", z.alias("z")).orderBy(F.desc("z"), "feature").limit(size)
    return [r["feature"] for r in chosen.collect()]


Change = tuple[tuple[int, ...], tuple[int, ...]]


def sentence_words(text: str) -> Iterator[set[str]]:
    """The words of each sentence of a lower-case text."""
    cut = lambda t, pattern: pc.split_pattern_regex(pa.array([t]), pattern).values.to_pylist()
    for sentence in cut(text, SENTENCE_END):
        yield {w for w in cut(sentence, NO_LETTER) if w}


def swaps(sentences: Iterator[set[str]], index: dict[str, int]) -> Counter[Change]:
    """(features lost, features gained) -> how many swaps of an identity term make this change, over the sentences' words."""
    own = {t: frozenset(index[f] for f in features(t) if f in index) for t in _GROUP}
    found: Counter[Change] = Counter()
    for words in sentences:
        terms = words & _GROUP.keys()
        if not terms:
            continue
        cover = Counter(i for w in words for i in {index[f] for f in features(w) if f in index})
        for term in terms:
            for other in _GROUP[term]:
                if other != term:
                    lost = tuple(sorted(i for i in own[term] - own[other] if cover[i] == 1))
                    gained = tuple(sorted(i for i in own[other] if not cover[i]))
                    if lost or gained:
                        found[lost, gained] += 1
    return found


def template_sentences() -> Iterator[set[str]]:
    return (set(t.format(term).split()) for t in TEMPLATES for term in _GROUP)


def _changes(index: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            words, code, row = word_lists(batch.column("text"))
            named = np.unique(row[np.isin(code, [i for i, w in enumerate(words) if w in _GROUP])])
            lower = pc.utf8_lower(batch.column("text").take(pa.array(named))).to_pylist()
            found = swaps((s for t in lower for s in sentence_words(t)), index)
            keys = list(found)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([k[i] for k in keys], pa.list_(pa.int32())) for i in (0, 1)), pa.array([found[k] for k in keys], pa.int64())], ["lost", "gained", "n"]
            )

    return run


def _matrix(index: dict[str, int]):
    """Of each slice one row: numbers of features by text (16 bits each), how many each text has, labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = lambda w: [index[f] for f in features(w) if f in index]
        for batch in slices(batches, "text", SLICE):
            feature, row = expanded(*word_lists(batch.column("text")), numbers, max(len(index), 1))
            lengths = np.bincount(row, minlength=batch.num_rows)
            got = feature.astype("<u2").tobytes(), lengths.astype("<u2").tobytes(), batch.column("y").to_numpy().astype("u1").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in got], ["features", "lengths", "y"])

    return run


class Classifier:
    def __init__(self, chosen: list[str], weights: np.ndarray, bias: float) -> None:
        self.weights = {f: float(w) for f, w in zip(chosen, weights, strict=True) if w}
        self.bias = bias
        self.seen: dict[str, list[int]] = {}

    def scores(self, texts: pa.Array) -> np.ndarray:
        index = {f: i for i, f in enumerate(self.weights)}
        weights = np.array(list(self.weights.values()))
        if len(self.seen) > SEEN:
            self.seen.clear()

        def numbers(word: str) -> list[int]:
            own = self.seen.get(word)
            if own is None:
                own = self.seen[word] = [index[f] for f in features(word) if f in index]
            return own

        feature, row = expanded(*word_lists(texts), numbers, max(len(index), 1))
        z = self.bias + np.bincount(row, weights=weights[feature] if len(feature) else None, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(features: np.ndarray, lengths: np.ndarray, y: np.ndarray, changes: dict[Change, int], chosen: list[str], *, l1: float, swap_penalty: float, rounds: int) -> Classifier:
    """Proximal gradient (accelerated) on mean log loss + l1 * |w| + swap_penalty * mean squared change of log odds under swaps."""
    n, size = len(lengths), len(chosen)
    # rows in steps of bounded size: (first row, end, first entry, end)
    ends = np.cumsum(lengths)
    edges = [0, *(np.flatnonzero(np.diff(ends // STEP_ENTRIES)) + 1).tolist(), n]
    steps = [(a, b, int(ends[a] - lengths[a]), int(ends[b - 1])) for a, b in zip(edges, edges[1:], strict=False)]
    pairs = sorted(changes)
    pweight = np.array([changes[p] for p in pairs], float) / max(sum(changes.values()), 1)
    pat = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs])
    pcols = np.array([i for a, b in pairs for i in (*a, *b)], np.int64)
    psign = np.array([s for a, b in pairs for s in (*[1.0] * len(a), *[-1.0] * len(b))])
    # both labels weigh the same
    share = y.mean()
    weight = np.where(y == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)) / n
    w, b = np.zeros(size), 0.0
    v, vb, momentum = w.copy(), b, 1.0
    # 1 / (a bound of the gradient's Lipschitz constant)
    step = 1.0 / (0.25 * float(weight @ (lengths + 1)) + 2 * swap_penalty * float(pweight[pat].sum()))
    for _ in range(rounds):
        grad, grad_b = np.zeros(size), 0.0
        for first, end, lo, hi in steps:
            cols, own = features[lo:hi], lengths[first:end]
            at = np.repeat(np.arange(end - first, dtype=np.int32), own)
            z = vb + np.bincount(at, v[cols], end - first)
            g = weight[first:end] * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y[first:end])
            grad += np.bincount(cols, g[at], size)
            grad_b += g.sum()
        if len(pairs):
            change = pweight * np.bincount(pat, psign * v[pcols], len(pairs))
            grad += 2 * swap_penalty * np.bincount(pcols, psign * change[pat], size)
        new = v - step * grad
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        new_b = vb - step * grad_b
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        v, vb = new + (momentum - 1) / after * (new - w), new_b + (momentum - 1) / after * (new_b - b)
        w, b, momentum = new, new_b, after
    return Classifier(chosen, w, b)


def train(
    docs: DataFrame, labels: DataFrame, *, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample_rows: int = 20_000, vocabulary_size: int = 4096, least_rows: int = 3, l1: float = 2e-4, swap_penalty: float = 1.0, rounds: int = 400,
) -> Classifier:
    """Learns from the rows of labels for which learn (a condition on doc_id) holds.

    sample_rows bounds the labelled documents that are read: up to half of it for either label, the first ones by a hash of the
    identifier, so the joined side is always small enough to broadcast.
    """
    small_batches(docs.sparkSession)
    y = labels.filter(F.col(label_col).isin(0, 1)).select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    y = y.filter(F.col("doc_id").isNotNull() & learn).distinct()
    all_counts = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = all_counts.get(0, 0), all_counts.get(1, 0)
    constant = lambda n0, n1: Classifier([], np.zeros(0), float(np.log(n1 / n0)) if n0 and n1 else (50.0 if n1 else -50.0))
    if not n0 or not n1:
        return constant(n0, n1)
    order = F.xxhash64("doc_id", F.lit(17))
    few = [y.filter(F.col("y") == k).orderBy(order, "doc_id").limit(sample_rows // 2) for k in (0, 1)]
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(few[0].unionByName(few[1])), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    rows = written(found.select("text", "y"), "toxicity-labelled")
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return constant(counts.get(0, 0), counts.get(1, 0))
    chosen = vocabulary(rows, (counts[0], counts[1]), vocabulary_size, least_rows)
    index = {f: i for i, f in enumerate(chosen)}
    by_change = rows.mapInArrow(_changes(index), "lost array<int>, gained array<int>, n bigint").groupBy("lost", "gained").agg(F.sum("n").alias("n"))
    changes = swaps(template_sentences(), index)
    for r in by_change.collect():
        changes[tuple(r["lost"]), tuple(r["gained"])] += r["n"]
    parts = rows.mapInArrow(_matrix(index), "features binary, lengths binary, y binary").toArrow()
    parts = parts.sort_by([(c, "ascending") for c in ("y", "lengths", "features")]).combine_chunks().to_batches()  # tasks end in any order
    joined = lambda c, kind: np.frombuffer(b"".join(x for p in parts for x in p.column(c).to_pylist()), kind)
    numbers, lengths, y = joined("features", "<u2"), joined("lengths", "<u2").astype(np.int64), joined("y", "u1").astype(float)
    drop_written(rows)
    model = fit(numbers, lengths, y, changes, chosen, l1=l1, swap_penalty=swap_penalty, rounds=rounds)
    del parts, numbers, lengths, y
    release()  # the driver lives on too
    return model


def scored(docs: DataFrame, model: Classifier, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(batch.column(1)), pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, score double")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: learnt from the labelled rows that aren't held out."""
    model = train(docs, labels, learn=~held_out(F.col("doc_id")))
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    return scored(docs, model).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that aren't predicted toxic, with all their columns."""
    model = train(docs, labels, learn=~held_out(F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            yield batch.filter(pa.array(model.scores(batch.column("text")) < 0.5))

    return docs.mapInArrow(run, docs.schema)
