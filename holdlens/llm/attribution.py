"""Token counts by section: a whole document is encoded once and its tokens are given to sections by their spans.

Sections are what a separator pattern leaves of a text; a separator belongs to the section before it, so sections cover the text without
gaps. Tokens' spans come from the lengths of the tokens' bytes; spans and section edges are both sorted, so the interval
join is a binary search of the edges in each document. The rule for tokens that cross an edge is explicit: "first" gives the token to the
section that has its first character, "last" to the one that has its last.

Texts are encoded in slices of bounded size, so memory doesn't grow with a batch of long texts.

Defined results: null text counts as empty; a null identifier stays null; an empty text has one empty section without tokens; repeated rows are counted
each; an empty table gives no rows; further columns are never read. The sum over a document's sections is its number of tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, small_batches
from .tokens import PartEncoder

SCHEMA = "doc_id bigint, section int, start_char bigint, end_char bigint, n_tokens bigint, n_crossing bigint, doc_tokens bigint"
RULES = ("first", "last")


def section_edges(text: str, separator: re.Pattern) -> list[int]:
    """Starts of the sections, and the text's end."""
    edges = [0, *(m.end() for m in separator.finditer(text) if 0 < m.end() < len(text))]
    return [*dict.fromkeys(edges), len(text)] if text else [0, 0]


def allot(lengths: np.ndarray, byte_edges: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of these cross an edge; lengths: bytes of each token."""
    ends = np.cumsum(lengths)
    first = np.searchsorted(byte_edges, ends - lengths, "right") - 1
    last = np.searchsorted(byte_edges, ends - 1, "right") - 1
    owner = first if rule == "first" else last
    n = len(byte_edges) - 1
    return np.bincount(owner, minlength=n), np.bincount(owner, weights=first != last, minlength=n).astype(np.int64)


def _run(tokenizer_json: str, separator: str, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PartEncoder(tokenizer_json)
        size = np.zeros(encoder.tokenizer.get_vocab_size() + 1, np.int64)
        for token, i in encoder.tokenizer.get_vocab().items():
            size[i] = len(token)  # a byte-level token has one character for each byte
        pattern = re.compile(separator)
        for batch in slices(batches, "text"):
            texts = batch.column(1).to_pylist()
            ids_out, rows = [], []
            for doc_id, text, raw in zip(batch.column(0).to_pylist(), texts, encoder.encode(texts), strict=True):
                edges = section_edges(text, pattern)
                lengths = size[np.frombuffer(raw, "<u4")]
                if text.isascii():
                    byte_edges = np.array(edges)
                else:
                    byte_edges = np.cumsum([0, *(len(text[a:b].encode()) for a, b in zip(edges, edges[1:], strict=False))])
                own, crossing = allot(lengths, byte_edges, rule)
                n = len(edges) - 1
                ids_out += [doc_id] * n
                rows.append((np.arange(n), np.array(edges[:-1]), np.array(edges[1:]), own[:n], crossing[:n], np.full(n, len(lengths))))
            columns = [np.concatenate(c).astype(np.int64) for c in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64)] * 6
            kinds = [pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids_out, pa.int64()), *(pa.array(c).cast(k) for c, k in zip(columns, kinds, strict=True))], [x.split()[0] for x in SCHEMA.split(", ")]
            )

    return run


def attribute(
    docs: DataFrame, *, tokenizer_json: str, separator: str = r"\n+", rule: str = "first", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row for each section: doc_id, section, start_char, end_char, n_tokens, n_crossing, doc_tokens."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(_run(tokenizer_json, separator, rule), SCHEMA)
