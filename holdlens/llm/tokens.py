"""Fast whole-text encoding with a public tokenizer: each distinct part of a block of texts is encoded once.

A text is cut at its single spaces, which byte-level pre-tokenization never joins to what stands before them. Distinct parts are
encoded by the tokenizer many at a time; a text with a white-space run that the cut would tear is encoded whole. Cutting, numbering
and putting together are Arrow kernels.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A space before white space or the end; the text is torn there if white space stands before it too.
SPACE = re.compile(r" (?=\s|$)")
#: A part that is empty or has white space at an end.
EDGY = r"^$|^[\t-\r\x1c-\x20\x{85}\p{Z}]|[\t-\r\x1c-\x20\x{85}\p{Z}]$"
#: Parts that the tokenizer gets at once.
TOGETHER = 400


def torn(text: str) -> bool:
    """Whether the text has a white-space run that a cut at its single spaces would tear."""
    return any(m.start() and text[m.start() - 1].isspace() for m in SPACE.finditer(text))


@lru_cache(maxsize=1)
def encoder(tokenizer_json: str) -> PartEncoder:
    """The worker process's encoder, which the tasks that follow one another there share."""
    return PartEncoder(tokenizer_json)


class PartEncoder:
    """ids of a text as little-endian unsigned 32-bit bytes."""

    def __init__(self, tokenizer_json: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        self.starts_part = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.starts_part[i] = token.startswith("Ġ")

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, parts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of parts that follow a space and aren't edgy: ids, and the number of ids of each part, in pieces."""
        ids, lengths = [], []
        for i in range(0, len(parts), TOGETHER):
            some = parts[i : i + TOGETHER]
            own = self._whole([" " + " ".join(some)])[0]
            at = np.flatnonzero(self.starts_part[own])
            if len(at) == len(some):
                ids.append(own)
                lengths.append(np.diff(at, append=len(own)))
            else:
                each = self._whole([" " + p for p in some])
                ids += each
                lengths.append(np.array([len(x) for x in each], np.int64))
        return ids, lengths

    def _cut(self, texts: list[str]) -> list[bytes]:
        """encode() for texts that aren't torn."""
        cut = pc.split_pattern(pa.array(texts, pa.string()), " ")
        edges = cut.offsets.to_numpy()
        flat = cut.flatten()
        coded, heads = flat.dictionary_encode(), flat.take(pa.array(edges[:-1])).dictionary_encode()
        edgy = pc.match_substring_regex(coded.dictionary, EDGY)
        plain = np.flatnonzero(~edgy.to_numpy(zero_copy_only=False))
        rest = np.flatnonzero(edgy.to_numpy(zero_copy_only=False))
        ids, lengths = self._parts(coded.dictionary.take(pa.array(plain)).to_numpy(zero_copy_only=False).tolist())
        alone = self._whole([" " + p for p in coded.dictionary.take(pa.array(rest)).to_pylist()] + heads.dictionary.to_pylist())
        lengths.append(np.array([len(x) for x in alone], np.int64))
        ends = np.cumsum(np.concatenate([[0], *lengths])).astype(np.int32)
        table = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, "<u4"), *ids, *alone])))
        place = np.empty(len(coded.dictionary), np.int32)
        place[plain], place[rest] = np.arange(len(plain)), len(plain) + np.arange(len(rest))
        codes = place[coded.indices.to_numpy()]
        codes[edges[:-1]] = len(place) + heads.indices.to_numpy()
        found = table.take(pa.array(codes))
        values, at = found.values.to_numpy(), found.offsets.to_numpy()[edges].tolist()
        return [values[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        apart = [torn(t) for t in texts]
        cut = iter(self._cut([t for t, x in zip(texts, apart, strict=True) if not x]) if not all(apart) else [])
        return [self._whole([t])[0].tobytes() if x else next(cut) for t, x in zip(texts, apart, strict=True)]
