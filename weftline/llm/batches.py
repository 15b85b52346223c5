"""Texts of an Arrow batch as numbered words, and hashes of words and of their parts, all in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of text that are worked on at once; one longer text makes a piece of its own.
PIECE_CHARS = 4_000_000


def pieces(batches: Iterator[pa.RecordBatch], text_col: str = "text", chars: int = PIECE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches and their texts (null as empty), each of about so many characters at most.

    Only the texts of one slice are Python strings at a time.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.utf8_length(batch.column(text_col)), 0).to_pylist()
        start = size = 0
        for i, n in enumerate([*sizes, 0]):
            if i == len(sizes) or (size and size + n > chars):
                if i > start:
                    part = batch.slice(start, i - start)
                    yield part, [t or "" for t in part.column(text_col).to_pylist()]
                start, size = i, 0
            size += n


def number(texts: list[str], split=str.split) -> tuple[np.ndarray, list[str], np.ndarray]:
    """codes of all words in order, the distinct words, and offsets of the texts into codes."""
    lists = [split(t) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    flat = np.empty(int(offsets[-1]), object)
    flat[:] = [w for x in lists for w in x]
    codes, distinct = pd.factorize(flat)
    return codes.astype(np.int64), list(distinct), offsets


def chars(distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after the other, and offsets."""
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in distinct])]).astype(np.int64)
    flat = np.frombuffer("".join(distinct).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, offsets


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser with well spread bits (wraps on purpose)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(distinct: list[str]) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    flat, off = chars(distinct)
    n = np.diff(off)
    if not len(n):
        return np.zeros(0, np.uint64)
    place = np.arange(len(flat)) - np.repeat(off[:-1], n)
    each = mix(flat.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(32)) + np.uint64(0x9E3779B97F4A7C15))
    total = np.concatenate([[np.uint64(0)], np.cumsum(each, dtype=np.uint64)])
    return mix(total[off[1:]] - total[off[:-1]] + n.astype(np.uint64))
