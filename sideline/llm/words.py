"""Words and word shingles of whole groups of documents, as arrays of hashes."""

from __future__ import annotations

import numpy as np

from sideline.llm.hashing import block_hashes, mix

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of its text): A-Z lower-cased, words split at ASCII white space."""
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    low = _LOWER[data]
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] = inside[heads]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    tails = offsets[1:][np.diff(offsets) > 0] - 1
    ends[tails] = inside[tails]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return block_hashes(low, starts, stops), np.searchsorted(offsets, starts, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, one after the other; their offsets).

    A shingle is ``size`` words in a row; a shorter text has its whole word
    sequence as its only one, a text without words has none.
    """
    texts = len(offsets) - 1
    word, text = word_hashes(data, offsets)
    count = np.bincount(text, minlength=texts)
    first = np.cumsum(count) - count
    made = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    owner = np.repeat(np.arange(texts), made)
    at = first[owner] + np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made)
    length = np.minimum(count[owner], size)
    h = mix(length.astype(np.uint64))
    for k in range(size):
        inside = k < length
        h = np.where(inside, mix(h * np.uint64(0x9E3779B97F4A7C15) + word[np.where(inside, at + k, 0)]), h) if len(word) else h
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts))])
