"""Content-chosen anchors: positions that equal strings of a given length choose alike."""

from __future__ import annotations

import numpy as np

from macrotide.llm.text import Rolling, Texts


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest value in every window of ``width`` values, by block-wise running minima."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    # The low bits become the place within two blocks, so that minima carry their index and ties go left.
    bits = int(2 * width - 1).bit_length()
    mask = np.uint64((1 << bits) - 1)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values & ~mask
    grid = padded.reshape(blocks, width)
    place = np.arange(width, dtype=np.uint64)
    ahead = np.minimum.accumulate((grid | place)[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid | (place + np.uint64(width)), axis=1).ravel()
    at = np.arange(n - width + 1)
    first = ahead[at]
    last = behind[at + width - 1]
    aligned = at % width == 0
    start = at - at % width
    best = np.where(aligned | (first < last), first, last)
    return start + (best & mask).astype(np.int64)


def anchors(texts: Texts, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a slice: text, place in the slice, hash, and the first and last start they stand for.

    Every string of ``length`` bytes inside a text is represented by the leftmost of its grams of ``gram`` bytes
    with the smallest hash, so equal strings have the same anchor at the same distance.
    """
    n = len(texts.data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none.astype(np.uint64), none, none
    rolling = Rolling(texts.data)
    h = rolling.runs(gram)
    chosen = window_minima(h, length - gram + 1)
    size = np.maximum(texts.end - texts.start - length + 1, 0)  # starts that fit into each text
    owner = np.repeat(np.arange(len(size)), size)
    start = np.arange(len(owner)) + np.repeat(texts.start - (np.cumsum(size) - size), size)
    if not len(start):
        return none, none, none.astype(np.uint64), none, none
    chosen = chosen[start]
    new = np.append(True, (chosen[1:] != chosen[:-1]) | (start[1:] != start[:-1] + 1))
    begin = np.flatnonzero(new)
    stop = np.append(begin[1:], len(start)) - 1
    return owner[begin], chosen[begin], h[chosen[begin]], start[begin], start[stop]
