"""Simple-8b coding of token ids: 64-bit words of a 4-bit selector and 60 bits of equal fields.

Ids are coded in blocks of 128. Every block starts a new word and its offset is kept, so blocks
are coded and decoded side by side with array operations. The last word of a block may hold fewer
ids than its selector says; its other fields are zero.
"""

from __future__ import annotations

import numpy as np

BLOCK = 128

# Fixed values of the format: the ids in a word and the bits of each, by selector. The last is the
# escape, for an id too large for any other.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])


def _bits(ids: np.ndarray) -> np.ndarray:
    """How many bits each id needs, one at least."""
    return np.maximum(np.frexp(ids.astype(np.float64))[1], 1).astype(np.uint8)


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words and the number of words before each block, for unsigned ids below 2 ** 53."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    n_blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    # Ids behind the end of a block are zeros of one bit: they fit any word, and are cut off.
    longest = int(COUNTS[0])
    wide = np.zeros((n_blocks, BLOCK + longest), np.uint64)
    body = np.zeros(n_blocks * BLOCK, np.uint64)
    body[:n] = ids
    wide[:, :BLOCK] = body.reshape(n_blocks, BLOCK)
    bits = np.ones(wide.shape, np.uint8)
    bits[:, :BLOCK] = _bits(wide[:, :BLOCK])
    sizes = np.full(n_blocks, BLOCK)
    sizes[-1] = n - (n_blocks - 1) * BLOCK
    flat_ids, flat_bits = wide.ravel(), bits.ravel()
    # By place, the selector that takes the most ids from there on.
    chosen = np.full(len(flat_bits), len(COUNTS) - 1, np.uint8)
    most, reach = flat_bits, 1
    for s in range(len(COUNTS) - 2, -1, -1):
        step = int(COUNTS[s]) - reach
        while step:
            part = min(step, reach)
            most = np.maximum(most[: len(most) - part], most[part:])
            reach, step = reach + part, step - part
        fits = most <= WIDTHS[s]
        if not fits.any() and s < 8:
            break
        chosen[: len(most)][fits] = s
    # Every round makes one word of every block that has ids left.
    places = np.arange(n_blocks) * wide.shape[1]
    ends = places + sizes
    active = np.arange(n_blocks)
    rows, words = [], []
    while len(active):
        at = places[active]
        selector = chosen[at]
        word = selector.astype(np.uint64) << np.uint64(60)
        for s in np.unique(selector):
            of = np.flatnonzero(selector == s)
            start = at[of]
            packed = np.zeros(len(of), np.uint64)
            for k in range(int(COUNTS[s])):
                packed |= flat_ids[start + k] << np.uint64(k * int(WIDTHS[s]))
            word[of] |= packed
        rows.append(active)
        words.append(word)
        places[active] = at + COUNTS[selector]
        active = active[places[active] < ends[active]]
    row, word = np.concatenate(rows), np.concatenate(words)
    counts = np.bincount(row, minlength=n_blocks)
    offsets = np.concatenate([[0], np.cumsum(counts)[:-1]])
    out = np.empty(len(word), np.uint64)
    nth = np.concatenate([np.full(len(r), i) for i, r in enumerate(rows)])
    out[offsets[row] + nth] = word
    return out, offsets.astype(np.uint32)


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids that were coded, as unsigned 64-bit numbers."""
    ids = np.zeros(n, np.uint64)
    if not n:
        return ids
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    ends = np.cumsum(counts)
    offsets = offsets.astype(np.int64)
    n_words = np.diff(np.append(offsets, len(words)))
    block = np.repeat(np.arange(len(offsets)), n_words)
    before_block = (ends - counts)[offsets]
    starts = ends - counts - before_block[block] + block * BLOCK
    limits = np.minimum((block + 1) * BLOCK, n)
    for s in np.unique(selectors):
        of = np.flatnonzero(selectors == s)
        width = np.uint64(WIDTHS[s])
        mask = np.uint64((1 << int(width)) - 1)
        held, start, limit = words[of], starts[of], limits[of]
        for k in range(int(COUNTS[s])):
            there = start + k < limit
            field = (held >> (np.uint64(k) * width)) & mask
            ids[(start + k)[there]] = field[there]
    return ids
