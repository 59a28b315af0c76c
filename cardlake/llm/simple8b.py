"""Simple-8b: unsigned integers in 64-bit words, a selector in the top four bits.

Blocks of ``BLOCK`` integers are coded apart, all blocks of a call in step with
each other; the words before each block are kept, so a reader can start at any
block and decodes all words of one selector at once.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the published code: integers a word and bits an integer, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

BLOCK = 1024
#: The selector of one integer in a word of its own: the way out for what no other holds.
ESCAPE = 15
LARGEST = (1 << 60) - 1


def _choose(padded: np.ndarray) -> np.ndarray:
    """The selector with the most integers that fit from each place on.

    Each integer's width comes from its exponent as a float (beyond 53 bits it
    may be one too many, never too few); then the widest of the next 2, 3, 4 ...
    integers, each of these windows made of two of the one before.
    """
    exponent = (padded.astype(np.float64).view(np.int64) >> 52) - 1022
    widest, have = np.maximum(exponent, 0).astype(np.uint8), 1
    best = np.full((padded.shape[0], BLOCK), ESCAPE, np.uint8)
    for s in range(ESCAPE - 1, -1, -1):
        step = int(COUNTS[s]) - have
        widest, have = np.maximum(widest[:, :-step], widest[:, step:]), int(COUNTS[s])
        best[widest[:, :BLOCK] <= BITS[s]] = s
    return best


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of the values, and the number of words before each block."""
    if len(values) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if int(values.max()) > LARGEST:
        raise ValueError("values of up to 60 bits can be coded")
    blocks = -(-len(values) // BLOCK)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[: len(values)] = values
    padded = np.zeros((blocks, BLOCK + int(COUNTS[0])), np.uint64)
    padded[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    length = np.full(blocks, BLOCK)
    length[-1] = len(values) - (blocks - 1) * BLOCK

    best, row, at, steps = _choose(padded), np.arange(blocks), np.zeros(blocks, np.int64), []
    while len(row):
        chosen = best[row, at]
        steps.append((row, at, chosen))
        at = at + COUNTS[chosen]
        more = at < length[row]
        row, at = row[more], at[more]

    rows, places, chosen = (np.concatenate(x) for x in zip(*steps))
    number = np.concatenate([np.full(len(s[0]), k) for k, s in enumerate(steps)])
    in_block = np.bincount(rows, minlength=blocks)
    before = np.cumsum(in_block) - in_block
    words = np.zeros(len(rows), np.uint64)
    slot, start, flat_ = before[rows] + number, rows * padded.shape[1] + places, padded.reshape(-1)
    order = np.argsort(chosen, kind="stable")
    edges = np.searchsorted(chosen[order], np.arange(len(COUNTS) + 1))
    for s, (lo, hi) in enumerate(zip(edges, edges[1:])):
        if lo == hi:
            continue
        here, bits = order[lo:hi], np.uint64(BITS[s])
        word, first = np.full(hi - lo, np.uint64(s) << np.uint64(60)), start[here]
        if bits:
            for lane in range(COUNTS[s]):
                word |= flat_[first + lane] << (np.uint64(lane) * bits)
        words[slot[here]] = word
    return words, before


def unpack(words: np.ndarray, before: np.ndarray, n: int) -> np.ndarray:
    """The values again; ``n`` is their number."""
    blocks = len(before)
    if not blocks:
        return np.zeros(0, np.uint64)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    upto = np.cumsum(COUNTS[chosen])
    first = upto - COUNTS[chosen]
    out = np.zeros(int(upto[-1]) + BLOCK, np.uint64)
    order = np.argsort(chosen, kind="stable")
    edges = np.searchsorted(chosen[order], np.arange(len(COUNTS) + 1))
    for s, (lo, hi) in enumerate(zip(edges, edges[1:])):
        bits = np.uint64(BITS[s])
        if lo == hi or not bits:
            continue
        here, mask = order[lo:hi], np.uint64((1 << int(BITS[s])) - 1)
        word, to = words[here], first[here]
        for lane in range(COUNTS[s]):
            out[to + lane] = (word >> (np.uint64(lane) * bits)) & mask
    # The last word of a block may reach beyond it.
    return out[(first[before][:, None] + np.arange(BLOCK)).reshape(-1)[:n]]
