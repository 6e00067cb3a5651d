"""Burrows-Wheeler transforms of shards of strings, merged by iterative interleave refinement.

Symbols are groups of STEP bytes, so a byte string gives STEP symbol strings (one for each phase), each with
an end mark that sorts first. A shard's transform lists the symbol before each of its sorted suffixes. Shards
are merged by their transforms alone: the interleave says from which shard each merged suffix comes, in the
order of the first h symbols; one pass over the transforms deals it by the symbols in front, which gives the
order by h + 1. Where the dealt runs divide, the common prefix is h symbols long; stretches of common prefixes of
DEPTH symbols or more are intervals of suffixes that repeat them. No suffix is sorted again.
"""

from __future__ import annotations

import numpy as np

STEP = 8
#: Bytes of a shard.
SHARD_BYTES = 1 << 16


def _stable(values: np.ndarray) -> np.ndarray:
    """Stable order of small non-negative integers, 16 bits at a time."""
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    if len(values) and values.max() > 0xFFFF:
        order = order[np.argsort((values[order] >> 16).astype(np.uint16), kind="stable")]
    return order


class Shard:
    """Sorted suffixes of the symbol strings in slots [low, high), and the symbol before each."""

    def __init__(self, symbols: np.ndarray, begins: np.ndarray, low: int, high: int, longest: int):
        n = high - low
        after = np.minimum(np.arange(n) + STEP, n - 1)
        ended = symbols[low:high] == 0
        after[ended] = np.flatnonzero(ended)[0]
        rank, span = symbols[low:high].astype(np.int64), 1
        while span < longest:  # ranks by twice as many symbols each time
            key = rank * (rank.max() + 1) + np.where(ended, 0, rank[after])
            order = np.argsort(key, kind="stable")
            key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[False, key[1:] != key[:-1]])
            after = np.where(ended, after, after[after])
            span *= 2
        self.suffixes = np.argsort(rank, kind="stable") + low
        first = self.suffixes - begins[self.suffixes] < STEP
        self.transform = np.where(first, 0, symbols[np.maximum(self.suffixes - STEP, 0)])


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in merged order, and each one's common prefix in symbols with the suffix before it (at most depth)."""
    kind = np.uint8 if len(shards) < 256 else np.uint16
    z = np.concatenate([np.full(len(s.suffixes), k, kind) for k, s in enumerate(shards)])
    transforms = np.concatenate([s.transform for s in shards])
    run, prefix = np.zeros(len(z), np.int64), np.full(len(z), depth, np.int16)
    symbol = np.empty(len(z), transforms.dtype)
    for h in range(depth):
        symbol[np.argsort(z, kind="stable")] = transforms
        dealt = _stable(symbol)
        # suffixes without a symbol before them give none of the merged suffixes: the end marks, which sort
        # first and are as many, take their places
        front = symbol[dealt]
        marks = int(np.searchsorted(front, 1))
        if h == 0:
            ends = np.concatenate([np.full(int((s.transform == 0).sum()), k, kind) for k, s in enumerate(shards)])
        z, run = np.concatenate([ends, z[dealt[marks:]]]), np.concatenate([np.zeros(marks, np.int64), run[dealt[marks:]]])
        new = np.r_[False, (front[1:] != front[:-1]) | (run[1:] != run[:-1])]
        prefix[new & (prefix == depth)] = h
        run = np.cumsum(new)
    suffixes = np.empty(len(z), np.int64)
    suffixes[np.argsort(z, kind="stable")] = np.concatenate([s.suffixes for s in shards])
    return suffixes, prefix


def repeated(strings: list[bytes], weights: np.ndarray, length: int) -> list[np.ndarray]:
    """For each string the places at which a substring of `length` bytes starts whose places over all strings
    weigh 2 or more together. Strings have `length` bytes or more; length is a multiple of STEP."""
    size = np.array([len(s) for s in strings])
    slots = size + 1  # a symbol for each place that has STEP bytes, and STEP end marks
    begin = np.cumsum(slots) - slots
    n = int(slots.sum())
    flat = np.zeros(n + STEP, np.uint8)
    flat[np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)] = np.frombuffer(b"".join(strings), np.uint8)
    which = np.repeat(np.arange(len(strings)), slots)
    begins = begin[which]
    place = np.arange(n) - begins
    eight = np.ndarray((n,), ">u8", flat, strides=(1,)).astype(np.uint64)
    real = place < size[which] - (STEP - 1)
    symbols = np.zeros(n, np.int64)
    _, back = np.unique(eight[real], return_inverse=True)
    symbols[real] = back + 1
    cuts, low = [0], 0
    for k in range(len(strings)):
        if begin[k] + slots[k] - low >= SHARD_BYTES or k == len(strings) - 1:
            low = int(begin[k] + slots[k])
            cuts.append(low)
    longest = int(size.max()) // STEP + 1
    shards = [Shard(symbols, begins, a, b, longest) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    depth = length // STEP
    suffixes, prefix = merge(shards, depth)
    run = np.cumsum(prefix < depth)  # suffixes in one interval have depth symbols in common
    heavy = np.bincount(run, weights=weights[which[suffixes]]) >= 2
    hit = np.zeros(n, bool)
    hit[suffixes] = heavy[run]
    hit &= place <= size[which] - length
    return [np.flatnonzero(hit[b : b + s]) for b, s in zip(begin.tolist(), size.tolist(), strict=True)]
