"""XXH64 of many short byte spans at once, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

# Fixed values of the XXH64 algorithm.
_P1 = np.uint64(0x9E3779B185EBCA87)
_P2 = np.uint64(0xC2B2AE3D27D4EB4F)
_P3 = np.uint64(0x165667B19E3779F9)
_P4 = np.uint64(0x85EBCA77C2B2AE63)
_P5 = np.uint64(0x27D4EB2F165667C5)

#: Longer spans are hashed one at a time.
LONGEST = 128


def _rotate(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotate(acc + lane * _P2, 31) * _P1


def _same_length(buf: np.ndarray, at: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of the spans of n bytes at `at`. buf has 8 spare bytes at its end."""
    eight = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    four = np.ndarray((len(buf) - 3,), "<u4", buf, strides=(1,))
    done = 0
    with np.errstate(over="ignore"):
        s = np.uint64(seed)
        if n >= 32:
            v = [np.full(len(at), x) for x in (s + _P1 + _P2, s + _P2, s, s - _P1)]
            while done + 32 <= n:
                v = [_round(x, eight[at + (done + 8 * i)]) for i, x in enumerate(v)]
                done += 32
            h = _rotate(v[0], 1) + _rotate(v[1], 7) + _rotate(v[2], 12) + _rotate(v[3], 18)
            for x in v:
                h = (h ^ _round(np.zeros_like(x), x)) * _P1 + _P4
        else:
            h = np.full(len(at), s + _P5)
        h = h + np.uint64(n)
        while done + 8 <= n:
            h = _rotate(h ^ _round(np.zeros_like(h), eight[at + done]), 27) * _P1 + _P4
            done += 8
        if done + 4 <= n:
            h = _rotate(h ^ (four[at + done].astype(np.uint64) * _P1), 23) * _P2 + _P3
            done += 4
        while done < n:
            h = _rotate(h ^ (buf[at + done].astype(np.uint64) * _P5), 11) * _P1
            done += 1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))


def xxh64_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of buf[start:end] for each span, as uint64."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    size = ends - starts
    out = np.empty(len(starts), np.uint64)
    order = np.argsort(np.minimum(size, LONGEST + 1).astype(np.uint8 if LONGEST < 255 else np.int64), kind="stable")
    ranked = size[order]
    cut = np.searchsorted(ranked, np.arange(LONGEST + 2))
    for n in range(LONGEST + 1):
        group = order[cut[n] : cut[n + 1]]
        if len(group):
            out[group] = _same_length(padded, starts[group], n, seed)
    for i in order[cut[LONGEST + 1] :]:
        out[i] = xxhash.xxh64_intdigest(padded[starts[i] : ends[i]].tobytes(), seed)
    return out
