"""XXH64 of many byte strings at once, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: Longer strings are hashed one by one.
LONGEST = 512


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotated(acc + lane * _P2, 31) * _P1


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a little-endian number; zeros stand behind the end."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[: len(data)] = data
    out = np.empty(len(data) + 8, np.uint64)
    for k in range(8):
        part = padded[k : k + (len(out) - k + 7) // 8 * 8].view(np.uint64)
        out[k::8] = part[: len(out[k::8])]
    return out


def xxh64(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 0) -> np.ndarray:
    """The hash of each ``data[start : start + size]``, as unsigned 64-bit numbers."""
    out = np.empty(len(start), np.uint64)
    if not len(start):
        return out
    view = memoryview(np.ascontiguousarray(data))
    long = np.flatnonzero(size > LONGEST)
    for i in long.tolist():
        out[i] = xxhash.xxh64_intdigest(view[start[i] : start[i] + size[i]], seed)
    some = np.flatnonzero(size <= LONGEST)
    word, seed64 = _words(data), np.uint64(seed)
    at, left = start[some].astype(np.int64), size[some].astype(np.int64)
    with np.errstate(over="ignore"):
        h = np.full(len(some), seed64 + _P5, np.uint64)
        wide = np.flatnonzero(left >= 32)
        if len(wide):
            acc = [np.full(len(wide), x, np.uint64) for x in (seed64 + _P1 + _P2, seed64 + _P2, seed64, seed64 - _P1)]
            stripes = left[wide] // 32
            for k in range(int(stripes.max())):
                on = np.flatnonzero(stripes > k)
                here = at[wide[on]] + 32 * k
                for j in range(4):
                    acc[j][on] = _round(acc[j][on], word[here + 8 * j])
            both = _rotated(acc[0], 1) + _rotated(acc[1], 7) + _rotated(acc[2], 12) + _rotated(acc[3], 18)
            for a in acc:
                both = (both ^ _round(np.zeros(len(wide), np.uint64), a)) * _P1 + _P4
            h[wide] = both
            at[wide] += 32 * stripes
        h += left.astype(np.uint64)
        left %= 32
        for _ in range(3):
            on = np.flatnonzero(left >= 8)
            h[on] = _rotated(h[on] ^ _round(np.zeros(len(on), np.uint64), word[at[on]]), 27) * _P1 + _P4
            at[on] += 8
            left[on] -= 8
        on = np.flatnonzero(left >= 4)
        h[on] = _rotated(h[on] ^ (word[at[on]] & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
        at[on] += 4
        left[on] -= 4
        for _ in range(3):
            on = np.flatnonzero(left >= 1)
            h[on] = _rotated(h[on] ^ (word[at[on]] & np.uint64(0xFF)) * _P5, 11) * _P1
            at[on] += 1
            left[on] -= 1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        out[some] = h ^ (h >> np.uint64(32))
    return out
