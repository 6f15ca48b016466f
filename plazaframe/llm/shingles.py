"""Hashes of a text's words and of its runs of words, computed on whole byte arrays."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: Bytes hashed at a time; bounds the arrays that a giant text needs.
STRETCH = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    with np.errstate(over="ignore"):
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


_draw = np.random.Generator(np.random.PCG64(7))
_LETTER = _draw.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_UP, _DOWN = _powers(_ODD, STRETCH + 1), _powers(pow(_ODD, -1, 1 << 64), STRETCH + 1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit numbers, one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """A hash for each word of the text in lower case; words are what white space separates."""
    data = np.frombuffer(text.lower().encode(), np.uint8)
    blank = np.concatenate(([True], _BLANK[data], [True]))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    out, i = [np.empty(0, np.uint64)], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + STRETCH, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        if b - a > STRETCH:  # a single giant word
            out.append(np.array([xxhash.xxh3_64_intdigest(data[a:b].tobytes())], np.uint64))
        else:
            with np.errstate(over="ignore"):
                sums = np.concatenate(([np.uint64(0)], np.cumsum(_LETTER[data[a:b]] * _UP[: b - a], dtype=np.uint64)))
                begin, end = starts[i:j] - a, ends[i:j] - a
                out.append(mix((sums[end] - sums[begin]) * _DOWN[begin]))
        i = j
    return np.concatenate(out)


def word_runs(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; fewer words make one run, none make none."""
    n = min(size, len(words))
    if not n:
        return words
    out = np.zeros(len(words) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = out * np.uint64(0xD6E8FEB86659FD93) + words[i : i + len(out)]
    return mix(out)


def labelled(runs: np.ndarray) -> np.ndarray:
    """``runs`` told apart by how often each has occurred before: all different."""
    order = np.argsort(runs, kind="stable")
    ordered = runs[order]
    fresh = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(runs) else np.empty(0, bool)
    if fresh.all():
        return runs
    at = np.arange(len(runs))
    before = at - np.maximum.accumulate(np.where(fresh, at, 0))
    out = runs.copy()
    with np.errstate(over="ignore"):
        out[order] = np.where(before > 0, mix(ordered + before.astype(np.uint64) * np.uint64(_ODD)), ordered)
    return out
