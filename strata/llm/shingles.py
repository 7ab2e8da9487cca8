"""Hashed word shingles of whole texts, vectorised over a batch."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words of a shingle.
K = 5
#: Groups of a count vector: enough that unrelated texts of some thousand words differ by
#: more than a link allows.  A byte holds a count; FULL stands for any count from there on.
GROUPS, FULL = 256, 255

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


def finish(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


# A word's hash is the sum of TABLE[byte] * BASE ** place, modulo 2 ** 64, then spread.
_TABLE = finish(np.arange(1, 257, dtype=np.uint64) * _MIX[0])
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64 (kept by the worker)."""
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, 1 << 20), base, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return _powers[base][:n]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in turn, words per text)."""
    bodies = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*bodies, b""]).lower(), dtype=np.uint8)
    space = np.concatenate(([True], _SPACE[data]))
    edge = space[1:] != space[:-1]
    starts, ends = np.flatnonzero(edge & ~space[1:]), np.flatnonzero(edge & space[1:])
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * powers(_BASE, len(data)), out=sums[1:])
    hashes = finish((sums[ends] - sums[starts]) * powers(_BASE_INVERSE, len(data))[starts])
    offsets = np.cumsum([0, *(len(b) + 1 for b in bodies)])
    return hashes, np.diff(np.searchsorted(starts, offsets))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its K-word shingles.

    Words are runs of anything but space and U+0009 to U+000D, with A-Z in lower case.
    Fewer than K words are one shingle; no words, none.
    """
    with np.errstate(over="ignore"):
        w, lengths = word_hashes(texts)
        rolled = np.zeros(max(len(w) - K + 1, 0), dtype=np.uint64)
        for j in range(K):
            rolled += w[j:len(rolled) + j] * _MIX[j]
        rolled = finish(rolled)
        out, start = [], 0
        for n in lengths.tolist():
            if n >= K:
                s = np.sort(rolled[start:start + n - K + 1])
                out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
            elif n:
                short = (w[start:start + n] * _MIX[:n]).sum(dtype=np.uint64) + np.uint64(n)
                out.append(finish(np.array([short], dtype=np.uint64)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
            start += n
    return out


def set_id(shingles: np.ndarray) -> int:
    """Signed 64-bit id of a set of shingles."""
    return np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64)).item()


def group_counts(shingles: np.ndarray) -> np.ndarray:
    """How many shingles fall into each of GROUPS groups, a byte each (FULL: that many or more)."""
    return np.minimum(np.bincount((shingles >> np.uint64(56)).astype(np.int64), minlength=GROUPS), FULL).astype(np.uint8)


def points(packed: list[bytes]) -> np.ndarray:
    """Rows of counts; a full count becomes one that bounds nothing."""
    v = np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(len(packed), GROUPS).astype(np.int32)
    v[v == FULL] = 1 << 22
    return v


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
