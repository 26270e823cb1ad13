"""Vectorised word and shingle hashes for tasks that read texts as bytes."""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
SOLID = np.ones(256, dtype=bool)
SOLID[[9, 10, 11, 12, 13, 32]] = False
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    if len(_powers.get(base, ())) < n:
        size = max(n, 1 << 16)
        p = np.full(size, base, dtype=np.uint64)
        p[0] = 1
        _powers[base] = np.cumprod(p, dtype=np.uint64)
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(raw: bytes) -> np.ndarray:
    a = np.frombuffer(raw, dtype=np.uint8)
    edges = np.flatnonzero(np.diff(SOLID[a], prepend=False, append=False))
    s, e = edges[::2], edges[1::2]
    c = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum((a + np.uint64(1)) * _power(_BASE, len(a)), out=c[1:])
    h = (c[e] - c[s]) * _power(_INVERSE, len(a) + 1)[s]  # the same word has one value wherever it stands
    return mix(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of each blank-separated word of a text, in order; memory is bounded by ``CHUNK`` bytes or one word."""
    if len(raw) <= CHUNK:
        return _hashes(raw) if raw else np.zeros(0, dtype=np.uint64)
    out, at = [], 0
    while at < len(raw):
        end = at + CHUNK
        if end < len(raw):
            cut = max(raw.rfind(b, at, end) for b in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
            while cut < 0:  # a word longer than a chunk
                found = [i for i in (raw.find(b, end) for b in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f")) if i >= 0]
                cut = min(found, default=len(raw))
            end = cut
        out.append(_hashes(raw[at:end]))
        at = max(end, at + 1)
    return np.concatenate(out)


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words; fewer words make one run, none makes none."""
    if len(h) < k:
        h = np.concatenate([h, np.zeros(k - len(h), dtype=np.uint64)]) if len(h) else h
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out = (out + h[j : j + n]) * np.uint64(0xFF51AFD7ED558CCD)
    return mix(out)
