"""Hashes of a batch's words, without a Python object for each word."""

from __future__ import annotations

import numpy as np

from tessera.llm.common import mix64

_PIECE = 1 << 20
_BASE = 0x5851F42D4C957F2D
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: a fixed odd-ish value for each byte
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and its inverse modulo 2**64 for i < n, at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, _PIECE + 1)
        out = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps))
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def _hash_words(buf: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hashes and starts of the words of ``buf``."""
    raw = np.frombuffer(buf, np.uint8)
    space = _SPACES[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True]))))
    start, end = edge[::2], edge[1::2]
    up, down = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=total[1:])
    return mix64((total[end] - total[start]) * down[start]), start


def word_hashes(texts: list[bytes | None]) -> list[np.ndarray]:
    """For each text the 64-bit hashes of its words: A-Z lower-cased, words
    are runs without [\\x20\\x09-\\x0D]."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def done():
        if held:
            h, start = _hash_words(b" ".join(held))
            bounds = np.cumsum([0, *(len(t) + 1 for t in held)])
            at = np.searchsorted(start, bounds)
            out.extend(h[lo:hi] for lo, hi in zip(at, at[1:]))
            held.clear()

    for t in texts:
        t = (t or b"").lower()
        if size + len(t) > _PIECE:
            done()
            size = 0
        if len(t) > _PIECE:
            out.append(_long(t))
            continue
        held.append(t)
        size += len(t) + 1
    done()
    return out


def _long(t: bytes) -> np.ndarray:
    parts, at = [], 0
    while at < len(t):
        end = at + _PIECE
        if end < len(t):  # cut at a space; a longer word is taken whole
            while end > at and not _SPACES[t[end - 1]]:
                end -= 1
            if end == at:
                end = at + _PIECE
                while end < len(t) and not _SPACES[t[end]]:
                    end += 1
        parts.append(_hash_words(t[at:end])[0])
        at = end
    return np.concatenate(parts)
