"""Vectorised hashing of the words or lines of UTF-8 buffers."""

from __future__ import annotations

import numpy as np

from lotguard.llm.common import U64, mix

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True
_SAME = np.arange(256, dtype=np.uint8)
LOWER = _SAME.copy()
LOWER[ord("A") : ord("Z") + 1] += 32
_PLACES = 64
_TABLE = mix(np.arange(1, 256 * _PLACES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))


def segments(data: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes outside of separators, which of these begin a segment, and
    the lengths of the segments."""
    at = np.flatnonzero(~separators[data])
    if not len(at):
        return at, at, at
    first = np.flatnonzero(np.concatenate(([True], np.diff(at) > 1)))
    return at, first, np.diff(np.append(first, len(at)))


def segment_hashes(data: np.ndarray, separators: np.ndarray = SPACE, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the segments between separators (A to Z lower-cased if
    asked for), and the place of their first byte."""
    at, first, length = segments(data, separators)
    if not len(at):
        return np.zeros(0, U64), at
    place = np.arange(len(at)) - np.repeat(first, length)
    value = _TABLE[(place % _PLACES) * 256 + (LOWER if lower else _SAME)[data[at]]]
    if (far := place >= _PLACES).any():
        value[far] = mix(value[far] + (place[far] // _PLACES).astype(U64))
    return mix(np.add.reduceat(value, first) + length.astype(U64)), at[first]
