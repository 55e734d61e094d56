"""64-bit hashes of the words of a text, computed on arrays of bytes."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240101)
#: One random number per byte value (A-Z as a-z), and odd multipliers for places in a word.
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_PLACE = _RNG.integers(0, 1 << 63, 1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
END = np.uint64(0x9AE16A3B2F90404F)
BEGIN = np.uint64(0xC3A5C85C97CB3127)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words (A-Z lower-cased) in order; words are what the six ASCII spaces separate."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    space = _IS_SPACE[raw]
    inside = np.flatnonzero(~space)
    if not len(inside):
        return np.zeros(0, np.uint64)
    gaps = np.flatnonzero(np.diff(inside) > 1) + 1
    starts = np.concatenate([[0], gaps])
    lengths = np.diff(np.append(starts, len(inside)))
    place = np.arange(len(inside)) - np.repeat(starts, lengths)
    factors = _PLACE[place & (len(_PLACE) - 1)]
    if lengths.max() > len(_PLACE):  # the table repeats: tell its rounds apart (the first is as it stands)
        factors = factors ^ (mix(place.astype(np.uint64) // np.uint64(len(_PLACE))) << np.uint64(1))
    weighed = _BYTE[raw[inside]] * factors
    return mix(np.add.reduceat(weighed, starts) + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
