"""Words of texts with separators of one's own choice, as numpy arrays: what phrase mining and toxicity share."""

from __future__ import annotations

import numpy as np

from pednet.llm.common import mix, powers

_R = np.random.default_rng(29).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_R[65:91] = _R[97:123]  # A-Z count as a-z
_P = 0xBF58476D1CE4E5B9
_PINV = pow(_P, -1, 1 << 64)


def gaps(chars: str) -> np.ndarray:
    """A table of the bytes that stand between words."""
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


def split(data: np.ndarray, off: np.ndarray, gap: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, 64-bit hash and document of each run of bytes that aren't gaps; off: where documents start, and the end."""
    none = np.zeros(0, np.int64)
    if len(data) == 0:
        return none, none, np.zeros(0, np.uint64), none
    word = ~gap[data]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge] |= word[edge]
    ends[edge - 1] |= word[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if len(start) == 0:
        return none, none, np.zeros(0, np.uint64), none
    with np.errstate(over="ignore"):
        value = _R[data] * powers(_P, len(data))
        value[~word] = 0
        h = np.add.reduceat(value, start) * powers(_PINV, len(data))[start] + (end - start).astype(np.uint64)
        h = mix(h + np.uint64((seed * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)))
    return start, end, h, np.searchsorted(off, start, "right") - 1
