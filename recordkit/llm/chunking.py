"""Content-defined chunks: a rolling hash over the last 32 bytes decides where a text is cut."""

from __future__ import annotations

import numpy as np

WINDOW = 32


def _byte_values() -> np.ndarray:
    """One 32-bit value for each byte, from a multiplicative generator."""
    state, values = 0x9E3779B9, []
    for _ in range(256):
        state = (state * 1664525 + 1013904223) % 2**32
        values.append(state ^ (state >> 15))
    return np.array(values, dtype=np.uint32)


BYTE_VALUES = _byte_values()


def rolling(data: bytes) -> np.ndarray:
    """For each byte, a hash of the 32 bytes that end with it (fewer at the start)."""
    total = BYTE_VALUES[np.frombuffer(data, dtype=np.uint8)]
    step = 1
    while step < WINDOW:
        longer = total.copy()
        longer[step:] += total[:-step] * np.uint32(3**step % 2**32)
        total, step = longer, 2 * step
    return total ^ (total >> np.uint32(16))


def cuts(data: bytes, mean: int, least: int, most: int) -> list[int]:
    """Ends of the chunks of ``data``; no bytes, no chunk. ``mean`` is a power of two.

    A chunk ends where the rolling hash is zero in its low bits, at least ``least`` bytes after the last
    end, and after ``most`` bytes in any case. Equal passages are cut alike soon after they begin.
    """
    if len(data) <= least:
        return [len(data)] if data else []
    places = np.flatnonzero((rolling(data) & np.uint32(mean - 1)) == 0) + 1
    ends, last = [], 0
    for place in places.tolist():
        while place - last > most:
            last += most
            ends.append(last)
        if place - last >= least:
            ends.append(place)
            last = place
    while len(data) - last > most:
        last += most
        ends.append(last)
    if last < len(data):
        ends.append(len(data))
    return ends
