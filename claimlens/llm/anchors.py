"""Content-chosen anchors: which places of a text can be compared with another text's.

Every window of ``length`` bytes is anchored at the place of the least hash among its ``GRAM``-byte strings (the first
of equals). Equal windows are anchored at the same place in themselves, so they are found under the same gram wherever
they stand. Neighbouring windows mostly share an anchor; there is about one anchor in ``length / 2`` bytes.
"""

from __future__ import annotations

import numpy as np
import xxhash

GRAM = 32
PLACE_BITS = 24
#: Windows looked at together; a cut between two slices only parts an anchor's windows.
SLICE = 1 << 20


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    step = 1
    while step < GRAM:
        h = (h[:-step] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ h[step:]
        h ^= h >> np.uint64(31)
        step *= 2
    return h * np.uint64(0x9E3779B97F4A7C15)


def anchored(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, and the first and last window start of each, in order."""
    count = len(text) - length + 1
    places, firsts, lasts = [], [], []
    width = length - GRAM + 1
    for at in range(0, max(0, count), SLICE):
        n = min(SLICE, count - at)
        part = np.frombuffer(text, np.uint8, n + length - 1, at)
        low = np.uint64((1 << PLACE_BITS) - 1)
        least = (gram_hashes(part) & ~low) | np.arange(n + width - 1, dtype=np.uint64)
        span = 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[:n], least[width - span : width - span + n])
        chosen = (least & low).astype(np.int64)
        new = np.flatnonzero(np.diff(chosen, prepend=-1))
        places.append(chosen[new] + at)
        firsts.append(new + at)
        lasts.append(np.append(new[1:], n) - 1 + at)
    if not places:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(places), np.concatenate(firsts), np.concatenate(lasts)


def names(text: bytes, length: int, places: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> tuple[list[int], list[int]]:
    """A hash of each anchor's gram, and of its context, the bytes of all its windows."""
    digest = xxhash.xxh3_64_intdigest
    view = memoryview(text)
    grams = [digest(view[p : p + GRAM]) for p in places.tolist()]
    contexts = [digest(view[a : b + length]) for a, b in zip(firsts.tolist(), lasts.tolist())]
    return grams, contexts
