"""Equal windows among fragments of text, by blockwise suffix sorting with a difference cover.

The suffixes that start in one block of fragments are sorted to a depth of one window. Suffixes that agree in their
first ``PERIOD`` bytes are told apart by ranks of a cover sample, made beforehand: of any two places there is a shift
below PERIOD that takes both into the sample, so ranks of an eighth of all places resolve ties of any length, and
memory stays bounded by the block.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Order of the field that the cover comes from; its period and size follow.
ORDER_BITS = 3
PERIOD = 4**ORDER_BITS + 2**ORDER_BITS + 1
#: A primitive polynomial over two elements, of degree 9: x^9 + x^4 + 1.
PRIMITIVE = 0b1000010001


@lru_cache(maxsize=1)
def cover() -> np.ndarray:
    """A perfect difference set modulo PERIOD (Singer): powers of a primitive element whose trace to the subfield is zero."""
    powers, x = [], 1
    for _ in range(2 ** (3 * ORDER_BITS) - 1):
        powers.append(x)
        x <<= 1
        x ^= PRIMITIVE if x >> (3 * ORDER_BITS) else 0
    n, q = len(powers), 2**ORDER_BITS
    return np.array([k for k in range(PERIOD) if powers[k] ^ powers[k * q % n] ^ powers[k * q * q % n] == 0])


@lru_cache(maxsize=1)
def shifts() -> np.ndarray:
    """For two residues the least shift that takes both into the cover."""
    member = np.zeros(PERIOD, bool)
    member[cover()] = True
    out = np.full((PERIOD, PERIOD), -1, np.int64)
    r = np.arange(PERIOD)
    for d in reversed(range(PERIOD)):
        both = member[(r[:, None] + d) % PERIOD] & member[(r[None, :] + d) % PERIOD]
        out[both] = d
    return out


def _ranked(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _joined(rank: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """Ranks of strings twice as long, or overlapping: by the rank of the first part, then of the part ahead."""
    return _ranked(rank * (int(ahead.max(initial=0)) + 1) + ahead)


def _ahead(rank: np.ndarray, step: int) -> np.ndarray:
    return np.concatenate([rank[step:], np.zeros(min(step, len(rank)), np.int64)])


def prefix_ranks(text: np.ndarray) -> np.ndarray:
    """Rank of the PERIOD bytes from each place; the text is followed by zeros."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(len(text), np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k : k + len(text)]
    rank, size = _ranked(word), 8
    while 2 * size <= PERIOD:
        rank, size = _joined(rank, _ahead(rank, size)), 2 * size
    return _joined(rank, _ahead(rank, PERIOD - size))


def cover_ranks(prefix: np.ndarray) -> np.ndarray:
    """At the places of the cover sample, the rank of the 4 * PERIOD bytes from there; elsewhere -1."""
    places = np.flatnonzero(np.isin(np.arange(len(prefix)) % PERIOD, cover()))
    out = np.full(len(prefix), -1, np.int64)
    rank, step = prefix[places], PERIOD
    size = len(cover())
    for _ in range(2):  # a place's next of the same residue is one cover further on in the sample
        rank = _joined(rank, _ahead(rank, size * (step // PERIOD)))
        step *= 2
    out[places] = rank
    return out


def repeated_starts(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the starts have windows of ``length`` bytes that also begin at another start."""
    if not 5 * PERIOD - 1 <= length <= 6 * PERIOD:
        raise ValueError(f"windows must have {5 * PERIOD - 1} to {6 * PERIOD} bytes")
    repeated = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return repeated
    text = np.concatenate([text, np.zeros(length, np.uint8)])
    prefix = prefix_ranks(text)
    sample, shift = cover_ranks(prefix), shifts()
    own = prefix[starts]
    left = np.argsort(own, kind="stable")
    group = own[left]
    while True:
        first = np.flatnonzero(np.diff(group, prepend=-1))
        counts = np.diff(first, append=len(group))
        several = np.repeat(counts > 1, counts)
        left, group = left[several], group[several]
        if not len(left):
            return repeated
        first = np.flatnonzero(np.diff(group, prepend=-1))
        counts = np.diff(first, append=len(group))
        number = np.repeat(np.arange(len(first)), counts)
        a, b = starts[left], starts[left[first + counts // 2]][number]
        d = shift[a % PERIOD, b % PERIOD]
        order = np.sign(sample[a + d] - sample[b + d])
        for tail in (length - 2 * PERIOD, length - PERIOD):  # what the sample's depth may leave of the window
            order = np.where(order, order, np.sign(prefix[a + tail] - prefix[b + tail]))
        same = order == 0
        n_same = np.bincount(number, same, len(first))
        repeated[left[same & (n_same[number] > 1)]] = True
        rest = ~same
        left, group = left[rest], 2 * number[rest] + (order[rest] > 0)
        by = np.argsort(group, kind="stable")
        left, group = left[by], group[by]


def repeated_windows(fragments: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Per fragment the runs (first, last) of windows that also occur in another place of the fragments."""
    sizes = np.array([len(f) for f in fragments])
    counts = np.maximum(sizes - length + 1, 0)
    begins = np.cumsum(sizes) - sizes
    number = np.repeat(np.arange(len(fragments)), counts)
    inside = np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts)
    found = repeated_starts(np.frombuffer(b"".join(fragments), np.uint8), begins[number] + inside, length)
    out: list[list[tuple[int, int]]] = [[] for _ in fragments]
    hits = np.flatnonzero(found)
    if len(hits):
        cut = np.flatnonzero((np.diff(hits, prepend=-2) != 1) | (np.diff(number[hits], prepend=-1) != 0))
        for a, b in zip(hits[cut], hits[np.append(cut[1:], len(hits)) - 1]):
            out[number[a]].append((int(inside[a]), int(inside[b])))
    return out
