"""Pre-tokens of many texts at once, and the distinct ones among them.

The texts of a slice are one buffer of UTF-8 bytes. Each character has a class (letter, number, white space, other);
where pre-tokens start follows from the classes of neighbours, for all characters together:

- every run of one class starts a pre-token;
- of white space before more text, the last character starts one too, and a space takes what follows into it;
- an apostrophe between a pre-token and one of the endings s, t, re, ve, m, ll, d takes the ending and no more.

The pre-tokens are then dictionary-encoded, so that whatever is made of one is made once in a slice.

Null texts count as empty; empty texts have no pre-token. A slice holds at most ``SLICE_BYTES`` of text, or one longer text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken

#: The pattern whose matches these cuts give.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LETTER, NUMBER, OTHER, SPACE = range(4)
SLICE_BYTES = 4 << 20


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point in the Unicode version of the tokenizer libraries, which is asked of one of them.

    An encoding whose tokens are the bytes gives just the characters that its pattern matches.
    """
    out, ranks = np.full(0x110000, OTHER, np.uint8), {bytes([b]): b for b in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        library = tiktoken.Encoding(f"class-{kind}", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for at in range(0, 0x110000, 0x800):
            if at == 0xD800:  # surrogates are no characters
                continue
            found = library.decode(library.encode_ordinary("".join(map(chr, range(at, at + 0x800)))))
            out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return out


@dataclass
class Cuts:
    """Pre-tokens of a slice: the distinct ones, each occurrence's place among them, and each text's first occurrence."""

    words: pa.BinaryArray
    index: np.ndarray
    first: np.ndarray


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of strings or binaries, and where each text starts in them, with the end as the last one."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive parts of an array of strings, binaries or lists, of at most ``limit`` bytes (items) each or of one row."""
    at = texts.offsets.to_numpy() if pa.types.is_list(texts.type) else buffer_of(texts)[1]
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + limit, "right")) - 1)
        yield texts.slice(begin, end - begin)
        begin = end


def binaries(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """The binary values that lie one after another in data, from each place in ``at`` to the next."""
    kind, width = (pa.binary(), np.int32) if at[-1] < 1 << 31 else (pa.large_binary(), np.int64)
    return pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at, width)), pa.py_buffer(np.ascontiguousarray(data))])


def _marked(data: np.ndarray, at: np.ndarray, added: re.Pattern[bytes]) -> np.ndarray:
    """Start and end of each added token, as rows."""
    whole = data.tobytes()
    found = [(b + x.start(), b + x.end()) for b, e in zip(at[:-1].tolist(), at[1:].tolist()) for x in added.finditer(whole[b:e])] if added.search(whole) else []
    return np.array(found, np.int64).reshape(-1, 2)


def _starts(kind: np.ndarray, char: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Whether each character starts a pre-token; ``edge`` tells where a text starts."""
    start = edge.copy()
    start[1:] |= kind[1:] != kind[:-1]
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~edge[1:])
    start[last] = True
    start[last[char[last] == 32] + 1] = False
    mark = np.flatnonzero((char[:-1] == 39) & start[:-1] & (kind[1:] == LETTER) & ~edge[1:])
    if len(mark):
        one = char[mark + 1]
        far = np.minimum(mark + 2, len(char) - 1)
        two = np.where((far > mark + 1) & ~edge[far], char[far], 0)
        short = np.isin(one, [ord(x) for x in "stmd"])
        long = (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        taken = short | long
        start[mark[taken] + 1] = False
        end = (mark + 2 + long)[taken]
        start[end[end < len(start)]] = True
    return start


def cut(texts: pa.Array, added: re.Pattern[bytes] | None = None) -> Cuts:
    """The pre-tokens of texts; what ``added`` matches in one is a pre-token of its own, and an edge for its neighbours."""
    data, at = buffer_of(texts)
    if not len(data):
        return Cuts(pa.array([], pa.binary()), np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64))
    marked = _marked(data, at, added) if added else np.zeros((0, 2), np.int64)
    if data.max() < 128:
        places, char = None, data
    else:
        places = np.flatnonzero((data & 0xC0) != 0x80)
        char = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    edge = np.zeros(len(char), bool)

    def on_chars(x: np.ndarray) -> np.ndarray:
        return x if places is None else np.searchsorted(places, x)

    edges = on_chars(np.unique(np.concatenate([at[:-1], marked.ravel()])))
    edge[edges[edges < len(char)]] = True
    start = _starts(classes()[char], char, edge)
    for b, e in on_chars(marked):
        start[b + 1 : e] = False
    begins = np.flatnonzero(start) if places is None else places[start]
    found = binaries(data, np.append(begins, len(data))).dictionary_encode()
    words = found.dictionary
    return Cuts(words, found.indices.to_numpy(), np.searchsorted(begins, at))


def joined(values: pa.Array, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The binary values at some places, one after another: their bytes, and where each starts, with the end as the last one."""
    return buffer_of(values.take(pa.array(places)))
