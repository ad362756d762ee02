"""Words and hashes of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

import hashlib
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

# Texts are handled in runs of about so many bytes; a longer text is a run of its own.
RUN_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# In ASCII texts letters and digits make tokens; the rest parts them. Other texts go by token_spans.
MARKS = np.ones(256, dtype=bool)
MARKS[128:] = False
for _range in (b"09", b"AZ", b"az"):
    MARKS[_range[0] : _range[1] + 1] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse modulo 2**64."""
    global _powers, _inverses
    if len(_powers) <= n:
        size = max(n + 1, RUN_BYTES + 1)
        ones = np.ones(size, dtype=np.uint64)
        ones[1:] = np.uint64(_BASE)
        _powers = np.cumprod(ones, dtype=np.uint64)
        ones[1:] = np.uint64(_INVERSE)
        _inverses = np.cumprod(ones, dtype=np.uint64)
    return _powers, _inverses


def runs(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first, last, data, offsets`` of consecutive texts; a null text is empty.

    ``data`` holds the bytes of the texts [first, last) and ``offsets`` their bounds.
    """
    column = texts.fill_null("").cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + RUN_BYTES, side="right")) - 1)
        yield first, last, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hashes`` takes the hash of any span."""
    up, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal for equal bytes, wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``starts, ends, bounds``: the words of all texts, and the index of each text's first word."""
    inside = ~gaps[data]
    starts_here = inside.copy()
    starts_here[1:] &= ~inside[:-1]
    ends_here = inside.copy()
    ends_here[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    starts_here[heads] = inside[heads]
    ends_here[tails] = inside[tails]
    starts, ends = np.flatnonzero(starts_here), np.flatnonzero(ends_here) + 1
    return starts, ends, np.searchsorted(starts, offsets)


# Scripts written without spaces, by the first words of their characters' names: each character is a token.
UNSPACED = ("CJK UNIFIED", "CJK COMPATIBILITY IDEOGRAPH", "HIRAGANA", "KATAKANA", "THAI", "LAO", "KHMER", "MYANMAR", "TIBETAN")


@cache
def code_points() -> np.ndarray:
    """Of each code point: 0 if it parts tokens, 1 if it makes tokens with its neighbours, 2 if it is one."""
    kinds = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for c in range(sys.maxunicode + 1):
        # letters, marks and numbers
        if unicodedata.category(chr(c))[0] in "LMN":
            kinds[c] = 2 if unicodedata.name(chr(c), "").startswith(UNSPACED) else 1
    return kinds


def token_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``starts, ends, bounds`` of tokens: runs of letters and digits, and single characters of scripts without spaces.

    Bytes that are no UTF-8 count as letters.
    """
    if not len(data) or data.max() < 128:
        return word_spans(data, offsets, MARKS)
    try:
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype="<u4")
    except UnicodeDecodeError:
        return word_spans(data, offsets, MARKS)
    kinds = code_points()[points]
    places = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    heads = np.searchsorted(places, offsets)
    joined = kinds == 1
    # whether a character goes on with the one before it
    on = np.zeros(len(kinds) + 1, dtype=bool)
    on[1:-1] = joined[1:] & joined[:-1]
    on[heads] = False
    inside = kinds > 0
    starts, ends = np.flatnonzero(inside & ~on[:-1]), np.flatnonzero(inside & ~on[1:]) + 1
    return places[starts], places[ends], np.searchsorted(starts, heads)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words with A-Z in lower case."""
    return solid_hashes(LOWER[data], starts, ends)


# Words above so many bytes are hashed one by one.
LONG_WORD = 128


def solid_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans, mixed anew at every eight bytes: unlike :func:`span_hashes`, no structure of a text makes them collide."""
    sizes = ends - starts
    filled = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    # eight bytes from any place on
    eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=filled, strides=(1,))
    out = mix(sizes.astype(np.uint64) * np.uint64(_BASE))
    for done in range(0, min(int(sizes.max(initial=0)), LONG_WORD), 8):
        at = np.flatnonzero(sizes > done) if done else np.arange(len(sizes))
        left = np.clip(sizes[at] - done, 0, 8)
        word = eights[starts[at] + done] & (_ALL >> (np.uint64(64) - np.uint64(8) * left.astype(np.uint64)))
        out[at] = mix(out[at] * np.uint64(_BASE) + word)
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, dtype="<u8")[0]
    return out


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of ``k`` words, by its first word."""
    n = max(0, len(words) - k + 1)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        total = mix(total * np.uint64(_BASE) + words[i : i + n])
    return total
