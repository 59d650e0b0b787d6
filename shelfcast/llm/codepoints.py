"""Texts as NumPy arrays of code points: character classes, spans and span hashes without a loop over characters."""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_cache: dict[str, np.ndarray] = {}


def classes() -> np.ndarray:
    """The class of every code point by its Unicode properties: white space, letter, number, other."""
    if "classes" not in _cache:
        table = np.full(0x110000, OTHER, dtype=np.uint8)
        every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
        for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
            for found in regex.finditer(pattern, every):
                table[ord(found[0][0]) : ord(found[0][-1]) + 1] = kind
        _cache["classes"] = table
    return _cache["classes"]


def decode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts in one array, and where each text starts (one more entry than texts)."""
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(text) for text in texts], out=starts[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32), starts


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    held = _cache.get("powers")
    if held is None or len(held) < count:
        size = max(count, 1 << 20)
        for name, base in (("powers", _MULTIPLIER), ("inverses", _INVERSE)):
            values = np.full(size, base, dtype=np.uint64)
            values[0] = 1
            _cache[name] = np.cumprod(values)
    return _cache["powers"][:count], _cache["inverses"][:count]


def span_hashes(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span [start, end) that depends on its code points alone."""
    powers, inverses = _powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(0x1F3D5B79)) * np.uint64(0xD6E8FEB86659FD93) * powers[:-1], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverses[start])


def distinct_spans(points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each span [begin, end) among the distinct ones, and the first span of each number.

    Spans are grouped by hash and then compared with the first of their group, code point by code point, so that
    different spans of one hash are told apart.
    """
    codes, hashes = pd.factorize(span_hashes(points, begin, end))
    first = np.empty(len(hashes), dtype=np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    model, size = first[codes], end - begin
    if len(size):
        same_size = size == size[model]
        own = np.where(same_size, size, 0)
        at = np.repeat(begin - (np.cumsum(own) - own), own) + np.arange(own.sum())
        if same_size.all() and np.array_equal(points[at], points[at + np.repeat(begin[model] - begin, own)]):
            return codes, first
        numbers: dict[bytes, int] = {}
        codes = np.array([numbers.setdefault(points[a:b].tobytes(), len(numbers)) for a, b in zip(begin.tolist(), end.tolist(), strict=True)], dtype=np.int64)
        first = np.empty(len(numbers), dtype=np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
    return codes, first


def words_between(points: np.ndarray, starts: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal spans of non-blank code points within a text: start, end, and the text's number."""
    solid = ~blank
    first = solid.copy()
    first[1:] &= blank[:-1]
    inner = starts[(starts > 0) & (starts < len(points))]
    first[inner] = solid[inner]
    last = solid.copy()
    last[:-1] &= blank[1:] | first[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(starts, start, side="right") - 1
