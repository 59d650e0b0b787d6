"""Pre-tokenising and byte-pair merging of many words at once, on NumPy arrays.

``Merges`` holds a merge table; ``encode`` merges all given words together.  In each round every word merges its best
pair: all occurrences at once if no better pair can arise beside the merged symbol, else the leftmost alone.  Either
way the result is that of merging one occurrence at a time.
"""

from __future__ import annotations

import base64
import json

import numpy as np
import pyarrow as pa

from shelfcast.llm.codepoints import LETTER, NUMBER, OTHER, SPACE, classes

_NONE = np.uint32(0xFFFFFFFF)
_loaded: dict[tuple[str, str], object] = {}


class Merges:
    """Symbols of single bytes, pair -> (rank, merged symbol) as an open hash table, and whole words with an id."""

    def __init__(self, symbols: np.ndarray, last: np.ndarray, left: np.ndarray, right: np.ndarray, merged: np.ndarray, rank: np.ndarray):
        self.symbols, self.last = symbols.astype(np.uint32), last.astype(np.uint32)
        self.bits = max(8, int(3 * len(left)).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.rank, self.merged = np.full(size, _NONE), np.full(size, _NONE)
        self.alone = np.zeros(size, dtype=bool)
        better = np.full(int(max(left.max(), right.max(), merged.max())) + 1, _NONE)
        for part in (left, right):
            np.minimum.at(better, part, rank)
        alone = better[merged] < rank
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        waiting, slot = np.arange(len(keys)), self._slots(keys)
        while len(waiting):
            free = self.keys[slot] == np.uint64(0xFFFFFFFFFFFFFFFF)
            self.keys[slot[free]] = keys[waiting[free]]
            placed = self.keys[slot] == keys[waiting]
            self.rank[slot[placed]], self.merged[slot[placed]] = rank[waiting[placed]], merged[waiting[placed]]
            self.alone[slot[placed]] = alone[waiting[placed]]
            waiting, slot = waiting[~placed], (slot[~placed] + 1) & (size - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair, -1 where no merge is known."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slots(keys)
        found = self.keys[slot]
        open_ = np.flatnonzero((found != keys) & (found != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[open_]]
            open_ = open_[(found != keys[open_]) & (found != np.uint64(0xFFFFFFFFFFFFFFFF))]
        slot[self.keys[slot] != keys] = -1
        return slot

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words in one array, and how many each word has."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols = self.symbols[data]
        ends = np.cumsum(lengths)
        filled = lengths > 0
        symbols[ends[filled] - 1] = self.last[data[ends[filled] - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_owner = [], []
        while len(symbols):
            joined = owner[:-1] == owner[1:]
            slot = np.full(len(symbols), -1, dtype=np.int64)
            pairs = np.flatnonzero(joined)
            slot[pairs] = self.find(symbols[pairs], symbols[pairs + 1])
            rank = np.where(slot >= 0, self.rank[slot], _NONE)
            first = np.flatnonzero(np.concatenate(([True], ~joined)))
            count = np.diff(np.append(first, len(symbols)))
            best = np.repeat(np.minimum.reduceat(rank, first), count)
            ended = best == _NONE
            if ended.any():
                done_symbols.append(symbols[ended])
                done_owner.append(owner[ended])
                symbols, owner, slot, rank, best = symbols[~ended], owner[~ended], slot[~ended], rank[~ended], best[~ended]
                if not len(symbols):
                    break
            merge = rank == best
            # of overlapping occurrences (a run of one symbol) every second one merges, from the left
            again = np.flatnonzero(merge[1:] & merge[:-1]) + 1
            if len(again):
                places = np.flatnonzero(merge)
                begins = np.concatenate(([True], np.diff(places) != 1))
                nth = np.arange(len(places)) - np.maximum.accumulate(np.where(begins, np.arange(len(places)), 0))
                merge[places[nth % 2 == 1]] = False
            at = np.flatnonzero(merge)
            leading = np.concatenate(([True], owner[at[1:]] != owner[at[:-1]]))
            at = at[leading | ~self.alone[slot[at]]]
            symbols[at] = self.merged[slot[at]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        if not done_symbols:
            return np.zeros(0, dtype=np.uint32), np.zeros(len(words), dtype=np.int64)
        all_symbols, all_owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(all_owner, kind="stable")
        return all_symbols[order], np.bincount(all_owner, minlength=len(words))


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a rank file (one base64 token and its id a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


def rank_file(path: str) -> tuple[Merges, dict[bytes, int]]:
    """Merges of a rank file: any two tokens whose bytes join to a token merge, best id first."""
    if ("ranks", path) not in _loaded:
        ranks = read_ranks(path)
        single = np.array([ranks[bytes([value])] for value in range(256)], dtype=np.uint32)
        rows = [
            (ranks[token[:cut]], ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        left, right, merged = np.array(rows, dtype=np.uint32).T
        _loaded["ranks", path] = (Merges(single, single, left, right, merged, merged), ranks)
    return _loaded["ranks", path]


def token_bytes(path: str) -> pa.Array:
    """The bytes of every id, as an Arrow array."""
    if ("bytes", path) not in _loaded:
        ranks = rank_file(path)[1]
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        _loaded["bytes", path] = pa.array(table, pa.binary())
    return _loaded["bytes", path]


def encode_pieces(path: str, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each piece by a rank file; a piece that is itself a token is that token."""
    merges, ranks = rank_file(path)
    whole = np.fromiter((ranks.get(piece, -1) for piece in pieces), dtype=np.int64, count=len(pieces))
    rest = np.flatnonzero(whole < 0)
    ids, counts = merges.encode([pieces[row] for row in rest])
    total = np.ones(len(pieces), dtype=np.int64)
    total[rest] = counts
    out = np.zeros(int(total.sum()), dtype=np.uint32)
    begin = np.cumsum(total) - total
    out[begin[whole >= 0]] = whole[whole >= 0]
    is_rest = np.repeat(whole < 0, total)
    out[is_rest] = ids
    return out, total


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 as is, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [value for value in range(256) if value not in set(shown)]
    return {value: chr(value) for value in shown} | {value: chr(0x100 + n) for n, value in enumerate(hidden)}


def word_file(path: str) -> Merges:
    """Merges of a tokenizers file whose words end in a suffix; symbols are the vocabulary's ids."""
    if ("words", path) not in _loaded:
        with open(path, encoding="utf-8") as source:
            model = json.load(source)["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"]
        alphabet = byte_alphabet()
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        left, right = (np.array([vocabulary[pair[side]] for pair in pairs], dtype=np.uint32) for side in (0, 1))
        merged = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.uint32)
        rank = np.arange(len(pairs), dtype=np.uint32)
        _loaded["words", path] = Merges(
            np.array([vocabulary[alphabet[value]] for value in range(256)]),
            np.array([vocabulary[alphabet[value] + suffix] for value in range(256)]),
            left, right, merged, rank,
        )
    return _loaded["words", path]


def _runs(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of every code point, whether a run of one class starts there, and whether a text does."""
    kind = classes()[points]
    begin = np.ones(len(points), dtype=bool)
    begin[1:] = kind[1:] != kind[:-1]
    opening = np.zeros(len(points) + 1, dtype=bool)
    opening[starts] = True
    return kind, begin | opening[:-1], opening


def _contractions(points: np.ndarray, kind: np.ndarray, begin: np.ndarray, opening: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where an apostrophe starts one of 's 't 're 've 'm 'll 'd, and the length of each."""
    place = np.flatnonzero((points == 0x27) & begin & allowed)
    place = place[place + 1 < len(points)]
    place = place[begin[place + 1] & ~opening[place + 1] & (kind[place + 1] == LETTER)]
    following = points[place + 1]
    second = np.where(place + 2 < len(points), points[np.minimum(place + 2, len(points) - 1)], 0)
    same = (place + 2 < len(points)) & ~begin[np.minimum(place + 2, len(points) - 1)]
    two = same & (((following == 0x72) | (following == 0x76)) & (second == 0x65) | (following == 0x6C) & (second == 0x6C))
    one = np.isin(following, [0x73, 0x74, 0x6D, 0x64])
    taken = one | two
    return place[taken], np.where(one, 2, 3)[taken]


def split_spaced(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Starts of the matches of public_tokenizers.PATTERN; together the matches cover every text."""
    if not len(points):
        return np.zeros(0, dtype=np.int64)
    kind, begin, opening = _runs(points, starts)
    final = np.zeros(len(points), dtype=bool)
    final[starts[1:][starts[1:] > 0] - 1] = True
    # a blank before a run of another class: the last one stands apart, and joins the run if it is U+0020
    before = np.zeros(len(points), dtype=bool)
    before[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE)
    before &= ~final
    begin_token = begin.copy()
    begin_token[before] = True
    glued = np.flatnonzero(before & (points == 0x20)) + 1
    begin_token[glued] = False
    allowed = np.ones(len(points), dtype=bool)
    allowed[glued] = False
    place, length = _contractions(points, kind, begin, opening, allowed)
    begin_token[place + 1] = False
    after = place + length
    inside = after < len(points)
    begin_token[after[inside]] = True
    return np.flatnonzero(begin_token)


def split_words(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the words of the word-end vocabulary: contractions, letter runs, single numbers, other runs."""
    if not len(points):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    kind, begin, opening = _runs(points, starts)
    place, length = _contractions(points, kind, begin, opening, np.ones(len(points), dtype=bool))
    begin |= kind == NUMBER
    begin[place + 1] = False
    after = place + length
    begin[after[after < len(points)]] = True
    start = np.flatnonzero(begin)
    end = np.append(start[1:], len(points))
    solid = kind[start] != SPACE
    return start[solid], end[solid]

