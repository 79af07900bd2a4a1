"""Words of many texts at once, as hashes, with array operations only.

Texts come as one byte array with row offsets. A table maps each byte to 0
(it separates words) or to a positive code (its letter, case folded or not);
runs of positive codes are words and never cross rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_PERIOD = 1 << 12
_BASE = np.uint64(0x9E3779B97F4A7C15)
with np.errstate(over="ignore"):
    _POWERS = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(_PERIOD - 1, _BASE)]))


def spread(h: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit numbers (the splitmix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _table(separates) -> np.ndarray:  # noqa: ANN001
    codes = np.arange(256, dtype=np.uint16) + 1
    upper = np.arange(ord("A"), ord("Z") + 1)
    codes[upper] += 32
    codes[[b for b in range(256) if separates(b)]] = 0
    return codes


#: Words between space and tab..carriage return, A-Z folded.
SPACED = _table(lambda b: b == 32 or 9 <= b <= 13)
#: The same words with letters as they are.
EXACT = np.where(SPACED > 0, np.arange(256) + 1, 0).astype(np.uint16)
#: Words of letters (ASCII, or any byte of a longer UTF-8 character), A-Z folded.
LETTERS = _table(lambda b: b < 128 and not chr(b).isalpha())


@dataclass
class Words:
    """One entry a word: ``hash``, byte places ``start`` and ``end``, and ``row``."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = SPACED) -> Words:
    codes = table[data]
    inside = codes > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(start):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, none)
    length = end - start
    place = np.flatnonzero(inside)
    inner = place - np.repeat(start, length)
    terms = codes[place].astype(np.uint64) * _POWERS[inner & (_PERIOD - 1)]
    sums = np.add.reduceat(terms, np.concatenate([[0], np.cumsum(length)[:-1]]))
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(spread(sums ^ spread(length.astype(np.uint64))), start, end, row)


def prefixes(data: np.ndarray, w: Words, length: int, table: np.ndarray = SPACED) -> np.ndarray:
    """Hash of the first ``length`` (at most 7) bytes of each word, folded."""
    h = np.full(len(w.start), length, np.uint64)
    for j in range(length):
        at = w.start + j
        inside = at < w.end
        h = h << np.uint64(9) | np.where(inside, table[data[np.where(inside, at, w.start)]], 0).astype(np.uint64)
    return spread(h)


def runs(keys: np.ndarray) -> np.ndarray:
    """First places of the runs of equal neighbours (rows of ``keys`` if 2-D)."""
    if not len(keys):
        return np.zeros(0, np.int64)
    change = keys[1:] != keys[:-1]
    if keys.ndim > 1:
        change = change.any(axis=1)
    return np.concatenate([[0], np.flatnonzero(change) + 1])
