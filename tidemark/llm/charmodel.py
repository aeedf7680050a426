"""Interpolated Kneser-Ney models over characters, for several languages at once.

Symbols are lower-case letters in 16 bits; everything between letters is one boundary, 0.
A gram of four symbols is a 64-bit number, its own hash; grams, shorter grams and contexts
are sorted arrays with one value per language beside each entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

ORDER = 4
BITS = 16
SYMBOLS = 1 << BITS
PAD = ORDER - 1
#: Symbols of a text that are worked on at a time; a longer one is read in pieces, of which each
#: goes on with the symbols before it.
PIECE = 1_000_000
#: Shorter texts are put together to so many.
PORTION = 250_000

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Symbol of each code point; letters beyond the first plane are folded into 16 bits."""
    if not _LETTERS:
        codes = np.arange(0x110000, dtype=np.uint32)
        folded = np.where(codes < SYMBOLS, codes, (codes ^ (codes >> 9)) & 0x7FFF | 0x8000)
        alpha = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        _LETTERS.append(np.where(alpha, folded, 0).astype(np.uint64))
    return _LETTERS[0]


def pieces(texts: list[str]) -> Iterator[tuple[list[str], np.ndarray, bool]]:
    """``texts`` in portions of PORTION characters or more: lower-cased pieces, the text each
    is of, and whether the last piece goes on as the first of the next portion."""
    some: list[str] = []
    of: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        lowered = text.lower()
        for start in range(0, len(lowered), PIECE):
            some.append(lowered[start : start + PIECE])
            of.append(number)
            size += len(some[-1])
            goes_on = start + PIECE < len(lowered)
            if size >= PORTION or goes_on:
                yield some, np.array(of), goes_on
                some, of, size = [], [], 0
    if some:
        yield some, np.array(of), False


def text_grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The grams of all texts, one for each symbol, in portions: (grams, text of each)."""
    before = None
    for some, text_of, goes_on in pieces(texts):
        found, of, before = grams(some, before, goes_on)
        if not goes_on:
            before = None
        yield found, text_of[of]


def grams(
    some: list[str], before: np.ndarray | None = None, goes_on: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The grams of each lower-cased piece, one for each symbol: (grams, piece of each, last
    symbols of the last piece).

    ``before`` are the last symbols before the first piece, if that is not the start of its
    text. All texts end with a boundary; the last piece has none if its text ``goes_on``.
    """
    ended = [text + " " for text in some]
    if goes_on:
        ended[-1] = some[-1]
    raw = "".join(ended).encode("utf-32-le", "surrogatepass")
    symbols = _letters()[np.frombuffer(raw, "<u4")]
    sizes = np.fromiter(map(len, ended), np.int64, len(ended))
    of = np.repeat(np.arange(len(ended)), sizes)
    # Of a run of boundaries the first stays, and none at the start of a text.
    letter = symbols > 0
    after = np.zeros(len(symbols), bool)
    after[1:] = letter[:-1]
    after[np.cumsum(sizes)[:-1]] = False
    if before is not None:
        after[0] = before[-1] > 0
    keep = np.flatnonzero(letter | after)
    of = of[keep]
    padded = np.zeros(len(keep) + PAD * len(ended), np.uint64)
    if before is not None:
        padded[:PAD] = before
    at = np.arange(len(keep)) + PAD * (of + 1)
    padded[at] = symbols[keep]
    found = padded[at]
    for back in range(1, ORDER):
        found |= padded[at - back] << np.uint64(BITS * back)
    return found, of, padded[-PAD:]


class Sorted:
    """A sorted array of keys with a row of values for each."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is there) of each key."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return at, self.keys[at] == keys


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``values`` added up by key; ``keys`` are sorted."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(values, starts, axis=0)


class CharModels:
    """Models of ``languages`` from counts of grams (one column per language)."""

    def __init__(self, languages: list[str], keys: np.ndarray, counts: np.ndarray):
        self.languages = languages
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order].astype(np.float64)
        floor = np.full(len(languages), 1 / SYMBOLS)
        # From the highest order down: counts of grams, then of the different
        # symbols seen before them.
        ladder = [(keys, counts)]
        for length in range(ORDER - 1, 0, -1):
            tails = ladder[-1][0] & np.uint64((1 << BITS * length) - 1)
            order = np.argsort(tails, kind="stable")
            ladder.append(_sums(tails[order], (ladder[-1][1] > 0)[order].astype(np.float64)))
        self.unseen = floor
        self.grams: list[Sorted] = []  # of 1, 2, ... symbols: log2 of the probability
        self.backoffs: list[Sorted] = []  # of the contexts of 0, 1, ... symbols: log2 of the weight
        for length, (own, n) in enumerate(reversed(ladder), 1):
            ones, twos = (n == 1).sum(axis=0), (n == 2).sum(axis=0)
            discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.9)
            contexts, total = _sums(own >> np.uint64(BITS), n)
            _, kinds = _sums(own >> np.uint64(BITS), (n > 0).astype(np.float64))
            weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1)
            at = np.searchsorted(contexts, own >> np.uint64(BITS))
            lower = self._lower(own & np.uint64((1 << BITS * (length - 1)) - 1), length - 1)
            seen = np.maximum(n - discount, 0) / np.maximum(total[at], 1)
            probability = seen + weight[at] * np.exp2(lower)
            self.backoffs.append(Sorted(contexts, np.log2(weight).astype(np.float32)))
            self.grams.append(Sorted(own, np.log2(probability).astype(np.float32)))
        surprise = -self.grams[-1].values.astype(np.float64)
        size = np.maximum(counts.sum(axis=0), 1)
        #: Bits per symbol of each language's own text, and their deviation.
        self.mean = (counts * surprise).sum(axis=0) / size
        self.deviation = np.sqrt(
            np.maximum((counts * surprise**2).sum(axis=0) / size - self.mean**2, 0)
        )

    def _lower(self, keys: np.ndarray, length: int) -> np.ndarray:
        """log2 of the probabilities of grams of ``length`` symbols, seen or not."""
        if length == 0:
            return np.broadcast_to(
                np.log2(self.unseen).astype(np.float32), (len(keys), len(self.languages))
            )
        table, backoff = self.grams[length - 1], self.backoffs[length - 1]
        at, there = table.find(keys)
        out = table.values[at] if len(table.keys) else np.empty((len(keys), len(self.languages)))
        missing = np.flatnonzero(~there)
        if len(missing):
            rest = keys[missing]
            shorter = self._lower(rest & np.uint64((1 << BITS * (length - 1)) - 1), length - 1)
            at, there = backoff.find(rest >> np.uint64(BITS))
            weight = np.where(there[:, None], backoff.values[at], np.float32(0))
            out[missing] = shorter + weight
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per symbol of each text in each language, and its number of symbols."""
        bits = np.zeros((len(texts), len(self.languages)))
        sizes = np.zeros(len(texts), np.int64)
        for found, of in text_grams(texts):
            if not len(found):
                continue
            starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            sums = np.add.reduceat(self._lower(found, ORDER), starts, axis=0, dtype=np.float64)
            owners = of[starts]
            np.add.at(bits, owners, -sums)
            np.add.at(sizes, owners, np.diff(np.append(starts, len(found))))
        return bits / np.maximum(sizes, 1)[:, None], sizes
