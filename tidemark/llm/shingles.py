"""Sets of hashed word shingles, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tidemark.llm.common import keeps
from tidemark.llm.perfecthash import mix

#: Bytes of text that are worked on at a time; a longer text is taken in parts between words.
#: A byte takes about 60 while its words are hashed, in each of an executor's workers.
PORTION = 250_000
BASE = 0x9FB21C651E98DF25
WORD_SEED, SHINGLE_SEED, SHORT_SEED = 11, 12, 13
_POWERS: list[np.ndarray] = []


def _release() -> bool:
    held = bool(_POWERS)
    _POWERS.clear()
    return held


keeps("jaccard", _release)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 1 to ``n`` of BASE modulo 2**64, and their inverses. Only those that a part of a
    text takes are kept; a longer word has its own."""
    if n > PORTION:
        return _computed(n)
    if not _POWERS:
        _POWERS[:] = _computed(PORTION)
    return _POWERS[0][:n], _POWERS[1][:n]


def _computed(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    first, second = (np.cumprod(np.full(n, b, np.uint64)) for b in (BASE, inverse))
    return first, second


def _table() -> np.ndarray:
    """Lower-cases A-Z; white space becomes 0 and every other byte is one higher."""
    table = np.arange(1, 257, dtype=np.uint64)
    table[0x41:0x5B] += 0x20
    table[[0x20, *range(0x09, 0x0E)]] = 0
    return table


TABLE = _table()


def portions(texts: list[str]) -> Iterator[list[bytes]]:
    """The texts encoded, about PORTION bytes at a time."""
    some: list[bytes] = []
    size = 0
    for text in texts:
        some.append(text.encode("utf-8", "surrogatepass"))
        size += len(some[-1])
        if size >= PORTION:
            yield some
            some, size = [], 0
    if some:
        yield some


def _parts(raw: np.ndarray) -> Iterator[slice]:
    """Stretches of PORTION bytes at most, each but a longer word's ending behind white space,
    as ``raw`` itself does."""
    start = 0
    while start < len(raw):
        end, step = start, PORTION
        while end == start:
            blanks = np.flatnonzero(TABLE[raw[start : start + step]] == 0)
            end, step = start + (int(blanks[-1]) + 1 if len(blanks) else 0), 2 * step
        yield slice(start, end)
        start = end


def word_hashes(some: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, in order, and the text that each is of."""
    raw = np.frombuffer(b"\n".join([*some, b""]), np.uint8)
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for part in _parts(raw):
        values = TABLE[raw[part]]
        power, inverse = _powers(len(values))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values * power)])
        word = np.concatenate([[False], values > 0, [False]])
        starts = np.flatnonzero(word[1:] & ~word[:-1])
        ends = np.flatnonzero(~word[1:] & word[:-1])
        hashes.append(mix((sums[ends] - sums[starts]) * inverse[starts], WORD_SEED))
        places.append(starts + part.start)
    text_ends = np.cumsum([len(b) + 1 for b in some])
    of = np.searchsorted(text_ends, np.concatenate(places), side="right")
    return np.concatenate(hashes), of


def shingle_sets(
    texts: list[str], width: int, levels: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """The sorted set of each text's shingles of ``width`` words; of fewer words, the whole
    sequence is the one shingle; no words, no shingle.

    With ``levels``, the level of each slot of words, comes the lowest level of each
    shingle's words.
    """
    for some in portions(texts):
        hashes, of = word_hashes(some)
        firsts = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(some)))])
        whole = max(len(hashes) - width + 1, 0)
        combined = np.zeros(whole, np.uint64)
        for step in range(width):
            combined += mix(hashes[step : step + whole], step)
        combined = mix(combined, SHINGLE_SEED)
        if levels is not None:
            word_levels = levels[slots(hashes, levels)]
            lowest = word_levels[:whole].copy()
            for step in range(1, width):
                np.minimum(lowest, word_levels[step : step + whole], out=lowest)
        for first, end in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            if end - first >= width:
                own = slice(first, end - width + 1)
                if levels is None:
                    yield np.unique(combined[own]), None
                else:
                    found, at = np.unique(combined[own], return_index=True)
                    yield found, lowest[own][at]
            elif end > first:
                short = np.full(1, end - first, np.uint64)
                for step in range(end - first):
                    short += mix(hashes[first + step : first + step + 1], step)
                found = mix(short, SHORT_SEED)
                yield found, None if levels is None else word_levels[first:end].min(keepdims=True)
            else:
                none = np.zeros(0, np.uint64)
                yield none, None if levels is None else none.astype(np.uint8)


def slots(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The place of each hash in a table whose length is a power of two."""
    return (hashes >> np.uint64(65 - len(table).bit_length())).astype(np.int64)
