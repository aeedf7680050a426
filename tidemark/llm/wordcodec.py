"""Token ids of texts, word by word, from a tokenizer file."""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MARK = "\x01"
STOPS = ".,"
#: Lower-case letters that normal forms leave alone: a-z and those of Latin-1.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
#: Bytes that a codec's memory takes, about, and that a word's entry takes besides its letters.
MEMORY, ENTRY = 200_000_000, 240
#: Words whose ids are put into their places at a time: what that takes is 50 bytes a word.
PLACED = 200_000


class WordCodec:
    """Encodes with a tokenizer for which white space only separates words, so that the ids
    of a text are those of its words in order. Words, between ASCII white space, are encoded
    once and remembered.

    More identities of such tokenizers are used: a full stop or comma behind a letter
    is a piece of its own, A-Z counts as lower case, and a word of LETTERS alone is one piece,
    which goes to the tokenizer's model at once. The last is only used if the tokenizer's
    normalizer and pre-tokenizer, asked for all of LETTERS as a word, say so. The memory has two halves of
    about ``most`` / 2 bytes; when the younger is full, it replaces the older. Words are
    encoded many at a time, with a mark between them that the tokenizer gives one id of its
    own; words with the mark in them are encoded alone.
    """

    def __init__(self, path: str, width: int, most: int = MEMORY):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype(f"<u{width}")
        self.most = most
        self.size = 0
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        (self.mark,) = self._ids(MARK)
        self.model = self.tokenizer.model
        self.pieces = self._pieces()
        self.plain = re.compile(f"[{LETTERS}]+" if self.pieces else "(?!)").fullmatch

    def _pieces(self) -> dict[int, str]:
        """What the pre-tokenizer makes of each of LETTERS; empty if a word of them is not
        what its letters make, one after the other."""
        normalizer, cutter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if cutter is None or normalizer and normalizer.normalize_str(LETTERS) != LETTERS:
            return {}

        def cut(word: str) -> list[str]:
            return [piece for piece, _ in cutter.pre_tokenize_str(word)]

        each = [cut(letter) for letter in LETTERS]
        if cut(LETTERS) != ["".join(chain.from_iterable(each))]:
            return {}
        return {ord(letter): "".join(cuts) for letter, cuts in zip(LETTERS, each, strict=True)}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, words: Iterable[str]) -> None:
        known, width = self.known, self.type.itemsize
        plain, rest = [], []
        for word in words:
            if self.plain(word):
                plain.append(word)
            elif MARK in word:
                known[word] = np.array(self._ids(word), self.type).tobytes()
            else:
                rest.append(word)
        tokenize, pieces = self.model.tokenize, self.pieces
        for at in range(0, len(plain), 256):
            some = plain[at : at + 256]
            cuts = [tokenize(word if word.isascii() else word.translate(pieces)) for word in some]
            raw = np.array([token.id for token in chain.from_iterable(cuts)], self.type).tobytes()
            start = 0
            for word, tokens in zip(some, cuts, strict=True):
                end = start + len(tokens) * width
                known[word] = raw[start:end]
                start = end
        for at in range(0, len(rest), 256):
            some = rest[at : at + 256]
            ids = np.array(self._ids(f" {MARK} ".join(some)), self.type)
            marks = np.flatnonzero(ids == self.mark).tolist()
            raw, start = ids.tobytes(), 0
            for word, end in zip(some, [*marks, len(ids)], strict=True):
                known[word] = raw[start * width : end * width]
                start = end + 1

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each followed by ``end_id``, and how many each has."""
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        del split
        forms = words.dictionary.to_pylist()
        raws = self._raws(forms)
        of = words.indices.to_numpy()
        del words
        ends = np.array([] if end_id is None else [end_id], self.type).tobytes()
        ids = np.frombuffer(b"".join([*raws, ends]), self.type)
        sizes = np.array([*map(len, raws), len(ends)]) // self.type.itemsize
        starts = np.cumsum(sizes) - sizes
        del forms, raws
        # A word after the last of each text stands for its end.
        encoded, counted, at = [], [], 0
        while at < len(texts):
            # At least one text, else as many as have PLACED words together.
            end = max(int(np.searchsorted(bounds, bounds[at] + PLACED, "right")) - 1, at + 1)
            last = bounds[at + 1 : end + 1] - bounds[at]
            order = np.insert(of[bounds[at] : bounds[end]], last, len(sizes) - 1)
            counts = sizes[order]
            behind = np.cumsum(counts)
            shift = (starts[order] - behind + counts).astype(np.int32)
            places = np.repeat(shift, counts)
            places += np.arange(len(places), dtype=np.int32)
            encoded.append(ids[places])
            counted.append(np.diff(behind[last + np.arange(len(last))], prepend=0))
            at = end
        if not encoded:
            return np.array([], self.type), np.array([], np.int64)
        return np.concatenate(encoded), np.concatenate(counted)

    def _raws(self, forms: list[str]) -> list[bytes]:
        """The ids of each word, as bytes."""
        if self.size > self.most // 2:
            self.known, self.older, self.size = {}, self.known, 0
        known, older = self.known, self.older
        fresh = set(STOPS).union(forms).difference(known)
        again = fresh.intersection(older)
        known.update(zip(again, map(older.__getitem__, again), strict=True))
        self.size += len(fresh) * ENTRY + sum(map(len, fresh))
        fresh -= again
        # Lists and no pairs: Python's collector would walk over millions of those.
        words = [word for word in fresh if word and word not in STOPS]
        stems, stops = [], []
        for word in words:
            stem, stop = word, ""
            if word[-1] in STOPS and word[:-1].isalpha():
                stem, stop = word[:-1], word[-1]
            if stem.isascii() and "<" not in stem:  # "<" may open a special token
                stem = stem.lower()
            stems.append(stem)
            stops.append(stop)
        self._learn(set(stems).union(STOPS).difference(known))
        known[""] = none = b""
        for word, stem, stop in zip(words, stems, stops, strict=True):
            known[word] = known[stem] + (known[stop] if stop else none)
        return list(map(known.__getitem__, forms))
