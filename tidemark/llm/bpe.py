"""Byte-level BPE through a table of distinct words, and back through a table of pieces.

Encoding: tasks cut texts into words at places where the tokenizer always cuts, and number
the distinct words of a block of texts. Words of all blocks meet by hash, in parts of one table
of distinct words, and each is encoded once; the ids go back to the blocks, where the numbers
say at which positions they stand. What is shuffled is the distinct words of each block, their
ids, and a number for each word of a text, packed; never the texts.

Decoding: ids meet the table of pieces, which is broadcast, and the pieces of a row are put
together where the row is.
"""

from __future__ import annotations

import functools
import itertools
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import enter, keeps, small_batches

#: Classes of bytes: letters, digits, signs, what is no white space but part of longer things
#: (apostrophes of contractions, bars of special tokens), a blank that may stand before a word.
LETTER, DIGIT, SIGN, BOUND, BLANK = 1, 2, 3, 4, 5
#: Bytes of texts that share one numbering, and that are looked at together.
BLOCK, SLICE = 12_000_000, 1_000_000
#: Words that are encoded together, and ids that are joined with their pieces together.
BATCH, JOINED = 2_000, 500_000
#: Ids of a vocabulary that may be sent to every task.
MOST_PIECES = 2_000_000
#: Blocks of one task, as a power of two.
BLOCK_BITS = 20
#: Parts of the table of distinct words for each partition of a shuffle.
PARTS = 4
#: Words of a block whose ids are put in place together.
GATHERED = 250_000


def _classes() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for byte in range(ord("!"), ord("~") + 1):
        letter = chr(byte)
        table[byte] = LETTER if letter.isalpha() else DIGIT if letter.isdigit() else SIGN
    table[[ord("'"), ord("|")]] = BOUND
    table[[ord(" "), ord("\n")]] = BLANK
    return table


CLASSES = _classes()


def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def cuts(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where words begin in the bytes of several texts, which begin at ``starts``.

    Besides there, that is before a blank between two printable ASCII characters, and between
    two of those of which one is a letter and one a digit, or one of them and a sign. No
    tokenizer of this kind has a piece across such a place, whatever surrounds it; characters
    beyond ASCII, of which versions of Unicode may think differently, are never cut at.
    """
    cut = np.zeros(len(raw) + 1, bool)
    for at in range(0, len(raw), SLICE):
        own = CLASSES[raw[max(at - 1, 0) : at + SLICE + 1]]  # a neighbour on each side
        before, here = own[:-1], own[1:]
        graded = (own >= LETTER) & (own <= SIGN)
        differ = (before != here) & graded[:-1] & graded[1:]
        solid = (own >= LETTER) & (own <= BOUND)
        differ[:-1] |= (here[:-1] == BLANK) & solid[:-2] & solid[2:]
        first = max(at - 1, 0) + 1
        # The last place of a slice has no neighbour behind it, and is the first of the next.
        cut[first : first + len(differ)] |= differ
    cut[starts] = True
    return np.flatnonzero(cut[: len(raw)])


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts (binary, no nulls), in a row, and how many each text has."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    data = texts.buffers()[2]
    raw = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts = (offsets - offsets[0]).astype(np.int64)
    places = cuts(raw, starts[:-1][np.diff(starts) > 0])
    ends = np.append(places, len(raw)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(places), pa.py_buffer(ends), pa.py_buffer(raw))
    return words, np.diff(np.searchsorted(places, starts))


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 by planes of bytes, of which the higher ones are nearly empty."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return _small(planes.tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(_whole(raw), np.uint8)
    return planes.reshape(4, -1).T.copy().view("<u4")[:, 0]


def _small(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(1).compress(raw)


def _whole(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, bytes]:
    """The sizes of strings or binary values, and what they hold, in a row."""
    if not len(values):
        return np.zeros(0, np.int64), b""
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    return np.diff(ends).astype(np.int64), bytes(data[ends[0] : ends[-1]]) if data else b""


def _values_of(sizes: np.ndarray, raw: bytes, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(
        kind, len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(raw)]
    )


class _Block:
    """Texts that share one numbering of their words, the most frequent first."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.rows: list[pa.Array] = []
        self.words: list[pa.Array] = []
        self.counts: list[np.ndarray] = []

    def add(self, rows: pa.Array, texts: pa.Array) -> None:
        words, counts = words_of(texts)
        self.rows.append(rows)
        self.words.append(words.dictionary_encode())
        self.counts.append(counts)
        self.size += int(pc.sum(pc.binary_length(texts)).as_py() or 0)

    def numbered(self) -> tuple[pa.Array, np.ndarray]:
        """The distinct words, and the number of each word of the texts."""
        whole = pa.chunked_array(self.words).unify_dictionaries().combine_chunks()
        codes = whole.indices.to_numpy()
        often = np.bincount(codes, minlength=len(whole.dictionary))
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        return whole.dictionary.take(pa.array(order)), rank[codes]


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[_Block]:
    """The texts of a task in blocks of about ``size`` bytes, numbered by task."""
    task = TaskContext.get().partitionId()
    number = 0

    def named() -> _Block:
        return _Block((task << BLOCK_BITS) + number)

    block = named()
    for batch in batches:
        texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            room = before + max(size - block.size, 0)
            end = max(int(np.searchsorted(sizes, room, "right")), at + (not block.rows))
            if end > at:
                block.add(batch.column("row").slice(at, end - at), texts.slice(at, end - at))
            at = end
            if at < batch.num_rows or block.size >= size:
                yield block
                number += 1
                block = named()
    if block.rows:
        yield block


def _digest(words: pa.Array) -> int:
    """A fingerprint of a block's words, by which two passes over the texts are compared."""
    sizes, raw = _bytes_of(words)
    hashed = xxhash.xxh64(sizes.tobytes())
    hashed.update(raw)
    return hashed.intdigest() & (1 << 62) - 1


def _positions(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """A row for each block: its rows, and which of its words stand where."""
    for block in _blocks(batches, size):
        words, codes = block.numbered()
        rows = pa.concat_arrays(block.rows)
        lists = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
        yield pa.record_batch(
            [
                pa.array([block.number], pa.int64()),
                pa.array([_digest(words)], pa.int64()),
                lists,
                pa.array([_packed(np.concatenate(block.counts))], pa.binary()),
                pa.array([_packed(codes)], pa.binary()),
            ],
            names=["of", "digest", "rows", "counts", "codes"],
        )


def _entries(batches: Iterator[pa.RecordBatch], size: int, parts: int) -> Iterator[pa.RecordBatch]:
    """A row for the distinct words of each block that belong to one part of the table."""
    for block in _blocks(batches, size):
        words, _ = block.numbered()
        held = words.to_pylist()
        of = np.fromiter((xxhash.xxh32_intdigest(w.encode()) for w in held), np.int64, len(held))
        of %= parts
        order = np.argsort(of, kind="stable")
        cuts = np.flatnonzero(np.diff(of[order])) + 1
        some = [codes for codes in np.split(order, cuts) if len(codes)]
        taken = [_bytes_of(words.take(pa.array(codes))) for codes in some]
        n = len(some)
        yield pa.record_batch(
            [
                pa.array([int(of[codes[0]]) for codes in some], pa.int32()),
                pa.array(np.full(n, block.number), pa.int64()),
                pa.array(np.full(n, _digest(words)), pa.int64()),
                pa.array([_packed(np.diff(codes, prepend=0)) for codes in some], pa.binary()),
                pa.array([_packed(sizes) for sizes, _ in taken], pa.binary()),
                pa.array([_small(raw) for _, raw in taken], pa.binary()),
            ],
            names=["part", "block", "digest", "codes", "sizes", "words"],
        )


def word_ids(entries: DataFrame, tokenizer: str) -> DataFrame:
    """``block``, ``digest``, ``codes`` and, for each code, how many ids its word has (``sizes``)
    and which (``ids``; 2 bytes each if all ids of the tokenizer fit, else 4), for every row of
    ``entries``. Equal words are in one part of the table, where they are encoded once."""
    kind = _id_type(tokenizer)

    def look_up(part: pa.Table) -> pa.Table:
        packed = [part.column(c).to_pylist() for c in ("sizes", "words")]
        each = [
            _values_of(_unpacked(sizes), _whole(raw), pa.string())
            for sizes, raw in zip(*packed, strict=True)
        ]
        encoded = pa.concat_arrays(each).dictionary_encode()
        found = _encoded(_codec(tokenizer), encoded.dictionary.to_pylist(), kind)
        ids = found.take(encoded.indices)
        starts = np.cumsum([0, *map(len, each)])
        own = [_bytes_of(ids.slice(a, b - a)) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        wide = np.dtype(kind).itemsize
        return pa.table(
            {
                "block": part.column("block"),
                "digest": part.column("digest"),
                "codes": part.column("codes"),
                "sizes": pa.array([_packed(sizes // wide) for sizes, _ in own], pa.binary()),
                "ids": pa.array([_small(raw) for _, raw in own], pa.binary()),
            }
        )

    schema = "block long, digest long, codes binary, sizes binary, ids binary"
    return entries.groupBy("part").applyInArrow(look_up, schema)


_CODECS: dict = {}


def _release() -> bool:
    held = bool(_CODECS)
    _CODECS.clear()
    return held


keeps("bpe", _release)


def _codec(path: str):
    """A worker's tokenizer, which serves all parts that it looks up."""
    enter("bpe")
    if path not in _CODECS:
        _CODECS[path] = _tokenizer(path)
    return _CODECS[path]


def _encoded(codec, words: list[str], kind: str) -> pa.Array:
    """The ids of each word as bytes."""
    parts = [pa.array([], pa.binary())]
    for start in range(0, len(words), BATCH):
        found = codec.encode_batch_fast(words[start : start + BATCH], add_special_tokens=False)
        lists = [e.ids for e in found]
        flat = np.fromiter(itertools.chain.from_iterable(lists), kind)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)) * flat.itemsize
        parts.append(_values_of(sizes, flat.tobytes(), pa.binary()))
    return pa.concat_arrays(parts)


def _id_type(tokenizer: str) -> str:
    return "<u2" if _tokenizer(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"


def _gathered(left: pa.Table, right: pa.Table, kind: str) -> pa.Table:
    """The ids of each row of a block, from the positions of its words and the words' ids."""
    (digest,) = left.column("digest").to_pylist()
    if set(right.column("digest").to_pylist()) - {digest}:
        raise RuntimeError("the texts were read twice and not alike: write them to a table first")
    parts = [
        (np.cumsum(_unpacked(codes), dtype=np.int64), _unpacked(sizes), _whole(ids))
        for codes, sizes, ids in zip(
            *(right.column(c).to_pylist() for c in ("codes", "sizes", "ids")), strict=True
        )
    ]
    values = np.frombuffer(b"".join(raw for _, _, raw in parts), kind)
    sizes = np.zeros(sum(len(own) for own, _, _ in parts), np.int32)
    starts = np.zeros(len(sizes), np.int64)
    at = 0
    for own, counts, _ in parts:
        sizes[own] = counts
        starts[own] = at + np.cumsum(counts, dtype=np.int64) - counts
        at += int(counts.sum(dtype=np.int64))
    codes = _unpacked(left.column("codes")[0].as_py())
    ends = np.cumsum(_unpacked(left.column("counts")[0].as_py()), dtype=np.int64)
    rows = left.column("rows").combine_chunks().flatten()
    if isinstance(rows, pa.ChunkedArray):
        rows = rows.combine_chunks()
    batches, row = [], 0
    while row < len(rows):
        first = int(ends[row - 1]) if row else 0
        last = max(int(np.searchsorted(ends, first + GATHERED, "right")), row + 1)
        own = codes[first : ends[last - 1]]
        counts = sizes[own]
        behind = np.cumsum(counts, dtype=np.int64)
        total = int(behind[-1]) if len(behind) else 0
        places = np.repeat(starts[own] - (behind - counts), counts)
        places += np.arange(total)
        cut = np.concatenate([[0], behind])[np.concatenate([[0], ends[row:last] - first])]
        ids = pa.ListArray.from_arrays(
            pa.array(cut.astype(np.int32)), pa.array(values[places].astype(np.int32))
        )
        batches.append(pa.record_batch([rows.slice(row, last - row), ids], names=["row", "ids"]))
        row = last
    return pa.Table.from_batches(batches)


def distinct_words(texts: DataFrame, block_bytes: int = BLOCK) -> DataFrame:
    """The distinct words of each block of ``texts`` (``row``, and ``text`` as bytes), packed by
    parts of the table of all words: ``part``, ``block``, ``digest``, ``codes``, ``sizes``, ``words``."""
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = functools.partial(_entries, size=block_bytes, parts=PARTS * tasks)
    schema = "part int, block long, digest long, codes binary, sizes binary, words binary"
    return texts.mapInArrow(each, schema)


def encode(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    block_bytes: int = BLOCK,
) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns) and ``ids`` of the whole text, for every row.

    ``tokenizer`` is the file of a byte-level BPE tokenizer on every executor. Special tokens
    within a text get their own id, none is added. Null and empty texts have no ids; equal
    rows stay apart; an empty table gives an empty one. Columns not kept are not read, so
    their names do not matter. A text of any length is encoded whole; a task holds a block
    of texts, or a longer text, and its words.

    Texts are read twice, once for the words and once for their positions, which costs less
    than keeping either. Rows that come otherwise the second time are found and raise.
    """
    small_batches(docs.sparkSession)
    read = docs.select(F.struct(*keep).alias("row"), F.col(text).cast("binary").alias("text"))
    row = read.schema["row"].dataType.simpleString()
    schema = f"of long, digest long, rows array<{row}>, counts binary, codes binary"
    positions = read.mapInArrow(functools.partial(_positions, size=block_bytes), schema)
    found = word_ids(distinct_words(read, block_bytes), tokenizer)
    kind = _id_type(tokenizer)

    def gathered(left: pa.Table, right: pa.Table) -> pa.Table:
        return _gathered(left, right, kind)

    return (
        positions.groupBy("of")
        .cogroup(found.groupBy("block"))
        .applyInArrow(gathered, f"row {row}, ids array<int>")
    )


def _byte_of_character() -> dict[str, int]:
    """Which byte a character of a piece stands for: printable bytes for themselves, the others
    in order for the characters from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1)]
    plain += range(ord("®"), ord("ÿ") + 1)
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def pieces(tokenizer: str) -> pa.Table:
    """``id`` and ``piece`` (its bytes) of every token of a byte-level tokenizer."""
    byte_of = _byte_of_character()
    known = _tokenizer(tokenizer).get_vocab(with_added_tokens=True)
    if len(known) > MOST_PIECES:
        raise ValueError(f"a vocabulary of {len(known)} is too large to send to every task")
    raw = [
        bytes(map(byte_of.__getitem__, token)) if set(token) <= byte_of.keys() else token.encode()
        for token in known
    ]
    return pa.table({"id": pa.array(known.values(), pa.int32()), "piece": pa.array(raw)})


class Pieces:
    """The pieces of all ids, in a row: the right side of a join that every task has whole."""

    def __init__(self, table: pa.Table):
        size = max(table.column("id").to_pylist(), default=-1) + 1
        held = [b""] * (size + 1)  # the last stands for ids that the tokenizer does not have
        for number, piece in zip(*(table.column(c).to_pylist() for c in ("id", "piece")), strict=True):
            held[number] = piece
        self.sizes = np.fromiter(map(len, held), np.int64, len(held))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(held), np.uint8)

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the pieces of ``ids`` in a row, and how many bytes there are up to each."""
        known = np.where((ids >= 0) & (ids < len(self.sizes) - 1), ids, len(self.sizes) - 1)
        counts = self.sizes[known]
        behind = np.cumsum(counts)
        total = int(behind[-1]) if len(behind) else 0
        places = np.repeat(self.starts[known] - (behind - counts), counts)
        places += np.arange(total)
        return self.bytes[places], np.concatenate([[0], behind])


def decode(
    encoded: DataFrame, tokenizer: str, ids: str = "ids", keep: Sequence[str] = ("row",)
) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns) and the ``text`` of its ids, for every row.

    Special tokens are text like any other; ids that the tokenizer does not have and nulls are
    left out, bytes that are no UTF-8 become U+FFFD. Null or no ids give an empty text. The
    pieces are a table of the vocabulary's size, checked, that is broadcast; ids meet it where
    their rows are, JOINED of them at a time, and nothing is shuffled.
    """
    spark = encoded.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(Pieces(pieces(tokenizer)))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            lists = batch.column("ids")
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(False)
            ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            flat = pc.fill_null(lists.flatten(), -1).to_numpy(False)
            at = 0
            while at < batch.num_rows:
                end = max(int(np.searchsorted(ends, ends[at] + JOINED, "right")) - 1, at + 1)
                texts = _texts(table, flat[ends[at] : ends[end]], ends[at : end + 1] - ends[at])
                yield pa.record_batch(
                    [batch.column("row").slice(at, end - at), texts], names=["row", "text"]
                )
                at = end

    rows = encoded.select(F.struct(*keep).alias("row"), F.col(ids).alias("ids"))
    row = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(join, f"row {row}, text string")


def _texts(table: Pieces, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The texts of rows of ids, put in a row, that end at ``ends``; more than JOINED are of one."""
    if len(ids) > JOINED:
        parts = [table.joined(ids[at : at + JOINED])[0] for at in range(0, len(ids), JOINED)]
        raws = [b"".join(part.tobytes() for part in parts)]
    else:
        raw, behind = table.joined(ids)
        whole, cut = raw.tobytes(), behind[ends].tolist()
        raws = [whole[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return pa.array([raw.decode("utf-8", "replace") for raw in raws], pa.string())
