"""Token ids of documents in binary shards, found through minimal perfect hashes.

A store is a folder:

* ``shards/*.ids``: nothing but token ids, little-endian, documents back to back in
  ascending order of their key, each closed by the end id;
* ``shards/*.lens``: the number of ids of each document, 4 bytes each;
* ``runs``: where each key's documents lie in a shard (equal keys are neighbours);
* ``shards.bin``: 24 bytes for each shard, its name and the number of ids before it;
* ``index/*.bin``: buckets of keys by hash, each with a perfect hash, its fingerprints and, by
  slot, the runs of the key; a file begins with the places of its buckets;
* ``meta.json``: the number of buckets.

One key is found by its hash, with one small read from its index file for the place of the
bucket, one for the bucket, one for the shard's name and one for the ids, whatever the size
of the store. No job is run for that.

Shards are written by the tasks that encode. A task names its files anew at each attempt
and only what a finished attempt reports enters ``runs``, so lost executors leave stray
files at worst.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import enter, keeps, small_batches, trim
from tidemark.llm.perfecthash import PerfectHash
from tidemark.llm.wordcodec import MEMORY, WordCodec
from tidemark.shared import read_text, write_text

END = 1
KEYS_PER_BUCKET = 4096
#: Buckets of one index file.
BUCKETS_PER_FILE = 64
#: Bytes of text that are encoded at a time.
CHUNK = 8_000_000
#: Bytes of ids that are read together, also when so many between them are not wanted.
READ, GAP = 8_000_000, 65_536
SPACE = re.compile(r"[ \t\n\r\x0b\x0c]")
SHARD = struct.Struct("<16sq")
RUN = "key long, shard int, file string, record long, n_records long, offset long, n_ids long"
ENTRY = np.dtype(
    [("shard", "<i4"), ("record", "<i8"), ("n_records", "<i8"), ("offset", "<i8"), ("n_ids", "<i8")]
)
_CODECS: dict[tuple[str, int, int], WordCodec] = {}


def _release() -> bool:
    held = bool(_CODECS)
    _CODECS.clear()
    return held


keeps("tokens", _release)


def _codec(path: str, width: int, memory: int) -> WordCodec:
    """A worker's codec: what it has learned serves all its tasks of this operator."""
    enter("tokens")
    if (path, width, memory) not in _CODECS:
        _CODECS.clear()
        _CODECS[path, width, memory] = WordCodec(path, width, memory)
    return _CODECS[path, width, memory]


def _opened(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root)


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows of about ``most`` bytes of text together; a longer text is alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(False)
        ends = np.cumsum(lengths, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            fits = int(np.searchsorted(ends, before + most - size, "right"))
            end = max(fits, at + (not held))
            if end > at:
                held.append(batch.slice(at, end - at))
                size += int(ends[end - 1]) - before
                at = end
            if at < batch.num_rows or size >= most:
                together = pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
                yield from together
                del together
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _long(texts: pa.Array, most: int) -> bool:
    return len(texts) == 1 and pc.binary_length(texts)[0].as_py() > most


def _in_parts(text: str, most: int) -> Iterator[str]:
    """A long text in parts that end before white space."""
    start = 0
    while start < len(text):
        found = SPACE.search(text, start + most)
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end


def _write_ids(codec: WordCodec, texts: pa.Array, end_id: int, out, most: int) -> np.ndarray:
    """Writes the ids of texts, each closed by ``end_id``; how many each has."""
    if not _long(texts, most):
        encoded, sizes = codec.encode(texts, end_id)
        out.write(encoded.tobytes())
        return sizes
    total = 1
    for part in _in_parts(texts[0].as_py(), most):
        encoded, _ = codec.encode(pa.array([part], pa.string()))
        out.write(encoded.tobytes())
        total += len(encoded)
    out.write(np.array([end_id], codec.type).tobytes())
    return np.array([total])


def write_store(
    docs: DataFrame,
    root: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END,
    width: int = 2,
    shards: int | None = None,
    chunk: int | None = None,
    memory: int = MEMORY,
) -> None:
    """Encodes every row of ``docs`` into a new store at ``root``, a folder all executors
    and pyarrow reach. ``width`` is the bytes of an id; a larger id raises. Without
    ``shards`` Spark chooses their number by the size of the texts. ``chunk`` bytes of text
    (CHUNK) are encoded at a time, and words of ``memory`` bytes are remembered: less of
    either takes time, not results.

    Keys are integers. Null keys come first, null texts are empty (the end id alone),
    rows of equal keys are stored one after the other in order of their text. Other
    columns are not read. An empty table gives a store without shards.
    """
    spark, most = docs.sparkSession, chunk or CHUNK
    small_batches(spark)
    # Ranges may end between equal rows, so that copies of one row are not one task's work.
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = (
        docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
        .withColumn("copy", F.monotonically_increasing_id())
        .repartitionByRange(*[shards] * bool(shards), *order, "copy")
        .drop("copy")
        .sortWithinPartitions(*order, "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        name = f"{shard:07d}-{uuid.uuid4().hex}"
        store, folder = _opened(root)
        codec = _codec(tokenizer, width, memory)
        runs: dict = {}  # key: record, n_records, offset, n_ids; keys come in order
        record = offset = 0
        ids = lens = None
        for part in _chunks(batches, most):
            if ids is None:
                store.create_dir(f"{folder}/shards", recursive=True)
                ids = store.open_output_stream(f"{folder}/shards/{name}.ids")
                lens = store.open_output_stream(f"{folder}/shards/{name}.lens")
            sizes = _write_ids(codec, pc.fill_null(part.column("text"), ""), end_id, ids, most)
            lens.write(sizes.astype("<u4").tobytes())
            for k, n in zip(part.column("key").to_pylist(), sizes.tolist(), strict=True):
                run = runs.setdefault(k, [record, 0, offset, 0])
                run[1] += 1
                run[3] += n
                record += 1
                offset += n
        if ids is None:
            return
        ids.close()
        lens.close()
        trim()
        columns = zip(*runs.values(), strict=True)
        first, counts, offsets, totals = (pa.array(c, pa.int64()) for c in columns)
        n = len(runs)
        yield pa.record_batch(
            [
                pa.array(list(runs), pa.int64()),
                pa.array(np.full(n, shard, np.int32)),
                pa.array([name] * n),
                first,
                counts,
                offsets,
                totals,
            ],
            names=["key", "shard", "file", "record", "n_records", "offset", "n_ids"],
        )

    ordered.mapInArrow(write, RUN).write.parquet(f"{root}/runs")
    _write_shards(spark, root)
    _write_index(spark, root)


def _write_shards(spark: SparkSession, root: str) -> None:
    """The list of shards, which has a row for each task that encoded, and never for a document."""
    runs = spark.read.schema(RUN).parquet(f"{root}/runs")
    each = runs.groupBy("shard", "file").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("shard")) - F.col("n")
    each.select("shard", "file", before.alias("base")).coalesce(1).write.parquet(f"{root}/shard-list")
    listed = spark.read.parquet(f"{root}/shard-list").orderBy("shard").collect()
    table = bytearray(SHARD.size * (listed[-1]["shard"] + 1 if listed else 0))
    for row in listed:
        name = bytes.fromhex(row["file"].split("-")[1])
        SHARD.pack_into(table, SHARD.size * row["shard"], name, row["base"])
    store, folder = _opened(root)
    with store.open_output_stream(f"{folder}/shards.bin") as out:
        out.write(bytes(table))


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")


def bucket_of(key: int | None, buckets: int) -> int:
    """The bucket of one key, as Spark's hash of a long has it."""
    hashed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
    signed = hashed - (1 << 64) if hashed >> 63 else hashed
    return signed % buckets


def _write_index(spark: SparkSession, root: str) -> None:
    runs = spark.read.schema(RUN).parquet(f"{root}/runs")
    n = runs.count()
    buckets = n // KEYS_PER_BUCKET + 1 if n else 0
    write_text(spark, f"{root}/meta.json", json.dumps({"buckets": buckets}))
    if not n:
        return

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["part"].iloc[0])
        by = dict(tuple(pdf.groupby("bucket")))
        first = part * BUCKETS_PER_FILE
        packed = [
            _packed_bucket(by[bucket]) if bucket in by else b""
            for bucket in range(first, first + BUCKETS_PER_FILE)
        ]
        head = np.cumsum([8 * (BUCKETS_PER_FILE + 1), *map(len, packed)]).astype("<i8")
        store, folder = _opened(root)
        store.create_dir(f"{folder}/index", recursive=True)
        draft = f"{folder}/index/{part:07d}.draft-{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as out:
            out.write(head.tobytes() + b"".join(packed))
        # Every attempt writes the same, so the last to finish may replace the others.
        store.move(draft, f"{folder}/index/{part:07d}.bin")
        return pd.DataFrame({"part": [part]})

    bucket = _bucket(buckets)
    parts = runs.drop("file").withColumns(
        {"bucket": bucket, "part": F.floor(bucket / BUCKETS_PER_FILE).cast("int")}
    )
    parts.groupBy("part").applyInPandas(build, "part int").write.parquet(f"{root}/index-parts")


def _packed_bucket(pdf: pd.DataFrame) -> bytes:
    known = pdf[pdf["key"].notna()]
    keys, of = np.unique(known["key"].to_numpy(np.int64), return_inverse=True)
    table = PerfectHash.build(keys)
    slots = table.find(keys)[of]
    order = np.lexsort((known["shard"], slots))
    counts = np.bincount(slots, minlength=len(keys)).astype("<u4")
    nulls = pdf[pdf["key"].isna()].sort_values("shard")
    parts = [table.to_bytes(), counts.tobytes(), _entries(known.iloc[order]), _entries(nulls)]
    return struct.pack("<4Q", *map(len, parts)) + b"".join(parts)


def _entries(pdf: pd.DataFrame) -> bytes:
    table = np.zeros(len(pdf), ENTRY)
    for name in ENTRY.names:
        table[name] = pdf[name].to_numpy()
    return table.tobytes()


class IndexBucket:
    """One bucket of the index: the runs of a key in constant time."""

    def __init__(self, raw: bytes):
        parts, at = [], 32
        for size in struct.unpack_from("<4Q", raw):
            parts.append(raw[at : at + size])
            at += size
        self.hash = PerfectHash.from_bytes(parts[0])
        counts = np.frombuffer(parts[1], "<u4").astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.entries = np.frombuffer(parts[2], ENTRY)
        self.null_entries = np.frombuffer(parts[3], ENTRY)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of the keys that are held: (position of the key, entry)."""
        slots = self.hash.find(keys)
        held = np.flatnonzero(slots >= 0)
        first, last = self.first[slots[held]], self.first[slots[held] + 1]
        counts = last - first
        at = np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        return np.repeat(held, counts), self.entries[at + np.arange(counts.sum())]


def _read_bucket(store: fs.FileSystem, folder: str, bucket: int) -> IndexBucket | None:
    """One bucket, by two reads of its index file; None if it holds no key."""
    part, place = divmod(bucket, BUCKETS_PER_FILE)
    path = f"{folder}/index/{part:07d}.bin"
    if store.get_file_info(path).type == fs.FileType.NotFound:
        return None
    with store.open_input_file(path) as file:
        start, end = np.frombuffer(file.read_at(16, 8 * place), "<i8").tolist()
        return IndexBucket(file.read_at(end - start, start)) if end > start else None


def _stretches(places: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """Places (start, size), in order of their start, in stretches (start, end, places) that
    are read at once."""
    first = end = 0
    some: list[int] = []
    for number, (start, size) in enumerate(places):
        if some and (start - end > GAP or start + size - first > READ):
            yield first, end, some
            some = []
        if not some:
            first = start
        some.append(number)
        end = max(start + size, end) if len(some) > 1 else start + size
    if some:
        yield first, end, some


class TokenStore:
    """Keyed access to a store that :func:`write_store` has made."""

    def __init__(self, spark: SparkSession, root: str, width: int = 2):
        self.spark, self.root, self.width = spark, root, width

    @functools.cached_property
    def buckets(self) -> int:
        return json.loads(read_text(self.spark, f"{self.root}/meta.json"))["buckets"]

    def shards(self) -> DataFrame:
        """One row per shard with the number of ids before it."""
        schema = "shard int, file string, base long"
        return self.spark.read.schema(schema).parquet(f"{self.root}/shard-list")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Where the documents of ``keys`` (distinct ``key``) lie; unknown keys have no row.
        Keys meet by the index file that may have them."""
        root = self.root
        schema = "key long, shard int, record long, n_records long, offset long, n_ids long"
        if not self.buckets:
            return self.spark.createDataFrame([], schema)

        def find(wanted: pd.DataFrame) -> pd.DataFrame:
            store, folder = _opened(root)
            found = [pd.DataFrame(columns=["key", *ENTRY.names])]
            for number, own in wanted.groupby("bucket"):
                bucket = _read_bucket(store, folder, int(number))
                if bucket is None:
                    continue
                known = own["key"].dropna().to_numpy(np.int64)
                at, entries = bucket.find(known)
                found.append(_located(pd.array(known[at], "Int64"), entries))
                if own["key"].isna().any():
                    nulls = bucket.null_entries
                    found.append(_located(pd.array([None] * len(nulls), "Int64"), nulls))
            return pd.concat([f for f in found if len(f)] or found)

        bucket = _bucket(self.buckets)
        placed = keys.select("key", bucket.alias("bucket"))
        part = F.floor(F.col("bucket") / BUCKETS_PER_FILE)
        return placed.groupBy(part.alias("part")).applyInPandas(find, schema)

    def documents(self, keys: DataFrame) -> DataFrame:
        """The documents of ``keys`` as read from the shards: ``key``, ``start`` (ids of all
        documents before it), ``n_tokens`` and ``ids_crc32`` (of the ids as 4 bytes each).
        Documents that lie near each other are read at once."""
        root, width = self.root, self.width
        found = self.lookup(keys).join(self.shards(), "shard")

        def read(pdf: pd.DataFrame) -> pd.DataFrame:
            store, folder = _opened(root)
            name, base = pdf["file"].iloc[0], int(pdf["base"].iloc[0])
            pdf = pdf.sort_values("record")
            columns = [pdf[n].tolist() for n in ("key", "record", "n_records", "offset", "n_ids")]
            runs, rows = list(zip(*columns, strict=True)), []
            places = [(offset * width, n_ids * width) for *_, offset, n_ids in runs]
            with (
                store.open_input_file(f"{folder}/shards/{name}.ids") as ids,
                store.open_input_file(f"{folder}/shards/{name}.lens") as lens,
            ):
                for first, end, some in _stretches(places):
                    raw = ids.read_at(end - first, first)
                    for key, record, n_records, offset, n_ids in (runs[n] for n in some):
                        sizes = [n_ids]
                        if n_records > 1:
                            sizes = np.frombuffer(lens.read_at(4 * n_records, 4 * record), "<u4")
                        for size in map(int, sizes):
                            at = offset * width - first
                            wide = np.frombuffer(raw[at : at + size * width], f"<u{width}")
                            rows.append((key, base + offset, size, zlib.crc32(wide.astype("<u4"))))
                            offset += size
            out = pd.DataFrame(rows, columns=["key", "start", "n_tokens", "ids_crc32"])
            return out.astype({"key": "Int64"})

        schema = "key long, start long, n_tokens long, ids_crc32 long"
        return found.groupBy("shard").applyInPandas(read, schema)

    def get(self, key: int | None) -> list[list[int]]:
        """The ids of the documents of one key; empty when the store has none. Reads the bucket
        of the key and its documents, and runs no job."""
        if not self.buckets:
            return []
        store, folder = _opened(self.root)
        bucket = _read_bucket(store, folder, bucket_of(key, self.buckets))
        if bucket is None:
            return []
        entries = bucket.null_entries if key is None else bucket.find(np.array([key]))[1]
        out = []
        with store.open_input_file(f"{folder}/shards.bin") as shards:
            for entry in entries:
                shard, n = int(entry["shard"]), int(entry["n_records"])
                name, _ = SHARD.unpack(shards.read_at(SHARD.size, SHARD.size * shard))
                path = f"{folder}/shards/{shard:07d}-{name.hex()}"
                with store.open_input_file(f"{path}.lens") as lens:
                    sizes = np.frombuffer(lens.read_at(4 * n, 4 * int(entry["record"])), "<u4")
                with store.open_input_file(f"{path}.ids") as ids:
                    size, offset = int(entry["n_ids"]), int(entry["offset"])
                    raw = ids.read_at(size * self.width, offset * self.width)
                parts = np.split(np.frombuffer(raw, f"<u{self.width}"), np.cumsum(sizes)[:-1])
                out += [part.tolist() for part in parts]
        return out


def _located(keys: pd.api.extensions.ExtensionArray, entries: np.ndarray) -> pd.DataFrame:
    found = pd.DataFrame({name: entries[name] for name in ENTRY.names})
    found.insert(0, "key", keys)
    return found
