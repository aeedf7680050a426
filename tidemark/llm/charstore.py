"""The models of :mod:`charmodel` as a table of any size, built by aggregation.

An entry is the log2 of a gram's probability or of a context's backoff weight in one
language; those a language has not seen have none. Entries are written to the shared
folder. Scoring reads them in blocks of bounded size and keeps the block if there is but
one; every gram of every language counts, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.charmodel import BITS, ORDER, SYMBOLS, Sorted, text_grams
from tidemark.llm.common import keeps, scratch, staged

#: Entries that a task holds at a time.
BLOCK = 8_000_000
#: Symbols, and numbers of one table, that are looked up together; entries read together.
SLAB, CELLS, READ = 500_000, 2_000_000, 1 << 18

Block = dict[tuple[int, int], Sorted]
_HELD: dict[str, Block] = {}


def _release() -> bool:
    held = bool(_HELD)
    _HELD.clear()
    return held


keeps("langid", _release)


def _context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, BITS)


def _tail(gram: Column, length: int) -> Column:
    """The last ``length`` symbols, fewer than ORDER."""
    return gram.bitwiseAND(F.lit((1 << BITS * length) - 1))


def store_models(counts: DataFrame) -> tuple[str, DataFrame]:
    """The folder of the entries (``kind``, ``lang``, ``key``, ``value``) of the models with
    these counts of grams (``lang``, ``gram``, ``n``; read several times), and by language
    the ``mean`` and ``deviation`` of the bits per symbol of the counted texts.

    Kind k has grams of k symbols, kind ORDER + k the contexts of such grams. The symbols
    after one context are at most SYMBOLS, so no window grows with the texts.
    """
    spark = counts.sparkSession
    ladder = {ORDER: counts}
    for length in range(ORDER - 1, 0, -1):
        shorter = ladder[length + 1].groupBy("lang", _tail(F.col("gram"), length).alias("gram"))
        ladder[length] = staged(spark, shorter.agg(F.count("*").alias("n")), "langid-grams")
    entries, lower = [], None
    for length in range(1, ORDER + 1):
        ones = F.sum((F.col("n") == 1).cast("long"))
        twos = F.sum((F.col("n") == 2).cast("long"))
        share = ones / F.greatest(ones + 2 * twos, F.lit(1))
        discounts = ladder[length].groupBy("lang").agg(
            F.greatest(F.least(share, F.lit(0.9)), F.lit(0.1)).alias("discount")
        )
        discount = F.lit(0.1)
        for row in discounts.collect():
            discount = F.when(F.col("lang") == row["lang"], row["discount"]).otherwise(discount)
        after = Window.partitionBy("lang", "context")
        weighed = (
            ladder[length]
            .select("lang", "gram", "n", _context(F.col("gram")).alias("context"))
            .withColumn("total", F.sum("n").over(after))
            .withColumn("kinds", F.count("*").over(after))
            .withColumn("discount", discount)
            .withColumn("weight", F.col("discount") * F.col("kinds") / F.col("total"))
        )
        if lower is None:
            weighed = weighed.withColumn("lower", F.lit(1 / SYMBOLS))
        else:
            tails = lower.select("lang", F.col("gram").alias("tail"), F.col("p").alias("lower"))
            weighed = weighed.withColumn("tail", _tail(F.col("gram"), length - 1))
            weighed = weighed.join(tails, ["lang", "tail"])
        own = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")
        p = (own + F.col("weight") * F.col("lower")).alias("p")
        lower = staged(
            spark, weighed.select("lang", "gram", "n", "context", "weight", p), "langid-models"
        )
        contexts = lower.groupBy("lang", "context").agg(F.any_value("weight").alias("weight"))
        for kind, frame, key, value in (
            (length, lower, "gram", "p"),
            (ORDER + length, contexts, "context", "weight"),
        ):
            entries.append(
                frame.select(
                    F.lit(kind).alias("kind"),
                    "lang",
                    F.col(key).alias("key"),
                    F.log2(value).cast("float").alias("value"),
                )
            )
    root = scratch(spark, "langid-entries")
    union = entries[0]
    for more in entries[1:]:
        union = union.unionByName(more)
    union.write.parquet(root)
    bits, n = -F.log2("p"), F.col("n")
    mean = F.sum(n * bits) / F.sum(n)
    spread = F.sum(n * bits * bits) / F.sum(n) - mean * mean
    usual = lower.groupBy("lang").agg(
        mean.alias("mean"), F.sqrt(F.greatest(spread, F.lit(0.0))).alias("deviation")
    )
    return root, usual


class _Gathered:
    """Entries on their way into a block, as numbers."""

    def __init__(self, languages: list[str]):
        self.number = {name: n for n, name in enumerate(languages)}
        self.size = 0
        self.parts: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}

    def add(self, batch: pa.RecordBatch) -> None:
        names = batch.column("lang").dictionary_encode()
        own = np.array([self.number[name] for name in names.dictionary.to_pylist()])
        kind = batch.column("kind").to_numpy().astype(np.int64)
        group = kind * len(self.number) + own[names.indices.to_numpy()]
        keys = batch.column("key").to_numpy().view(np.uint64)
        values = batch.column("value").to_numpy()
        for number in np.unique(group).tolist():
            here = group == number
            part = keys[here], values[here]
            self.parts.setdefault(divmod(number, len(self.number)), []).append(part)
        self.size += batch.num_rows

    def block(self) -> Block:
        """The tables of each kind and language, put in order one after the other."""
        found = {}
        for which in list(self.parts):
            keys, values = map(np.concatenate, zip(*self.parts.pop(which), strict=True))
            order = np.argsort(keys)
            found[which] = Sorted(keys[order], values[order])
        return found


def _blocks(root: str, languages: list[str], most: int) -> Iterator[Block]:
    """The entries below ``root``, ``most`` at a time."""
    if root in _HELD:
        yield _HELD[root]
        return
    files, path = fs.FileSystem.from_uri(root)
    found = [f.path for f in files.get_file_info(fs.FileSelector(path)) if f.size]
    number, gathered = 0, _Gathered(languages)
    for name in sorted(f for f in found if f.endswith(".parquet")):
        with files.open_input_file(name) as raw:
            for batch in pq.ParquetFile(raw).iter_batches(min(most, READ)):
                if gathered.size and gathered.size + batch.num_rows > most:
                    yield gathered.block()
                    number, gathered = number + 1, _Gathered(languages)
                gathered.add(batch)
    block = gathered.block()
    if not number:
        _HELD.clear()
        _HELD[root] = block
    pa.default_memory_pool().release_unused()
    yield block


@dataclass
class StoredModels:
    """Models of ``languages`` below ``root``, with the mean and the deviation of the bits per
    symbol of the texts learned. By its bound, a language's texts of s symbols take no more than
    usual + slack + reach * sqrt(between + deviation ** 2 / s) bits per symbol."""

    languages: list[str]
    root: str
    mean: np.ndarray
    deviation: np.ndarray
    usual: np.ndarray | None = None
    between: np.ndarray | None = None
    reach: np.ndarray | None = None
    slack: np.ndarray | None = None
    most: int = BLOCK

    def bound(self, best: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The bits per symbol beyond which texts of ``sizes`` are not of the language ``best``."""
        chance = self.deviation[best] ** 2 / np.maximum(sizes, 1)
        spread = np.sqrt(self.between[best] + chance)
        return self.usual[best] + self.slack[best] + self.reach[best] * spread

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per symbol of each text in each language, and its number of symbols."""
        bits = np.zeros((len(texts), len(self.languages)))
        sizes = np.zeros(len(texts), np.int64)
        slab: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        symbols = kinds = 0
        for found, of in text_grams(texts):
            keys, at = np.unique(found, return_inverse=True)
            slab.append((keys, at.astype(np.int32), of.astype(np.int32)))
            symbols, kinds = symbols + len(found), kinds + len(keys)
            if symbols >= SLAB or kinds * len(self.languages) >= CELLS:
                self._add(slab, bits, sizes)
                slab, symbols, kinds = [], 0, 0
        self._add(slab, bits, sizes)
        return bits / np.maximum(sizes, 1)[:, None], sizes

    def _add(self, slab: list, bits: np.ndarray, sizes: np.ndarray) -> None:
        if not sum(len(keys) for keys, _, _ in slab):
            return
        wanted = np.unique(np.concatenate([keys for keys, _, _ in slab]))
        values = self._values(wanted)
        for keys, at, owner in slab:
            if not len(keys):
                continue
            at = np.searchsorted(wanted, keys)[at]
            first, last = int(owner[0]), int(owner[-1]) + 1
            place = owner - first
            sizes[first:last] += np.bincount(place, minlength=last - first)
            for lang, own in enumerate(values):
                bits[first:last, lang] -= np.bincount(place, own[at], last - first)

    def _values(self, wanted: np.ndarray) -> np.ndarray:
        """log2 of the probability of each gram, a row for each language."""
        shift, levels = np.uint64(BITS), {ORDER: wanted}
        tails, contexts, places = {}, {}, {}
        for length in range(ORDER, 0, -1):
            own = levels[length]
            contexts[length], places[length] = np.unique(own >> shift, return_inverse=True)
            tail = own & np.uint64((1 << BITS * (length - 1)) - 1)
            levels[length - 1], tails[length] = np.unique(tail, return_inverse=True)
        asked = {n: levels[n] for n in tails} | {ORDER + n: contexts[n] for n in tails}
        held = {
            kind: np.full((len(self.languages), len(keys)), np.nan, np.float32)
            for kind, keys in asked.items()
        }
        for block in _blocks(self.root, self.languages, self.most):
            for (kind, lang), table in block.items():
                at, there = table.find(asked[kind])
                held[kind][lang, there] = table.values[at[there]]
        values = np.full((len(self.languages), 1), np.log2(1 / SYMBOLS), np.float32)
        for length in range(1, ORDER + 1):
            weight = np.nan_to_num(held[ORDER + length], nan=0.0)[:, places[length]]
            values = np.where(
                np.isnan(held[length]), values[:, tails[length]] + weight, held[length]
            )
        return values
