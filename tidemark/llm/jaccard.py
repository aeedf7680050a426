"""N-gram Jaccard join: documents whose shingle sets have a similarity of s (0.9) or more.

The overlaps of all pairs are the product of the document by shingle incidence matrix with
its transpose. Spark takes it in blocks of columns, the hash partitions by shingle:

* Equal rows are merged: documents of one set are one node.
* Of a row of n shingles only the first n - ceil(s n) + 1 in one common order, rare ones
  first, are multiplied. Rows that are similar enough share one of those.
* A column gives the products of its nodes, which meet by pair over all blocks. Where two
  rows share the column before, too, the product is left out: the pair has one there.
  Two rows of n and m shingles are similar enough if they share a = ceil(s (n + m) / (1 + s)),
  so they have one of their first n - a + 1 and m - a + 1 in common; other products, and
  those of sizes too far apart, are not made.
* Each row has a sketch: the parity of its shingles in each of SKETCH_BITS slots. Sketches
  differ in no more slots than rows differ in shingles, so pairs whose sketches differ in
  more than n + m - 2 a are discarded. Pairs of long rows are tested again with sketches of
  as many slots as the rows have shingles. The rest is compared in full.

Only components are asked for, so a column need not be multiplied out where its nodes are
known to be connected. Star rounds multiply each column's first node with the others
alone and merge what they link; then the products between different components, which is
what is left of a large group of near copies, are made without exception.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import enter, small_batches, staged, trim
from tidemark.llm.components import components
from tidemark.llm.shingles import portions, shingle_sets, slots, word_hashes

#: Words of a shingle, and the similarity of a link in percent, unless told otherwise.
WIDTH, PERCENT = 3, 90
SKETCH_BITS = 512
#: Keys whose texts are wanted are marked in so many slots (as a power of two): 1 MiB.
MARK_BITS = 23
#: Bytes of text that a task works on at a time.
SLICE = 4_000_000
#: Words are counted in so many slots (as a power of two), to order columns by rarity.
SLOT_BITS = 22
BLOCK_BITS = 16
#: Star rounds end when so many products per entry of the multiplied matrix are left.
PRODUCTS_PER_ENTRY = 3
#: A further round needs to have this share of the products gone in the one before.
GAIN = 0.5


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [text or "" for text in batch.column("text").to_pylist()]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to rows of about SLICE bytes of text, so that no task holds more than the
    shingles of those."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(False)
        part = np.cumsum(sizes, dtype=np.int64) // SLICE
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(start, end - start)


def _least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` must share with any set it is linked to."""
    return -(-percent * n // 100)


def word_levels(docs: DataFrame) -> np.ndarray:
    """How common the words of each slot are, on a scale of half powers of two.

    A shingle is at most as common as its rarest word, whose level is the shingle's place in
    the common order. One byte a slot, 4 MiB whatever the corpus: words that share a slot
    make each other look more common, which costs time but no link. Tasks count their own
    words; counts are added up by blocks of slots, a row at a time.
    """
    size, block = 1 << SLOT_BITS, 1 << BLOCK_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("jaccard")
        total = np.zeros(size, np.uint32)
        for batch in _slices(batches):
            for some in portions(_texts(batch)):
                at = slots(word_hashes(some)[0], total)
                found, n = np.unique(at, return_counts=True)
                total[found] += n.astype(np.uint32)
        for number, part in enumerate(total.reshape(-1, block)):
            if part.any():
                yield pa.record_batch(
                    [pa.array([number], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                    names=["block", "counts"],
                )
        del total
        trim()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(raw, np.uint32)
                sums[number] = sums[number] + part if number in sums else part.astype(np.uint64)
        levels = [(2 * np.log2(total + 1)).astype(np.uint8) for total in sums.values()]
        yield pa.record_batch(
            [
                pa.array(list(sums), pa.int32()),
                pa.array([level.tobytes() for level in levels], pa.binary()),
            ],
            names=["block", "levels"],
        )

    partial = docs.select("text").mapInArrow(count, "block int, counts binary")
    whole = partial.repartition("block").mapInArrow(add, "block int, levels binary")
    levels = np.zeros(size, np.uint8)
    for row in whole.collect():
        at = row["block"] * block
        levels[at : at + block] = np.frombuffer(row["levels"], np.uint8)
    return levels


def rows_of(docs: DataFrame, width: int, levels: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """Each document's row: ``key``, ``tag``, ``n``, ``digest`` of its set, the shingles of it
    that are multiplied, in order (``prefix``), its ``sketch``, and its ``wide`` sketch if it
    has more than SKETCH_BITS shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("jaccard")
        levels = shared.value
        for batch in _slices(batches):
            sizes, digests, prefixes, sketches, wide = [], [], [], [], []
            for found, level in shingle_sets(_texts(batch), width, levels):
                n = len(found)
                sizes.append(n)
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                sketches.append(_sketch(found))
                # The next power of two: a smaller sketch is the larger one folded.
                wide.append(_sketch(found, 1 << (n - 1).bit_length()) if n > SKETCH_BITS else None)
                least = _least_overlap(n, percent)
                if least == n:  # only an equal set, or one of n + 1, could be near
                    length = int(100 * n >= percent * (n + 1))
                else:
                    length = min(n - least + 1, n)
                order = np.lexsort((found, level))[:length]
                prefixes.append(found[order].view(np.int64))
            ends = np.cumsum([0, *map(len, prefixes)])
            flat = np.concatenate([np.zeros(0, np.int64), *prefixes])
            yield pa.record_batch(
                [
                    batch.column("key"),
                    batch.column("tag"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                    pa.array(sketches, pa.list_(pa.int64())),
                    pa.array(wide, pa.list_(pa.int64())),
                ],
                names=["key", "tag", "n", "digest", "prefix", "sketch", "wide"],
            )
            del prefixes, sketches, wide, flat
        trim()

    return docs.select("key", F.md5("text").alias("tag"), "text").mapInArrow(
        read,
        "key long, tag string, n long, digest binary, prefix array<long>, sketch array<long>, "
        "wide array<long>",
    )


def _sketch(found: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    slot = found & np.uint64(bits - 1)
    odd = np.bincount(slot.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """``digest`` and all shingles (``shingles``) of each document's set."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("jaccard")
        for batch in _slices(batches):
            digests, sets = [], []
            for found, _ in shingle_sets(_texts(batch), width):
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                sets.append(found.view(np.int64))
            ends = np.cumsum([0, *map(len, sets)])
            flat = np.concatenate([np.zeros(0, np.int64), *sets])
            yield pa.record_batch(
                [
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                ],
                names=["digest", "shingles"],
            )
            del sets, flat
        trim()

    return docs.select("text").mapInArrow(read, "digest binary, shingles array<long>")


def _spare(own: Column, other: Column, percent: int) -> Column:
    """Shingles of a set of size ``own`` that a linked set of size ``other`` may lack."""
    above = (own + other) * percent + 99 + percent
    return own - (above - above % (100 + percent)) / (100 + percent)


def _possible(left: str, right: str, percent: int) -> Column:
    """Whether sizes, the places of a shared shingle, and sketches allow a link."""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    sizes = (n * 100 >= m * percent) & (m * 100 >= n * percent)
    spare = _spare(n, m, percent), _spare(m, n, percent)
    first = F.col(f"{left}.place") <= spare[0]
    second = F.col(f"{right}.place") <= spare[1]
    x, y = F.col(f"{left}.sketch"), F.col(f"{right}.sketch")
    differ = F.lit(0)
    for word in range(SKETCH_BITS // 64):
        both = F.get(x, F.lit(word)).bitwiseXOR(F.get(y, F.lit(word)))
        differ = differ + F.bit_count(both)
    return sizes & first & second & (differ <= spare[0] + spare[1])


def _folded(sketch: Column, words: Column) -> Column:
    """A wide sketch of ``words`` or twice as many, as it would be with ``words``."""
    halves = F.slice(sketch, 1, words), F.slice(sketch, words + 1, words)
    folded = F.zip_with(*halves, lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(sketch) > words, folded).otherwise(sketch)


def _may_link(left: str, right: str, percent: int) -> Column:
    """Whether wide sketches allow a link; without two of nearly one size, they do."""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    x, y = F.col(f"{left}.wide"), F.col(f"{right}.wide")
    words = F.least(F.size(x), F.size(y))
    bits = F.zip_with(
        _folded(x, words), _folded(y, words), lambda u, v: F.bit_count(u.bitwiseXOR(v))
    )
    differ = F.aggregate(bits, F.lit(0), lambda total, some: total + some)
    near = F.greatest(F.size(x), F.size(y)) <= 2 * words
    spare = _spare(n, m, percent) + _spare(m, n, percent)
    return F.when(x.isNotNull() & y.isNotNull() & near, differ <= spare).otherwise(F.lit(True))


def _parted(docs: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose ``key`` may be in ``keys`` (one column), and the others, whose
    key is not: the former alone need to meet ``keys``, so that other texts are not shuffled.

    The slots of the keys are marked in a bitmap of one size that is broadcast; keys that
    share a slot with one of ``keys`` are among the former, which costs time alone.
    """

    def slot(of: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(of), 64 - MARK_BITS)

    of = keys.select(slot(F.col(keys.columns[0])).alias("slot"))
    marks = of.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    marks = staged(docs.sparkSession, marks, "jaccard-marks")
    own = slot(key)
    place = F.bitmap_bit_position(own)
    rows = docs.select(
        F.struct("*").alias("doc"),
        F.bitmap_bucket_number(own).alias("bucket"),
        (place / 8 + 1).cast("int").alias("byte"),
        F.pow(F.lit(2), place % 8).cast("int").alias("bit"),
    ).join(F.broadcast(marks), "bucket", "left")
    byte = F.conv(F.hex(F.substring("bits", F.col("byte"), F.lit(1))), 16, 10).cast("int")
    marked = F.coalesce(byte.bitwiseAND(F.col("bit")) > 0, F.lit(False))
    return rows.where(marked).select("doc.*"), rows.where(~marked).select("doc.*")


def _mixed(entries: DataFrame, name: str) -> DataFrame:
    """Entries of the columns that have more than one value of ``name``."""
    own = Window.partitionBy("column")
    ends = {"first": F.min(name).over(own), "last": F.max(name).over(own)}
    return entries.withColumns(ends).where("first < last").drop("first", "last")


class _Join:
    """The columns with several nodes, and what is known about their components."""

    def __init__(self, docs: DataFrame, width: int, classes: DataFrame, percent: int):
        self.spark, self.docs, self.width, self.classes = docs.sparkSession, docs, width, classes
        self.percent = percent
        entries = classes.where(F.size("prefix") > 0).select(
            "node", F.posexplode("prefix").alias("place", "column")
        )
        each = _mixed(entries, "node").groupBy("node")
        shared = each.agg(F.sort_array(F.collect_list(F.struct("place", "column"))).alias("columns"))
        sketched = shared.join(classes.select("node", "n", "sketch"), "node")
        self.nodes = staged(self.spark, sketched, "jaccard-nodes")
        self.links: DataFrame | None = None
        self.roots: DataFrame | None = None

    def sets_of(self, pairs: DataFrame) -> DataFrame:
        """Full rows of the nodes in ``pairs``, read again from their texts."""
        nodes = pairs.select("a").union(pairs.select("b")).distinct().toDF("node")
        held = self.classes.select("node", "digest", F.col("key").alias("holder"))
        wanted = staged(self.spark, held.join(nodes, "node"), "jaccard-wanted")
        docs, _ = _parted(self.docs, F.col("key"), wanted.select("holder"))
        holders = docs.join(wanted, docs["key"].eqNullSafe(wanted["holder"]), "left_semi")
        found = full_sets(holders, self.width).join(wanted.select("digest", "node"), "digest")
        once = found.groupBy("digest").agg(
            F.any_value("node").alias("node"), F.any_value("shingles").alias("shingles")
        )
        return staged(self.spark, once.select("node", "shingles"), "jaccard-sets")

    def labelled(self) -> DataFrame:
        """All entries, with the ``root`` of their node. Roots meet nodes, not entries."""
        nodes = self.nodes
        if self.roots is not None:
            nodes = nodes.join(self.roots, "node", "left")
        root = F.col("node") if self.roots is None else F.coalesce("root", "node")
        columns = F.transform(
            "columns",
            lambda entry, at: F.struct(
                entry["place"].alias("place"),
                entry["column"].alias("column"),
                F.get("columns", at - 1)["column"].alias("previous"),
            ),
        )
        return nodes.select("node", "n", root.alias("root"), "sketch", F.inline(columns))

    def near(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` without those that the wide sketches of their nodes rule out."""
        wide = self.classes.where("wide IS NOT NULL").select("node", F.struct("n", "wide"))
        left, right = wide.toDF("a", "x"), wide.toDF("b", "y")
        both = pairs.join(left, "a", "left").join(right, "b", "left")
        return both.where(_may_link("x", "y", self.percent)).select("a", "b")

    def add(self, pairs: DataFrame) -> int:
        """Compares ``pairs`` (a, b), keeps those that are linked, renews the roots."""
        pairs = staged(self.spark, self.near(pairs), "jaccard-pairs")
        sets = self.sets_of(pairs)
        both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
        common = F.size(F.array_intersect("x", "y"))
        union = F.size("x") + F.size("y") - F.col("common")
        linked = both.withColumn("common", common).where(100 * F.col("common") >= self.percent * union)
        linked = staged(self.spark, linked.select("a", "b"), "jaccard-links")
        found = linked.count()
        if found:
            self.links = linked if self.links is None else self.links.unionByName(linked)
            self.roots = components(self.links)
        return found


def _products(entries: DataFrame, percent: int) -> int:
    """About how many products multiplying out between components would make: those of
    entries that count for a set of the same size."""
    counting = entries.where(F.col("place") <= _spare(F.col("n"), F.col("n"), percent))
    each = counting.groupBy("column", "root").agg(F.count("*").alias("n"))
    columns = each.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within")
    )
    return columns.agg(F.sum((F.col("n") * F.col("n") - F.col("within")) / 2)).first()[0] or 0


def _star_pairs(entries: DataFrame, number: int, percent: int) -> DataFrame:
    """Each column's first node with all others of other components. First comes the node in
    which the column stands foremost, that is the one with the fewest shingles of its own;
    later rounds have an order of their own each."""
    turn = F.xxhash64("node", F.lit(number)) if number else F.col("place")
    first = F.min(F.struct(turn.alias("turn"), "node", "n", "place", "root", "sketch"))
    hub = first.over(Window.partitionBy("column"))
    own = F.struct("node", "n", "place", "root", "sketch")
    return (
        entries.select(own.alias("m"), hub.alias("h"))
        .where((F.col("m.root") != F.col("h.root")) & _possible("m", "h", percent))
        .groupBy(
            F.least("m.node", "h.node").alias("a"), F.greatest("m.node", "h.node").alias("b")
        )
        .agg(F.count("*").alias("products"))
        .select("a", "b")
    )


def _all_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """The pairs that the products between different components are of. Columns of one
    component are left out before they meet themselves."""
    open_ = _mixed(entries, "root")
    again = F.coalesce(F.col("l.previous") == F.col("r.previous"), F.lit(False))
    return (
        open_.alias("l")
        .join(open_.alias("r"), "column")
        .where(
            (F.col("l.node") < F.col("r.node"))
            & (F.col("l.root") != F.col("r.root"))
            & ~again
            & _possible("l", "r", percent)
        )
        .groupBy(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
        .agg(F.count("*").alias("products"))
        .select("a", "b")
    )


def jaccard_components(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """``key``, ``tag`` (hash of the text), ``n_shingles``, ``component_id`` (smallest key
    reachable by links, its own included) and ``component`` (a number of the component in
    this run; null without shingles) for every row of ``docs``. Links are similarities of
    ``percent`` or more between sets of shingles of ``width`` words. Keys are integers.

    Null and empty texts have no shingles and are linked with nothing, not even with each
    other: their component is their own key. Equal sets are linked at any size. Rows of one
    key are rows of their own with their own links. Null keys never name a component that has
    another key. Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    read = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    rows = staged(spark, rows_of(read, width, word_levels(read), percent), "jaccard-rows")
    classes = (
        rows.where("n > 0")
        .groupBy("digest")
        .agg(
            F.min("key").alias("key"),
            F.any_value("n").alias("n"),
            F.any_value("prefix").alias("prefix"),
            F.any_value("sketch").alias("sketch"),
            F.any_value("wide").alias("wide"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = staged(spark, classes, "jaccard-classes")
    join = _Join(read, width, classes, percent)
    limit = PRODUCTS_PER_ENTRY * (join.nodes.agg(F.sum(F.size("columns"))).first()[0] or 0)
    entries, number = join.labelled(), 0
    products = _products(entries, percent)
    while products > limit:
        join.add(_star_pairs(entries, number, percent))
        entries, number, before = join.labelled(), number + 1, products
        products = _products(entries, percent)
        if products > GAIN * before:
            break
    join.add(_all_pairs(entries, percent))

    named = classes.select("node", "digest", "key")
    if join.roots is not None:
        named = named.join(join.roots, "node", "left")
        named = named.withColumn("root", F.coalesce("root", "node"))
    else:
        named = named.withColumn("root", F.col("node"))
    named = staged(spark, named, "jaccard-named")
    smallest = named.groupBy("root").agg(F.min("key").alias("component_id"))
    labels = named.join(smallest, "root").select("digest", "component_id", "root")
    return rows.join(labels, "digest", "left").select(
        "key",
        "tag",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("component_id")).alias(
            "component_id"
        ),
        F.col("root").alias("component"),
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without all but one row of each component: of those with the smallest key the
    one whose text hashes lowest. Rows without shingles stay."""
    spark = docs.sparkSession
    rows = staged(spark, jaccard_components(docs, key, text, **options), "jaccard-components")
    some = rows.where("n_shingles > 0")
    lead = F.struct(F.col("key").isNull(), "key", "tag")
    best = some.groupBy("component").agg(F.min(lead).alias("best"))
    best = staged(spark, best.select("best.key", "best.tag"), "jaccard-best")

    def same(left: DataFrame, right: DataFrame) -> Column:
        keys = left["key"].eqNullSafe(right["key"])
        return keys & left["tag"].eqNullSafe(right["tag"])

    held = some.groupBy("key", "tag").agg(F.count("*").alias("copies"))
    lost = staged(spark, held.join(best, same(held, best), "left_anti"), "jaccard-lost")
    doubtful, kept = _parted(docs, F.col(key).cast("long"), lost.select("key"))
    own = doubtful[key].cast("long"), F.md5(doubtful[text])
    kept = kept.unionByName(
        doubtful.join(
            lost, own[0].eqNullSafe(lost["key"]) & own[1].eqNullSafe(lost["tag"]), "left_anti"
        )
    )
    twice = held.where("copies > 1").join(best, same(held, best), "left_semi")
    twice = staged(spark, twice, "jaccard-twice")
    if twice.isEmpty():
        return kept
    # Whole rows that are repeated: one stays.
    own = kept[key].cast("long"), F.md5(kept[text])
    match = own[0].eqNullSafe(twice["key"]) & own[1].eqNullSafe(twice["tag"])
    single = kept.join(twice, match, "left_anti")
    repeated = kept.join(twice, match, "left_semi")
    first = repeated.groupBy(F.col(key), F.md5(text)).agg(F.first(F.struct("*")).alias("doc"))
    return single.unionByName(first.select("doc.*"))
