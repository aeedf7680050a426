"""Benchmark decontamination as a prefix-filtered set join.

A benchmark item becomes windows of 13 words (a shorter item is one window), a
window becomes its shingles of 5 words. A document can hold a window only if it
holds every shingle, so one shingle is enough to find it: the prefix of a join for
full containment has length one. Shingles are ordered by rarity in the documents
and each window is joined on its rarest. The place of that shingle fixes where the
window would lie; bounds of the document rule out places, and the words there are
compared with the window's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, row_key, staged

WINDOW = 13
SHINGLE = 5
#: Documents are cut into pieces of so many words, so that no row holds a whole long text.
PIECE = 256
#: Words are runs of anything but the ASCII characters that are no lower-case letter or digit.
#: All those are spelled out: Java looks them up in a table, but tests ranges one by one.
NO_WORD = [c for c in range(0x80) if not (chr(c).islower() or chr(c).isdigit())]
WORD_CHARS = "[^" + "".join(f"\\x{c:02X}" for c in NO_WORD) + "]+"
#: The same words before A-Z is lower-cased.
RAW_WORD_CHARS = "[^" + "".join(f"\\x{c:02X}" for c in NO_WORD if not chr(c).isupper()) + "]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD_CHARS), F.lit(0))


def _shingle_key(words: Column, at: Column, length: int) -> Column:
    """Hash of ``length`` words from the 0-based place ``at``; hits are verified later."""
    return F.xxhash64(F.lit(length), *[F.get(words, at + n) for n in range(length)])


def _keys(words: Column, places: Column, length: int) -> Column:
    return F.transform(
        places,
        lambda at: F.struct(at.alias("at"), _shingle_key(words, at, length).alias("shingle")),
    )


def windows_of(items: DataFrame, item: str, text: str) -> DataFrame:
    """Every window of every item: ``item``, ``window`` (its words), ``window_key``."""
    read = items.select(F.col(item).cast("string").alias("item"), words_of(F.col(text)).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - WINDOW, F.lit(0)))
    cut = read.where(F.size("w") > 0).select("item", "w", F.explode(starts).alias("start"))
    return cut.select(
        "item", F.slice("w", F.col("start") + 1, WINDOW).alias("window")
    ).withColumn("window_key", F.md5(F.concat_ws(" ", "window")))


def window_shingles(windows: DataFrame) -> DataFrame:
    """The shingles of each distinct window: ``shingle`` at ``offset``."""
    short = F.least(F.size("window"), F.lit(SHINGLE))
    placed = windows.dropDuplicates(["window_key"]).select(
        "window_key",
        "window",
        short.alias("length"),
        F.explode(F.sequence(F.lit(0), F.size("window") - short)).alias("offset"),
    )
    keys = [
        F.when(F.col("length") == n, _shingle_key(F.col("window"), F.col("offset"), n))
        for n in range(1, SHINGLE + 1)
    ]
    return placed.withColumn("shingle", F.coalesce(*keys))


def shingle_hits(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """Where ``docs`` (row, text) hold one of ``shingles``: ``row``, ``shingle``, ``place``,
    the words around it (``near``, from word ``near_from`` on) and ``n_words``.

    Only hits leave the join; the words of a document are never shuffled.
    """
    lengths = sorted(r[0] for r in shingles.select("length").distinct().collect())  # 5 at most
    lengths = lengths or [SHINGLE]
    before = WINDOW - lengths[0]
    # explode_outer, because for explode Catalyst would filter by the size of the array
    # before it is made, and so make it, and what it is made of, several times over.
    read = docs.select("row", words_of(F.col("text")).alias("w"))
    piece_starts = F.when(
        F.size("w") > 0, F.sequence(F.lit(0), F.size("w") - 1, F.lit(PIECE))
    )
    pieces = (
        read.select(
            "row", "w", F.size("w").alias("n_words"), F.explode_outer(piece_starts).alias("start")
        )
        .withColumn("from", F.greatest(F.col("start") - before, F.lit(0)))
        .select(
            "row",
            "n_words",
            "start",
            "from",
            F.slice("w", F.col("from") + 1, PIECE + before + WINDOW).alias("near"),
        )
    )
    own = F.sequence(
        F.col("start") - F.col("from"),
        F.least(F.col("start") + PIECE, F.col("n_words")) - F.col("from") - 1,
    )
    keys = F.concat(*[_keys(F.col("near"), own, n) for n in lengths])
    keyed = pieces.select("row", "n_words", "from", "near", keys.alias("keys"))
    hits = keyed.select("row", "n_words", "from", "near", F.explode_outer("keys").alias("hit"))
    hits = hits.select("row", "n_words", "from", "near", "hit.at", "hit.shingle")
    wanted = shingles.groupBy("shingle").agg(F.max("length").alias("length"))
    wanted = staged(docs.sparkSession, wanted, "decontaminate-wanted")
    first = F.greatest(F.col("at") - (WINDOW - F.col("length")), F.lit(0))
    return hits.join(wanted, "shingle").select(
        "row",
        "shingle",
        "n_words",
        (F.col("from") + F.col("at")).alias("place"),
        (F.col("from") + first).alias("near_from"),
        F.slice("near", first + 1, F.lit(2 * WINDOW)).alias("near"),
    )


def occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Every place where a row of ``docs`` (row, text) holds a window: ``row``,
    ``window_key``, ``start``, ``length``, verified word for word."""
    spark = docs.sparkSession
    shingles = staged(spark, window_shingles(windows), "decontaminate-shingles")
    hits = staged(spark, shingle_hits(docs, shingles), "decontaminate-hits")
    rarity = hits.groupBy("shingle").agg(F.count("*").alias("found"))
    rarest = F.min(F.struct("found", "shingle", "offset", F.size("window"), "window"))
    prefix = (
        shingles.join(rarity, "shingle", "left")
        .withColumn("found", F.coalesce("found", F.lit(0)))
        .groupBy("window_key")
        .agg(rarest.alias("prefix"))
        .where("prefix.found > 0")
        .select(
            "window_key",
            "prefix.shingle",
            "prefix.offset",
            "prefix.window",
            F.size("prefix.window").alias("length"),
        )
    )
    prefix = staged(spark, prefix, "decontaminate-prefix")
    start = F.col("place") - F.col("offset")
    found = (
        hits.join(prefix, "shingle")
        .where((start >= 0) & (start + F.col("length") <= F.col("n_words")))
        .where(start >= F.col("near_from"))
        .where(
            F.slice("near", start - F.col("near_from") + 1, F.col("length")) == F.col("window")
        )
    )
    return found.select("row", "window_key", start.alias("start"), "length").distinct()


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    least_share: int = 20,
) -> DataFrame:
    """What each row of ``docs`` holds of the benchmark ``items``.

    Returns ``doc`` (the row as a struct), ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``n_items``, ``items`` (sorted ids), ``contaminated``
    (some hit, and ``least_share`` times the hits reach the words).

    Null and empty texts have no words and are clean; items without words have no
    window. Rows with equal key and text get equal results. Items that share an id
    count as one; an item without an id hits, and counts as the item with the empty
    id. Either table may be empty.
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("doc")).select(
        "doc",
        row_key(F.col(f"doc.{key}"), F.col(f"doc.{text}")).alias("row"),
        F.col(f"doc.{text}").alias("text"),
    )
    windows = staged(spark, windows_of(items, item, item_text), "decontaminate-windows")
    found = staged(spark, occurrences(rows, windows), "decontaminate-found")

    by_place = Window.partitionBy("row").orderBy("start")
    earlier_end = F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    spans = found.groupBy("row", "start").agg(
        F.max(F.col("start") + F.col("length")).alias("end")
    )
    new_words = F.greatest(
        F.col("end") - F.greatest("start", F.coalesce("earlier_end", F.lit(0))), F.lit(0)
    )
    hit = (
        spans.withColumn("earlier_end", earlier_end)
        .groupBy("row")
        .agg(F.sum(new_words).alias("n_hit"))
    )
    holders = windows.select("window_key", F.coalesce("item", F.lit("")).alias("item")).distinct()
    held = (
        found.select("row", "window_key")
        .distinct()
        .join(holders, "window_key")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    result = staged(spark, hit.join(held, "row"), "decontaminate-result")
    n_words = F.regexp_count(F.col("text"), F.lit(RAW_WORD_CHARS))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (
        rows.withColumn("n_words", F.coalesce(n_words, F.lit(0)).cast("long"))
        .drop("text")
        .join(result, "row", "left")
        .select(
            "doc",
            "n_words",
            n_hit.alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (n_hit * least_share >= F.col("n_words"))).alias("contaminated"),
        )
    )
