"""Benchmark passages in documents: a prefix-filtered set join of windows, verified word by word.

A window is thirteen consecutive words of an item, or a whole shorter item. Its shingles of three
words are ordered by how rare they are in the documents. As a window must occur whole, the rarest
shingle is the prefix that any document with the window has to share: only occurrences of that one
are joined. Its place in the window gives the only start the occurrence can have, which has to lie
inside the document; then the words at that place are compared with those of the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.arrays import once
from gaugeflow.session import write_out

#: Words in a window, and in a shingle.
WINDOW, SHINGLE = 13, 3
#: A document is contaminated if at least one in so many of its words is hit.
ONE_IN = 20
#: Bits of the set of shingles that every task tests first. More shingles than bits make the test
#: useless, never wrong.
SET_BITS = 1 << 18

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of ``text``, with A-Z in lower case; of a null text none."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def _shingles(words: str, size: int) -> str:
    """SQL of the hashes of all runs of ``size`` words, by start; of three if ``size`` is more."""
    hashes = f"transform({words}, w -> xxhash64(w))"
    for n in range(1, min(size, SHINGLE)):
        following = f"slice({words}, {n + 1}, size({words}))"
        hashes = f"zip_with({hashes}, {following}, (h, w) -> xxhash64(h, w))"
    return f"slice({hashes}, 1, greatest(size({words}) - {min(size, SHINGLE) - 1}, 0))"


def _windows(items: DataFrame) -> DataFrame:
    """``item_id`` and ``window``, the words of a window joined by spaces, without repetition."""
    rows = once(items.select("item_id", "text"), words=words_of(F.col("text")))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - WINDOW + 1, F.lit(1)))
    rows = rows.where(F.size("words") > 0).select("item_id", "words", F.explode(starts).alias("at"))
    window = F.array_join(F.expr(f"slice(words, at, {WINDOW})"), " ")
    return rows.select("item_id", window.alias("window")).distinct()


def _bit_set(shingles: DataFrame, bits: int) -> str:
    """SQL of a constant array with the bits of the hashes ``h``: of one size whatever their number."""
    rows = (
        shingles.select(F.expr(f"cast(h & {bits - 1}L AS int)").alias("p"))
        .groupBy(F.expr("p div 64").cast("int").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, p % 64))").alias("bits"))
    )
    full = ["0"] * (bits // 64)
    for row in rows.collect():  # a 64th of ``bits`` at most
        full[row["word"]] = str(row["bits"])
    return f"cast(split('{','.join(full)}', ',') AS array<bigint>)"


def _occurrences(docs: DataFrame, shingles: DataFrame, sizes: list[int], bits: int) -> DataFrame:
    """Where documents have a shingle of a window: ``key``, ``h``, ``at`` (from 1), ``n_words``."""
    held = _bit_set(shingles, bits)
    known = f"(shiftrightunsigned({held}[cast(shiftrightunsigned(x.h & {bits - 1}L, 6) AS int)], "
    known += "cast(x.h & 63L AS int)) & 1L) = 1L"
    rows = once(docs.select("key", "text"), words=words_of(F.col("text")))
    places = F.concat(
        *[
            F.expr(f"""filter(transform({_shingles("words", n)}, (h, i) ->
                              named_struct('h', h, 'at', i + 1)), x -> {known})""")
            for n in sizes
        ]
    )
    rows = rows.select("key", F.size("words").alias("n_words"), F.explode(places).alias("x"))
    rows = rows.select("key", "n_words", "x.h", "x.at")
    return rows.join(shingles.select("h").distinct(), "h", "left_semi")


def _covered(hits: str) -> Column:
    """Words inside the windows of the array ``hits``, sorted by start."""
    return F.expr(f"""aggregate({hits}, named_struct('n', 0L, 'to', 0),
        (s, x) -> named_struct(
            'n', s.n + greatest(0, x.start + x.m - 1 - greatest(s.to, x.start - 1)),
            'to', greatest(s.to, x.start + x.m - 1)),
        s -> s.n)""")


def find_windows(docs: DataFrame, items: DataFrame, set_bits: int = SET_BITS) -> DataFrame:
    """Windows of ``items`` in each row of ``docs``: ``key, doc_id, n_words, n_hit, hits``.

    ``hits`` has ``start`` (word, from 1), ``m`` (words) and ``window`` of every occurrence, by
    start. ``key`` is a hash of ``doc_id`` and ``text``; rows that share it by chance share
    candidates, which the comparison of words sorts out. Null texts have no words, items without
    words no windows; either table may be empty or repeat rows, and other columns are not read.
    """
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    source = source.withColumn("key", F.xxhash64("doc_id", "text"))
    windows = _windows(items).select("window").distinct()
    windows = windows.withColumn("words", F.split("window", " "))
    by_size = F.when(F.size("words") == 1, F.expr(_shingles("words", 1)))
    by_size = by_size.when(F.size("words") == 2, F.expr(_shingles("words", 2)))
    hashes = by_size.otherwise(F.expr(_shingles("words", SHINGLE)))
    shingles = write_out(
        windows.select(
            "window",
            F.size("words").alias("m"),
            F.size(hashes).alias("n_shingles"),
            F.posexplode(hashes).alias("off", "h"),
        ),
        "window-shingles",
    )
    # at most three sizes
    sizes = [r[0] for r in shingles.select(F.least("m", F.lit(SHINGLE))).distinct().collect()]
    found = _occurrences(source, shingles, sizes or [SHINGLE], set_bits)
    found = write_out(found, "shingle-occurrences")

    rarity = found.groupBy("h").agg(F.count("*").alias("n"))
    prefix = (
        shingles.join(rarity, "h")
        .groupBy("window", "m", "n_shingles")
        .agg(F.count("*").alias("present"), F.min(F.struct("n", "off", "h")).alias("rarest"))
        .where("present = n_shingles")
        .select("window", "m", "rarest.off", "rarest.h")
    )
    candidates = (
        found.join(prefix, "h")
        .select("key", "n_words", (F.col("at") - F.col("off")).alias("start"), "m", "window")
        .where("start >= 1 AND start + m - 1 <= n_words")
        .groupBy("key")
        .agg(F.sort_array(F.collect_set(F.struct("start", "m", "window"))).alias("candidates"))
    )
    rows = source.join(candidates, "key", "left")
    rows = once(rows, words=words_of(F.col("text")))
    hits = F.expr("""filter(coalesce(candidates, array()), c ->
        array_join(slice(words, c.start, c.m), ' ') = c.window)""")
    rows = once(rows.select("key", "doc_id", "words", "candidates"), hits=hits)
    return rows.select(
        "key",
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        _covered("hits").alias("n_hit"),
        "hits",
    )


def contamination(docs: DataFrame, items: DataFrame, set_bits: int = SET_BITS) -> DataFrame:
    """How much of every document lies in windows of ``items``, and of which.

    One row per row of ``docs``: ``key, doc_id, n_words, n_hit, n_items, item_ids`` (strings, in
    order), ``contaminated``. See :func:`find_windows` for nulls and repeated rows.
    """
    found = write_out(find_windows(docs, items, set_bits), "window-hits")
    windows = F.expr("array_distinct(transform(hits, x -> x.window))")
    item_ids = (
        found.where("n_hit > 0")
        .select("key", F.explode(windows).alias("window"))
        .distinct()
        .join(_windows(items), "window")
        .groupBy("key")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    rows = found.drop("hits").join(item_ids, "key", "left")
    none = F.array().cast("array<string>")
    rows = rows.withColumn("item_ids", F.coalesce("item_ids", none))
    return rows.select(
        "key",
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        "item_ids",
        F.expr(f"n_hit > 0 AND {ONE_IN} * n_hit >= n_words").alias("contaminated"),
    )
