"""Benchmark decontamination with SimHash windows, in DataFrame functions only.

A benchmark item of n words is compared with windows of n words. Words are runs
of ASCII letters and digits or other characters beyond ASCII, lower-cased; a set
is the multiset of five-word shingles.

1. **Windows.** A window can only be similar to an item if it shares a shingle
   with it, and the best one can be moved right until it starts with a shared
   shingle (or ends with the text) without losing any. So one window per shared
   shingle and item length is enough, and no other is made. A text shorter than
   the item is one window.
2. **SimHash.** A bit of a window's fingerprint is the majority of that bit over
   its shingles' hashes, each counted as often as it occurs.
3. **Multi-index.** 64 bits are eight blocks. Two fingerprints within ``RADIUS``
   = 8 * (``FLIPS`` + 1) - 1 bits agree in some block but for ``FLIPS`` bits, so
   items are listed under every block value that near, and each window looks up
   its own eight: no fingerprint within the radius is missed.
4. **Verification.** Exact weighted Jaccard of the shingle multisets, 0.75 or more.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.skew import materialise

SHINGLE = 5
THRESHOLD = 75
BLOCKS, BLOCK_BITS = 8, 8
#: Bits that may differ within a block.
FLIPS = 2
RADIUS = BLOCKS * (FLIPS + 1) - 1
#: Most item shingles that are broadcast, 16 bytes each.
MOST_BROADCAST = 1 << 20
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KEY = ("doc_id", "text_hash")


def with_shingles(rows: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep``, n_words and shingles of ``text``. Fewer than five
    words are one shingle, no words (or NULL) none."""
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), _BREAK, " "))
    hashes = F.transform(F.filter(F.split(clean, " "), lambda w: w != ""), lambda w: F.xxhash64(w))
    # A generated column is worked out once; a projected one would be again for every element that refers to it.
    hashed = rows.select(*keep, F.explode(F.array(hashes)).alias("_hashes")).withColumn("n_words", F.size("_hashes"))

    def shingle(i: Column) -> Column:
        return F.xxhash64(*(F.get("_hashes", i + k) for k in range(SHINGLE)))

    long = F.transform(F.sequence(F.lit(0), F.col("n_words") - SHINGLE), shingle)
    short = F.array(F.xxhash64("_hashes", "n_words"))
    shingles = F.when(F.col("n_words") >= SHINGLE, long).when(F.col("n_words") > 0, short).otherwise(F.array().cast("array<bigint>"))
    return hashed.select(*keep, "n_words", F.explode(F.array(shingles)).alias("shingles"))


def fingerprints(windows: DataFrame, key: list[str], shingles: str = "shingles") -> DataFrame:
    """(key, total, fingerprint): SimHash of the shingle multisets, one per key.

    Counts of two bits share a sum, 32 bits each; rows of a key are combined
    where they are before anything is shuffled.
    """
    rows = windows.select(*key, F.explode(shingles).alias("g"))

    def pair(bit: int) -> Column:
        low = F.shiftright("g", bit).bitwiseAND(F.lit(1).cast("long"))
        high = F.shiftright("g", bit + 32).bitwiseAND(F.lit(1).cast("long"))
        return F.sum(low + F.shiftleft(high, 32)).alias(f"_b{bit}")

    sums = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("total"), *map(pair, range(32)))

    def bits(bit: int) -> list[Column]:
        low = F.col(f"_b{bit}").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
        high = F.shiftright(f"_b{bit}", 32)
        one = F.lit(1).cast("long")
        return [
            F.when(low * 2 > F.col("total"), F.shiftleft(one, bit)).otherwise(F.lit(0).cast("long")),
            F.when(high * 2 > F.col("total"), F.shiftleft(one, bit + 32)).otherwise(F.lit(0).cast("long")),
        ]

    every = [c for bit in range(32) for c in bits(bit)]
    return sums.select(*key, "total", reduce(Column.bitwiseOR, every).alias("fingerprint"))


def _blocks(fingerprint: Column) -> Column:
    mask = F.lit((1 << BLOCK_BITS) - 1).cast("long")
    return F.array(*(F.shiftright(fingerprint, BLOCK_BITS * b).bitwiseAND(mask) for b in range(BLOCKS)))


def near(windows: DataFrame, items: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs of ``windows`` and ``items`` of equal ``n_words`` whose fingerprints
    differ in at most ``radius`` bits, with ``distance``.

    ``radius`` must not exceed ``RADIUS``, up to which the blocks find everything.
    Both have columns n_words and fingerprint; items also item_id.
    """
    if radius > RADIUS:
        raise ValueError(f"the blocks guarantee a radius of {RADIUS}, not {radius}")
    flips = [m for m in range(1 << BLOCK_BITS) if m.bit_count() <= FLIPS]
    listed = items.select(
        "item_id", F.col("n_words").alias("_n"), F.col("fingerprint").alias("_print"), F.posexplode(_blocks(F.col("fingerprint"))).alias("_block", "_near")
    )
    listed = listed.select("item_id", "_n", "_print", "_block", F.explode(F.array(*(F.col("_near").bitwiseXOR(F.lit(m).cast("long")) for m in flips))).alias("_value"))
    looked = windows.select("*", F.posexplode(_blocks(F.col("fingerprint"))).alias("block", "value"))
    same = (F.col("n_words") == F.col("_n")) & (F.col("block") == F.col("_block")) & (F.col("value") == F.col("_value"))
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("_print")))
    # A pair may meet in several blocks: the first in which it does stands for all.
    earlier = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("_print")).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long"))) <= FLIPS
    first = F.when(earlier, 0)
    for b in range(1, BLOCKS):
        part = F.shiftright(F.col("fingerprint").bitwiseXOR(F.col("_print")), BLOCK_BITS * b).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long"))
        first = first.when(F.bit_count(part) <= FLIPS, b)
    pairs = looked.join(listed, same & (distance <= radius) & (F.col("block") == first))
    return pairs.withColumn("distance", distance).drop("block", "value", "_n", "_print", "_block", "_value")


def _weights(windows: DataFrame, key: list[str], weight: str) -> DataFrame:
    return windows.select(*key, F.explode("shingles").alias("g")).groupBy(*key, "g").agg(F.count(F.lit(1)).alias(weight))


def _item_windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_hash, row, n_words, at, start_word, shingles): a window of
    ``n_words`` words for every shingle of a text, at ``at``, that an item of
    ``n_words`` words has. ``row`` tells repeated rows of a document apart.

    The items' shingles are broadcast if there are at most ``MOST_BROADCAST``;
    then windows are cut where the texts are read and no text is shuffled. More of
    them are joined by shingle, and the texts that met any are read again.
    """
    wanted = materialise(items.select(F.explode("shingles").alias("g"), "n_words").distinct(), "wanted")
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"))
    at_hand = wanted.count() <= MOST_BROADCAST
    texts = with_shingles(keyed, *_KEY, "row")
    held = [*_KEY, "row", F.col("n_words").alias("size"), *(["shingles"] if at_hand else [])]
    met = texts.select(*held, F.posexplode("shingles").alias("at", "g")).join(F.broadcast(wanted) if at_hand else wanted, "g")
    start = F.when(F.col("size") < F.col("n_words"), 0).otherwise(F.least(F.col("at"), F.col("size") - F.col("n_words")))
    starts = met.withColumn("start_word", start)
    window = F.slice("shingles", F.col("start_word") + 1, F.greatest(F.col("n_words") - (SHINGLE - 1), F.lit(1))).alias("shingles")
    if not at_hand:
        starts = materialise(starts.select(*_KEY, "n_words", "at", "start_word").distinct(), "starts")
        some = starts.select(*_KEY).distinct()
        again = keyed.join(some, reduce(Column.__and__, (keyed[k].eqNullSafe(some[k]) for k in _KEY)), "left_semi")
        cut = with_shingles(again.dropDuplicates(list(_KEY)), *_KEY).select(*(F.col(k).alias(f"_{k}") for k in _KEY), "shingles")
        same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in _KEY))
        starts = starts.withColumn("row", F.lit(0).cast("long")).join(cut, same)
    return materialise(starts.select(*_KEY, "row", "n_words", "at", "start_word", window), "windows")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Where items of ``benchmark`` (item_id, text) stand in ``docs`` (doc_id, text).

    One row per document and item: doc_id, text_hash, item_id, the best window
    (start_word, n_words), its similarity and the fingerprints' distance. Of
    equally similar windows the first is told. Texts and items without words match nothing;
    an item of fewer than five words only matches a text of the same words.
    Rows that repeat give one; NULL doc_id is reported as such. Empty tables
    give no rows.
    """
    items = materialise(with_shingles(benchmark.where("item_id is not null"), "item_id").where("n_words > 0"), "items")
    windows = _item_windows(docs, items)
    key = [*_KEY, "row", "n_words", "at", "start_word"]
    found = near(fingerprints(windows, key), fingerprints(items, ["item_id", "n_words"]).withColumnRenamed("total", "item_total"))
    found = materialise(found, "pairs")
    again = reduce(Column.__and__, (F.col(f"p.{k}").eqNullSafe(F.col(f"w.{k}")) for k in key))
    ours = _weights(windows.alias("w").join(found.select(*key).distinct().alias("p"), again, "left_semi"), key, "weight")
    theirs = _weights(items, ["item_id"], "item_weight")
    both = reduce(Column.__and__, (F.col(f"f.{k}").eqNullSafe(F.col(f"o.{k}")) for k in key))
    shared = (
        found.alias("f").join(ours.alias("o"), both)
        .select(*(F.col(f"f.{k}") for k in key), "f.item_id", "f.total", "f.distance", "o.g", "o.weight")
        .join(theirs, ["item_id", "g"])
        .groupBy(*key, "item_id", "distance", "total")
        .agg(F.sum(F.least("weight", "item_weight")).alias("shared"))
    )
    sizes = items.select("item_id", F.size("shingles").alias("item_total"))
    union = F.col("total") + F.col("item_total") - F.col("shared")
    similar = shared.join(sizes, "item_id").where(F.col("shared") * 100 >= union * THRESHOLD)
    best = Window.partitionBy(*_KEY, "item_id").orderBy(F.desc("similarity"), "start_word")
    told = similar.withColumn("similarity", F.col("shared") / union).withColumn("_rank", F.row_number().over(best))
    return told.where("_rank = 1").select(*_KEY, "item_id", "start_word", "n_words", "similarity", "distance")


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item stands."""
    found = materialise(leaks(docs, benchmark).select(*_KEY).distinct(), "leaks")
    same = docs["doc_id"].eqNullSafe(found["doc_id"]) & (F.xxhash64(docs["text"]) == found["text_hash"])
    return docs.join(found.hint("merge"), same, "left_anti")
