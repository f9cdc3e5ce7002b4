"""N-gram Jaccard join by vertical partitioning.

The global n-gram order is cut into fragments. Every fragment counts, on its
own, the overlaps that fall into it; the partial counts are summed, first per
document and then per pair:

1. **Per document.** Each fragment finds the n-grams that occur in more than
   one document and counts them per document. A document can only link when
   75 % of its set is shared at all, so the sums leave few documents standing,
   and only their n-grams go on. N-grams travel here as 32 bits within their
   fragment; a clash can only let a document through, never lose one.
2. **Candidates.** The documents left order their n-grams by frequency, rarest
   first. Two sets that reach the threshold share one of the first
   ``n - ceil(0.75 n) + 1``; and the places where they first meet bound the
   overlap. First every document meets the smallest document of each of its
   posting lists only - linear in the postings, whatever the size of a group of
   copies. What links to one smallest document belongs together already; only
   others in a list are compared after that.
3. **Per pair.** Fragments of both sets are intersected separately and the
   counts summed per pair; the threshold is tested on the exact sum.

Equal sets are one node throughout. N-grams are 64-bit hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.skew import materialise
from . import textbytes as B
from .components import components
from .store import compact

#: Two sets link when ``100 * intersection >= THRESHOLD * union``.
THRESHOLD = 75
#: Fewest fragments of the document count; with more shuffle partitions there are as many.
FRAGMENTS = 64
#: Fragments of the pair count.
PAIR_FRAGMENTS = 8
#: Bits of the fixed-size filter that spares documents without partners a second hashing.
FILTER_BITS = 1 << 24


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in B.slices(batches, size=B.SMALL_SLICE):
        _, _, hashes, bounds = B.words(data, offsets, lower=True)
        sets = B.shingle_sets(hashes, bounds)
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        one = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
        two = np.array([(s * (s >> np.uint64(7) | np.uint64(1))).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(sizes), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))],
            names=["doc_id", "n", "sig_a", "sig_b"],
        )


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n, sig_a, sig_b) per row: size and order-free hash of its shingle set."""
    return docs.select("doc_id", "text").mapInArrow(_signatures, "doc_id bigint, n bigint, sig_a bigint, sig_b bigint")


def _fragment_rows(fragments: int):
    """Per slice and fragment one row: documents, their counts and 32 bits of each n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in B.slices(batches, size=B.SMALL_SLICE):
            _, _, hashes, bounds = B.words(data, offsets, lower=True)
            sets = B.shingle_sets(hashes, bounds)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            if not sizes.sum():
                continue
            grams = np.concatenate(sets)
            part = ((grams >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.uint16)
            owner = np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(part, kind="stable")
            part, owner, low = part[order], owner[order], grams[order].astype(np.uint32)
            segment = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])))
            counts = np.diff(np.append(segment, len(part))).astype(np.int32)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)[owner[segment]]
            which = part[segment]
            first = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
            rows = np.append(first, len(which))
            ends = np.append(segment, len(part))[rows] * 4
            yield pa.record_batch(
                [
                    pa.array(which[first].astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(ids)),
                    pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(counts)),
                    pa.Array.from_buffers(
                        pa.binary(), len(first), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(low)]
                    ),
                ],
                names=["fragment", "docs", "counts", "grams"],
            )

    return run


def _shared_counts(table: pa.Table) -> pa.Table:
    """Within one fragment: how many n-grams of each document also occur in another."""
    docs = np.concatenate([c.flatten().to_numpy() for c in table.column("docs").chunks])
    counts = np.concatenate([c.flatten().to_numpy() for c in table.column("counts").chunks])
    grams = np.frombuffer(b"".join(table.column("grams").to_pylist()), np.uint32)
    order = np.argsort(grams)
    ordered = grams[order]
    same = ordered[1:] == ordered[:-1]
    shared = np.zeros(len(grams), dtype=np.int64)
    shared[order[1:][same]] = 1
    shared[order[:-1][same]] = 1
    total = np.add.reduceat(shared, np.cumsum(counts) - counts)
    seen = total > 0
    return pa.table({"doc_id": docs[seen], "shared": total[seen]})


def _may_link(docs: DataFrame, known: DataFrame, fragments: int) -> DataFrame:
    """(doc_id, n, sig_a, sig_b) of the distinct sets of which enough is shared."""
    packed = docs.select("doc_id", "text").mapInArrow(
        _fragment_rows(fragments), "fragment int, docs array<bigint>, counts array<int>, grams binary"
    )
    partial = packed.repartition(fragments, "fragment").groupBy("fragment").applyInArrow(
        _shared_counts, "doc_id bigint, shared bigint"
    )
    shared = partial.groupBy("doc_id").agg(F.sum("shared").alias("shared"))
    alive = known.join(shared, "doc_id").where(F.col("shared") * 100 >= F.col("n") * THRESHOLD)
    return alive.groupBy("n", "sig_a", "sig_b").agg(F.min("doc_id").alias("doc_id"))


def _filter_position() -> F.Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))


def _member_filter(alive: DataFrame) -> np.ndarray:
    """A bit per hashed doc_id; its size does not depend on the data."""
    rows = (  # Spark's bitmap buckets count from 1
        alive.select((_filter_position() + 1).alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in rows:
        part = np.frombuffer(bytes(row["bits"]), np.uint8)
        start = (row["bucket"] - 1) * 4096
        bits[start:start + len(part)] = part
    return bits


def _filtered(bits, inside: bool):
    """Rows whose position ``__at`` is set in the filter, or those whose isn't."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member = np.unpackbits(bits.value, bitorder="little").astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(member[batch.column("__at").to_numpy()] == inside))

    return run


def _whole_sets(bits):
    chosen = _filtered(bits, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in B.slices(chosen(batches), size=B.SMALL_SLICE):
            _, _, hashes, bounds = B.words(data, offsets, lower=True)
            sets = B.shingle_sets(hashes, bounds)
            one = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
            edges = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32)
            grams = pa.array(np.concatenate(sets).view(np.int64))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(one.view(np.int64)), pa.ListArray.from_arrays(pa.array(edges), grams)],
                names=["doc_id", "sig_a", "grams"],
            )

    return run


def _sets(docs: DataFrame, alive: DataFrame) -> DataFrame:
    """(doc_id, n, grams) of the documents in ``alive``."""
    bits = docs.sparkSession.sparkContext.broadcast(_member_filter(alive))
    rows = docs.select("doc_id", "text", _filter_position().alias("__at")).where("doc_id is not null").mapInArrow(
        _whole_sets(bits), "doc_id bigint, sig_a bigint, grams array<bigint>"
    )
    return rows.join(alive.select("doc_id", "sig_a", "n"), ["doc_id", "sig_a"]).dropDuplicates(["doc_id", "sig_a"]).drop("sig_a")


def _prefixes(sets: DataFrame) -> DataFrame:
    """(gram, doc_id, n, place): the n-grams by which a set can be found, with
    their place in the set's rarest-first order. N-grams of one set only come
    first and take up places, but nothing can be found by them."""
    grams = sets.select("doc_id", "n", F.explode("grams").alias("gram"))
    frequent = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = grams.join(frequent, "gram")
    own = Window.partitionBy("doc_id")
    placed = shared.withColumn("place", F.row_number().over(own.orderBy("df", "gram")) - 1).withColumn(
        "place", F.col("place") + F.col("n") - F.count(F.lit(1)).over(own)
    )
    needed = F.ceil(F.col("n") * THRESHOLD / 100)
    return placed.where(F.col("place") <= F.col("n") - needed).select("gram", "doc_id", "n", "place")


def _may_reach(left: str, right: str) -> str:
    """Sets that first meet at these places can still reach the threshold."""
    both = f"{THRESHOLD} * ({left}.n + {right}.n)"
    return (
        f"{100 + THRESHOLD} * ({left}.n - {left}.place) >= {both} and {100 + THRESHOLD} * ({right}.n - {right}.place) >= {both}"
    )


def _verify(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that reach the threshold: partial overlaps per
    fragment, summed per pair."""
    left = segments.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), "part", F.col("grams").alias("grams_a"))
    right = segments.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), "part", F.col("grams").alias("grams_b"))
    partial = (
        pairs.join(left, "a").join(right, ["b", "part"])
        .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).alias("overlap"))
    )
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    return total.where(
        F.col("overlap") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * THRESHOLD
    ).select("a", "b")


def _segments(sets: DataFrame) -> DataFrame:
    """(doc_id, n, part, grams): the sets cut into fragments, empty ones left out."""
    def fragment(part: int) -> F.Column:
        return F.filter("grams", lambda gram: F.pmod(gram, F.lit(PAIR_FRAGMENTS)) == part)

    cut = sets.select("doc_id", "n", F.posexplode(F.array(*map(fragment, range(PAIR_FRAGMENTS)))).alias("part", "grams"))
    return cut.where(F.size("grams") > 0)


def _links(sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect what is connected: star links first, then every
    link between documents that these do not tie to the same one."""
    postings = compact(_prefixes(sets), "postings")
    segments = materialise(_segments(sets), "segments")
    heads = postings.groupBy("gram").agg(F.min(F.struct("doc_id", "n", "place")).alias("head"), F.count(F.lit(1)).alias("size"))
    heads = heads.where("size > 1").select("gram", "head.*")
    star = postings.alias("l").join(heads.alias("r"), "gram").where("l.doc_id <> r.doc_id").where(_may_reach("l", "r"))
    stars = star.select(F.col("l.doc_id").alias("a"), F.col("r.doc_id").alias("b")).distinct()
    linked = compact(_verify(stars, segments), "links")

    # What links to the same smallest document needs no further comparing.
    low = linked.groupBy(F.col("a").alias("doc_id")).agg(F.min("b").alias("low"))
    placed = postings.join(low, "doc_id", "left").withColumn("component", F.least("doc_id", "low"))
    placed = placed.drop("low")
    members = placed.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("members"))
    mixed = members.groupBy("gram").agg(F.max(F.struct("members", "component"))["component"].alias("main"), F.count(F.lit(1)).alias("parts"))
    mixed = mixed.where("parts > 1").select("gram", "main")
    held = placed.join(mixed, "gram")
    others = held.where("component <> main")
    # A pair within the lesser components comes up once, by its order; one with the main component once, from the lesser side.
    cross = others.alias("l").join(placed.alias("r"), "gram").where(
        "l.component <> r.component and (r.component = l.main or l.component < r.component)"
    ).where(_may_reach("l", "r"))
    pairs = cross.select(F.col("l.doc_id").alias("a"), F.col("r.doc_id").alias("b")).distinct()
    return linked.unionByName(_verify(pairs, segments))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Every row's shingle count and near-duplicate component.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Returns
    ``doc_id, n_shingles, component_id``, one row per row of ``docs``:
    ``component_id`` is the smallest doc_id reachable by links. A document
    without words, or NULL text, has no shingles and is linked with nothing. A
    row without doc_id takes part in no links and has no component. Rows that
    repeat a doc_id are one document; if their texts differ, its links are
    those of all its texts. An empty table gives no rows.
    """
    known = materialise(signatures(docs), "sizes")
    return known.join(_components(docs, known), "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def _components(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, component) of the documents that are linked with any other."""
    fragments = max(FRAGMENTS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    identified = known.where("doc_id is not null and n > 0")
    alive = compact(_may_link(docs.where("doc_id is not null"), identified, fragments), "alive")
    sets = materialise(_sets(docs, alive), "sets")
    # Equal sets first: one node per set, tied to its smallest doc_id.
    nodes = identified.groupBy("n", "sig_a", "sig_b").agg(F.min("doc_id").alias("node"))
    tied = identified.join(nodes, ["n", "sig_a", "sig_b"]).where("doc_id <> node")
    edges = _links(sets).unionByName(tied.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct())
    return components(edges).withColumnRenamed("node", "doc_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` less those whose document is linked with one of a
    smaller doc_id. Rows that repeat in full are one document and leave one row;
    rows without doc_id stay."""
    known = materialise(signatures(docs), "sizes")
    parts = _components(docs, known)
    later = materialise(parts.where("component <> doc_id").select("doc_id"), "later")
    # Most rows miss the filter and stay without being shuffled; the others are looked up.
    bits = docs.sparkSession.sparkContext.broadcast(_member_filter(later))
    marked = docs.select(F.struct("*").alias("row"), F.coalesce(_filter_position(), F.lit(0)).alias("__at"))
    stay, ask = (marked.mapInArrow(_filtered(bits, inside), marked.schema).select("row.*") for inside in (False, True))
    kept = stay.unionByName(ask.join(later.hint("merge"), "doc_id", "left_anti").select(docs.columns))
    repeated = known.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_semi").select(docs.columns).dropDuplicates()
    return kept.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(once)
