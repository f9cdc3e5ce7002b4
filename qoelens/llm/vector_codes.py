"""Codes for vectors: each of sixteen parts is replaced by the index of its nearest codebook entry.

Components are whole numbers, floor(256 x). In every pass a task takes a slice
of its vectors and, part by part, puts the distinct parts into lexicographic
order, which is the order of the leaves of a trie with one level per dimension.
Going through it depth first, the squared distances of a prefix to all entries
are added up once for all parts that share the prefix; at a leaf their least
is the part's entry, and the leaf counts as often as the part occurs. New
entries come from sums per entry, sixteen times sixty-four rows per task; the
vectors themselves are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_back, materialise

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components stay within this; beyond it a distance would not fit 64 bits.
MOST = 1 << 27
#: Vectors whose parts are put into one trie, and leaves that are worked out together.
SLICE, LEAVES = 1 << 15, 2048

_SUMS = "part int, entry int, n bigint, sums array<bigint>"


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & (F.size(vector) % PARTS == 0) & F.coalesce(finite, F.lit(False))


def whole(values: np.ndarray) -> np.ndarray:
    """floor(256 x), held within ``MOST``."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * SCALE), -MOST, MOST).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """About ``SLICE`` vectors at a time, with their components."""
    held: list[pa.RecordBatch] = []

    def out():
        table = pa.Table.from_batches(held)
        flat = pa.concat_arrays([c.flatten() for c in table.column("vector").chunks])
        return table, whole(flat.to_numpy(zero_copy_only=False)).reshape(-1, width)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= SLICE:
            yield out()
            held = []
    if held:
        yield out()


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct parts in lexicographic order, how often each occurs, which one each row is)."""
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    new = np.ones(len(parts), dtype=bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    which = np.empty(len(parts), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return ordered[new], np.diff(np.append(np.flatnonzero(new), len(parts))), which


def nearest(leaves: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each of the sorted distinct ``leaves``; ties go to the lower entry.

    Depth first over the trie, in blocks of neighbouring leaves: ``open_`` keeps,
    per level, the distances of the prefix on the path to the last leaf, which the
    next block goes on from. In a block every prefix is added up once.
    """
    n, depth = leaves.shape
    begins = np.ones((depth, n), dtype=bool)
    for level in range(depth):
        begins[level, 1:] = leaves[1:, level] != leaves[:-1, level]
        if level:
            begins[level] |= begins[level - 1]
    entry, distance = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    open_: list[np.ndarray | None] = [None] * depth
    for first in range(0, n, LEAVES):
        last = min(first + LEAVES, n)
        above, above_of = np.zeros((1, len(entries)), dtype=np.int64), np.zeros(last - first, dtype=np.int64)
        for level in range(depth):
            starts = begins[level, first:last].copy()
            goes_on = not starts[0]
            starts[0] = True
            at = np.flatnonzero(starts)
            sums = above[above_of[at]] + (leaves[first + at, level][:, None] - entries[:, level][None, :]) ** 2
            if goes_on:  # the path to this prefix is open since the block before
                sums[0] = open_[level]
            above, above_of = sums, np.cumsum(starts) - 1
            open_[level] = sums[-1]
        best = above.argmin(axis=1)
        entry[first:last] = best[above_of]
        distance[first:last] = above[np.arange(len(above)), best][above_of]
    return entry, distance


def _sums(codebooks: np.ndarray):
    """Sums and counts of the parts nearest to every entry."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for _, rows in _slices(batches, parts * width):
            for p in range(parts):
                leaves, times, _ = distinct_parts(rows[:, p * width:(p + 1) * width])
                entry, _ = nearest(leaves, codebooks[p])
                np.add.at(n[p], entry, times)
                np.add.at(sums[p], entry, leaves * times[:, None])
        used = np.argwhere(n)
        yield pa.record_batch(
            [
                pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()), pa.array(n[n > 0]),
                pa.array(list(sums[n > 0]), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "sums"],
        )

    return run


def _codes(codebooks: np.ndarray):
    parts, _, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, rows in _slices(batches, parts * width):
            codes, error = np.empty((len(rows), parts), np.uint8), np.zeros(len(rows), np.int64)
            for p in range(parts):
                leaves, _, which = distinct_parts(rows[:, p * width:(p + 1) * width])
                entry, distance = nearest(leaves, codebooks[p])
                codes[:, p] = entry[which]
                error += distance[which]
            told = codes.tobytes().hex()
            step = 2 * parts
            out = table.select(["vec_id", "label"])
            out = out.append_column("code", pa.array([told[i:i + step] for i in range(0, len(told), step)]))
            yield from out.append_column("error", pa.array(error)).combine_chunks().to_batches()

    return run


def kept_vectors(vectors: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """(the rows that are coded as vec_id, label, vector; their length).

    Rows whose vector is NULL or has NULL or non-finite components are dropped.
    Vectors must be of one length, a multiple of sixteen: that of the row with the
    smallest vec_id (then vector) whose length is such a multiple. Rows of other
    lengths can't be coded and are dropped. The length is 0 if no row is left.
    """
    value = F.col(vector).cast("array<double>")
    rows = vectors.select("vec_id", "label", value.alias("vector")).where(_usable(value))
    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    first = rows.orderBy(*order).limit(1).select(F.size("vector")).first()
    width = first[0] if first else 0
    return materialise(rows.where(F.size("vector") == width), "vectors"), width


def codebooks_of(kept: DataFrame, width: int, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks by part, entry and position, learnt from all rows. They hold
    64 vectors in all, and so does what each round returns to the driver."""
    part_width = width // PARTS
    seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()
    start = whole(np.array([r["vector"] for r in seeds], dtype=float).reshape(len(seeds), PARTS, part_width))
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    for _ in range(rounds):
        sums = kept.select("vector").mapInArrow(_sums(books), _SUMS)
        total = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(part_width)]
        books = books.copy()
        for r in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total).collect():
            books[r["part"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(part_width)]
    return books


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of every row that ``kept_vectors`` keeps.

    ``error`` is the row's squared distance to its entries, ``label_error`` the
    sum over its label (NULL is one label). Rows that repeat are coded each. The
    codebooks start from the 64 smallest vec_id, NULL last, ties by vector; with
    fewer rows they have fewer entries. Components beyond ``MOST`` are held there.
    An empty table gives no rows.
    """
    spark, kinds = vectors.sparkSession, dict(vectors.dtypes)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint"
    kept, width = kept_vectors(vectors, vector)
    if not width:
        return spark.createDataFrame([], f"{schema}, label_error bigint, codebooks_sha256 string")
    books = codebooks_of(kept, width)
    coded = materialise(kept.mapInArrow(_codes(books), schema), "codes")
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n"))
    return join_back(coded, totals, ["label"], size="_n").withColumn("codebooks_sha256", F.lit(digest(books)))
