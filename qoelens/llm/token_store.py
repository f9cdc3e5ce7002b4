"""Token ids in word-aligned blocks (Simple-8b), written in document order and read back.

**Word.** 64 bits: a selector in the top four bits and up to 60 bits of ids.
Selector ``s`` in 1..14 packs ``COUNTS[s]`` ids of ``60 // COUNTS[s]`` bits, the
first id lowest. Selector 15 announces an escape: the next word is one id of up
to 64 bits, plain. A block is padded with zero ids; its true number of ids is
stored beside it.

**Block.** One row: the part it belongs to, its number in the part, the ids
before it in the part, its number of ids, the documents it completes with their
lengths, and the packed words, little-endian. Blocks hold whole documents and
close once they have ``BLOCK_IDS`` ids, so every block can be decoded alone.

**File.** A Parquet file of blocks per part. Parts are ranges of ``doc_id`` in
ascending order, so ids follow one another in document order across the whole
table; ids before a part come from the parts' totals.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textbytes as B
from .encoding import encoder

END_ID = 1
BLOCK_IDS = 1 << 18

# Ids per word by selector (0 is not used, 15 is the escape).
COUNTS = [0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
ESCAPE = 15
_WIDTHS = [0] + [60 // c for c in COUNTS[1:]]

BLOCK_SCHEMA = (
    "part int, block int, ids_before bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, packed binary"
)


_SELECTOR = np.full(256, ESCAPE, dtype=np.int8)
_SELECTOR[COUNTS[1:]] = np.arange(1, len(COUNTS))


_BITS = np.zeros(1 << 16, dtype=np.uint8)
for _bit in range(16):
    _BITS[1 << _bit:] = _bit + 1


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs."""
    out = _BITS[ids & np.uint64(0xFFFF)]
    for step in (16, 32, 48) if int(ids.max()) >> 16 else ():
        part = (ids >> np.uint64(step)) & np.uint64(0xFFFF)
        out = np.where(part != 0, _BITS[part] + np.uint8(step), out)
    return out


def pack(ids: np.ndarray) -> np.ndarray:
    """Simple-8b words of ``ids`` (whole numbers from 0 to 2^64 - 1).

    Every word takes as many of the next ids as fit; the fits of all positions
    are worked out at once, and only the walk from word to word is a loop.
    """
    ids = np.asarray(ids, dtype=np.uint64)
    n = len(ids)
    if not n:
        return np.empty(0, np.uint64)
    # most[k]: the bits of the largest of the next ``count`` ids from k on, zeros after the last.
    bits = np.zeros(n + max(COUNTS), dtype=np.uint8)
    bits[:n] = _bits(ids)
    step, most, reach = np.zeros(n, dtype=np.uint8), bits, 1
    for selector in range(len(COUNTS) - 1, 0, -1):
        count = COUNTS[selector]
        if count > reach:  # two overlapping stretches of what is known cover it
            grown = count - reach
            most = np.maximum(most[:len(most) - grown], most[grown:])
            reach = count
        np.maximum(step, (most[:n] <= _WIDTHS[selector]) * np.uint8(count), out=step)
    choice = _SELECTOR[step]
    step[step == 0] = 1
    starts, at, steps = [], 0, step.tolist()
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts)
    chosen = choice[starts].astype(np.int64)
    place = np.cumsum(np.append(0, 1 + (chosen == ESCAPE)))
    out = np.zeros(place[-1], dtype=np.uint64)
    padded = np.append(ids, np.zeros(max(COUNTS), dtype=np.uint64))
    out[place[:-1]] = chosen.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(chosen).tolist():
        mine = chosen == selector
        if selector == ESCAPE:
            out[place[:-1][mine] + 1] = ids[starts[mine]]
            continue
        at = starts[mine]
        words = padded[at]
        for k in range(1, COUNTS[selector]):
            words |= padded[at + k] << np.uint64(k * _WIDTHS[selector])
        out[place[:-1][mine]] |= words
    return out


def unpack(words: np.ndarray, n_ids: int) -> np.ndarray:
    """The ``n_ids`` ids of packed words. The words are decoded selector by selector, all at once."""
    words = np.asarray(words, dtype=np.uint64)
    if not n_ids:
        return np.empty(0, np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    # A word after an escape is plain. Escapes are rare: walk over the candidates only.
    plain = np.zeros(len(words), dtype=bool)
    for at in np.flatnonzero(selectors == ESCAPE).tolist():
        if not plain[at]:
            plain[at + 1] = True
    head = ~plain
    counts = np.append(COUNTS, 0)[np.where(head, selectors, 0)]
    counts[plain] = 1
    first = np.append(0, np.cumsum(counts))
    out = np.zeros(first[-1], dtype=np.uint64)
    out[first[:-1][plain]] = words[plain]
    body = words & np.uint64((1 << 60) - 1)
    for selector in np.unique(selectors[head]).tolist():
        if selector in (0, ESCAPE):
            continue
        mine = np.flatnonzero(head & (selectors == selector))
        held, place = body[mine], first[mine]
        width = _WIDTHS[selector]
        mask = np.uint64((1 << width) - 1)
        for k in range(COUNTS[selector]):
            out[place + k] = held >> np.uint64(k * width) & mask
    return out[:n_ids]


def _blocks(path: str, remember: int | None):
    """Blocks of a sorted partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path, remember).encode, np.array([END_ID], "<u4").tobytes()
        part, block, before = TaskContext.get().partitionId(), 0, 0
        docs, lengths, ids, held = [], [], [], 0

        def close():
            flat = np.concatenate(ids)
            row = {
                "part": [part], "block": [block], "ids_before": [before], "n_ids": [len(flat)],
                "doc_ids": [docs], "lengths": [lengths],
                "packed": [pack(flat).astype("<u8").tobytes()],
            }
            return pa.RecordBatch.from_pydict(row, schema=_BLOCK_ARROW)

        size = B.SLICE if remember is None else B.SMALL_SLICE  # a cut text is a dozen times its size
        for batch, _, _ in B.slices(batches, size=size):
            found = [raw + end for raw in encode(batch.column("text").to_pylist())]
            docs += batch.column("doc_id").to_pylist()
            lengths += [len(raw) // 4 for raw in found]
            ids.append(np.frombuffer(b"".join(found), "<u4"))
            held += len(ids[-1])
            if held >= BLOCK_IDS:
                yield close()
                block, before = block + 1, before + held
                docs, lengths, ids, held = [], [], [], 0
        if docs:
            yield close()

    return run


_BLOCK_ARROW = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("ids_before", pa.int64()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("packed", pa.binary()),
])


def write(docs: DataFrame, folder: str, tokenizer: str, remember: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text) with the tokenizer file at ``tokenizer``
    (a path every executor has) and write the blocks to ``folder``. A worker
    remembers up to ``remember`` stretches of text (None: ``encoding.MOST``); with
    a number given it also cuts smaller slices.

    NULL text counts as empty: the end id alone. Documents without doc_id come
    first; rows that repeat a doc_id follow one another by text. An empty
    table writes no blocks.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The last key only spreads rows that are equal in full.
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    keys = [F.col("doc_id").asc_nulls_first(), "hash", "row"]
    ordered = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    ordered.select("doc_id", "text").mapInArrow(_blocks(tokenizer, remember), BLOCK_SCHEMA).write.parquet(folder)


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The stored blocks with the ids before each in the whole table."""
    stored = spark.read.schema(BLOCK_SCHEMA).parquet(folder)
    # One row per part: as many as the files were written by tasks.
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before_part"))
    return stored.join(F.broadcast(before), "part").withColumn("start", F.col("before_part") + F.col("ids_before"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(np.frombuffer(row["packed"], "<u8"), row["n_ids"]).astype("<u4")
            lengths = np.array(row["lengths"], dtype=np.int64)
            ends = np.cumsum(lengths)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
            yield pa.record_batch(
                [
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - lengths),
                    pa.array(lengths), pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the stored blocks."""
    return blocks(spark, folder).select("start", "n_ids", "doc_ids", "lengths", "packed").mapInArrow(
        _digests, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(np.frombuffer(row["packed"], "<u8"), row["n_ids"]).astype(np.int64)
            bounds = np.append(0, np.cumsum(row["lengths"])).astype(np.int32)
            yield pa.record_batch(
                [pa.array(row["doc_ids"], pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids))],
                names=["doc_id", "ids"],
            )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id and ids of every stored document."""
    return blocks(spark, folder).select("n_ids", "doc_ids", "lengths", "packed").mapInArrow(
        _decoded, "doc_id bigint, ids array<bigint>"
    )
