"""Exact top-k search by postings blocks and by pivots, with early termination.

Both searches keep the corpus in groups of bounded size, a shelf of texts or a
cell of vectors. Questions are a table too: small tables of bounds say which
(question, group) pairs can still hold one of the best k, and only those meet.
A group and a block of questions are scored together in one task, which ships its
best k per question. Nothing of a question or of the corpus reaches the driver
but counts, the mean length, the pivots and a bounded table of marks for the words asked.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import top_rows
from ..operators.skew import materialise

# Number of hits and BM25's parameters.
TOP_K = 5
K1, B = 1.5, 0.75
#: Decimals kept before ranking, so equal scores tie on every machine; half of the last one is how far a bound may be off.
DIGITS = 6
MARGIN = 1e-6
WORD_BREAK = r"[^\p{L}\p{N}]+"

#: Texts on a shelf, vectors in a cell, questions that are scored together.
SHELF, CELL, QUESTION_BLOCK = 512, 4096, 256
#: Blocks with rare words that a question's threshold is drawn from.
SEED_BLOCKS = 48
#: Vectors that serve as pivots: a bounded sample.
MOST_PIVOTS = 1024


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")


def joined_words(text: Column) -> Column:
    """The ``words`` of a text, joined by blanks."""
    return F.trim(F.regexp_replace(F.lower(text), WORD_BREAK, " "))


def _question_block(questions: DataFrame) -> Column:
    blocks = max(1, math.ceil(questions.count() / QUESTION_BLOCK))
    return F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")


def _thresholds(scored: DataFrame, k: int) -> DataFrame:
    """(query_id, least): what the k-th best of some scores of different rows reaches, where there are k."""
    best = top_rows(scored, ["query_id"], [F.desc("score"), F.col("id")], k)
    return best.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).drop("n")


def _best(hits: DataFrame, k: int) -> DataFrame:
    return top_rows(hits.withColumn("score", F.round("score", DIGITS)), ["query_id"], [F.desc("score"), F.col("id")], k)


def _first(scores: np.ndarray, ids: pa.Array, k: int) -> np.ndarray:
    """Places of the k best scores, ties by id."""
    rounded = np.round(scores, DIGITS)
    if len(rounded) > k:
        near = np.flatnonzero(rounded >= np.partition(rounded, len(rounded) - k)[len(rounded) - k])
    else:
        near = np.arange(len(rounded))
    names = ids.take(pa.array(near)).to_pylist()
    return near[sorted(range(len(near)), key=lambda i: (-rounded[near[i]], names[i]))[:k]]


def _hits(id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("query_id", T.LongType()), T.StructField("id", id_type), T.StructField("score", T.DoubleType())])


# --- texts


@dataclass(frozen=True)
class TextIndex:
    """Postings of a corpus, written once: one row per (shelf, word) with the
    texts, what the word adds to each at weight 1, and the most it adds."""

    blocks: DataFrame
    texts: int
    id_type: T.DataType


#: Marks of the words that an index is for: what the driver gets of them.
WORD_MARKS = 1 << 20
#: Stands for all words in the row of a shelf that has its texts and their words; no word is empty.
EVERY_WORD = ""


def _counted(id_type: T.DataType) -> T.StructType:
    whole = T.ArrayType(T.LongType())
    return T.StructType([
        T.StructField("shelf", T.LongType()), T.StructField("word", T.StringType()), T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("lengths", whole), T.StructField("counts", whole),
    ])


def _marked_words(vocabulary: DataFrame) -> np.ndarray:
    """A mark for each checksum, modulo ``WORD_MARKS``, of a word; other words that have one are left out later."""
    marks = vocabulary.select((F.crc32(F.col("word").cast("binary")) % WORD_MARKS).alias("mark")).distinct().toArrow()
    out = np.zeros(WORD_MARKS, dtype=bool)
    out[marks.column("mark").to_numpy()] = True
    return out


def _count_shelf(out: pa.Schema, marked: Broadcast | None = None):
    """The texts of a shelf, as words joined by blanks -> per (marked) word its texts, their
    lengths and how often each has it; and in one row more the number of texts and of their words."""

    def run(texts: pa.Table) -> pa.Table:
        cut = pc.split_pattern(texts.column("words"), " ")
        some = pc.not_equal(texts.column("words"), "")
        lengths = np.where(some.to_numpy(), pc.list_value_length(cut).to_numpy(), 0).astype(np.int64)
        rest, cut = texts.filter(some), cut.filter(some)
        # Texts of one id and length are one text that has all their words.
        names = rest.column("id").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        length = lengths[lengths > 0]
        _, first, place = np.unique(np.stack([names, length]), axis=1, return_index=True, return_inverse=True)
        found = pa.chunked_array([c.flatten() for c in cut.chunks], pa.string()).dictionary_encode().unify_dictionaries()
        dictionary = found.chunk(0).dictionary if found.num_chunks else pa.array([], pa.string())
        codes = np.concatenate([np.empty(0, np.int64), *(c.indices.to_numpy().astype(np.int64) for c in found.chunks)])
        owner = np.repeat(place.ravel(), length)
        if marked is not None:
            sums = np.fromiter((zlib.crc32(w.encode()) for w in dictionary.to_pylist()), np.int64, len(dictionary))
            keep = marked.value[sums % WORD_MARKS][codes]
            codes, owner = codes[keep], owner[keep]
        pairs, often = np.unique(codes * max(len(first), 1) + owner, return_counts=True)
        word, text = np.divmod(pairs, max(len(first), 1))
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.empty(0, np.int64)
        ends = pa.array(np.append(starts, len(word)).astype(np.int32))
        rows = [
            pa.ListArray.from_arrays(ends, values).cast(out.field(name).type)
            for name, values in (
                ("ids", rest.column("id").combine_chunks().take(pa.array(first[text]))),
                ("lengths", pa.array(length[first[text]].astype(np.int64))), ("counts", pa.array(often.astype(np.int64))),
            )
        ]
        shelf = pa.array(np.full(len(starts) + 1, texts.column("shelf")[0].as_py(), np.int64))
        of_shelf = [
            pa.array([EVERY_WORD]), pa.array([None], out.field("ids").type),
            *(pa.array([[n]], out.field("counts").type) for n in (int(lengths.sum()), len(lengths))),
        ]
        own = [dictionary.take(pa.array(word[starts])), *rows]
        return pa.Table.from_arrays([shelf, *(pa.concat_arrays([x, y]) for x, y in zip(own, of_shelf))], schema=out)

    return run


def _impacts(mean: float, k1: float, b: float, out: pa.Schema):
    """Word counts of shelves -> blocks of postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("counts").flatten().to_numpy()
            impact = n * (k1 + 1) / (n + k1 * (1 - b + b * batch.column("lengths").flatten().to_numpy() / mean))
            ends = np.append(0, np.cumsum(batch.column("counts").value_lengths().to_numpy()))
            columns = [
                batch.column("shelf"), batch.column("word"), pa.array(np.maximum.reduceat(impact, ends[:-1])), pa.array(np.diff(ends)),
                batch.column("ids"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(impact)),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return run


def index_texts(docs: DataFrame, vocabulary: DataFrame | None = None, k1: float = K1, b: float = B) -> TextIndex:
    """Index the texts (id, text). ``vocabulary`` (word) leaves all other words
    out, for an index that serves known questions only.

    A shelf has about ``SHELF`` texts, so a block is bounded however common its
    word is. Texts are cut into words once, and each travels to its shelf as one
    row; the words of a shelf are counted together.
    """
    texts, id_type = docs.count(), docs.schema["id"].dataType
    shelf = F.pmod(F.xxhash64("id"), F.lit(max(1, math.ceil(texts / SHELF))))
    tokens = docs.where("text is not null").select(shelf.alias("shelf"), "id", joined_words(F.col("text")).alias("words"))
    schema = _counted(id_type)
    marked = None if vocabulary is None else docs.sparkSession.sparkContext.broadcast(_marked_words(vocabulary))
    counts = tokens.groupBy("shelf").applyInArrow(_count_shelf(_arrow(schema), marked), schema)
    if vocabulary is not None:
        asked = vocabulary.select("word").union(docs.sparkSession.range(1).select(F.lit(EVERY_WORD)))
        counts = counts.join(asked.distinct(), "word", "left_semi").select(*schema.names)
    counts = materialise(counts, "word-counts")
    every = counts.where(F.col("word") == EVERY_WORD).agg(F.sum(F.get("counts", F.lit(0))), F.sum(F.get("lengths", F.lit(0)))).first()
    mean = every[1] / every[0] if every[0] else None
    found = T.StructType([
        *schema.fields[:2], T.StructField("top", T.DoubleType()), T.StructField("n", T.LongType()), schema["ids"],
        T.StructField("impacts", T.ArrayType(T.DoubleType())),
    ])
    blocks = counts.where(F.col("word") != EVERY_WORD).mapInArrow(_impacts(float(mean or 1.0), k1, b, _arrow(found)), found)
    return TextIndex(materialise(blocks, "postings"), texts, id_type)


def score_shelf(words_of: list[tuple[float, float, np.ndarray, np.ndarray]], n_texts: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the texts that can reach ``least``, fully scored.

    ``words_of`` has, per word of the question, the most it adds on this shelf, its
    weight, and its texts with their impacts. Words that add most go first. Once the
    words still to come cannot lift a text from nothing to ``least``, no new text
    enters, and texts that they cannot lift there are dropped as we go.
    """
    order = sorted(words_of, key=lambda w: -w[0])
    rest = np.cumsum([w[0] for w in order][::-1])[::-1].tolist() + [0.0]
    if rest[0] < least:
        return np.empty(0, np.int64), np.empty(0)
    sums = np.zeros(n_texts)
    at = 0
    while at < len(order) and (rest[at] >= least or least <= 0):
        _, weight, places, impacts = order[at]
        sums[places] += weight * impacts
        at += 1
    alive = np.flatnonzero((sums > 0) & (sums + rest[at] >= least))
    for k in range(at, len(order)):
        if not len(alive):
            break
        _, weight, places, impacts = order[k]
        more = np.zeros(n_texts)
        more[places] = weight * impacts
        sums[alive] += more[alive]
        alive = alive[sums[alive] + rest[k + 1] >= least]
    return alive, sums[alive]


def _score_texts(k: int, out: pa.Schema):
    def run(blocks: pa.Table, asked: pa.Table) -> pa.Table:
        ids = pa.concat_arrays([c.flatten() for c in blocks.column("ids").chunks]).dictionary_encode()
        places, names = ids.indices.to_numpy(), ids.dictionary
        impacts = pa.concat_arrays([c.flatten() for c in blocks.column("impacts").chunks]).to_numpy()
        ends = np.cumsum(blocks.column("n").to_numpy()).tolist()
        found = {
            word: (top, places[end - n:end], impacts[end - n:end])
            for word, top, n, end in zip(*(blocks.column(c).to_pylist() for c in ("word", "top", "n")), ends)
        }
        questions: dict[int, tuple[float, list]] = {}
        for q, word, weight, least in zip(*(asked.column(c).to_pylist() for c in ("query_id", "word", "weight", "least"))):
            if word in found:
                top, where, adds = found[word]
                questions.setdefault(q, (least, []))[1].append((weight * top, weight, where, adds))
        rows = [], [], []
        for q, (least, words_of) in questions.items():
            alive, scores = score_shelf(words_of, len(names), least)
            best = _first(scores, names.take(pa.array(alive)), k)
            rows[0].extend([q] * len(best))
            rows[1].extend(alive[best].tolist())
            rows[2].extend(scores[best].tolist())
        return pa.Table.from_arrays([pa.array(rows[0], pa.int64()), names.take(pa.array(rows[1], pa.int64())), pa.array(rows[2], pa.float64())], schema=out)

    return run


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def asked_words(questions: DataFrame) -> DataFrame:
    """(query_id, word, asked) of questions (query_id, text)."""
    asked = questions.select("query_id", F.explode(words(F.col("text"))).alias("word"))
    return asked.groupBy("query_id", "word").agg(F.count(F.lit(1)).alias("asked"))


def open_shelves(index: TextIndex, weights: DataFrame, k: int) -> DataFrame:
    """(query_id, shelf, least): the shelves on which a question can find one of its best k.

    ``least`` is what its k-th best text reaches on some blocks of its rarest words
    alone; a shelf on which all its words together cannot add that is closed. Only
    one row per (question, word, shelf) is joined, no posting.
    """
    heads = materialise(weights.join(index.blocks.select("shelf", "word", "top"), "word"), "block-bounds")
    seeds = top_rows(heads, ["query_id"], [F.col("df"), F.desc("top"), F.col("shelf"), F.col("word")], SEED_BLOCKS)
    entries = seeds.join(index.blocks.select("shelf", "word", F.arrays_zip("ids", "impacts").alias("entries")), ["shelf", "word"])
    parts = entries.select("query_id", "weight", F.explode("entries").alias("e")).groupBy("query_id", F.col("e.ids").alias("id"))
    least = _thresholds(parts.agg(F.sum(F.col("weight") * F.col("e.impacts")).alias("score")), k)
    reach = heads.groupBy("query_id", "shelf").agg(F.sum(F.col("weight") * F.col("top")).alias("reach"))
    least_score = F.coalesce(F.col("least") - MARGIN, F.lit(0.0))
    return reach.join(least, "query_id", "left").withColumn("least", least_score).where("reach >= least").drop("reach")


def bm25_topk(
    docs: DataFrame | TextIndex, questions: DataFrame, k: int = TOP_K, k1: float = K1, b: float = B
) -> DataFrame:
    """Best k texts per question (query_id, text) by BM25: (query_id, id, score, rank).

    ``docs`` (id, text) is indexed for the words of these questions, or an index
    of all words is given and used again. Words in no text add nothing; texts that
    score 0 are no hits. Scores are rounded before ranking, ties go to the smaller id.
    """
    asked = materialise(asked_words(questions), "asked")
    index = docs if isinstance(docs, TextIndex) else index_texts(docs, asked.select("word"), k1, b)
    frequency = index.blocks.groupBy("word").agg(F.sum("n").alias("df"))
    idf = F.log(1 + (F.lit(float(index.texts)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = materialise(asked.join(frequency, "word").select("query_id", "word", "df", (F.col("asked") * idf).alias("weight")), "weights")
    block = _question_block(weights.select("query_id").distinct())
    open_ = materialise(open_shelves(index, weights, k).withColumn("block", block), "open-shelves")
    meeting = open_.select(F.col("shelf").alias("_shelf"), F.col("block").alias("_block")).distinct()
    shelves = index.blocks.join(meeting, F.col("shelf") == F.col("_shelf")).drop("shelf")
    wanted = open_.join(weights.select("query_id", "word", "weight"), "query_id")
    schema = _hits(index.id_type)
    scored = shelves.groupBy("_shelf", "_block").cogroup(wanted.groupBy("shelf", "block")).applyInArrow(_score_texts(k, _arrow(schema)), schema)
    return _best(scored, k)


# --- vectors


def _unit(vectors: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(lengths == 0, 1.0, lengths)


def _matrix(column) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = pa.concat_arrays([c.flatten() for c in chunks]).to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(sum(len(c) for c in chunks), -1)


def _lists(vectors: np.ndarray) -> pa.ListArray:
    rows, width = vectors.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width, pa.int32()), pa.array(vectors.ravel()))


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def _to_pivots(pivots: np.ndarray):
    """Vectors -> their nearest pivot and the angle to it; -1 for a vector of zeros, which is at 0 to everything."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(_matrix(batch.column("embedding")))
            cosines = unit @ pivots.T
            nearest = cosines.argmax(axis=1)
            angle = _angles(cosines[np.arange(len(unit)), nearest])
            zero = ~unit.any(axis=1)
            nearest[zero], angle[zero] = -1, 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(nearest.astype(np.int32)), pa.array(angle), _lists(unit)],
                names=["id", "pivot", "angle", "embedding"],
            )

    return run


def _from_questions(pivots: np.ndarray):
    """Questions -> their angle to every pivot; the zeros' pivot has none."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(_matrix(batch.column("embedding")))
            angles = _angles(unit @ pivots.T)
            angles[~unit.any(axis=1)] = np.nan
            n = len(pivots)
            ids = np.repeat(batch.column("query_id").to_numpy(), n + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(np.tile(np.arange(-1, n, dtype=np.int32), len(unit))), pa.array(np.insert(angles, 0, np.nan, axis=1).ravel())],
                names=["query_id", "pivot", "angle"],
            )

    return run


@dataclass(frozen=True)
class VectorIndex:
    """Unit vectors by cell, written once: a pivot and a number below it. ``cells`` has n and the largest angle of each."""

    vectors: DataFrame
    cells: DataFrame
    pivots: np.ndarray
    id_type: T.DataType


def index_vectors(vectors: DataFrame) -> VectorIndex:
    """Group vectors (id, embedding) by their nearest pivot, in cells of about ``CELL`` vectors.

    The pivots, at most ``MOST_PIVOTS`` and about the square root of the number of
    vectors, are those with the smallest hashes of their ids. Copies of one vector
    are in as many cells as they need. Rows without vector are left out.
    """
    rows = vectors.select("id", F.col("embedding").cast("array<double>").alias("embedding")).where("embedding is not null")
    total = rows.count()
    n_pivots = min(MOST_PIVOTS, math.isqrt(total))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(n_pivots).select("embedding").collect()
    pivots = _unit(np.array([r["embedding"] for r in sample], dtype=float).reshape(n_pivots, -1 if n_pivots else 0))
    schema = T.StructType([
        vectors.schema["id"], T.StructField("pivot", T.IntegerType()), T.StructField("angle", T.DoubleType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
    ])
    # Cells are numbered by the whole table's size: a pivot with many vectors has as many full cells as it needs.
    cell = F.pmod(F.xxhash64("id"), F.lit(max(1, math.ceil(total / CELL)))).cast("int")
    placed = materialise(rows.mapInArrow(_to_pivots(pivots), schema).withColumn("cell", cell), "cells")
    cells = materialise(placed.groupBy("pivot", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")), "radii")
    return VectorIndex(placed, cells, pivots, vectors.schema["id"].dataType)


def _score_vectors(k: int, out: pa.Schema):
    def run(vectors: pa.Table, asked: pa.Table) -> pa.Table:
        ids = vectors.column("id").combine_chunks()
        scores = _matrix(asked.column("embedding")) @ _matrix(vectors.column("embedding")).T
        rows = [], [], []
        for q, row in zip(asked.column("query_id").to_pylist(), scores):
            best = _first(row, ids, k)
            rows[0].extend([q] * len(best))
            rows[1].extend(best.tolist())
            rows[2].extend(row[best].tolist())
        return pa.Table.from_arrays([pa.array(rows[0], pa.int64()), ids.take(pa.array(rows[1], pa.int64())), pa.array(rows[2], pa.float64())], schema=out)

    return run


def _meet(index: VectorIndex, wanted: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """Best k hits of each (question, cell) pair's question in its cell."""
    keys = ["pivot", "cell", "block"]
    have = index.vectors.join(wanted.select(*keys).distinct(), ["pivot", "cell"])
    have = have.select(*(F.col(c).alias(f"_{c}") for c in keys), "id", "embedding")  # other names: both sides come from one table
    asked = wanted.select(*keys, "query_id").join(questions, "query_id")
    schema = _hits(index.id_type)
    return have.groupBy(*(f"_{c}" for c in keys)).cogroup(asked.groupBy(*keys)).applyInArrow(_score_vectors(k, _arrow(schema)), schema)


def _unit_rows(batches):
    for batch in batches:
        if batch.num_rows:
            unit = _unit(_matrix(batch.column("embedding")))
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), _lists(unit)], names=["query_id", "embedding"])


def open_cells(index: VectorIndex, questions: DataFrame, k: int) -> DataFrame:
    """(query_id, pivot, cell, block): the cells in which a question can find one of its best k.

    By the triangle inequality no vector of a cell is nearer to a question than
    its pivot less the cell's radius. The k-th best cosine in the nearest cells that
    hold k vectors is the threshold; cells whose bound is below are closed.
    """
    angles = questions.mapInArrow(_from_questions(index.pivots), "query_id bigint, pivot int, angle double")
    reach = angles.join(index.cells, "pivot")
    # A question or a vector of zeros is at cosine 0.
    bound = F.when(F.isnan("angle"), F.lit(0.0)).otherwise(F.cos(F.greatest(F.col("angle") - F.col("radius"), F.lit(0.0))))
    reach = materialise(reach.select("query_id", "pivot", "cell", "n", bound.alias("bound")).withColumn("block", _question_block(questions)), "cell-bounds")
    near = top_rows(reach, ["query_id"], [F.desc("bound"), F.col("pivot"), F.col("cell")], k)
    earlier = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).where(F.col("before") < k)
    least = _thresholds(_meet(index, near, questions, k), k)
    opened = reach.join(least, "query_id", "left").where(F.col("bound") >= F.coalesce(F.col("least") - MARGIN, F.lit(-1.0)))
    return opened.select("query_id", "pivot", "cell", "block")


def dense_topk(vectors: DataFrame | VectorIndex, questions: DataFrame, k: int = TOP_K) -> DataFrame:
    """Best k vectors per question (query_id, embedding) by cosine: (query_id, id, score, rank).

    ``vectors`` (id, embedding) are indexed first, or an index is given and used
    again. Scores are rounded before ranking, ties go to the smaller id. A vector
    of zeros is at cosine 0. Rows without vector are left out.
    """
    index = vectors if isinstance(vectors, VectorIndex) else index_vectors(vectors)
    if not len(index.pivots):
        return _best(questions.sparkSession.createDataFrame([], _hits(index.id_type)), k)
    asked = questions.select("query_id", F.col("embedding").cast("array<double>").alias("embedding")).where("embedding is not null")
    asked = materialise(asked.mapInArrow(_unit_rows, "query_id bigint, embedding array<double>"), "questions")
    opened = materialise(open_cells(index, asked, k), "open-cells")
    return _best(_meet(index, opened, asked, k), k)
