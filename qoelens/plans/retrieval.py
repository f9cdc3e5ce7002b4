"""Chunking, fusion of sparse and dense hits, and retrieval reports. The searches themselves are in ``search``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import top_rows
from .search import TOP_K, bm25_topk, dense_topk  # noqa: F401

# Chunking and fusion weights.
CHUNK, OVERLAP = 1200, 150
SPARSE_WEIGHT, DENSE_WEIGHT = 0.4, 0.6
RANK_OFFSET = 60
SEPARATOR = "\n\n---\n\n"


def chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """The whole text in pieces of ``size`` characters, each starting
    ``size - overlap`` after the last; a piece inside its predecessor is not made."""
    last = F.greatest(F.length(text) - overlap - 1, F.lit(0))
    starts = F.sequence(F.lit(0), last, F.lit(size - overlap))
    cut = docs.where(F.length(text) > 0).select(key, text, F.posexplode(starts).alias("chunk_no", "_start"))
    return cut.select(key, "chunk_no", F.substring(text, F.col("_start") + 1, F.lit(size)).alias("chunk"))


def fuse(
    sparse: DataFrame, dense: DataFrame, k: int = TOP_K, sparse_weight: float = SPARSE_WEIGHT,
    dense_weight: float = DENSE_WEIGHT, offset: int = RANK_OFFSET,
) -> DataFrame:
    """Weighted reciprocal-rank fusion of two hit lists."""
    left = sparse.select("query_id", "id", F.col("rank").alias("sparse_rank"))
    right = dense.select("query_id", "id", F.col("rank").alias("dense_rank"))
    share = F.coalesce(F.lit(sparse_weight) / (F.col("sparse_rank") + offset), F.lit(0.0)) + F.coalesce(
        F.lit(dense_weight) / (F.col("dense_rank") + offset), F.lit(0.0)
    )
    both = left.join(right, ["query_id", "id"], "full").withColumn("score", F.round(share, 9))
    return top_rows(both, ["query_id"], [F.desc("score"), F.col("id")], k)


def context(hits: DataFrame, texts: DataFrame, separator: str = SEPARATOR) -> DataFrame:
    """The texts of each question's hits, best first, as one string. A question
    has at most k hits."""
    found = texts.select("id", "text").join(hits.select("query_id", "id", "rank"), "id")
    ordered = F.array_sort(F.collect_list(F.struct("rank", "text")))
    return found.groupBy("query_id").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), separator).alias("context"))


def precision_at_k(hits: DataFrame, relevant: DataFrame, k: int = TOP_K) -> DataFrame:
    """Share of each question's first k hits that are relevant, over judged hits."""
    judged = hits.where(F.col("rank") <= k).join(relevant.select("id", "relevant"), "id")
    return judged.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("judged"), F.avg(F.col("relevant").cast("double")).alias("precision")
    )


def evaluation_report(cases: DataFrame, metrics: Sequence[str], low: float = 0.5) -> DataFrame:
    """Metric means overall, per category and per difficulty, and how many cases
    have any metric below ``low``; one pass with grouping sets."""
    poor = (F.least(*metrics) if len(metrics) > 1 else F.col(metrics[0])) < low
    grouped = cases.groupingSets([[], ["category"], ["difficulty"]], "category", "difficulty").agg(
        F.grouping_id().alias("_level"),
        F.count(F.lit(1)).alias("cases"),
        *(F.avg(m).alias(m) for m in metrics),
        F.count_if(poor).alias("low_cases"),
    )
    level = F.when(F.col("_level") == 3, "overall").when(F.col("_level") == 1, "category").otherwise("difficulty")
    return grouped.withColumn("level", level).drop("_level")


def low_cases(cases: DataFrame, metrics: Sequence[str], low: float = 0.5) -> DataFrame:
    return cases.where((F.least(*metrics) if len(metrics) > 1 else F.col(metrics[0])) < low)


def mean_vectors(vectors: DataFrame, group: str) -> DataFrame:
    """Component-wise mean vector per group, combined on the map side."""
    parts = vectors.select(group, F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy(group, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
    return means.groupBy(group).agg(F.transform(ordered, lambda e: e["x"]).alias("embedding"))


def case_scores(rows: DataFrame, metrics: Mapping[str, Column], category: Column, difficulty: Column) -> DataFrame:
    return rows.select(category.alias("category"), difficulty.alias("difficulty"), *(c.alias(m) for m, c in metrics.items()))
