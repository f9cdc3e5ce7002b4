"""Chunking, top-k retrieval, fusion and evaluation over documents and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import telemetry as data
from ..plans import retrieval as R
from .base import query

_CHUNKS = """
chunks AS (SELECT doc_id, CAST(i AS BIGINT) AS chunk_no, substring(text, CAST(i AS BIGINT) * 1050 + 1, 1200) AS chunk
  FROM documents, range(0, 100000) r(i)
  WHERE length(text) > 0 AND i * 1050 <= greatest(length(text) - 151, 0))"""


def _docs(spark, sf_dir):
    return data.spread(data.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


@query("chunk_documents", f"WITH {_CHUNKS} SELECT * FROM chunks")
def chunk_documents(spark, sf_dir):
    return R.chunks(_docs(spark, sf_dir))


def _centroids(spark, sf_dir):
    vectors = data.table(spark, sf_dir, "embeddings")
    return R.mean_vectors(vectors, "label").select(F.col("label").cast("bigint").alias("query_id"), "embedding")


_DENSE = """
flat AS (SELECT vec_id, label, unnest(range(1, 65)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
center AS (SELECT label AS query_id, i, avg(x) AS x FROM flat GROUP BY ALL),
cos AS (SELECT c.query_id, f.vec_id AS id, round(sum(c.x * f.x) / sqrt(sum(c.x * c.x)) / sqrt(sum(f.x * f.x)), 6) AS score
  FROM center c JOIN flat f ON c.i = f.i GROUP BY ALL)"""


@query(
    "dense_topk",
    f"""WITH {_DENSE}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM cos)
    SELECT CAST(query_id AS BIGINT) AS query_id, id, score, rank FROM r WHERE rank <= 5""",
)
def dense_topk(spark, sf_dir):
    vectors = data.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return R.dense_topk(data.spread(vectors, "id"), _centroids(spark, sf_dir))


def _bm25_sql(corpus: str) -> str:
    """Hits of every benchmark item against ``corpus`` (id, text)."""
    split = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"
    return f"""
corpus AS ({corpus}),
dl AS (SELECT id, {split.format('text')} AS ws FROM corpus),
tok AS (SELECT id, unnest(ws) AS w FROM dl),
tf AS (SELECT id, w, count(*) AS n FROM tok GROUP BY ALL),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY w),
stat AS (SELECT count(*) AS total, avg(len(ws)) AS mean FROM dl),
qt AS (SELECT query_id, w, count(*) AS qn FROM (
    SELECT item_id AS query_id, unnest({split.format('text')}) AS w FROM benchmark) GROUP BY ALL),
bm AS (SELECT query_id, tf.id, round(sum(qn * ln(1 + (total - df + 0.5) / (df + 0.5)) * n * 2.5
      / (n + 1.5 * (0.25 + 0.75 * len(ws) / mean))), 6) AS score
    FROM qt JOIN tf USING (w) JOIN df USING (w) JOIN dl ON dl.id = tf.id, stat GROUP BY ALL),
sparse AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
    FROM bm WHERE score > 0) WHERE rank <= 5)"""


def _questions(spark, sf_dir):
    return data.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _chunk_corpus(spark, sf_dir):
    pieces = R.chunks(_docs(spark, sf_dir))
    return pieces.select(F.concat_ws(":", "doc_id", "chunk_no").alias("id"), F.col("chunk").alias("text"))


_CHUNK_CORPUS = "SELECT doc_id || ':' || chunk_no AS id, chunk AS text FROM chunks"


@query("bm25_topk", f"WITH {_CHUNKS}, {_bm25_sql(_CHUNK_CORPUS)} SELECT query_id, id, score, rank FROM sparse")
def bm25_topk(spark, sf_dir):
    return R.bm25_topk(_chunk_corpus(spark, sf_dir), _questions(spark, sf_dir))


def _doc_corpus(spark, sf_dir):
    return _docs(spark, sf_dir).withColumnRenamed("doc_id", "id")


def _item_vectors(spark, sf_dir):
    """The stored vector of each benchmark item stands for its embedding."""
    items = _questions(spark, sf_dir).select("query_id")
    vectors = data.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    return vectors.join(items, "query_id", "left_semi")


def _hybrid(spark, sf_dir):
    sparse = R.bm25_topk(_doc_corpus(spark, sf_dir), _questions(spark, sf_dir))
    vectors = data.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    dense = R.dense_topk(data.spread(vectors, "id"), _item_vectors(spark, sf_dir))
    return R.fuse(sparse, dense)


_HYBRID = f"""{_bm25_sql("SELECT doc_id AS id, text FROM documents")},
flat AS (SELECT vec_id, unnest(range(1, 65)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
vcos AS (SELECT q.vec_id AS query_id, f.vec_id AS id,
    round(sum(q.x * f.x) / sqrt(sum(q.x * q.x)) / sqrt(sum(f.x * f.x)), 6) AS score
  FROM flat q JOIN flat f ON q.i = f.i WHERE q.vec_id IN (SELECT item_id FROM benchmark) GROUP BY ALL),
dense AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM vcos)
  WHERE rank <= 5),
fused AS (SELECT query_id, id, s.rank AS sparse_rank, d.rank AS dense_rank,
    round(coalesce(CAST(0.4 AS DOUBLE) / (s.rank + 60), 0) + coalesce(CAST(0.6 AS DOUBLE) / (d.rank + 60), 0), 9) AS score
  FROM sparse s FULL JOIN dense d USING (query_id, id)),
hybrid AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM fused)
  WHERE rank <= 5)"""


@query("hybrid_topk", f"WITH {_HYBRID} SELECT * FROM hybrid")
def hybrid_topk(spark, sf_dir):
    return _hybrid(spark, sf_dir)


@query(
    "retrieved_context",
    f"""WITH {_bm25_sql("SELECT doc_id AS id, text FROM documents")} SELECT query_id,
    string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context
    FROM sparse JOIN corpus USING (id) GROUP BY query_id""",
)
def retrieved_context(spark, sf_dir):
    corpus = _doc_corpus(spark, sf_dir)
    return R.context(R.bm25_topk(corpus, _questions(spark, sf_dir)), corpus)


@query(
    "precision_at_k",
    f"""WITH {_bm25_sql("SELECT doc_id AS id, text FROM documents")} SELECT query_id, count(*) AS judged,
    round(avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END), 6) AS precision
    FROM sparse JOIN labels ON id = doc_id GROUP BY query_id""",
)
def precision_at_k(spark, sf_dir):
    hits = R.bm25_topk(_doc_corpus(spark, sf_dir), _questions(spark, sf_dir))
    relevant = data.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), (F.col("quality") == 1).cast("int").alias("relevant")
    )
    return R.precision_at_k(hits, relevant).withColumn("precision", F.round("precision", 6))


_CASES = """
cases AS (SELECT lang AS category, CASE WHEN n_chars > 3000 THEN 'hard' WHEN n_chars > 1000 THEN 'medium' ELSE 'easy' END
    AS difficulty, CAST(quality AS DOUBLE) AS quality, 1.0 - toxic AS clean FROM labels JOIN documents USING (doc_id))"""


def _cases(spark, sf_dir):
    labels, docs = (data.table(spark, sf_dir, t) for t in ("labels", "documents"))
    n = F.col("n_chars")
    difficulty = F.when(n > 3000, "hard").when(n > 1000, "medium").otherwise("easy")
    metrics = {"quality": F.col("quality").cast("double"), "clean": 1.0 - F.col("toxic")}
    return R.case_scores(labels.join(docs.select("doc_id", "lang", "n_chars"), "doc_id"), metrics, F.col("lang"), difficulty)


@query(
    "eval_report",
    f"""WITH {_CASES} SELECT CASE WHEN grouping(category) = 0 THEN 'category' WHEN grouping(difficulty) = 0 THEN 'difficulty'
      ELSE 'overall' END AS level, category, difficulty, count(*) AS cases, round(avg(quality), 6) AS quality,
      round(avg(clean), 6) AS clean, count(*) FILTER (WHERE least(quality, clean) < 0.5) AS low_cases
    FROM cases GROUP BY GROUPING SETS ((), (category), (difficulty))""",
)
def eval_report(spark, sf_dir):
    report = R.evaluation_report(_cases(spark, sf_dir), ["quality", "clean"])
    return report.withColumns({c: F.round(c, 6) for c in ("quality", "clean")})


@query(
    "low_scoring_cases",
    f"WITH {_CASES} SELECT category, difficulty, count(*) AS n FROM cases WHERE least(quality, clean) < 0.5 GROUP BY ALL",
)
def low_scoring_cases(spark, sf_dir):
    low = R.low_cases(_cases(spark, sf_dir), ["quality", "clean"])
    return low.groupBy("category", "difficulty").agg(F.count(F.lit(1)).alias("n"))
