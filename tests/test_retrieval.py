"""Retrieval against brute force, with more questions than one block holds."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from qoelens.plans import retrieval as R
from qoelens.plans import search

from .conftest import rows_of


def test_chunks_cover_the_whole_text(spark):
    rng = random.Random(1)
    texts = {i: "".join(rng.choice("abcé ") for _ in range(n)) for i, n in enumerate([1, 150, 1199, 1200, 1201, 2250, 2251, 5000])}
    df = spark.createDataFrame([*texts.items(), (99, ""), (98, None)], "doc_id long, text string")
    got = {}
    for r in R.chunks(df).collect():
        got.setdefault(r.doc_id, {})[r.chunk_no] = r.chunk
    assert set(got) == set(texts)
    for i, text in texts.items():
        pieces = [got[i][n] for n in range(len(got[i]))]
        rebuilt = pieces[0] + "".join(p[R.OVERLAP:] for p in pieces[1:])
        assert rebuilt == text and all(len(p) <= R.CHUNK for p in pieces)
        assert all(len(p) > R.OVERLAP for p in pieces[1:])


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(search, "QUESTION_BLOCK", 3)
    monkeypatch.setattr(search, "SHELF", 40)
    monkeypatch.setattr(search, "CELL", 50)


def test_dense_topk(spark, small_blocks):
    rng = np.random.default_rng(2)
    vectors = {i: rng.normal(size=8) for i in range(300)}
    vectors[7] = vectors[8] = vectors[9]
    vectors[10] = np.zeros(8)
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "id long, embedding array<double>").repartition(6)
    questions = spark.createDataFrame([(100 + i, vectors[i].tolist()) for i in (7, 20, 30, 40, 50, 60, 70)], "query_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): r.id for r in R.dense_topk(docs, questions, k=4).collect()}
    assert len(got) == 7 * 4
    for q in questions.collect():
        a = np.array(q.embedding)
        cos = {i: round(float(a @ v / (np.linalg.norm(a) * (np.linalg.norm(v) or 1))), 6) for i, v in vectors.items()}
        want = sorted(cos, key=lambda i: (-cos[i], i))[:4]
        assert [got[q.query_id, n] for n in range(1, 5)] == want


def test_bm25_topk(spark, small_blocks):
    rng = random.Random(4)
    words = ["radio", "signal", "slow", "Été", "reboot", "x1"] + [f"w{i}" for i in range(40)]
    docs = {i: " ".join(rng.choices(words, k=rng.randint(3, 60))) for i in range(200)}
    docs[5] = docs[6]
    questions = {i: " ".join(rng.choices(words, k=4)) for i in range(7)} | {8: "nothing-known"}
    df = spark.createDataFrame(list(docs.items()), "id long, text string").repartition(5)
    qs = spark.createDataFrame(list(questions.items()), "query_id long, text string")
    got = {}
    for r in R.bm25_topk(df, qs, k=3).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.id
    tokens = {i: re.findall(r"[^\W_]+", t.lower()) for i, t in docs.items()}
    mean = sum(map(len, tokens.values())) / len(tokens)
    df_of = Counter(w for t in tokens.values() for w in set(t))
    for q, text in questions.items():
        scores = {}
        for i, t in tokens.items():
            tf = Counter(t)
            norm = search.K1 * (1 - search.B + search.B * len(t) / mean)
            scores[i] = round(sum(
                n * math.log(1 + (len(docs) - df_of[w] + 0.5) / (df_of[w] + 0.5)) * tf[w] * (search.K1 + 1) / (tf[w] + norm)
                for w, n in Counter(re.findall(r"[^\W_]+", text.lower())).items() if tf[w]), 6)
        want = [i for i in sorted(scores, key=lambda i: (-scores[i], i)) if scores[i] > 0][:3]
        assert [got.get(q, {}).get(n) for n in range(1, len(want) + 1)] == want


def test_an_index_serves_again(spark, small_blocks):
    docs = spark.createDataFrame([(i, f"common word{i % 9} rare{i}") for i in range(150)], "id long, text string").repartition(3)
    index = search.index_texts(docs)
    for number in (3, 77):
        question = spark.createDataFrame([(number, f"common rare{number} unheard")], "query_id long, text string")
        assert rows_of(R.bm25_topk(index, question)) == rows_of(R.bm25_topk(docs, question))
        assert R.bm25_topk(index, question).orderBy("rank").first().id == number
    nothing = spark.createDataFrame([(1, "unheard"), (2, None)], "query_id long, text string")
    assert R.bm25_topk(index, nothing).count() == 0 and R.bm25_topk(docs.limit(0), nothing).count() == 0


def test_shelves_without_a_chance_are_closed(spark, small_blocks):
    # Every text has the common words; only the question's own has the rare ones.
    docs = spark.createDataFrame([(i, f"the of and to a{i} b{i} c{i}") for i in range(400)], "id long, text string").repartition(3)
    asked = spark.createDataFrame([(i, f"the of and a{i} b{i}") for i in range(0, 400, 40)], "query_id long, text string")
    index = search.index_texts(docs)
    frequency = index.blocks.groupBy("word").agg(F.sum("n").alias("df"))
    weights = search.asked_words(asked).join(frequency, "word").withColumn("weight", F.log(1 + 400 / F.col("df")))
    opened = search.open_shelves(index, weights, 1)
    assert opened.count() == 10 and R.bm25_topk(index, asked, k=1).where("id <> query_id").isEmpty()


def test_few_texts_are_scored_in_full():
    """Of one shelf, and with the best score known, under a fifth of the texts that share a word with a question is scored to the end."""
    rng = np.random.default_rng(8)
    n, full, pairs = 2000, 0, 0
    for _ in range(20):
        words_of, sums = [], np.zeros(n)
        for df in (3, 10, 40, 200, 900, 1500, 1900):
            places, impacts = rng.choice(n, df, replace=False), rng.uniform(0.4, 2.2, df)
            weight = math.log(1 + n / df)
            words_of.append((weight * impacts.max(), weight, places, impacts))
            sums[places] += weight * impacts
        least = float(np.sort(sums)[-5])
        alive, scores = search.score_shelf(words_of, n, least)
        assert set(np.flatnonzero(sums >= least)) == set(alive.tolist())
        assert np.allclose(scores, sums[alive])
        full, pairs = full + len(alive), pairs + int((sums > 0).sum())
    assert full < pairs / 5


def test_cells_without_a_chance_are_closed(spark, small_blocks):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(12, 16))
    rows = [(i, (centers[i % 12] + rng.normal(scale=0.02, size=16)).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(5000, None), (5001, [0.0] * 16)]
    vectors = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(4)
    asked = spark.createDataFrame([(i, centers[i].tolist()) for i in range(12)] + [(12, [0.0] * 16)], "query_id long, embedding array<double>")
    index = search.index_vectors(vectors)
    cells = index.cells.count()
    opened = search.open_cells(index, asked.where("query_id < 12"), 5).count()
    assert opened < 12 * cells / 3
    table = {i: np.array(v) for i, v in rows if v}
    got = {}
    for r in R.dense_topk(index, asked).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.id
    for q in asked.collect():
        a = np.array(q.embedding)
        cos = {i: round(float(a @ v / ((np.linalg.norm(a) * np.linalg.norm(v)) or 1)), 6) for i, v in table.items()}
        assert [got[q.query_id][n] for n in range(1, 6)] == sorted(cos, key=lambda i: (-cos[i], i))[:5]
    assert R.dense_topk(vectors.limit(0), asked).count() == 0


def test_fusion_and_context(spark):
    hits = "query_id long, id long, score double, rank int"
    sparse = spark.createDataFrame([(1, 10, 9.0, 1), (1, 11, 8.0, 2)], hits)
    dense = spark.createDataFrame([(1, 11, 0.9, 1), (1, 12, 0.8, 2)], hits)
    fused = R.fuse(sparse, dense, k=2)
    assert [r.id for r in fused.orderBy("rank").collect()] == [11, 12]
    texts = spark.createDataFrame([(11, "eleven"), (12, "twelve")], "id long, text string")
    assert R.context(fused, texts).first().context == "eleven\n\n---\n\ntwelve"
    relevant = spark.createDataFrame([(11, 1), (12, 0)], "id long, relevant int")
    assert rows_of(R.precision_at_k(fused, relevant)) == [(1, 2, 0.5)]


def test_report_levels(spark):
    cases = spark.createDataFrame([("a", "easy", 1.0, 0.2), ("a", "hard", 0.0, 1.0), ("b", "hard", 1.0, 1.0)],
                                  "category string, difficulty string, m double, n double")
    got = {(r.level, r.category or r.difficulty): (r.cases, r.low_cases) for r in R.evaluation_report(cases, ["m", "n"]).collect()}
    assert got == {("overall", None): (3, 2), ("category", "a"): (2, 2), ("category", "b"): (1, 0),
                   ("difficulty", "easy"): (1, 1), ("difficulty", "hard"): (2, 1)}
    assert R.low_cases(cases, ["m", "n"]).count() == 2


def test_an_index_cuts_its_texts_into_words_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    rows = [(1, "a b a"), (1, "a b a"), (1, "a c"), (2, None), (3, " .. "), (None, "b d é"), (4, "É")]
    docs = spark.createDataFrame(rows, "id long, text string")
    docs = docs.withColumn("text", F.udf(seen).asNondeterministic()("text"))
    for words in (None, [("a",), ("é",), ("none",)]):
        read.value = 0
        vocabulary = spark.createDataFrame(words, "word string") if words else None
        index = search.index_texts(docs, vocabulary)
        assert index.texts == 7 and read.value == 7
        mean = (3 + 3 + 2 + 0 + 3 + 1) / 6
        got = {r.word: {i: (r.n, round(r.top, 9), round(x, 9)) for i, x in zip(r.ids, r.impacts)} for r in index.blocks.collect()}
        # Rows of one id and length are one text; another length is another one.
        impact = lambda n, length: round(n * 2.5 / (n + 1.5 * (0.25 + 0.75 * length / mean)), 9)
        assert set(got) == ({"a", "é"} if words else {"a", "b", "c", "d", "é"})
        assert {i: x for i, (_, _, x) in got["é"].items()} == {None: impact(1, 3), 4: impact(1, 1)}
        a = index.blocks.where("word = 'a'").first()
        assert sorted((round(x, 9) for x in a.impacts)) == sorted([impact(4, 3), impact(1, 2)]) and a.n == 2 and round(a.top, 9) == impact(4, 3)
