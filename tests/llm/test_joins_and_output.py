"""Near duplicates, mixing, token output and the pipeline against plain Python."""

import random
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from qoelens.llm import encoding, jaccard, mixing, token_store
from qoelens.llm import textbytes as B
from qoelens.llm.components import components
from qoelens.llm.encoding import public_tokenizer
from qoelens.llm.store import small_batches

from .common import ROWS, SCHEMA, by_id, corpus, words


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def plain_components(rows):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    sets = {}
    for r in rows:
        if r[0] is not None:
            sets.setdefault(r[0], []).append(shingles(r[1]))
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {i: root(i) for i in ids}


def family(rng, n, size):
    base = [f"f{rng.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, max(1, size // 30))):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def check_components(spark, rows):
    found = by_id(jaccard.near_duplicates(corpus(spark, rows)))
    want = plain_components(rows)
    assert len(found) == len(rows)
    sizes = Counter((r[0], len(shingles(r[1]))) for r in rows)
    assert Counter((r["doc_id"], r["n_shingles"]) for r in found) == sizes
    assert {r["doc_id"]: r["component_id"] for r in found if r["doc_id"] is not None} == want


def test_near_duplicates(spark):
    rng = random.Random(2)
    texts = family(rng, 40, 60) + family(rng, 15, 200) + family(rng, 25, 12)
    passage = [f"p{i}" for i in range(80)]
    # Much of these is shared, but few pairs reach the threshold.
    texts += [" ".join([f"o{rng.randrange(10**6)}" for _ in range(rng.randint(0, 40))] + passage) for _ in range(40)]
    chain = [f"c{i}" for i in range(120)]
    texts += [" ".join(chain[i:i + 60]) for i in range(0, 60, 4)]
    rng.shuffle(texts)
    rows = list(ROWS) + [(100 + i, t, None, None) for i, t in enumerate(texts)] + [(None, ROWS[0][1], None, None)]
    check_components(spark, rows)


def test_near_duplicates_of_nothing(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    check_components(spark, [(1, None, None, None), (2, "", None, None)])


def test_one_document_with_several_texts(spark):
    rng = random.Random(4)
    a, b = family(rng, 2, 80), family(rng, 2, 80)
    check_components(spark, [(1, a[0], None, None), (5, a[1], None, None), (5, b[0], None, None), (3, b[1], None, None)])


def test_keep_first(spark):
    docs = corpus(spark, list(ROWS) + [(None, "no id", None, None)])
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    label = plain_components(ROWS)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted([i for i in label if label[i] == i] + [0])


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(5, 2), (2, 9), (9, 7), (4, 3), (3, 4), (3, 4)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)]])
def test_components(spark, edges):
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        assert found[node] == min(seen)
    assert set(found) == set(near)


def test_targets():
    assert mixing.targets({"a": 100, "b": 100, "c": 100}) == pytest.approx({"a": 187.5, "b": 75, "c": 37.5})
    # The first stops at three times its words; the rest is shared out 2 to 1.
    assert mixing.targets({"a": 10, "b": 145, "c": 145}) == pytest.approx({"a": 30, "b": 180, "c": 90})
    assert mixing.targets({None: 6, "b": 0, "a": 6}) == pytest.approx({"a": 10, "b": 0, None: 2})
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0.0}


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 500):
        size, p = rng.integers(0, 50, n), rng.random(n)
        out = mixing.fly(size, p)
        assert out.sum() == pytest.approx(p.sum(), abs=1e-6) and (out * size).sum() == pytest.approx((p * size).sum(), abs=1e-4)
        assert np.count_nonzero((out > 1e-9) & (out < 1 - 1e-9)) <= 2
    same = mixing.fly(np.full(100, 7), np.full(100, 0.3))
    assert same.sum() == pytest.approx(30)


def test_flight_keeps_expectations():
    size = np.array([3, 9, 4, 20, 7, 1, 30, 12])
    total = np.zeros(8)
    for seed in range(400):
        order = np.random.default_rng(seed).permutation(8)
        mixing.SEED, old = seed, mixing.SEED
        total[order] += mixing.fly(size[order], np.full(8, 0.4))
        mixing.SEED = old
    assert np.abs(total / 400 - 0.4).max() < 0.12


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 64)
    rng = random.Random(9)
    rows = list(ROWS) + [(1000 + i, "w " * rng.randint(0, 60), None, rng.choice("aaaaaabbcdd")) for i in range(1500)]
    docs = corpus(spark, rows)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    totals = Counter()
    for r in rows:
        totals[r[3]] += len(words(r[1]))
    want = mixing.targets(totals)
    taken = Counter()
    for r in found:
        assert r["source_size"] == totals[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["times"] * r["size"] and 0 <= r["times"] <= 3
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        largest = max(len(words(r[1])) for r in rows if r[3] == source)
        assert abs(taken[source] - target) <= max(largest, 60), source
    again = mixing.mix(docs.repartition(5))
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, again.collect()), key=repr)
    out = mixing.take(docs)
    assert out.columns == docs.columns
    times = {}
    for r in found:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + r["times"]
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({k: v for k, v in times.items() if v})


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).count() == 0 and mixing.take(empty).count() == 0
    assert [r["taken"] for r in mixing.mix(corpus(spark, [(1, None, None, None), (2, "", None, "a")])).collect()] == [0, 0]


def test_equal_rows_are_drawn_one_by_one(spark):
    small_batches(spark)
    same = [(None, "w " * 20, "en", "hot")] * 3000 + [(5, "w " * 20, "en", "hot")] * 40
    rows = same + [(i, "v " * 10, "en", "a" if i % 2 else "b") for i in range(300)]
    docs = corpus(spark, rows).withColumn("_times", F.lit(1)).withColumn("key", F.lit("k")).withColumn("number", F.lit(2))
    found = mixing.mix(docs).collect()
    want = mixing.targets({"hot": 3040 * 20, "a": 1500, "b": 1500})
    taken = Counter()
    for r in found:
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 3 * r["size"]
    assert len(found) == len(rows) and all(abs(taken[s] - t) <= 60 for s, t in want.items())
    out = mixing.take(docs)
    assert out.columns == docs.columns
    words_out = Counter()
    for r in out.collect():
        words_out[r["source"]] += len((r["text"] or "").split())
    assert words_out == taken


def test_rows_of_one_doc_id_are_taken_as_the_mix_says(spark):
    small_batches(spark)
    rows = [(1, " ".join(["w"] * n), "en", "a") for n in range(1, 200)] + [(2, "x " * 500, "en", "b"), (3, "y " * 900, "en", None)]
    docs = corpus(spark, rows)
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r["doc_id"], r["size"]] += r["times"]
    have = Counter((r["doc_id"], len(r["text"].split())) for r in mixing.take(docs).collect())
    assert have == Counter({k: v for k, v in want.items() if v})


def test_words_that_collide_modulo_powers_of_two():
    line = "a"
    while len(line) < 1024:
        line += line.translate({97: 98, 98: 97})
    other = line.translate({97: 98, 98: 97})
    _, _, hashes, _ = B.words(*B.text_bytes(pa.array([f"{line} {other} {'x' * (B.LONGEST + 9)} {'x' * (B.LONGEST + 9)} {'x' * (B.LONGEST + 8)}"])), False)
    assert hashes[0] != hashes[1] and hashes[2] == hashes[3] != hashes[4]


@pytest.mark.parametrize("n", [0, 1, 2, 59, 60, 61, 1000])
@pytest.mark.parametrize("high", [1, 2, 100, 49408, 1 << 40, 1 << 63])
def test_pack_round_trip(n, high):
    ids = np.random.default_rng(n).integers(0, high, n).astype(np.uint64)
    if n > 2:
        ids[1] = 2**64 - 1
        ids[2] = 1 << 60
    packed = token_store.pack(ids)
    assert (token_store.unpack(packed, n) == ids).all()
    assert len(packed) <= 2 * n


WORD_BPE = public_tokenizer("word_bpe_49k.json")


TRICKY = [
    "", "  a\x1cb c", "ÉCOLE it's I'LL 12 ab!!　x y\x85z\xa0w", "é ́x <|endoftext|> ﬁ İ ΟΔΟΣ Σ​x ǅ", "\x00a\x7f z ½ ²x 中文字 한국 \U0001f600",
    "don't 'd 'S we'Re ''s", "á Å Å",
]


@pytest.mark.parametrize("most", [2, 10_000])
def test_ids_are_the_tokenizers(monkeypatch, most):
    monkeypatch.setattr(encoding, "MOST", most)
    texts = [
        *TRICKY, *(r[1] or "" for r in ROWS), "a <|endoftext|> b", "<|startoftext|>hello", "x<|endoftext|><|startoftext|>Y's <|ENDOFTEXT|>",
        "\xe9<|endoftext|>\u0301 a", "<|endoftext|",
    ]
    encoder, library = encoding.Encoder(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    for part in (texts[:5], texts, texts[::-1]):
        for text, raw in zip(part, encoder.encode(part)):
            assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_IDS", 50)
    rows = list(ROWS) + [(300 + i, t, None, None) for i, t in enumerate(TRICKY)]
    folder = str(tmp_path / "tokens")
    token_store.write(corpus(spark, rows), folder, WORD_BPE)
    found, plain, at = token_store.digests(spark, folder).orderBy("start").collect(), Tokenizer.from_file(WORD_BPE), 0
    texts = {r[0]: r[1] or "" for r in rows}
    assert [r["doc_id"] for r in found] == sorted(r[0] for r in rows)
    for row in found:
        ids = [*plain.encode(texts[row["doc_id"]], add_special_tokens=False).ids, 1]
        assert (row["start"], row["n_tokens"]) == (at, len(ids))
        assert row["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        at += len(ids)
    assert {r["doc_id"]: r["ids"] for r in token_store.read(spark, folder).collect()}[10] == [*plain.encode("one two three").ids, 1]


def test_no_tokens(spark, tmp_path):
    folder = str(tmp_path / "tokens")
    token_store.write(spark.createDataFrame([], SCHEMA), folder, WORD_BPE)
    assert token_store.digests(spark, folder).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as pipeline
    from qoelens.llm import decontaminate, quality_rules

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = {r["doc_id"] for r in quality_rules.verdicts(docs).where("kept").collect()}
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect() if r["doc_id"] in good]
    label = plain_components(rows)
    first = [r for r in rows if label[r[0]] == r[0]]
    leaks = decontaminate.leaks(corpus(spark, first), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaked = {r["doc_id"] for r in leaks.collect()}
    clean = [r for r in first if r[0] not in leaked]
    times = {r["doc_id"]: r["times"] for r in mixing.mix(corpus(spark, clean)).collect()}
    out = pipeline.run(spark, sf_dir).collect()
    assert Counter(r["doc_id"] for r in out) == Counter({k: v for k, v in times.items() if v})
    ends = sorted((r["start"], r["n_tokens"]) for r in out)
    assert [a + n for a, n in ends[:-1]] == [a for a, _ in ends[1:]] and ends[0][0] == 0
    assert [name for name, _ in pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing", "token_output"
    ]
