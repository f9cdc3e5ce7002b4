"""Quality rules, language, grades and language-model scores against plain Python."""

import math
import time
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from qoelens.llm import context_tree, grades, language, quality_rules
from qoelens.llm import textbytes as B
from qoelens.llm.store import drop_finished

from .common import ROWS, SCHEMA, by_id, corpus, fold_of, words


def plain_counts(text):
    text = text or ""
    tokens = words(text, fold=False)
    lines = [line for line in text.split("\n") if words(line)]
    grams = [tuple(tokens[i:i + 5]) for i in range(len(tokens) - 4)]
    often, covered = Counter(grams), set()
    for i, gram in enumerate(grams):
        if often[gram] > 1:
            covered.update(range(i, i + 5))
    return {
        "n_words": len(tokens), "word_chars": sum(map(len, tokens)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def test_base_counts_and_base_test(spark):
    found = by_id(quality_rules.verdicts(corpus(spark)))
    assert len(found) == len(ROWS)
    texts = dict((r[0], r[1]) for r in ROWS)
    for row in found:
        want = plain_counts(texts[row["doc_id"]])
        assert {k: row[k] for k in want} == want
        failed = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert row["base_failed"] == failed
        assert not (failed and row["kept"])


def test_counts_do_not_depend_on_the_neighbour():
    texts = [".. a 'b'", "'quoted' **", "", "** starred", None, "* one more"]
    alone = [quality_rules.counts(*B.text_bytes(pa.array([t], pa.string()))) for t in texts]
    together = quality_rules.counts(*B.text_bytes(pa.array(texts)))
    for name, found in together.items():
        assert found.tolist() == [int(a[name][0]) for a in alone], name
    assert together["n_doubled"].tolist() == [1, 1, 0, 1, 0, 0]


def test_rules_separate_junk_from_prose(spark):
    prose = [(i, " ".join(f"word{(i * 31 + k * 7) % 997} and" for k in range(40)) + ".", "en", "a") for i in range(300)]
    junk = [(1000 + i, " ".join(f"w{(i + k) % 89}%%% |" for k in range(40)), "en", "a") for i in range(40)]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.verdicts(corpus(spark, prose + junk)).collect()}
    assert all(kept[i] for i, *_ in prose)
    assert not any(kept[i] for i, *_ in junk)
    docs = corpus(spark, prose + junk)
    stayed = quality_rules.keep_good(docs)
    assert stayed.columns == docs.columns
    assert sorted(r["doc_id"] for r in stayed.collect()) == [i for i, *_ in prose]


def test_estimate_finds_a_planted_model():
    rng = np.random.default_rng(3)
    names = list(quality_rules.RULES)
    good = rng.random(20000) < 0.8
    right_good, right_bad = rng.uniform(0.85, 0.99, len(names)), rng.uniform(0.6, 0.9, len(names))
    votes = np.where(good[:, None], np.where(rng.random((20000, len(names))) < right_good, 1, -1),
                     np.where(rng.random((20000, len(names))) < right_bad, -1, 1))
    codes = Counter(((votes + 1) @ (3 ** np.arange(len(names) - 1, -1, -1))).tolist())
    model = quality_rules.estimate(codes)
    assert abs(model.prior - 0.8) < 0.02
    assert max(abs(model.right_on_good[n] - r) for n, r in zip(names, right_good)) < 0.02
    assert max(abs(model.right_on_bad[n] - r) for n, r in zip(names, right_bad)) < 0.04


def test_shingles_and_lines_cross_no_document():
    data, offsets = B.text_bytes(pa.array(["ab", "cd ef", None, "", "ab"]))
    _, _, hashes, bounds = B.words(data, offsets, lower=True)
    assert np.diff(bounds).tolist() == [1, 2, 0, 0, 1]
    assert hashes[0] == hashes[3] and len(set(hashes.tolist())) == 3


def test_pieces_of_any_size_hash_alike(monkeypatch):
    text = "Some words, " * 500 + "y" * 300
    data, offsets = B.text_bytes(pa.array([text, "tail"]))
    whole = B.words(data, offsets, lower=True)
    monkeypatch.setattr(B, "PIECE", 64)
    for a, b in zip(whole, B.words(data, offsets, lower=True)):
        assert (a == b).all()


def plain_rank(text, most):
    data = np.frombuffer((text or "").encode(), np.uint8)
    blank, symbols = True, [0]
    for b in data.tolist():
        s = int(language._SYMBOL[b])
        if s or not blank:
            symbols.append(s)
        blank = s == 0
    if symbols[-1]:
        symbols.append(0)
    grams = Counter()
    for i, s in enumerate(symbols):
        if s:
            grams[s] += 1
        if i + 1 < len(symbols):
            grams[64 + s * 64 + symbols[i + 1]] += 1
        if i + 2 < len(symbols):
            grams[64 + 4096 + (s * 64 + symbols[i + 1]) * 64 + symbols[i + 2]] += 1
    return grams, [g for g, _ in sorted(grams.items(), key=lambda x: (-x[1], x[0]))[:most]]


def test_language_by_out_of_place_distance(spark):
    found = by_id(language.learn_and_identify(corpus(spark)))
    totals = defaultdict(Counter)
    for doc_id, text, lang, _ in ROWS:
        if lang and text and fold_of(doc_id, 5):
            totals[lang].update(plain_rank(text, 10**9)[0])
    profiles = {
        lang: {g: i for i, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:language.PROFILE])}
        for lang, c in totals.items()
    }
    texts = dict((r[0], r[1]) for r in ROWS)
    for row in found:
        text = texts[row["doc_id"]]
        assert row["held_out"] == (fold_of(row["doc_id"], 5) == 0)
        if not any(c.isalpha() for c in text or ""):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        own = plain_rank(text, language.PROFILE)[1]
        distance = {
            lang: sum(abs(p[g] - i) if g in p else language.PROFILE for i, g in enumerate(own)) for lang, p in profiles.items()
        }
        best = min(sorted(distance), key=distance.get)
        assert row["lang_pred"] == best
        assert row["score"] == pytest.approx(1 - distance[best] / (language.PROFILE * len(own)))


def test_language_without_learning(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert language.learn_and_identify(empty).count() == 0
    assert language.learn(empty) == {}
    assert {r["lang_pred"] for r in language.identify(corpus(spark), {}).collect()} == {"und"}


def test_word_base_of_language_model(spark, monkeypatch):
    monkeypatch.setattr(context_tree, "COMMON_WORDS", 5)
    found = by_id(context_tree.learn_and_score(corpus(spark)))
    counts = Counter()
    for doc_id, text, *_ in ROWS:
        if fold_of(doc_id, 7) != 2:
            counts.update([*words(text), "\0end"])
    n, v = sum(counts.values()), len(counts)
    texts = dict((r[0], r[1]) for r in ROWS)
    assert len(found) == len(ROWS)
    for row in found:
        tokens = [*words(texts[row["doc_id"]]), "\0end"]
        assert row["n_tokens"] == len(tokens) and row["train_tokens"] == n
        assert row["n_known"] == sum(counts[t] > 0 for t in tokens)
        assert row["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens))
        assert row["held_out"] == (fold_of(row["doc_id"], 7) == 2)
        assert row["score"] < 0


def test_context_tree_weighting_by_hand():
    texts = ["Abab abba.", "", "ab", "é\nab 12 ab"]
    data, offsets = B.text_bytes(pa.array(texts))
    codes, starts = context_tree._codes(data, offsets)
    keys, often = np.unique(codes, return_counts=True)
    log_p = context_tree.model(keys.astype(np.int64), often)
    assert np.allclose((10 ** log_p.reshape(-1, 256).astype(float)).sum(axis=1), 1, atol=1e-5)

    def context(seq, i):
        return tuple(int(context_tree._CLASS[seq[i - 1 - j]]) if i - 1 - j >= 0 else 27 for j in range(3))

    seqs = [[*t.lower().encode(), 0xFF] for t in texts]
    counts, children = defaultdict(lambda: [0, 0]), defaultdict(set)
    for seq in seqs:
        for i, byte in enumerate(seq):
            c = context(seq, i)
            for depth in range(4):
                prefix = 1
                for bit in range(7, -1, -1):
                    counts[c[:depth], prefix][byte >> bit & 1] += 1
                    if depth:
                        children[c[:depth - 1], prefix].add(c[:depth])
                    prefix = prefix * 2 + (byte >> bit & 1)

    def own(node):
        z, o = counts[node]
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.lgamma(z + o + 1) - math.log(math.pi)

    def below(c, prefix):
        return sum(weighted(k, prefix) for k in children[c, prefix])

    def weighted(c, prefix):
        return own((c, prefix)) if len(c) == 3 else np.logaddexp(own((c, prefix)), below(c, prefix)) - math.log(2)

    def one(c, prefix):
        p = 0.5
        for depth in range(3, -1, -1):
            if (c[:depth], prefix) in counts:
                z, o = counts[c[:depth], prefix]
                e = (o + 0.5) / (z + o + 1)
                lead = 1.0 if depth == 3 else 1 / (1 + math.exp(below(c[:depth], prefix) - own((c[:depth], prefix))))
                p = lead * e + (1 - lead) * p
        return p

    for seq in [*seqs, [*b"zzq ab"]]:
        for i, byte in enumerate(seq):
            c, prefix, want = context(seq, i), 1, 0.0
            for bit in range(7, -1, -1):
                p = one(c, prefix)
                want += math.log10(p if byte >> bit & 1 else 1 - p)
                prefix = prefix * 2 + (byte >> bit & 1)
            assert log_p[(c[2] * 1600 + c[1] * 40 + c[0]) * 256 + byte] == pytest.approx(want, abs=1e-4)


@pytest.mark.parametrize("step", [8, 1 << 20])
def test_scores_see_whole_contexts(spark, monkeypatch, step):
    """In one fragment and in many: weighting over 0 to 7 unfolded bytes, worked out node by node."""
    monkeypatch.setattr(context_tree, "SAMPLE_STEP", step)
    monkeypatch.setattr(context_tree, "FRAGMENT_SAMPLES", 1)
    texts = ["Abab abba. number 1234 or 1235", "", "ab", "\u00e9\nab 12 ab \u4e2d\u6587 \u4e2d\u6587", "number 1239 or 1235", None, "zzq number 7 abba \u00e8"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    splits = context_tree.fragment_splits(docs)
    assert (len(splits) > 4) == (step == 8)
    seqs = [[*(t or "").translate({c: c + 32 for c in range(65, 91)}).encode(), 0xFF] for t in texts]
    depth_of = context_tree.CONTEXT_BYTES

    def context(seq, i):
        return tuple(seq[i - 1 - j] if i - 1 - j >= 0 else 0x0A for j in range(depth_of))

    counts, children = defaultdict(lambda: [0, 0]), defaultdict(set)
    for seq in seqs[:5]:
        for i, byte in enumerate(seq):
            c, prefix = context(seq, i), 1
            for bit in range(7, -1, -1):
                for depth in range(depth_of + 1):
                    counts[c[:depth], prefix][byte >> bit & 1] += 1
                    if depth:
                        children[c[:depth - 1], prefix].add(c[:depth])
                prefix = prefix * 2 + (byte >> bit & 1)

    def own(c, prefix):
        z, o = counts[c, prefix]
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.lgamma(z + o + 1) - math.log(math.pi)

    def below(c, prefix):
        return sum(weighted(k, prefix) for k in children[c, prefix])

    def weighted(c, prefix):
        return own(c, prefix) if len(c) == depth_of else np.logaddexp(own(c, prefix), below(c, prefix)) - math.log(2)

    def one(c, prefix):
        p = 0.5
        for depth in range(depth_of, -1, -1):
            if (c[:depth], prefix) in counts:
                z, o = counts[c[:depth], prefix]
                lead = 1.0 if depth == depth_of else 1 / (1 + math.exp(below(c[:depth], prefix) - own(c[:depth], prefix)))
                p = lead * (o + 0.5) / (z + o + 1) + (1 - lead) * p
        return p

    found = {r["doc_id"]: r["score"] for r in context_tree.score(docs, docs.where("doc_id < 5")).collect()}
    for doc_id, seq in enumerate(seqs):
        want = 0.0
        for i, byte in enumerate(seq):
            prefix = 1
            for bit in range(7, -1, -1):
                p = one(context(seq, i), prefix)
                want += math.log10(p if byte >> bit & 1 else 1 - p)
                prefix = prefix * 2 + (byte >> bit & 1)
        assert found[doc_id] == pytest.approx(want, abs=1e-6)


def test_scores_without_training(spark):
    docs = corpus(spark)
    found = context_tree.score(docs, docs.limit(0))
    row = found.where("doc_id = 10").first()
    assert row["n_known"] == 0 and row["train_tokens"] == 0
    assert row["score"] == pytest.approx(14 * 8 * math.log10(0.5), rel=1e-5)
    assert context_tree.learn_and_score(docs.limit(0)).count() == 0


def test_grades_hold_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    graded = grades.learn_and_grade(docs, labels)
    assert graded.count() == docs.count()
    judged = graded.join(grades.rating(labels), "doc_id").where("held_out")
    right = judged.agg(F.avg((F.col("kept") == (F.col("grade") == 2)).cast("double"))).first()[0]
    assert right > 0.8
    assert graded.where("expected_grade < 0 or expected_grade > 2 or p_top > expected_grade").isEmpty()


def test_grades_odd_rows(spark):
    docs = corpus(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (3, 1, 0), (13, 0, 0), (14, 0, None), (16, None, 1), (None, 1, 1), (99, 0, 0)], "doc_id bigint, quality int, toxic int"
    )
    found = grades.learn_and_grade(docs, labels)
    assert found.count() == len(ROWS) and found.where("p_top is null").isEmpty()
    assert grades.learn_and_grade(docs, labels.limit(0)).where("not kept").isEmpty()
    assert grades.learn_and_grade(docs.limit(0), labels).count() == 0


def test_postings_of_small_batches_share_a_slice_and_number_the_longest_text_first(spark):
    from qoelens.llm import context_tree as CT

    texts = [(i, "abc" * (i % 7 + 1)) for i in range(30)] + [(30, "xyz" * 40), (31, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    common = spark.sparkContext.broadcast((np.empty(0, np.uint64), np.empty(0)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        rows = docs.mapInArrow(CT._postings(np.empty(0, np.uint64), common), CT._POSTINGS).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len({r.slice for r in rows}) == 1 and len(rows) == 2
    known = pa.ipc.open_stream(next(r["keys"] for r in rows if r.fragment < 0)).read_all()
    coded = known.column("n_coded").to_pylist()
    assert known.column("doc_id")[0].as_py() == 30 and coded == sorted(coded, reverse=True) and len(coded) == 32


def postings_of(monkeypatch, texts, splits):
    monkeypatch.setattr(context_tree, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    common = SimpleNamespace(value=(np.empty(0, np.uint64), np.empty(0)))
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["doc_id", "text"])
    for out in context_tree._postings(splits, common)(iter([batch])):
        yield from out.to_pylist()


@pytest.mark.parametrize("part", [1, 40, 1 << 20])
@pytest.mark.parametrize("most", [40, 1 << 62])
def test_postings_part_by_part_name_every_byte_once(monkeypatch, part, most):
    texts = ["Abab abba", None, "", "a", "ab" * 30, "\u00e9\nab 12", "b" * 70, "Abab abba"] * 3
    by_key = context_tree._by_key
    # Places and owners that do not fit one number are put in order otherwise.
    monkeypatch.setattr(context_tree, "_by_key", lambda keys, owners, _: by_key(keys, owners, most))
    monkeypatch.setattr(context_tree, "POSTINGS_PART", part)
    longest_first = sorted(range(len(texts)), key=lambda i: -len((texts[i] or "").encode()))
    want = Counter()
    for number, i in enumerate(longest_first):
        coded = [*(texts[i] or "").lower().encode(), 0xFF]
        for k, byte in enumerate(coded):
            before = [coded[k - 1 - j] if k - 1 - j >= 0 else 0x0A for j in range(context_tree.CONTEXT_BYTES)]
            want[int.from_bytes(bytes([*before, byte]), "big"), number] += 1
    splits = np.array(sorted({key for key, _ in want})[5::9], np.uint64)
    found, fragments = Counter(), []
    for row in postings_of(monkeypatch, texts, splits):
        if row["fragment"] < 0:
            continue
        fragments.append(row["fragment"])
        keys, often = context_tree._unpacked_keys(row["keys"]), context_tree._unpacked(row["often"]).tolist()
        assert (np.searchsorted(splits, keys, side="right") == row["fragment"]).all() and (np.diff(keys.astype(object)) > 0).all()
        steps = iter(context_tree._unpacked(row["owners"]).tolist())
        for key, n in zip(keys.tolist(), often):
            owner = 0
            for _ in range(n):
                owner += next(steps)
                found[key, owner] += 1
        assert next(steps, None) is None
    assert found == want and fragments == sorted(set(fragments))


def test_postings_hold_little_beside_the_keys(monkeypatch):
    """Workers sort a few fragments of a slice at a time, not the whole slice."""
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 123, 50_000, dtype=np.uint8)).decode() for _ in range(40)]
    keys = np.sort(rng.integers(0x61 << 56, 0x7B << 56, 64, dtype=np.uint64))
    monkeypatch.setattr(context_tree, "POSTINGS_PART", 1 << 16, raising=False)
    tracemalloc.start()
    try:
        for _ in postings_of(monkeypatch, texts, keys):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 25 * 40 * 50_001


def test_finished_shuffles_leave_the_disk(spark, tmp_path):
    def files():
        held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for k in range(held.size()) if (name := held.apply(k).getName()).startswith("shuffle_")}

    before = files()
    spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(str(tmp_path / "out"))
    made = files() - before
    assert made
    spark.range(50, numPartitions=2).groupBy("id").count().write.parquet(str(tmp_path / "next"))
    drop_finished(spark)
    until = time.monotonic() + 15
    while made & files() and time.monotonic() < until:
        time.sleep(0.2)
    assert not made & files()
