"""Conversation trie, vector codes and packing against plain Python."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from qoelens.llm import affine, packing, prefix_trie, vector_codes
from qoelens.llm.encoding import Encoder, public_tokenizer
from qoelens.llm.store import small_batches

from .common import ROWS, corpus

CONV = "conv_id bigint, turn bigint, role string, text string, depth string, part string, m string, k string"


def conversations(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "d", "p", "m", "k") for r in rows], CONV).repartition(parts)


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = turns.get(c - int(math.fmod(c, 100)), [])[:h] + turns[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        path = tuple(built[c])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in members:
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
    return sorted(
        (
            m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def spark_trie(df):
    return sorted(tuple(r)[:8] for r in prefix_trie.trie(df).collect())


def sample_conversations(seed, n=300, longest=9):
    rng = random.Random(seed)
    texts = ["", "hi", "hello there", "é😀", "ok", "tell me more", None]
    rows = []
    for _ in range(n):
        c = rng.choice([0, 100, 200, -100]) + rng.randint(-20, 30)
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for t in range(rng.randint(1, longest))]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie(spark, seed):
    rows = sample_conversations(seed)
    # Ties in turn, NULL turn, rows without conversation, repeated rows.
    rows += [(7, None, "user", "late"), (7, None, None, None), (7, 2, "user", "b"), (7, 2, "user", "a"), (None, 1, "user", "x")]
    rows += [(8, 1, "user", "again")] * 3
    assert spark_trie(conversations(spark, rows)) == plain_trie(rows)


def test_trie_of_one_long_conversation(spark):
    # One conversation holds most rows and spreads over all range partitions; a chain of 150 levels.
    rows = [(300, t, "user", f"turn {t % 7}") for t in range(150)]
    rows += [(300 + i, t, "user", f"turn {t % 7}") for i in range(1, 12) for t in range(8)]
    assert spark_trie(conversations(spark, rows)) == plain_trie(rows)


def test_trie_of_copies_and_very_long_texts(spark):
    rows = [(c, t, "user", "x" * 200_000 if t == 3 else f"t{t}") for c in range(400, 440) for t in range(6)]
    rows += [(500 + c, 0, "user", "same first turn") for c in range(60)]
    assert spark_trie(conversations(spark, rows)) == plain_trie(rows)


def test_trie_edges(spark):
    assert prefix_trie.trie(conversations(spark, [(None, 1, "a", "b")])).collect() == []
    # h of conversation 1 is larger than its turns and its base is absent: nothing is left of it but the root.
    assert zlib.crc32(b"1") % 6 >= 1
    assert spark_trie(conversations(spark, [(1, 0, "user", "only")])) == plain_trie([(1, 0, "user", "only")])


def test_trie_starts_anew_on_equal_products_of_different_turns(spark):
    def weak(seed, role, text):
        # The first seed gives all turns the same map.
        return affine.item(seed, role, text) if seed else (3, 5)

    rows = sample_conversations(3, 60, 4)
    got = prefix_trie.trie(conversations(spark, rows), weak).collect()
    assert sorted(tuple(r)[:8] for r in got) == plain_trie(rows)


def test_products_compose():
    items = [affine.item(1, "user", str(i)) for i in range(9)]

    def product(xs):
        out = affine.ONE
        for x in xs:
            out = affine.then(out, x)
        return out

    whole = product(items)
    assert affine.then(product(items[:4]), product(items[4:])) == whole
    assert affine.then(affine.inverse(product(items[:4])), whole) == product(items[4:])
    rng = np.random.default_rng(3)
    x, y = (rng.integers(0, affine.PRIME, 5000, dtype=np.uint64) for _ in range(2))
    x[:3] = affine.PRIME - 1
    y[:2] = affine.PRIME - 1
    assert affine.times(x, y).tolist() == [int(a) * int(b) % affine.PRIME for a, b in zip(x, y)]


def plain_codes(rows):
    kept = sorted(
        (r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1])
    )
    width = len(kept[0][1]) // 16
    vectors = [[math.floor(256 * x) for x in v] for _, v, _ in kept]

    def part(v, p):
        return v[p * width:(p + 1) * width]

    def near(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), i) for i, y in enumerate(book))

    books = [[part(v, p) for v in vectors[:64]] for p in range(16)]
    for _ in range(2):
        for p, book in enumerate(books):
            groups = defaultdict(list)
            for v in vectors:
                groups[near(book, part(v, p))[1]].append(part(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*groups[i])] if i in groups else y for i, y in enumerate(book)]
    out = []
    for (vec_id, _, label), v in zip(kept, vectors):
        found = [near(books[p], part(v, p)) for p in range(16)]
        out.append((vec_id, label, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    by_label = defaultdict(int)
    for _, label, _, error in out:
        by_label[label] += error
    told = hashlib.sha256(",".join(str(x) for book in books for y in book for x in y).encode()).hexdigest()
    return sorted(((i, lab, code, error, by_label[lab], told) for i, lab, code, error in out), key=repr)


VEC = "vec_id bigint, embedding array<float>, label int, error string, n string"


def spark_codes(spark, rows):
    df = spark.createDataFrame([(*r, "e", "n") for r in rows], VEC).repartition(3)
    return sorted((tuple(r) for r in vector_codes.compress(df).collect()), key=repr)


@pytest.mark.parametrize("n, width", [(300, 64), (40, 16), (150, 32)])
def test_codes(spark, n, width):
    rng = np.random.default_rng(n)
    rows = [(i, np.round(rng.normal(0, 0.02 if i % 3 else 0.4, width), 2).astype(np.float32).tolist(), [None, 1, 2][i % 3]) for i in range(n)]
    rows += [(n + i, rows[5][1], 1) for i in range(50)] + [rows[7], rows[7]]  # copies of a vector, repeated rows
    rows += [(n + 90, None, 1), (n + 91, [None] * width, 1), (n + 92, [float("nan")] * width, 2), (n + 93, [float("inf")] * width, 2), (-5, [], 1)]
    rows += [(None, rows[9][1], 2)]
    assert spark_codes(spark, rows) == plain_codes(rows)


def test_codes_edges(spark):
    assert spark_codes(spark, [(1, None, 1)]) == []
    # Another length than the first usable vector's, and components beyond what a distance can hold.
    got = spark_codes(spark, [(1, [0.5] * 16, 1), (2, [0.5] * 32, 1), (3, [1.0] * 15, 1), (4, [3e38] * 16, 2)])
    assert [r[0] for r in got] == [1, 4] and all(0 <= r[3] < 1 << 62 for r in got)


def test_nearest_goes_on_over_blocks(monkeypatch):
    monkeypatch.setattr(vector_codes, "LEAVES", 7)
    rng = np.random.default_rng(1)
    parts = rng.integers(-3, 4, (500, 4))
    entries = rng.integers(-3, 4, (20, 4))
    leaves, times, which = vector_codes.distinct_parts(parts)
    assert times.sum() == 500 and (leaves[which] == parts).all()
    entry, distance = vector_codes.nearest(leaves, entries)
    want = ((leaves[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (entry == want.argmin(axis=1)).all() and (distance == want.min(axis=1)).all()


BYTE_BPE = public_tokenizer("byte_bpe_50k.json")
ALPHABET = [
    " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "'s", "'S", "a", "B", "zebra", "12", "7", ",", "!?", "é", "École", "œuf,", "İ,", "ŉ", "ſ", "ǅ",
    "ª", "µ", "é", "\xa0", "　", "\u0085", "\x1c", "\x1f", "\x00", "\x7f", "Σ", "ΑΣ", "Ᲊ", "ß", "\U0001f600", "日本",
    "<|endoftext|>", "<|ENDOFTEXT|>", "́", "don't", "We'LL", "​", "﻿", "᠎", "ﬁ", "\U00010d50", "가", "가",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_gives_the_librarys_ids(name):
    path = public_tokenizer(name)
    library, ours, rng = Tokenizer.from_file(path), Encoder(path), random.Random(11)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    texts += [r[1] for r in ROWS] + ["x" * 30_000, "ab " * 20_000]
    # Every letter that is newer than some version of Unicode, next to others.
    texts += [f"a{chr(c)}b {chr(c)}" for c in [*range(0xA7C0, 0xA7DD), *range(0x10D40, 0x10D90), *range(0x16EA0, 0x16ED4), 0x1C89, 0x1C8A]]
    for text, ids in zip(texts, ours.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)


def check_pieces(docs, rows, size):
    """Every id in one piece, sequences without gaps, full but for powers of two. Returns pieces by sequence."""
    library = Tokenizer.from_file(BYTE_BPE)
    want = sorted(
        (r[0], np.array(library.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4").tobytes()) for r in docs
    )
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] > 0 for r in rows)
    # Rows of one doc_id are told apart by their ids: join pieces by how the documents begin.
    held = defaultdict(list)
    for r in rows:
        held[(r["doc_id"], r["doc_tokens"])].append((r["start"], r["ids"]))
    assert sum(len(r["ids"]) for r in rows) == sum(len(ids) for _, ids in want)
    for doc_id, ids in want:
        mine = held[(doc_id, len(ids) // 4)]
        at = 0
        while at < len(ids) // 4:
            piece = next(p for p in mine if p[0] == at and ids[4 * at:4 * at + len(p[1])] == p[1])
            mine.remove(piece)
            at += len(piece[1]) // 4
    assert not any(held.values())
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append(r)
    assert sorted(by) == list(range(len(by)))
    for pieces in by.values():
        pieces.sort(key=lambda r: r["offset"])
        at = 0
        for r in pieces:
            assert r["offset"] == at
            at += r["length"]
        assert at == size or at < size and at & (at - 1) == 0
    return by


def source_texts(rng):
    return [
        (i, " ".join(f"word{rng.randint(0, 99)}" for _ in range(rng.randint(0, 60))), "en", "hot" if i % 3 else rng.choice(["b", "c", None]))
        for i in range(240)
    ]


def test_packing(spark):
    small_batches(spark)
    rows = source_texts(random.Random(2)) + [r[:4] for r in ROWS]
    docs = corpus(spark, rows)
    got = [r.asDict() for r in packing.pack(docs, BYTE_BPE, size=64, least=8).collect()]
    by = check_pieces(rows, got, 64)
    # Target proportions hold in every run of windows, up to what a few pieces can owe.
    share = defaultdict(int)
    for r in got:
        share[r["source"]] += r["length"]
    total, seen = sum(share.values()), defaultdict(int)
    for k in sorted(by)[:-8]:
        for r in by[k]:
            seen[r["source"]] += r["length"]
        for source, n in share.items():
            assert abs(seen[source] - 64 * (k + 1) * n / total) < 64
    held = {r["sequence_id"]: r for r in packing.sequences(packing.pack(docs, BYTE_BPE, size=64, least=8)).collect()}
    assert set(held) == set(by)
    for k, r in held.items():
        assert r["n_tokens"] * 4 == len(r["ids"]) and r["lengths"] == [x["length"] for x in by[k]]
        assert bytes(r["ids"]) == b"".join(x["ids"] for x in by[k])


def test_packing_with_weights(spark):
    small_batches(spark)
    rows = source_texts(random.Random(4))
    got = [r.asDict() for r in packing.pack(corpus(spark, rows), BYTE_BPE, weights={"hot": 1, "b": 1}, size=64, least=8).collect()]
    by = check_pieces(rows, got, 64)
    first = [r for k in range(10) for r in by[k]]
    assert {r["source"] for r in first} == {"hot", "b"}
    n = sum(r["length"] for r in first if r["source"] == "b")
    assert abs(n - 320) <= 32


def test_packing_edges(spark):
    small_batches(spark)
    assert packing.pack(corpus(spark, []), BYTE_BPE).collect() == []
    only = [(1, None, "en", None)]
    assert [(r["length"], r["offset"]) for r in packing.pack(corpus(spark, only), BYTE_BPE).collect()] == [(1, 0)]


@pytest.mark.parametrize("seed", range(6))
def test_windows_serve_their_quotas(seed):
    rng = random.Random(seed)
    for _ in range(25):
        n, size = rng.choice([1, 2, 3, 5, 20, 40]), rng.choice([8, 64, 1024])
        totals = [rng.choice([0, 1, 3, 50, 1000, 30000, 100000]) + rng.randint(0, 9) for _ in range(n)]
        if not sum(totals):
            continue
        weights = None if rng.random() < 0.5 else [rng.choice([0, 1, 2, 5]) for _ in totals]
        plan = packing.phases(totals, weights, size)
        assert [sum(p.quota[s] for p in plan) for s in range(n)] == totals
        layout = packing.Layout(plan, rng.choice([1, 16, 128]), rng.choice([4, 256]))
        for i, phase in enumerate(plan):
            spans = range(min(40, -(-phase.n_windows // layout.span[i])))
            table = layout.windows(i, list(spans))
            for j, grid in zip(spans, table):
                quota = np.array(layout.served(i, j + 1)) - np.array(layout.served(i, j))
                full = min(layout.span[i], phase.n_windows - j * layout.span[i])
                assert grid.min() >= 0 and (grid.sum(axis=0) == quota).all()
                assert (grid.sum(axis=1)[:full] == phase.size).all() and not grid[full:].any()
