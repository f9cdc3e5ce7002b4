"""The trie of all prefixes of rebuilt conversations, by products of turn fingerprints.

A conversation c is rebuilt from the head of its base conversation c - c % 100
(the first h turns, h = crc32 of c's decimal form modulo 6) and its own turns
after the first h. No rebuilt text is ever put together: every turn is a map of
``affine``, stored conversations carry the products of their prefixes, and a
prefix of a rebuilt one is (product of the base's head) x (inverse of the own
first h turns) x (product of the own prefix).

Equal products make a node of the trie. A node is then held against the stored
turns: every prefix refers to its last turn by the SHA-256 of role and text that
is stored with the turn, and the members of a node must agree in that reference
and in their parent. By induction over the depth equal nodes are equal
sequences; if two differ, all is done anew with another seed.

Nothing is gathered per conversation or node: running products are taken over
range partitions, where one conversation may spread over many tasks and only the
products of its stretches meet; a node's members are counted by aggregates that
combine on the map side; sums over subtrees go sixteen levels up in the first
round, 256 in the second, and so on.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_back, materialise
from . import affine
from .store import compact

#: Conversations that share a base, and the values that a head's length can take.
FAMILY, HEADS = 100, 6
#: Conversation ids that are joined into one piece of a digest's input.
_PIECE = 4096
#: Levels that sums go up in a round.
LEAP = 16

_STORED = (
    "conv_id bigint, part int, k bigint, n_chars bigint, told_1 bigint, told_2 bigint, m bigint, a bigint, before_m bigint, before_a bigint"
)
_CARRY = "conv_id bigint, part int, first bigint, carry_m bigint, carry_a bigint"
_TURN = ["n_chars", "told_1", "told_2"]
_PLACED = "conv_id bigint, pos bigint, n_chars bigint, told_1 bigint, told_2 bigint, before_m bigint, before_a bigint, after_m bigint, after_a bigint"
_STORED_ARROW = pa.schema([(c.split()[0], pa.int32() if c.endswith(" int") else pa.int64()) for c in _STORED.split(", ")])
_NODE = ["depth", "m", "a"]
_EMPTY = hashlib.sha256(b"").hexdigest()

NODES = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string"
)


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def reference(role: str, text: str) -> tuple[int, int]:
    """128 bits of the SHA-256 of a turn, as two signed 64-bit numbers."""
    raw = role.encode("utf-8", "surrogatepass")
    digest = hashlib.sha256(len(raw).to_bytes(8, "little") + raw + text.encode("utf-8", "surrogatepass")).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:16], "little", signed=True)


def _running(seed: int, item: Callable[..., affine.Map]):
    """Turns in order -> their place and the product before them within their run, the turns of one conversation in this part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, k, product = TaskContext.get().partitionId(), None, 0, affine.ONE
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for conv, role, text in zip(*columns):
                if conv != last:
                    last, k, product = conv, 0, affine.ONE
                turn = item(seed, role, text)
                out.append((conv, part, k, len(text), *reference(role, text), *turn, *product))
                k, product = k + 1, affine.then(product, turn)
            if out:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*out))), names=_STORED_ARROW.names).cast(_STORED_ARROW)

    return run


def stored_turns(convs: DataFrame, seed: int, item: Callable[..., affine.Map] = affine.item) -> DataFrame:
    """All turns in the order of (conv_id, turn with NULL first, role, text), written with products of their runs."""
    turns = convs.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint"), "turn",
        *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    ordered = turns.repartitionByRange(_parts(turns), *order).sortWithinPartitions(*order)
    return materialise(ordered.drop("turn").mapInArrow(_running(seed, item), _STORED), "turns")


def _carries(stored: DataFrame) -> DataFrame:
    """For conversations that more than one part holds: what stands before each of their runs.

    Only the first and the last conversation of a part can be split, so the
    driver gets a row per part, and a row for each run of those conversations.
    """
    edges = stored.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high")).collect()
    times = Counter(conv for e in edges for conv in {e["low"], e["high"]})
    split = [(conv,) for conv, n in times.items() if n > 1]
    rows = []
    if split:
        some = stored.join(F.broadcast(stored.sparkSession.createDataFrame(split, "conv_id bigint")), "conv_id")
        last = F.max_by(F.struct("k", "m", "a", "before_m", "before_a"), "k").alias("last")
        place, product, conv = 0, affine.ONE, None
        for r in sorted(some.groupBy("conv_id", "part").agg(last).collect(), key=lambda r: (r["conv_id"], r["part"])):
            if r["conv_id"] != conv:
                place, product, conv = 0, affine.ONE, r["conv_id"]
            rows.append((conv, r["part"], place, *product))
            x = r["last"]
            place += x["k"] + 1
            product = affine.then(product, affine.then((x["before_m"], x["before_a"]), (x["m"], x["a"])))
    return stored.sparkSession.createDataFrame(rows, _CARRY)


def _maps(batch: pa.RecordBatch, *names: str) -> tuple[np.ndarray, ...]:
    return tuple(batch.column(n).to_numpy(zero_copy_only=False).astype(np.uint64) for n in names)


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        before = affine.each_then(_maps(batch, "carry_m", "carry_a"), _maps(batch, "before_m", "before_a"))
        after = affine.each_then(before, _maps(batch, "m", "a"))
        yield pa.record_batch(
            [*(batch.column(c) for c in ("conv_id", "pos", *_TURN)), *(pa.array(x.astype(np.int64)) for x in (*before, *after))],
            names=["conv_id", "pos", *_TURN, "before_m", "before_a", "after_m", "after_a"],
        )


def _with_place(stored: DataFrame, carries: DataFrame) -> DataFrame:
    """Every part has at most two runs of split conversations, its first and its last: the table is broadcast."""
    placed = stored.join(F.broadcast(carries), ["conv_id", "part"], "left")
    return placed.withColumn("pos", F.col("k") + F.coalesce("first", F.lit(0)))


def prefix_products(stored: DataFrame, carries: DataFrame) -> DataFrame:
    """(conv_id, pos, the turn's size and reference, product before and after) of every turn, counted from the conversation's start."""
    placed = _with_place(stored, carries).select(
        "conv_id", "pos", *_TURN, "m", "a", "before_m", "before_a",
        F.coalesce("carry_m", F.lit(1)).alias("carry_m"), F.coalesce("carry_a", F.lit(0)).alias("carry_a"),
    )
    return compact(placed.mapInArrow(_products, _PLACED), "products")


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % HEADS


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """link = (product of the head) x (inverse of the own turns that the head replaces)."""
    for batch in batches:
        links = [
            affine.then((r["head_m"], r["head_a"]), affine.inverse((r["own_m"], r["own_a"])))
            for r in batch.select(["head_m", "head_a", "own_m", "own_a"]).to_pylist()
        ]
        columns = [batch.column(n) for n in ("conv_id", "h", "n", "n_head", "heads")]
        yield pa.record_batch(
            [*columns, *(pa.array([x[i] for x in links], pa.int64()) for i in (0, 1))],
            names=["conv_id", "h", "n", "n_head", "heads", "link_m", "link_a"],
        )


def rebuilt(products: DataFrame) -> DataFrame:
    """One row per conversation: h, its own number of turns n, the head's turns and the link from the head to its own products."""
    own = products.withColumn("h", head_length(F.col("conv_id")))
    own = own.groupBy("conv_id", "h").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.coalesce(F.max(F.when(F.col("pos") == F.col("h"), F.col(f"before_{x}"))), F.lit(one)).alias(f"own_{x}") for x, one in (("m", 1), ("a", 0))),
    )
    turns = products.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS - 1))
    turn = F.struct("pos", *_TURN, "before_m", "before_a", "after_m", "after_a")
    bases = turns.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    # A base has at most 199 conversations.
    held = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(bases, "base", "left")
    heads = F.when(F.col("turns").isNotNull(), F.slice("turns", F.lit(1), F.col("h").cast("int")))
    held = held.withColumn("heads", heads).withColumn("n_head", F.coalesce(F.size("heads"), F.lit(0)).cast("bigint"))
    held = held.withColumn("n_head", F.greatest("n_head", F.lit(0).cast("bigint")))
    for x, one in (("m", 1), ("a", 0)):
        last = F.try_element_at("heads", F.lit(-1))[f"after_{x}"]
        held = held.withColumn(f"head_{x}", F.coalesce(last, F.lit(one)))
    names = ("pos", *_TURN, "before_m", "before_a", "after_m", "after_a")
    item = f"array<struct<{','.join(f'{n}:bigint' for n in names)}>>"
    held = held.select("conv_id", F.col("h").cast("bigint").alias("h"), "n", "n_head", F.col("heads").cast(item).alias("heads"), "head_m", "head_a", "own_m", "own_a")
    schema = f"conv_id bigint, h bigint, n bigint, n_head bigint, heads {item}, link_m bigint, link_a bigint"
    return compact(held.mapInArrow(_links, schema), "rebuilt")


def _own_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        link = _maps(batch, "link_m", "link_a")
        here = affine.each_then(link, _maps(batch, "after_m", "after_a"))
        up = affine.each_then(link, _maps(batch, "before_m", "before_a"))
        names = ["conv_id", "depth", "ends", "turn_conv_id", "turn_pos", *_TURN]
        yield pa.record_batch(
            [*(batch.column(n) for n in names), *(pa.array(x.astype(np.int64)) for x in (*here, *up))],
            names=[*names, "m", "a", "up_m", "up_a"],
        )


_PATH = (
    "conv_id bigint, depth bigint, ends boolean, turn_conv_id bigint, turn_pos bigint, n_chars bigint, "
    "told_1 bigint, told_2 bigint, m bigint, a bigint, up_m bigint, up_a bigint"
)


def paths(products: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per prefix of every rebuilt conversation, the empty one included:
    its fingerprint (m, a), its parent's, and a reference to its last turn."""
    whole = F.col("n_head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    nothing = F.lit(None).cast("bigint")
    roots = convs.select(
        "conv_id", F.lit(0).cast("bigint").alias("depth"), (whole == 0).alias("ends"), nothing.alias("turn_conv_id"), nothing.alias("turn_pos"),
        *(F.lit(0).cast("bigint").alias(c) for c in _TURN), F.lit(1).cast("bigint").alias("m"), F.lit(0).cast("bigint").alias("a"),
        nothing.alias("up_m"), nothing.alias("up_a"),
    )
    heads = convs.select("conv_id", whole.alias("whole"), F.explode("heads").alias("x")).select(
        "conv_id", (F.col("x.pos") + 1).alias("depth"), (F.col("x.pos") + 1 == F.col("whole")).alias("ends"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("turn_conv_id"), F.col("x.pos").alias("turn_pos"), *(f"x.{c}" for c in _TURN),
        F.col("x.after_m").alias("m"), F.col("x.after_a").alias("a"), F.col("x.before_m").alias("up_m"), F.col("x.before_a").alias("up_a"),
    )
    stats = convs.select("conv_id", "h", F.col("n").alias("rows"), "n_head", "link_m", "link_a", whole.alias("whole"))
    own = join_back(products, stats, ["conv_id"], size="rows").where("pos >= h")
    depth = F.col("n_head") + F.col("pos") - F.col("h") + 1
    own = own.select(
        "conv_id", depth.alias("depth"), (depth == F.col("whole")).alias("ends"), F.col("conv_id").alias("turn_conv_id"),
        F.col("pos").alias("turn_pos"), *_TURN, "before_m", "before_a", "after_m", "after_a", "link_m", "link_a",
    ).mapInArrow(_own_paths, _PATH)
    return compact(roots.unionByName(heads).unionByName(own), "paths")


def _groups(path: DataFrame) -> DataFrame:
    """Prefixes of equal fingerprint: smallest conversation, members, and whether they differ in parent or last turn."""
    agree = [F.min(c) == F.max(c) for c in (*_TURN, "up_m", "up_a")]
    unequal = ~F.coalesce(reduce(Column.__and__, agree), F.lit(True))  # the root has no parent
    return compact(
        path.groupBy(*_NODE).agg(
            F.min("conv_id").alias("first_conv"), F.count(F.lit(1)).alias("n_convs"), F.max("n_chars").alias("n_chars"), unequal.alias("unequal")
        ),
        "groups",
    )


def _subtree_sums(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens): ``leaf`` and ``saved`` of ``nodes`` summed over every node's subtree.

    A round takes the sums of the 1, 16, 256, ... levels that begin with each node
    to its fifteen forefathers at those distances. The forefather of a node so many
    levels up is the node on the path of its own conv_id.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = nodes.select("conv_id", "depth", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    added = [F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")]
    step = 1
    while step <= deepest:
        ups = F.sequence(F.lit(1), F.least(F.lit(LEAP - 1), F.floor(F.col("depth") / step)))
        ups = sums.where(F.col("depth") >= step).select("conv_id", "n_leaves", "saved_tokens", "depth", F.explode(ups).alias("j"))
        given = ups.groupBy("conv_id", (F.col("depth") - F.col("j") * step).alias("depth")).agg(*added)
        given = given.join(members.select("conv_id", "depth", "node"), ["conv_id", "depth"])
        given = given.select(F.col("node").alias("conv_id"), "depth", "n_leaves", "saved_tokens")
        sums = compact(sums.unionByName(given).groupBy("conv_id", "depth").agg(*added), "subtrees")
        step *= LEAP
    return sums


def _id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, depth, conv_id) -> comma-joined pieces of a node's ids."""
    key, ids = None, []

    def piece():
        return pa.RecordBatch.from_pydict(
            {"node": [key[0]], "depth": [key[1]], "first": [ids[0]], "ids": [",".join(map(str, ids))]}, schema=_PIECE_ARROW
        )

    for batch in batches:
        held: list[pa.RecordBatch] = []
        for node, depth, conv in zip(*(batch.column(n).to_pylist() for n in ("node", "depth", "conv_id"))):
            if key is not None and ((node, depth) != key or len(ids) >= _PIECE):
                held.append(piece())
                ids = []
            key = (node, depth)
            ids.append(conv)
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    if ids:
        yield piece()


_PIECE_ARROW = pa.schema([("node", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])


def _sha256(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces -> one digest per node; only the digest under way is held."""
    key, digest = None, None
    for batch in batches:
        done = []
        for node, depth, ids in zip(*(batch.column(n).to_pylist() for n in ("node", "depth", "ids"))):
            if (node, depth) != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = (node, depth), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield _digest_rows(done)
    if key is not None:
        yield _digest_rows([(*key, digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    node, depth, told = zip(*rows)
    return pa.record_batch([pa.array(node, pa.int64()), pa.array(depth, pa.int64()), pa.array(told)], names=["conv_id", "depth", "ends_sha256"])


def _ends(members: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes at which conversations end.

    A digest reads its ids in one order, so one task feeds it; but the ids of a
    node are sorted and joined into pieces of thousands by as many tasks as they need.
    """
    ends = members.where("ends").select("node", "depth", "conv_id")
    order = ["node", "depth", "conv_id"]
    ranged = ends.repartitionByRange(_parts(ends), *order).sortWithinPartitions(*order)
    pieces = ranged.mapInArrow(_id_pieces, "node bigint, depth bigint, first bigint, ids string")
    dealt = pieces.repartition(_parts(ends), "node", "depth").sortWithinPartitions("node", "depth", "first")
    return dealt.mapInArrow(_sha256, "conv_id bigint, depth bigint, ends_sha256 string")


def trie(convs: DataFrame, item: Callable[..., affine.Map] = affine.item) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations of ``convs`` (conv_id, turn, role, text).

    Per node: conv_id, its smallest member, so that the node is the first
    ``depth`` rebuilt turns of conv_id (``paths`` says where each is stored);
    depth; parent_conv_id; n_convs, members; n_children; n_leaves, childless nodes
    of its subtree; saved_tokens, the sum over its subtree of (n_convs - 1) times
    the code points of the last text; and ends_sha256 of the ascending ids that
    end here.

    NULL role or text counts as empty. Turns of one conversation that agree in
    ``turn`` follow by role and text; repeated rows are turns of their own. Rows
    without conv_id belong to no conversation and are left out. c % 100 has the
    sign of c, as in SQL. A conversation without any turn left is a member of
    the root. An empty table gives no rows, not even a root. ``item`` makes the
    map of a turn from a seed, its role and its text.
    """
    spark = convs.sparkSession
    if convs.where("conv_id IS NOT NULL").isEmpty():
        return spark.createDataFrame([], NODES)
    for seed in count():
        stored = stored_turns(convs, seed, item)
        products = prefix_products(stored, _carries(stored))
        path = paths(products, rebuilt(products))
        groups = _groups(path)
        if groups.where("unequal").isEmpty():
            break
    known = groups.select(*_NODE, F.col("first_conv").alias("node"), F.col("n_convs").alias("size"))
    members = compact(join_back(path.select("conv_id", "ends", *_NODE), known, _NODE, size="size").drop("m", "a"), "members")
    parents = members.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent_conv_id"))
    nodes = groups.select(F.col("first_conv").alias("conv_id"), "depth", "n_convs", ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved"))
    nodes = compact(nodes.join(parents, ["conv_id", "depth"], "left"), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    nodes = nodes.join(children.agg(F.count(F.lit(1)).alias("n_children")), ["conv_id", "depth"], "left")
    nodes = nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = compact(nodes.withColumn("leaf", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint")), "nodes")
    sums = _subtree_sums(nodes, members)
    out = nodes.join(sums, ["conv_id", "depth"]).join(_ends(members), ["conv_id", "depth"], "left")
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY))).select(*(c.split()[0] for c in NODES.split(", ")))
