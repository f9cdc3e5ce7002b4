"""Joining group statistics back to rows when one key may hold most rows.

A per-key table ``stats`` (unique on the keys) meets its rows again. It is
written to the shared folder first: it is computed once, it survives a lost
executor, and its size in bytes is known to the planner, which broadcasts it if
it is small. Keys that hold more than ``hot_share`` of all *rows* - members of
``stats`` or not - are at most ``1/hot_share``, so those are broadcast and their
rows never shuffled by key, while all other rows take an ordinary join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_finished, run_dir
from ..sources.tables import delete

#: A key above this share of all rows is hot; at most 10,000 keys can be.
HOT_SHARE = 1 / 10_000


#: Folders written since the innermost ``temporary`` block began; None outside of any.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def materialise(df: DataFrame, purpose: str = "stats") -> DataFrame:
    """Write ``df`` to the shared folder and read it back, lineage cut."""
    path = run_dir(df.sparkSession, purpose)
    written = _WRITTEN.get()
    if written is not None:
        written.append(path)
    df.write.parquet(path)
    if written is not None:
        drop_finished(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete what ``materialise`` writes in this block when the block ends, and drop the
    shuffles behind each table once it is written. Results of the block must be stored by then."""
    written: list[str] = []
    token = _WRITTEN.set(written)
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        for path in written:
            delete(spark, path)
        drop_finished(spark)


def _same(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys))


def _meet(
    rows: DataFrame, stats: DataFrame, keys: Sequence[str], sizes: DataFrame,
    join: Callable[[DataFrame, DataFrame, Column], DataFrame], hot_share: float,
) -> DataFrame:
    """``stats`` is a written table; ``sizes`` has the row count ``n`` of every key of ``rows``."""
    table = stats.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = _same(keys)
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = materialise(sizes.where(F.col("n") > float(total) * hot_share).select(*keys), "hot-keys")
    if hot.isEmpty():
        return join(rows, table, on)
    hot = F.broadcast(hot.withColumnsRenamed({k: f"_k_{k}" for k in keys}))
    known = reduce(Column.__and__, (table[f"_k_{k}"].eqNullSafe(hot[f"_k_{k}"]) for k in keys))
    spread = join(rows.join(hot, on, "left_semi"), F.broadcast(table.join(hot, known, "left_semi")), on)
    rest = join(rows.join(hot, on, "left_anti"), table.join(hot, known, "left_anti"), on)
    return spread.unionByName(rest)


def _row_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return materialise(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "sizes")


def join_back(
    rows: DataFrame, stats: DataFrame, keys: Sequence[str], size: str | None = None, how: str = "inner",
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Add the columns of ``stats`` to every row of ``rows`` with the same keys.

    ``how`` is ``inner`` or ``left``. NULL keys match each other, as they do in
    a window partition. ``size`` names the column of ``stats`` with the row
    count of its key, and may be given only if ``stats`` has every key of
    ``rows``; it is dropped. Without it the rows are counted.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join_back does inner or left, not {how}")
    stats = materialise(stats)
    if size:
        sizes = stats.select(*keys, F.col(size).alias("n"))
    else:
        sizes = _row_counts(rows, keys)
    joined = _meet(rows, stats.drop(*([size] if size else [])), keys, sizes, lambda left, right, on: left.join(right, on, how), hot_share)
    return joined.drop(*(f"_k_{k}" for k in keys))


def keep_members(
    rows: DataFrame, members: DataFrame, keys: Sequence[str], hot_share: float = HOT_SHARE, sizes: DataFrame | None = None
) -> DataFrame:
    """Rows whose keys occur in ``members`` (left semi join).

    ``sizes`` has the keys of ``rows`` and the number ``n`` of their rows, if that is
    known; else they are counted.
    """
    sizes = _row_counts(rows, keys) if sizes is None else materialise(sizes, "sizes")
    return _meet(
        rows, materialise(members.select(*keys).distinct()), keys, sizes,
        lambda left, right, on: left.join(right, on, "left_semi"), hot_share,
    )


def share_of_total(rows: DataFrame, keys: Sequence[str], value: str, out: str, **kw) -> DataFrame:
    """``value / sum(value)`` within the keys, NULL where the sum is 0 or NULL."""
    totals = rows.groupBy(*keys).agg(F.sum(value).alias("_total"), F.count(F.lit(1)).alias("_n"))
    joined = join_back(rows, totals, keys, size="_n", **kw)
    return joined.withColumn(out, F.try_divide(F.col(value), F.col("_total"))).drop("_total")
