"""Look-backs over many days from stored sketches, without reading records again.

A sketch per key and slot is written once a day; any look-back merges the
slots it needs. Sketches have a fixed size, so a merge costs slots, not records.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a quantile sketch; its rank error is below ``RANK_ERROR`` with 99 % confidence.
QUANTILE_SIZE, RANK_ERROR = 400, 0.01
#: Two to this power registers of a distinct-count sketch; its relative standard error is 1.04 / sqrt(registers), 1.6 %.
DISTINCT_SIZE, DISTINCT_ERROR = 12, 0.05


def quantile_states(records: DataFrame, keys: Sequence[str], slot: str, value: str) -> DataFrame:
    """(keys, slot, state): one mergeable quantile sketch per key and slot, combined on the map side."""
    known = records.where(F.col(value).isNotNull())
    return known.groupBy(*keys, slot).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(QUANTILE_SIZE)).alias("state"))


def quantiles(states: DataFrame, keys: Sequence[str], shares: Mapping[str, float]) -> DataFrame:
    """(keys, n, one column per share) over all slots given."""
    merged = states.groupBy(*keys).agg(F.kll_merge_agg_double("state").alias("_s"))
    at = [F.kll_sketch_get_quantile_double("_s", F.lit(p)).alias(name) for name, p in shares.items()]
    return merged.select(*keys, F.kll_sketch_get_n_double("_s").alias("n"), *at)


def distinct_states(records: DataFrame, keys: Sequence[str], slot: str, value: str) -> DataFrame:
    """(keys, slot, state): one mergeable distinct-count sketch per key and slot."""
    known = records.where(F.col(value).isNotNull())
    return known.groupBy(*keys, slot).agg(F.hll_sketch_agg(value, F.lit(DISTINCT_SIZE)).alias("state"))


def distinct_counts(states: DataFrame, keys: Sequence[str], out: str = "distinct") -> DataFrame:
    """(keys, out): how many different values all slots given have together."""
    return states.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("state")).alias(out))
