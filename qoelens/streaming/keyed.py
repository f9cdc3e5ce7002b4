"""Neighbouring-row counts with keyed state that outlives the batch and expires.

The state of a series is its last row. A timer forgets series that have been
silent for ``expire``. Rows of a series are sorted in one task per batch: for
series that may hold a large share of a batch use ``stateful.StepCounter``, which
splits them over range partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.ordered import Step

#: What ``count_steps_keyed`` needs of the session.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def known(value) -> bool:
    """Neither NULL nor NaN."""
    return value is not None and value == value


class StepProcessor(StatefulProcessor):
    """Per batch and series: (keys, groups, number of steps) of its rows in order.

    ``order`` are whole numbers, the first of them event time in milliseconds.
    Rows that do not come after the series' last row are not counted. Rows come as
    they are, without a data frame per series: most series have few rows in a batch.
    """

    def __init__(self, keys, groups, order, value, value_type, step: Step, out: str, expire_ms: int) -> None:
        self.keys, self.groups, self.order, self.value = list(keys), list(groups), list(order), value
        self.value_type, self.step, self.out, self.expire_ms = value_type, step, out, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = [T.StructField(c, T.LongType()) for c in self.order] + [T.StructField("value", self.value_type)]
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType(fields))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        data = [r for r in rows if known(r[self.value])]
        data.sort(key=lambda r: (*((r[c] is None, r[c]) for c in self.order), r[self.value]))
        held = self.last.get()
        if held is not None:
            *seen, previous = held
            # NULL comes after nothing, so it is no later than the series' last row.
            data = [r for r in data if tuple(math.nan if r[c] is None else r[c] for c in self.order) > tuple(seen)]
        if not data:
            return
        counts: dict[tuple, int] = {}
        for i, row in enumerate(data):
            hit = (i > 0 or held is not None) and bool(self.step.test(previous, row[self.value]))
            previous = row[self.value]
            group = tuple(row[g] for g in self.groups)
            if all(known(part) for part in group):
                counts[group] = counts.get(group, 0) + hit
        end = data[-1]
        self.last.update((*(int(end[c]) for c in self.order), end[self.value]))
        if held is None:
            self.handle.registerTimer(int(end[self.order[0]]) + self.expire_ms)
        made = Row(*self.keys, *self.groups, self.out)
        for group in sorted(counts):
            yield made(*key, *group, counts[group])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """A series has one timer, set by its first row: it forgets the series, or moves on to where its last row expires."""
        held = self.last.get()
        due = None if held is None else held[0] + self.expire_ms
        if due is not None and due > expiredTimerInfo.getExpiryTimeInMs():
            self.handle.registerTimer(due)
        else:
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def count_steps_keyed(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, step: Step, groups: Sequence[str] = (),
    out: str = "steps", expire_ms: int = 7 * 86_400_000,
) -> DataFrame:
    """A stream of (keys, groups, steps), one row per batch, series and group; sums of them are the counts.

    ``stream`` has a watermark. A series silent for longer than ``expire_ms`` starts anew.
    """
    spark = stream.sparkSession
    spark.conf.set(STATE_STORE, ROCKS)
    kind = {f.name: f.dataType for f in stream.schema}
    schema = T.StructType([*(T.StructField(c, kind[c]) for c in (*keys, *groups)), T.StructField(out, T.LongType())])
    processor = StepProcessor(keys, groups, order, value, kind[value], step, out, expire_ms)
    return stream.groupBy(*keys).transformWithState(processor, schema, "Append", "EventTime")
