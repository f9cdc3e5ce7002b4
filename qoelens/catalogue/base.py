"""Registry of runnable queries and the SQL each one must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Plain comparable types: whole numbers as bigint, fractions as double,
    dates and times as text, lists as sorted joined text."""
    def plain(field: T.StructField):
        c = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(kind, T.DecimalType):
            c = c.cast("bigint" if kind.scale == 0 else "double")
        elif isinstance(kind, T.FloatType):
            c = c.cast("double")
        elif isinstance(kind, T.DateType):
            c = c.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(F.array_sort(c), ",")
        return c.alias(field.name)

    return df.select(*(plain(f) for f in df.schema))


def query(name: str, oracle: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: tidy(build(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return add
