"""Near-real-time aggregates: event-time windows over a stream of reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_files(spark: SparkSession, folder: str, schema: T.StructType | str, glob: str = "*.parquet",
               files_per_batch: int | None = None) -> DataFrame:
    """A stream of the Parquet files that arrive in ``folder``."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def in_event_time(stream: DataFrame, column: str, late_by: str = "30 minutes") -> DataFrame:
    """Event time as a UTC timestamp with a watermark. Rows later than
    ``late_by`` are dropped here; ``corrections`` repairs their windows."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, late_by)


def windowed(
    stream: DataFrame, time: str, keys: Sequence[str], values: Mapping[str, Column],
    width: str = "1 hour", slide: str | None = None,
) -> DataFrame:
    """Aggregates per window and keys; overlapping windows when ``slide`` is given."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return (
        stream.groupBy(window.alias("w"), *keys)
        .agg(*(c.alias(name) for name, c in values.items()))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *values)
    )


def sessions(stream: DataFrame, time: str, keys: Sequence[str], values: Mapping[str, Column], gap: str) -> DataFrame:
    """Activity sessions per key, closed by ``gap`` of silence. Sessions are
    merged inside each task before the shuffle."""
    stream.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return (
        stream.groupBy(F.session_window(time, gap).alias("w"), *keys)
        .agg(*(c.alias(name) for name, c in values.items()))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *values)
    )


def trailing(df: DataFrame, time: str, width: str = "1 hour") -> DataFrame:
    """Records of the last ``width`` before the newest record."""
    newest = df.agg(F.max(time)).scalar()
    return df.where(F.col(time) > newest - F.expr(f"INTERVAL {width}"))


def complete_until(sources: Mapping[str, DataFrame], time: str) -> DataFrame:
    """One row: the newest time of every source and the time all have reached."""
    newest = [df.agg(F.max(time).alias("newest")).withColumn("source", F.lit(name)) for name, df in sources.items()]
    merged = newest[0]
    for more in newest[1:]:
        merged = merged.unionByName(more)
    return merged.groupBy().agg(
        F.min("newest").alias("complete_until"),
        *(F.max(F.when(F.col("source") == name, F.col("newest"))).alias(f"newest_{name}") for name in sources),
    )


def common_slots(
    sources: Mapping[str, DataFrame], time: str, delays: Mapping[str, str], width: str = "1 hour"
) -> DataFrame:
    """A stream of slots that all sources have passed, with each source's records.

    Every source has a watermark of its own delay. A slot comes out, once, when
    the slowest watermark has passed its end: the session's policy for several
    watermarks is set to their minimum.
    """
    spark = next(iter(sources.values())).sparkSession
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    merged = None
    for name, stream in sources.items():
        timed = in_event_time(stream, time, delays[name]).select(time, F.lit(name).alias("source"))
        merged = timed if merged is None else merged.unionByName(timed)
    counts = {f"n_{name}": F.count_if(F.col("source") == name) for name in sources}
    return windowed(merged, time, [], counts, width)


def passed_slots(sources: Mapping[str, DataFrame], time: str, delays: Mapping[str, str], width: str = "1 hour") -> DataFrame:
    """The batch twin of ``common_slots``: the slots that end by the earliest of the sources' newest time less its delay."""
    merged = None
    for name, df in sources.items():
        timed = df.select(F.col(time).cast("timestamp").alias(time), F.lit(name).alias("source"))
        merged = timed if merged is None else merged.unionByName(timed)
    reached = merged.groupBy("source").agg(F.max(time).alias("newest"))
    delay = F.create_map(*(x for name in sources for x in (F.lit(name), F.expr(f"INTERVAL {delays[name]}"))))
    mark = reached.agg(F.min(F.col("newest") - delay[F.col("source")]).alias("mark"), F.count(F.lit(1)).alias("n"))
    counts = {f"n_{name}": F.count_if(F.col("source") == name) for name in sources}
    slots = windowed(merged, time, [], counts, width)
    return slots.join(F.broadcast(mark), F.col("window_end") <= F.col("mark")).where(F.col("n") == len(sources)).select(slots["*"])


def open_sessions(spark: SparkSession, progress: str, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Sessions that an append-mode ``sessions`` stream has not closed yet, read
    from its state under ``progress``, in the form of those that it has written.

    ``values`` are the stream's aggregates in their order; each must be a count,
    a sum, a minimum or a maximum, which the state holds as they are.
    """
    state = spark.read.format("statestore").load(progress)
    held = state.schema["value"].dataType
    # The state names fields by their functions, so names repeat: window, keys and aggregates are taken by place.
    names = ["w", *keys, *values]
    if len(held.fields) != len(names):
        raise ValueError("an aggregate has more than one number in the state")
    named = T.StructType([T.StructField(n, f.dataType, f.nullable) for n, f in zip(names, held.fields)])
    opened = state.select(F.col("value").cast(named).alias("v")).select("v.*")
    return opened.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *values)
