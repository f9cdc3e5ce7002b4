"""Reading dated Parquet directories, CSV mappings and stored results."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COLUMNS = ("date", "hour", "day")


def _filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _filesystem(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _filesystem(spark, path)
    fs.delete(where, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when the writing job finished (its ``_SUCCESS`` marker is there)."""
    return path_exists(spark, f"{path}/_SUCCESS")


def partitions(spark: SparkSession, base: str, *columns: str) -> list[tuple[str, ...]]:
    """Values of the ``column=value`` directories under ``base``, from a listing
    of directory names alone."""
    fs, where = _filesystem(spark, base)
    if not fs.exists(where):
        return []
    pattern = spark._jvm.org.apache.hadoop.fs.Path(base + "".join(f"/{c}=*" for c in columns))
    found = fs.globStatus(pattern) or []
    names = (status.getPath().toString().rstrip("/").split("/")[-len(columns):] for status in found)
    return sorted(tuple(part.split("=", 1)[1] for part in parts) for parts in names)


def require(df: DataFrame, schema: str | T.StructType, name: str = "table") -> DataFrame:
    """Fail early, naming every absent or differently typed column; extra
    columns stay."""
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    have = {f.name.lower(): f.dataType for f in df.schema}
    faults = []
    for f in wanted:
        kind = have.get(f.name.lower())
        if kind is None:
            faults.append(f"{f.name} is missing")
        elif kind != f.dataType:
            faults.append(f"{f.name} is {kind.simpleString()}, not {f.dataType.simpleString()}")
    if faults:
        raise ValueError(f"{name}: " + "; ".join(faults))
    return df


def read_partitioned(spark: SparkSession, base: str, **wanted: str) -> DataFrame:
    """A partitioned table with its partition columns as text (``08`` stays
    ``08``); ``wanted`` filters become partition pruning."""
    schema = spark.read.parquet(base).schema
    text = [
        T.StructField(f.name, T.StringType()) if f.name in PARTITION_COLUMNS else f for f in schema
    ]
    df = spark.read.schema(T.StructType(text)).parquet(base)
    for column, value in wanted.items():
        df = df.where(F.col(column) == value)
    return df


def days_back(day: str, days: int, ends_before: int = 0) -> list[str]:
    last = date.fromisoformat(day) - timedelta(days=ends_before)
    return [(last - timedelta(days=i)).isoformat() for i in range(days)]


def read_days(spark: SparkSession, template: str, days: Sequence[str]) -> DataFrame:
    """One multi-path read of those days that exist; an error when none does."""
    found = [p for p in (template.format(d) for d in days) if path_exists(spark, p)]
    if not found:
        raise FileNotFoundError(f"no directory exists for {template}")
    return spark.read.parquet(*found)


def newest(spark: SparkSession, template: str, days: Iterable[str]) -> str:
    """Path of the first of ``days`` that exists."""
    for d in days:
        if path_exists(spark, template.format(d)):
            return template.format(d)
    raise FileNotFoundError(f"no directory exists for {template}")


def read_recursive(spark: SparkSession, base: str, *columns: str) -> DataFrame:
    """All files below ``base``, projected and deduplicated."""
    return spark.read.option("recursiveFileLookup", "true").parquet(base).select(*columns).distinct()


MAPPING_SCHEMA = "mdn_5g string, serialnumber string, cust_id string, status string"


def read_mapping(spark: SparkSession, path: str, status: str = "INSTALL COMPLETE") -> DataFrame:
    """Installed lines of the serial-number mapping CSV."""
    lines = spark.read.option("header", True).option("enforceSchema", False).schema(MAPPING_SCHEMA).csv(path)
    return lines.where(F.col("status") == status).select(
        F.col("mdn_5g").alias("mdn"), F.col("serialnumber").alias("serial_num"), "cust_id"
    )


def read_or_compute(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The finished table at ``path``; computed and stored first if absent."""
    if not is_complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
