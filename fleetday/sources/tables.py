"""Stored tables: Parquet datasets partitioned by day, zstd."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # Spark's directory name for an empty partition value
_MISSING = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local session without that setting (a test) gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fleetday-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


#: Folder that the staged tables of the current run share, if it has one.
_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    folder = _run_folder.get() or f"{shared_dir(spark)}/fleetday"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """A folder for everything that is staged inside; it goes when the block ends, however it ends."""
    folder = f"{shared_dir(spark)}/fleetday/run-{uuid.uuid4().hex}"
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """`df` written once and read back: later uses neither recompute it nor depend on executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, None if it was never written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in _MISSING:
            raise
        return None


def _writer(df: DataFrame, day: str | None):
    # rebalance splits a day that holds much of the table and joins small ones into one file
    if day is None:
        return df.write.option("compression", "zstd")
    return df.hint("rebalance", day).write.option("compression", "zstd").partitionBy(day)


def write_table(df: DataFrame, path: str, day: str | None = None) -> None:
    _writer(df, day).mode("overwrite").parquet(path)


def append_table(df: DataFrame, path: str, day: str) -> None:
    _writer(df, day).mode("append").parquet(path)


def delete_table(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _delete_day(spark: SparkSession, path: str, day_column: str, day: str) -> None:
    delete_table(spark, f"{path}/{day_column}={day}")


def _day_text(day: str) -> Column:
    return F.coalesce(F.col(day).cast("string"), F.lit(_NO_DAY))


def distinct_days(df: DataFrame, day: str) -> list[str]:
    """The calendar days of a table as ISO text: one value per day, whatever the number of rows."""
    return sorted(r[0] for r in df.select(_day_text(day)).distinct().collect())


def on_days(day: str, days: list[str]) -> Column:
    """Whether a row lies on one of `days`; a condition on the partition column alone."""
    return _day_text(day).isin(*days)


def drop_days(spark: SparkSession, path: str, day_column: str, days: list[str]) -> None:
    for day in days:
        _delete_day(spark, path, day_column, day)


def replace_days(df: DataFrame, path: str, day_column: str, days: list[str]) -> None:
    """Make `df` the whole content of `days`; other days are not touched.

    `df` may read the same table: it is staged first. The overwrite can be repeated from there.
    """
    spark = df.sparkSession
    content = stage(df, "days")
    (
        _writer(content, day_column)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )
    filled = set(distinct_days(content, day_column))
    drop_days(spark, path, day_column, [d for d in days if d not in filled])


class RepeatedKeys(RuntimeError):
    """An upsert holds a key twice."""
