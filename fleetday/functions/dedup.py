"""One row per key.

`row_number() = 1` lets Spark drop all but one row of a key inside every map task before the
shuffle (WindowGroupLimit), so a key that holds a large part of the table costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(
    df: DataFrame, keys: list[str], order: list[Column], unique: bool = False
) -> DataFrame:
    """The first row of every key in `order`.

    Ties are settled by all other columns, unless `order` is already `unique` within a key.
    """
    ties = [] if unique else [c for c in df.columns if c not in keys]  # ascending, nulls first
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *ties))
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")


def keep_first(df: DataFrame, keys: list[str], ingest_order: list[str]) -> DataFrame:
    """The row that was ingested first. Null keys are equal to each other."""
    return keep_one(df, keys, [F.col(c).asc_nulls_last() for c in ingest_order])


def keep_latest(df: DataFrame, keys: list[str], file_time: str = "_ts_fichero") -> DataFrame:
    """The row from the newest file of every key."""
    return keep_one(df, keys, [F.col(file_time).desc_nulls_last()])


def add_unseen(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `new` whose key is not in `existing` (null keys equal): what an ingest appends."""
    seen = existing.select(*[F.col(k).alias(f"_seen_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_seen_{k}")) for k in keys]
    return new.join(seen, same, "left_anti")
