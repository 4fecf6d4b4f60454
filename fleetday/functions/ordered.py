"""Ordered scans over keys of any size.

Most keys are small: a window over the key is one shuffle, and that is all. A key with more rows than a
task should scan is cut into ranges of its order instead. The rows of all such keys are dealt by range of
(key, time, ties), which splits a key wherever it is dense, also inside one second; the window runs
inside (key, range), a small table with one row per (key, range) carries the state from range to range, and
both meet on (key, range), the partitioning the window already has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetday.sources.tables import stage

#: Ranges that a key of just `heavy_rows` rows is cut into.
RANGES = 4
_RANGE, _TIE = "_range", "_tie"


def _same(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[Column]]:
    """`df` with its keys renamed, and the condition that joins it; null keys are equal."""
    other = df.select(*[F.col(k).alias(f"_heavy_{k}") for k in keys])
    return other, [F.col(k).eqNullSafe(F.col(f"_heavy_{k}")) for k in keys]


def split_heavy(df: DataFrame, keys: list[str], order: list[str], heavy_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ordinary keys, and those of keys with over `heavy_rows` rows with the number of their range.

    Counts the rows per key. Without a heavy key the first is all of `df` and the second None. Otherwise
    the second is stored, with `_tie` added, which settles the order of rows that are equal in `order`.
    """
    heavy = stage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > heavy_rows), "heavy")
    total = heavy.agg(F.sum("_rows")).first()[0]
    if total is None:
        return df, None
    named, same = _same(heavy, keys)
    rows = df.join(named, same, "left_semi").withColumn(_TIE, F.xxhash64(*df.columns))
    parts = max(2, -(-total * RANGES // heavy_rows))
    # the last column splits what is equal in all others
    ranged = rows.repartitionByRange(parts, *keys, *order, _TIE, F.monotonically_increasing_id())
    return df.join(named, same, "left_anti"), stage(ranged.withColumn(_RANGE, F.spark_partition_id()), "ranges")


def _with_carry(rows: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    other = carried.withColumnsRenamed({k: f"_heavy_{k}" for k in keys}).withColumnRenamed(_RANGE, "_heavy_range")
    same = [F.col(k).eqNullSafe(F.col(f"_heavy_{k}")) for k in keys] + [F.col(_RANGE) == F.col("_heavy_range")]
    return rows.join(other, same, "left").drop(*[f"_heavy_{k}" for k in keys], "_heavy_range")


def with_next(df: DataFrame, keys: list[str], ts: str, ties: list[str], name: str, heavy_rows: int) -> DataFrame:
    """Add `name`: the `ts` of the next row of the same key in (ts, ties) order."""
    light, heavy = split_heavy(df, keys, [ts, *ties], heavy_rows)
    done = light.withColumn(name, F.lead(ts).over(Window.partitionBy(*keys).orderBy(ts, *ties)))
    if heavy is None:
        return done
    inside = F.lead(ts).over(Window.partitionBy(*keys, _RANGE).orderBy(ts, *ties, _TIE))
    following = (
        heavy.groupBy(*keys, _RANGE)
        .agg(F.min(ts).alias("_head"))
        .withColumn("_following", F.lead("_head").over(Window.partitionBy(*keys).orderBy(_RANGE)))
        .drop("_head")
    )
    ranged = _with_carry(heavy.withColumn(name, inside), following, keys)
    return done.unionByName(ranged.withColumn(name, F.coalesce(name, "_following")).drop(_RANGE, _TIE, "_following"))


def with_previous_max(
    df: DataFrame, keys: list[str], ts: str, ties: list[str], value: Column, name: str, heavy_rows: int
) -> DataFrame:
    """Add `name`: the largest `value` among the earlier rows of the same key, null for the first."""
    light, heavy = split_heavy(df, keys, [ts, *ties], heavy_rows)
    before = (Window.unboundedPreceding, -1)
    done = light.withColumn(name, F.max(value).over(Window.partitionBy(*keys).orderBy(ts, *ties).rowsBetween(*before)))
    if heavy is None:
        return done
    inside = F.max(value).over(Window.partitionBy(*keys, _RANGE).orderBy(ts, *ties, _TIE).rowsBetween(*before))
    earlier = (
        heavy.groupBy(*keys, _RANGE)
        .agg(F.max(value).alias("_peak"))
        .withColumn("_carried", F.max("_peak").over(Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(*before)))
        .drop("_peak")
    )
    ranged = _with_carry(heavy.withColumn(name, inside), earlier, keys)
    return done.unionByName(ranged.withColumn(name, F.greatest(name, "_carried")).drop(_RANGE, _TIE, "_carried"))
