"""Join against a small table whose keys many rows share (files, file days)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "_salt"


def salted_join(
    big: DataFrame, small: DataFrame, on: list[str], spread: list[str], how: str, salts: int
) -> DataFrame:
    """`big` joined with `small` on `on`, each key of `big` spread over `salts` slices.

    `spread` are columns of `big` that differ inside a key. `small` is repeated once per slice. No
    broadcast is forced: Spark broadcasts `small` only if its measured size is under the session's
    threshold, and otherwise a key that holds a third of all rows is still shared by many tasks.
    """
    slices = F.array(*[F.lit(i) for i in range(salts)])
    repeated = small.withColumn(_SALT, F.explode(slices))
    salted = big.withColumn(
        _SALT, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    )
    return salted.join(repeated, [*on, _SALT], how).drop(_SALT)
