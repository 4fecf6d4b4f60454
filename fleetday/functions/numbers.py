"""Non-strict numeric conversion of text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def parse_double(c: Column | str) -> Column:
    """Text to double; text that is not a plain decimal number becomes null.

    A cast alone would also take `1.5d`, padded numbers and `NaN`.
    """
    text = F.col(c) if isinstance(c, str) else c
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def double_column(df: DataFrame, name: str) -> Column:
    """`name` as double, whether it is stored as text or already typed."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_double(name)
    return F.col(name).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, 0.0 where the denominator is null or not positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))
