"""Wall-clock expressions. Everything is TIMESTAMP_NTZ, so no session time zone is involved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NTZ = "timestamp_ntz"
_FULL_DATE = r"^\d{4}-\d{1,2}-\d{1,2}(?!\d)"
_SLASHES = r"^(\d{4})/(\d{1,2})/(\d{1,2})(?!\d)"
_DAY_FIRST = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})(?!\d)"


def hours(n: int) -> Column:
    return F.make_dt_interval(hours=F.lit(n))


def days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))


def parse_ts(c: Column | str, formats: tuple[str, ...] = ()) -> Column:
    """Text to timestamp; unreadable text becomes null.

    A full date is needed, as a bare year or year-month would cast to its first day: year first with
    dashes or slashes, or day first with either, each with or without a time. `formats` are tried
    after these.
    """
    text = F.trim(F.col(c) if isinstance(c, str) else c)
    # the usual form costs no pattern; what is read with dashes in these two places is a full date
    dashed = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    usual = F.when(dashed, text.try_cast(NTZ))
    iso = F.regexp_replace(F.regexp_replace(text, _SLASHES, "$1-$2-$3"), _DAY_FIRST, "$3-$2-$1")
    parsed = F.when(iso.rlike(_FULL_DATE), iso.try_cast(NTZ))
    return F.coalesce(usual, parsed, *[_by_format(text, f) for f in formats])


def _by_format(text: Column, pattern: str) -> Column:
    """Wall-clock time by a pattern, read at offset zero so that no zone's clock changes matter."""
    instant = F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f"{pattern} xx"))
    seconds = (F.unix_micros(instant) / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast(NTZ) + F.make_dt_interval(secs=seconds)


def timestamp_column(df: DataFrame, name: str, formats: tuple[str, ...] = ()) -> Column:
    """`name` as a timestamp, whether it is stored as text or already typed."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_ts(name, formats)
    return F.col(name).cast(NTZ)


def export_timestamp(name: Column | str) -> Column:
    """The `YYYYMMDD_HHMMSS` part of a file name as a timestamp, null if absent or impossible."""
    stamp = F.regexp_extract(name, r"(\d{8}_\d{6})", 1)
    iso = F.regexp_replace(
        stamp, r"^(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6"
    )
    return F.nullif(iso, F.lit("")).try_cast(NTZ)


def logical_day(ts: Column, cutoff_hour: int) -> Column:
    """Date of `ts`, counting what happens before the cutoff hour to the day before."""
    return F.to_date(ts - hours(cutoff_hour))


def day_start(ts: Column) -> Column:
    return F.to_date(ts).cast(NTZ)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from `start` to `end`, fractions cut off."""
    gap = end - start

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), gap).cast("long")

    return part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")
