"""Bronze: ledger of read files, reprocessing, retention and the catch-up window."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetday.config import Config
from fleetday.functions.clock import export_timestamp, seconds_between, timestamp_column
from fleetday.functions.dedup import add_unseen, keep_first
from fleetday.functions.joins import salted_join


def new_files(files: DataFrame, bronze: DataFrame | None, file_column: str) -> DataFrame:
    """Files on disk that no bronze row comes from."""
    if bronze is None:
        return files
    seen = bronze.select(F.col(file_column).alias("file_name")).distinct()
    return files.join(seen, "file_name", "left_anti")


def unread_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files on disk that the ledger does not list."""
    return files.join(ledger.select("file_name").distinct(), "file_name", "left_anti")


def files_to_reprocess(files: DataFrame, since: date) -> DataFrame:
    """Files on disk whose name carries an export time at or after `since`."""
    return files.filter(export_timestamp("file_name") >= F.lit(since).cast("timestamp_ntz"))


def reprocess_from(
    bronze: DataFrame, files: DataFrame, since: date, spread: list[str], cfg: Config
) -> DataFrame:
    """Bronze without the rows of files that are on disk again and will be re-read."""
    again = files_to_reprocess(files, since).select("file_name").distinct()
    return salted_join(bronze, again, ["file_name"], spread, "left_anti", cfg.salts)


def append_rows(existing: DataFrame | None, new: DataFrame | None) -> DataFrame | None:
    if existing is None or new is None:
        return new if existing is None else existing
    return existing.unionByName(new, allowMissingColumns=True)


def prune_retention(
    bronze: DataFrame, ts_column: str, as_of: datetime, cfg: Config
) -> DataFrame:
    """Rows of the last days; a row whose date cannot be read is kept."""
    if ts_column not in bronze.columns:
        return bronze
    limit = as_of - timedelta(days=cfg.retention_days)
    ts = timestamp_column(bronze, ts_column, cfg.timestamp_formats)
    return bronze.filter(ts.isNull() | (ts >= F.lit(limit).cast("timestamp_ntz")))


def first_wins(
    existing: DataFrame | None, new: DataFrame, keys: list[str], ingest_order: list[str]
) -> DataFrame:
    """The rows of `new` to append: first of their key, and not stored already."""
    first = keep_first(new, keys, ingest_order)
    return first if existing is None else add_unseen(existing, first, keys)


def catch_up_days(
    offers: DataFrame | None, connections: DataFrame | None, as_of: datetime, cfg: Config
) -> DataFrame | None:
    """One row: how many days back the next download has to reach; None without any bronze.

    Every partition sends one value, whatever the size of the tables.
    """
    if offers is None and connections is None:
        return None
    sources = [(offers, "timestamp"), (connections, "start_time")]
    newest = [
        df.agg(F.max(timestamp_column(df, c, cfg.timestamp_formats)).alias("newest"))
        for df, c in sources
        if df is not None
    ]
    merged = newest[0]
    for df in newest[1:]:
        merged = merged.unionByName(df)
    now = F.lit(as_of).cast("timestamp_ntz")
    elapsed = F.floor(seconds_between(F.col("newest"), now) / F.lit(86400)).cast("long")
    wanted = elapsed + 1 + cfg.catch_up_margin_days
    clamped = F.greatest(
        F.least(wanted, F.lit(cfg.catch_up_max_days)), F.lit(cfg.catch_up_min_days)
    )
    first_run = F.lit(cfg.catch_up_first_run_days).cast("long")
    return merged.agg(F.max("newest").alias("newest")).select(
        F.when(F.col("newest").isNull(), first_run).otherwise(clamped).cast("long").alias("days")
    )
