"""Incremental ingest of one CSV family into its bronze table.

Bronze is partitioned by the day a row belongs to, and a run appends only rows it does not hold
yet: neither the stored history nor the files already read are touched again.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetday import schema as S
from fleetday.config import Config
from fleetday.functions.clock import export_timestamp, timestamp_column
from fleetday.functions.dedup import keep_one
from fleetday.functions.joins import salted_join
from fleetday.operators import bronze as B
from fleetday.sources.csv_files import Scan, discover_files, file_error_gate, scan_family
from fleetday.sources.families import Family
from fleetday.sources.tables import (
    append_table,
    delete_table,
    distinct_days,
    drop_days,
    on_days,
    read_table,
    replace_days,
    stage,
    write_table,
)

DAY = S.BRONZE_DAY
_BUCKET = "_bucket"


def read_bronze(
    spark: SparkSession, path: str, family: Family, as_of: datetime, cfg: Config
) -> DataFrame | None:
    """The stored rows within retention. The day filter prunes partitions before the exact one."""
    stored = read_table(spark, path)
    if stored is None:
        return None
    first_day = (as_of - timedelta(days=cfg.retention_days)).date()
    recent = stored.filter(F.col(DAY).isNull() | (F.col(DAY) >= F.lit(first_day)))
    return B.prune_retention(recent, family.dated_by, as_of, cfg)


def ledger_path(path: str) -> str:
    return f"{path}_files"


def keys_path(path: str) -> str:
    return f"{path}_keys"


def _needs_keys(family: Family) -> bool:
    """Whether a key of the family can lie on any stored day, so that its keys are kept in buckets of their own."""
    return bool(family.key) and family.dated_by not in family.key


def _bucket(family: Family, cfg: Config) -> Column:
    return F.pmod(F.xxhash64(*family.key), F.lit(cfg.key_buckets)).cast("int").alias(_BUCKET)


def _append_keys(rows: DataFrame, path: str, family: Family, cfg: Config) -> None:
    keyed = rows.select(*family.key, DAY, _bucket(family, cfg)).hint("rebalance", DAY, _BUCKET)
    keyed.write.option("compression", "zstd").partitionBy(DAY, _BUCKET).mode("append").parquet(keys_path(path))


def known_keys(spark: SparkSession, path: str, family: Family, rows: DataFrame, cfg: Config) -> DataFrame:
    """The stored keys in the buckets that the keys of `rows` fall into; other buckets are not read.

    A table from before its keys were kept, or whose keys were deleted, has them written anew from its rows.
    """
    if read_table(spark, keys_path(path)) is None:
        _append_keys(read_table(spark, path), path, family, cfg)
    wanted = [r[0] for r in rows.select(_bucket(family, cfg)).distinct().collect()]  # as many as buckets at most
    return read_table(spark, keys_path(path)).filter(F.col(_BUCKET).isin(sorted(wanted)))


def _ledger(spark: SparkSession, path: str, family: Family) -> DataFrame | None:
    """Names of the files whose rows are all in the table or were not needed.

    A table from before the ledger lists the files that its rows come from.
    """
    ledger = read_table(spark, ledger_path(path))
    stored = read_table(spark, path)
    if ledger is None and stored is not None:
        names = stored.select(F.col(family.file_column).alias("file_name")).distinct()
        write_table(names, ledger_path(path))
        ledger = read_table(spark, ledger_path(path))
    return ledger


def _remove_files(
    spark: SparkSession, path: str, family: Family, names: DataFrame, spread: list[str], cfg: Config
) -> None:
    """Delete the rows and ledger entries of files; only the days that they are on are rewritten."""
    names = stage(names.select("file_name").distinct(), "files")
    stored = read_table(spark, path).withColumnRenamed(family.file_column, "file_name")
    days = distinct_days(stored.join(names, "file_name", "left_semi"), DAY)
    if days:
        affected = stored.filter(on_days(DAY, days))
        kept = salted_join(affected, names, ["file_name"], spread, "left_anti", cfg.salts)
        replace_days(kept.withColumnRenamed("file_name", family.file_column), path, DAY, days)
    ledger = read_table(spark, ledger_path(path))
    write_table(stage(ledger.join(names, "file_name", "left_anti"), "ledger"), ledger_path(path))


def _append(
    path: str, family: Family, rows: DataFrame, stored: DataFrame | None, as_of: datetime, cfg: Config
) -> None:
    """Append the rows that count. `stored` is the whole table: the first row of a key counts even if it
    has expired, so retention comes after it is decided.
    """
    dated = rows.withColumn(
        DAY, F.to_date(timestamp_column(rows, family.dated_by, cfg.timestamp_formats))
    )
    if not family.key:
        append_table(B.prune_retention(dated, family.dated_by, as_of, cfg), path, DAY)
        return
    order = [export_timestamp(family.file_column).asc_nulls_last(), family.file_column, "_block", "_row"]
    first = stage(keep_one(dated, family.key, order).drop("_block", "_row"), family.name)
    if _needs_keys(family):
        if stored is not None:
            first = B.add_unseen(known_keys(first.sparkSession, path, family, first, cfg), first, family.key)
        kept = stage(B.prune_retention(first, family.dated_by, as_of, cfg), family.name)
        append_table(kept, path, DAY)
        _append_keys(kept, path, family, cfg)
        return
    if stored is not None:
        # equal keys have equal dates: only the days of the new rows can hold them
        stored = stored.filter(on_days(DAY, distinct_days(first, DAY)))
        first = B.add_unseen(stored, first, family.key)
    append_table(B.prune_retention(first, family.dated_by, as_of, cfg), path, DAY)


def ingest(
    spark: SparkSession,
    family: Family,
    directory: str,
    path: str,
    as_of: datetime,
    cfg: Config,
) -> tuple[DataFrame | None, Scan]:
    """Read the new files of `directory` into `path`; returns the bronze rows and the file report.

    A file that fails leaves no rows and is tried again in the next run. Files are entered in the
    ledger after their rows are stored, also those whose rows were all known. If a run ends in between,
    the next one first deletes what it left of files that are not in the ledger (a table whose key has
    the day needs no deleting, its rows are recognised).
    """
    # listed once: a file that arrives meanwhile must not enter the ledger unread
    files = stage(discover_files(spark, directory, family.pattern), "listing")
    ledger = _ledger(spark, path, family)
    whole = read_table(spark, path)
    if ledger is not None and whole is not None and (not family.key or _needs_keys(family)):
        names = whole.select(F.col(family.file_column).alias("file_name"))
        removed = B.unread_files(names, ledger)
        if cfg.reprocess_from is not None and not family.key:
            removed = removed.unionByName(B.files_to_reprocess(files, cfg.reprocess_from).select("file_name"))
        if not removed.isEmpty():
            # the keys go first: they are written anew from the rows that stay
            delete_table(spark, keys_path(path))
            spread = ["driver_uuid", "datestr"] if not family.key else family.key
            _remove_files(spark, path, family, removed, spread, cfg)
            ledger = read_table(spark, ledger_path(path))
    fresh = files if ledger is None else B.unread_files(files, ledger)
    scan = scan_family(spark, fresh, family, cfg.timestamp_formats)
    file_error_gate(family, scan)
    if scan.rows is not None:
        _append(path, family, scan.rows, read_table(spark, path), as_of, cfg)
        read = fresh.join(scan.errors, "file_name", "left_anti").select("file_name")
        read.write.mode("append").parquet(ledger_path(path))
    _expire(spark, path, as_of, cfg)
    return read_bronze(spark, path, family, as_of, cfg), scan


def _expire(spark: SparkSession, path: str, as_of: datetime, cfg: Config) -> None:
    """Remove whole days before the retention window; nothing is rewritten."""
    stored = read_table(spark, path)
    if stored is None:
        return
    first_day = (as_of - timedelta(days=cfg.retention_days)).date()
    old = distinct_days(stored.select(DAY).filter(F.col(DAY) < F.lit(first_day)), DAY)
    drop_days(spark, path, DAY, old)
    drop_days(spark, keys_path(path), DAY, old)
