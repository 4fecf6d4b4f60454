"""CSV exports: find the files, look at their headers, read each layout in one scan.

Files of a family differ in separator, column order and columns. One read over files with different
headers would assign columns by position, so files are grouped by (separator, header) first. Only
the first line of each file is fetched for that, in parallel; the content is scanned once.

A file of ordinary size is read by one task, as line breaks in quotes ask for. A larger one is read in blocks
by many tasks and cut into records by quote parity: a line begins a record if an even number of
quotes stands before it in the file. Quotes are counted per block, one running sum over a file's blocks says
how each begins, and the lines are numbered inside their block; a record that goes on in the next blocks
is put together from there.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetday import schema as S
from fleetday.functions.clock import export_timestamp, parse_ts
from fleetday.functions.numbers import parse_double
from fleetday.sources.families import DAILY, Family, MissingColumns

_FILES = "path string, file_name string, modified timestamp, size long"
_HEADERS = "path string, file_name string, size long, separator string, columns array<string>, error string"
_ERRORS = "family string, file_name string, reason string"
_FIRST_LINE_BYTES = 1 << 16
#: A header line is no longer than this.
_HEADER_BYTES = 1 << 22
#: Larger files are cut into records by quote parity.
WHOLE_FILE_BYTES = 1 << 28


class TooManyBadFiles(RuntimeError):
    """More than half of the files of a family could not be used."""


@dataclass
class Scan:
    """Rows of the usable files (None if there are none) and one row per refused file."""

    rows: DataFrame | None
    errors: DataFrame
    failed: int
    total: int


def discover_files(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """Files of a folder whose name matches `pattern`; a missing folder has none.

    The content column is never selected, so only the listing is paid. A scan skips files of zero
    bytes, the listing behind it does not: they are added from there, without a time, and fail later
    for want of a header.
    """
    try:
        listed = (
            spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(directory)
        )
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _FILES)
    jvm = spark._jvm
    every = spark._jsparkSession.createDataset(
        jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(listed._jdf.inputFiles()),
        jvm.org.apache.spark.sql.Encoders.STRING(),
    )
    # the listing percent-encodes its paths and leaves a plus sign alone
    decoded = F.url_decode(F.replace("value", F.lit("+"), F.lit("%2B")))
    paths = DataFrame(every.toDF(), spark).select(decoded.alias("path"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    # the listing writes local paths with three slashes, the scan with one
    local = F.regexp_replace("path", "^file:/+", "file:///")
    return (
        paths.join(listed.select(local.alias("path"), F.col("modificationTime").alias("modified"), F.col("length").alias("size")), "path", "left")
        .select("path", name.alias("file_name"), "modified", "size")
        .filter(F.col("file_name").rlike(f"(?i){pattern}"))
    )


def detect_separator(first_line: str) -> str:
    return "\t" if first_line.count("\t") > first_line.count(",") else ","


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from urllib.parse import quote

    from pyarrow import fs

    def first_line(path: str) -> str | None:
        system, inside = fs.FileSystem.from_uri(quote(path.replace("s3a://", "s3://"), safe=":/"))
        with system.open_input_stream(inside) as stream:
            head = b""
            while b"\n" not in head:
                block = stream.read(_FIRST_LINE_BYTES)
                if not block:
                    break
                head += block
                if len(head) > _HEADER_BYTES:
                    return None
        return head.split(b"\n")[0].decode("utf-8-sig", errors="replace").rstrip("\r")

    def header(path: str) -> tuple[str | None, list[str] | None, str | None]:
        try:
            line = first_line(path)
        except OSError as e:
            return None, None, f"unreadable: {e}"
        if line is None:
            return None, None, "no line end in the first part of the file"
        if not line.strip():
            return None, None, "no header"
        separator = detect_separator(line)
        return separator, next(csv.reader([line], delimiter=separator)), None

    for batch in batches:
        found = [header(p) for p in batch["path"]]
        yield pd.DataFrame(
            {
                "path": batch["path"],
                "file_name": batch["file_name"],
                "size": batch["size"].astype("Int64"),
                "separator": [f[0] for f in found],
                "columns": [f[1] for f in found],
                "error": [f[2] for f in found],
            }
        )


def read_headers(files: DataFrame) -> DataFrame:
    """Separator and column names of every file."""
    return files.select("path", "file_name", "size").mapInPandas(_first_lines, _HEADERS)


def _decoded_name() -> Column:
    # the metadata column is percent-encoded, with a literal plus sign left alone
    return F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))


def _escape_glob(path: str) -> str:
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def null_tokens(column: Column) -> Column:
    return F.when(~column.isin(*S.NULL_TOKENS), column)


def _options(separator: str) -> dict[str, str]:
    return {"sep": separator, "multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _read_whole(spark: SparkSession, paths: list[str], separator: str, schema: str) -> DataFrame:
    """The records of files that are read by one task each."""
    raw = spark.read.schema(schema).options(header="true", **_options(separator)).csv([_escape_glob(p) for p in paths])
    return raw.select(
        "*", _decoded_name().alias("_name"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def split_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(_name, _block, _row, record) of every record but the header of files of any size.

    `_block` and `_row` are those of the record's first line; (file, _block, _row) is the order in the file.
    Every quote counts, also one inside a value that isn't quoted.
    """
    line = F.col("value")
    lines = spark.read.option("lineSep", "\n").text([_escape_glob(p) for p in paths]).select(
        F.col("_metadata.file_path").alias("_file"), _decoded_name().alias("_name"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"), "value",
        ((F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2).alias("_odd"),
    )
    by_block = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # line breaks in quotes are of the file's own kind: those of a file with \r\n are read as \n, as in an unsplit read
    first_line = F.when(F.col("_block") == 0, F.col("_first"))
    blocks = lines.groupBy("_file", "_block").agg(F.sum("_odd").alias("_quotes"), F.min_by("value", "_row").alias("_first")).select(
        F.col("_file").alias("_f"), F.col("_block").alias("_b"), F.coalesce(F.sum("_quotes").over(by_block), F.lit(0)).alias("_ahead"),
        F.endswith(F.max(first_line).over(Window.partitionBy("_file")), F.lit("\r")).alias("_crlf"),
    )
    here = Window.partitionBy("_file", "_block").orderBy("_row")
    before = F.coalesce(F.sum("_odd").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = lines.join(blocks, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    joined = joined.withColumn("value", F.when(F.col("_crlf"), F.regexp_replace("value", r"\r$", "")).otherwise(F.col("value"))).drop("_crlf")
    begins = joined.withColumns(
        {"_begins": (F.col("_ahead") + before) % 2 == 0, "_header": (F.col("_block") == 0) & (F.row_number().over(here) == 1)}
    )
    place = F.struct("_block", "_row", "_header")
    marked = begins.withColumn("_start", F.last(F.when(F.col("_begins"), place), ignorenulls=True).over(here)).drop("_f", "_b", "_ahead")
    single = marked.where("_begins AND _odd = 0 AND NOT _header").select("_name", "_block", "_row", F.col("value").alias("record"))

    # what stands in a block before its first record belongs to the last record begun in an earlier block
    last = marked.where("_begins").groupBy("_file", "_block").agg(F.max(place).alias("_last"))
    every = marked.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_lines")).drop("_lines").join(last, ["_file", "_block"], "left")
    carried = every.select(
        F.col("_file").alias("_f"), F.col("_block").alias("_b"), F.last("_last", ignorenulls=True).over(by_block).alias("_carried")
    )
    parts = marked.where("NOT _begins OR _odd = 1").join(
        carried, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b"))
    ).withColumn("_start", F.coalesce("_start", "_carried"))
    whole = parts.groupBy("_file", "_name", "_start").agg(F.sort_array(F.collect_list(F.struct("_block", "_row", "value"))).alias("_parts"))
    longer = whole.where("NOT _start._header").select(
        "_name", F.col("_start._block").alias("_block"), F.col("_start._row").alias("_row"),
        F.array_join(F.transform("_parts", lambda p: p["value"]), "\n").alias("record"),
    )
    return single.unionByName(longer).where(F.col("record") != "")


def _read_split(spark: SparkSession, paths: list[str], separator: str, schema: str) -> DataFrame:
    """The records of large files, each read by many tasks."""
    records = split_records(spark, paths)
    return records.select(F.from_csv("record", schema, _options(separator)).alias("_r"), "_name", "_block", "_row").select("_r.*", "_name", "_block", "_row")


def _scan_layout(
    spark: SparkSession, files: list[tuple[str, int]], separator: str, header: list[str], family: Family
) -> DataFrame:
    """All files (path, size) with one separator and header: text columns, null tokens, lineage, row order."""
    positions = [f"c{i}" for i in range(len(header))]
    schema = ", ".join(f"{p} string" for p in positions)
    small = sorted(p for p, size in files if size <= WHOLE_FILE_BYTES)
    large = sorted(p for p, size in files if size > WHOLE_FILE_BYTES)
    reads = [read(spark, paths, separator, schema) for read, paths in ((_read_whole, small), (_read_split, large)) if paths]
    raw = reduce(DataFrame.unionByName, reads)
    if family.keep_only and family.keep_only[0] in header:
        name, value = family.keep_only
        raw = raw.filter(F.col(positions[header.index(name)]) == value)
    empty = F.lit(None).cast("string")
    columns = [
        (empty if at is None else null_tokens(F.col(positions[at]))).alias(name)
        for name, at in family.layout(header).items()
    ]
    return raw.select(*columns, F.col("_name").alias(family.file_column), "_block", "_row")


def _add_export_time(rows: DataFrame, family: Family) -> DataFrame:
    if family.time_column is None:
        return rows
    fallback = F.lit(family.time_fallback).cast("timestamp_ntz")
    stamp = F.coalesce(export_timestamp(family.file_column), fallback)
    return rows.withColumn(family.time_column, stamp)


def conform_daily(rows: DataFrame, formats: tuple[str, ...] = ()) -> DataFrame:
    """Dates and numbers of the daily contract from their text."""
    return rows.withColumns(
        {
            **{c: parse_ts(c, formats) for c in S.DAILY_DATES},
            **{c: parse_double(c) for c in S.DAILY_NUMBERS},
        }
    )


def scan_family(
    spark: SparkSession, files: DataFrame, family: Family, formats: tuple[str, ...] = ()
) -> Scan:
    """Read `files` of one family.

    The driver holds one entry per distinct layout with its file paths, the list any file read
    needs there. Rows stay lazy.
    """
    headers = read_headers(files)
    layouts = (
        headers.groupBy("separator", "columns", "error")
        .agg(F.collect_list(F.struct("path", "file_name", "size")).alias("files"))
        .collect()
    )
    scans, refused, total = [], [], 0
    for layout in layouts:
        total += len(layout["files"])
        reason = layout["error"]
        if reason is None:
            try:
                family.layout(layout["columns"])
            except MissingColumns as e:
                reason = f"missing columns: {e}"
        if reason is None:
            found = [(f["path"], f["size"] or 0) for f in layout["files"]]
            scans.append(_scan_layout(spark, found, layout["separator"], layout["columns"], family))
        else:
            refused += [(family.name, f["file_name"], reason) for f in layout["files"]]
    rows = reduce(DataFrame.unionByName, scans) if scans else None
    if rows is not None:
        rows = _add_export_time(rows, family)
        if family is DAILY:
            rows = conform_daily(rows, formats).drop("_block", "_row")
    return Scan(rows, spark.createDataFrame(refused, _ERRORS), len(refused), total)


def too_many_failed(scan: Scan) -> bool:
    return scan.failed > scan.total / 2


def file_error_gate(family: Family, scan: Scan) -> None:
    """Stop rather than publish from less than half of the files."""
    if too_many_failed(scan):
        raise TooManyBadFiles(f"{family.name}: {scan.failed} of {scan.total} files could not be read")
