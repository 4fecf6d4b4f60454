import random
import shutil
import tempfile
from datetime import date, datetime
from pathlib import Path

import pandas as pd
import pytest
from helpers import ts, tuples
from pyspark.sql import functions as F

from fleetday import schema as S
from fleetday.config import Config
from fleetday.plans import ingest as plan
from fleetday.plans.ingest import ingest, known_keys
from fleetday.sources import csv_files, families as FA
from fleetday.sources.tables import append_table
from fleetday.sources.csv_files import (
    TooManyBadFiles,
    detect_separator,
    discover_files,
    file_error_gate,
    scan_family,
)

CFG = Config()
AS_OF = datetime(2024, 2, 1, 12)


def scan(spark, folder, family):
    return scan_family(spark, discover_files(spark, str(folder), family.pattern), family)


def put(folder, name, text, **kw):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, newline="", **kw)


@pytest.mark.parametrize(
    "line, expected", [("a\tb\tc,d", "\t"), ("a,b", ","), ("a\tb,c", ","), ("a", ",")]
)
def test_separator_needs_strictly_more_tabs(line, expected):
    assert detect_separator(line) == expected


def test_patterns(spark, tmp_path):
    for name in [
        "x_courier_daily_1.csv", "COURIER_DAILY.CSV", "CANCEL_1.csv", "CANCELLATION_1.csv",
        "xCANCEL_1.csv", "my connections [1].csv", "notes.csv",
    ]:
        put(tmp_path, name, "a\n1\n")
    found = {
        f.name: [r[0] for r in tuples(discover_files(spark, str(tmp_path), f.pattern), "file_name")]
        for f in (FA.DAILY, FA.CANCELS, FA.OFFERS, FA.CONNECTIONS)
    }
    assert found == {
        "daily": ["x_courier_daily_1.csv"],
        "cancels": ["CANCEL_1.csv"],
        "offers": ["CANCELLATION_1.csv"],
        "connections": ["my connections [1].csv"],
    }
    assert discover_files(spark, str(tmp_path / "none"), FA.DAILY.pattern).count() == 0


def test_layouts_null_tokens_quotes_and_ragged_rows(spark, tmp_path):
    put(tmp_path, "connections a+b 20%.csv",
        'status,courier_uuid,start_time,extra,courier_name\n'
        'open,a,2024-01-01 10:00:00,x,"two\nlines, ""quoted"""\n'
        'NA,null,NULL,\\N,\n'
        'open,b\n'
        'open,c,2024-01-01 10:00:00,x,n,too,many\n')
    put(tmp_path, "connections_tab.csv",
        "courier_uuid\tstatus\tstart_time\tend_time\r\nd\topen\t2024-01-01 11:00:00\t\r\n")
    put(tmp_path, "connections_bom.csv", "﻿courier_uuid,status,start_time\ne,open,x\n")
    put(tmp_path, "connections_bad.csv", "courier_uuid,status\nz,open\n")
    result = scan(spark, tmp_path, FA.CONNECTIONS)
    assert (result.failed, result.total) == (1, 4)
    assert tuples(result.errors) == [
        ("connections", "connections_bad.csv", "missing columns: start_time")
    ]
    got = tuples(result.rows, "courier_uuid", "status", "start_time", "end_time", "courier_name",
                 "conn_file")
    one, tab = "connections a+b 20%.csv", "connections_tab.csv"
    assert got == sorted(
        [
            ("a", "open", "2024-01-01 10:00:00", None, 'two\nlines, "quoted"', one),
            (None, None, None, None, None, one),
            ("b", "open", None, None, None, one),
            ("c", "open", "2024-01-01 10:00:00", None, "n", one),
            ("d", "open", "2024-01-01 11:00:00", None, None, tab),
            ("e", "open", "x", None, None, "connections_bom.csv"),
        ],
        key=str,
    )


def test_files_without_bytes_fail_for_want_of_a_header(spark, tmp_path):
    put(tmp_path, "CANCEL_1 a+b.csv", "")
    put(tmp_path, "CANCEL_2.csv", ",".join(S.CANCEL_COLUMNS) + "\n2024-01-09 10:00:00,a,t,o,CANCEL,why,bike\n")
    result = scan(spark, tmp_path, FA.CANCELS)
    assert (result.failed, result.total) == (1, 2)
    assert tuples(result.errors) == [("cancels", "CANCEL_1 a+b.csv", "no header")]


def test_a_key_whose_first_row_has_expired_has_no_row(spark, tmp_path):
    head = "timestamp,offer_id,courier_uuid\n"
    put(tmp_path, "CANCELLATION_20240101_000000.csv", head + "2023-01-01 10:00:00,O1,a\n2024-01-01 10:00:00,O2,a\n")
    put(tmp_path, "CANCELLATION_20240102_000000.csv", head + "2024-01-02 10:00:00,O1,b\n2024-01-02 10:00:00,O3,b\n")
    now = datetime(2024, 1, 3)
    bronze, _ = ingest(spark, FA.OFFERS, str(tmp_path), str(tmp_path / "bronze"), now, Config())
    assert tuples(bronze, "offer_id", "courier_uuid") == [("O2", "a"), ("O3", "b")]


def test_daily_contract(spark, tmp_path):
    put(tmp_path, "COURIER_DAILY_20240102_030405.csv",
        "datestr\tweekstr\tdriver_uuid\tnum_of_trips\tcity_id\tunknown\n"
        "2024-01-01\t2024-01-01 00:00:00\ta\t3\tx1\tq\n")
    put(tmp_path, "COURIER_DAILY_none.csv", "datestr,weekstr,driver_uuid\nbad,,b\n")
    put(tmp_path, "COURIER_DAILY_refused.csv", "weekstr,driver_uuid\n2024-01-01,c\n")
    result = scan(spark, tmp_path, FA.DAILY)
    assert result.rows.columns == [*S.DAILY_COLUMNS, "file_name", "file_date"]
    assert tuples(result.rows, "driver_uuid", "datestr", "num_of_trips", "city_id", "file_date") == [
        ("a", ts("2024-01-01"), 3.0, None, ts("2024-01-02 03:04:05")),
        ("b", None, None, None, ts("0001-01-01")),
    ]
    assert result.failed == 1


def test_trip_aliases_and_delivery_status(spark, tmp_path):
    put(tmp_path, "trips_1.csv",
        "courier_uuid,driver_uuid,order_uuid,job_uuid,day_date,distance_km,delivery_status\n"
        "c,d,o,j,2024-01-01,1.5,COMPLETED\nc,d,o2,j2,2024-01-01,1.5,FAILED\n"
        "c,d,o3,j3,2024-01-01,1.5,\n")
    put(tmp_path, "trips_2.csv", "courier_uuid,trip_uuid,datestr,km\nc,t,2024-01-01,1\n")
    result = scan(spark, tmp_path, FA.TRIPS)
    assert tuples(result.rows, "courier_uuid", "trip_uuid", "momento", "km", "order_id") == [
        ("d", "j", "2024-01-01", "1.5", None)
    ]
    assert tuples(result.errors, "reason") == [("missing columns: km",)]


@pytest.mark.parametrize("bad, raises", [(1, False), (2, True)])
def test_error_gate_is_strict(spark, tmp_path, bad, raises):
    good = 2 if bad == 1 else 1
    # one of two stays, two of three stops
    for n in range(good if bad == 2 else 1):
        put(tmp_path, f"CANCEL_ok{n}.csv", ",".join(S.CANCEL_COLUMNS) + "\n" + ",".join("1234567") + "\n")
    for n in range(bad):
        put(tmp_path, f"CANCEL_bad{n}.csv", "a,b\n1,2\n")
    result = scan(spark, tmp_path, FA.CANCELS)
    if raises:
        with pytest.raises(TooManyBadFiles):
            file_error_gate(FA.CANCELS, result)
    else:
        file_error_gate(FA.CANCELS, result)


HEADER = "courier_uuid,status,start_time,end_time\n"


def run(spark, tmp_path, family, as_of=AS_OF, cfg=CFG):
    table, report = ingest(
        spark, family, str(tmp_path / "in"), str(tmp_path / "bronze"), as_of, cfg
    )
    return table, report


def test_first_row_of_a_key_stays_and_rereading_changes_nothing(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "connections_20240105_000000.csv", HEADER + "a,open,2024-01-04 10:00:00,\n")
    first, _ = run(spark, tmp_path, FA.CONNECTIONS)
    put(folder, "connections_20240106_000000.csv",
        HEADER + "a,open,2024-01-04 10:00:00,2024-01-04 11:00:00\nb,open,2024-01-05 10:00:00,x\n"
        "b,open,2024-01-05 10:00:00,later\nc,open,unreadable,\nd,open,2023-11-01 10:00:00,\n")
    # only holds a known row, but is entered in the ledger like any other
    put(folder, "connections_20240107_000000.csv", HEADER + "b,open,2024-01-05 10:00:00,z\n")
    columns = ["courier_uuid", "start_time", "end_time"]
    expected = [
        ("a", "2024-01-04 10:00:00", None),
        ("b", "2024-01-05 10:00:00", "x"),
        ("c", "unreadable", None),
    ]
    table, report = run(spark, tmp_path, FA.CONNECTIONS)
    assert tuples(table, *columns) == expected and report.total == 2
    again, report = run(spark, tmp_path, FA.CONNECTIONS)
    assert tuples(again, *columns) == expected and report.total == 0


def test_rows_that_a_broken_run_left_are_replaced(spark, tmp_path):
    """Half a file is in the table and its name is not in the ledger."""
    head = "datestr,weekstr,driver_uuid,num_of_trips\n"
    put(tmp_path / "in", "COURIER_DAILY_20240105_060000.csv", head + "2024-01-04,,a,1\n2024-01-03,,a,2\n")
    run(spark, tmp_path, FA.DAILY)
    put(tmp_path / "in", "COURIER_DAILY_20240106_060000.csv", head + "2024-01-04,,b,3\n2024-01-05,,b,4\n")
    half = spark.read.parquet(str(tmp_path / "bronze")).filter("num_of_trips = 1").withColumns(
        {"driver_uuid": F.lit("b"), "num_of_trips": F.lit(3.0), "file_name": F.lit("COURIER_DAILY_20240106_060000.csv")})
    append_table(half, str(tmp_path / "bronze"), S.BRONZE_DAY)
    for total in (1, 0):
        table, report = run(spark, tmp_path, FA.DAILY)
        assert report.total == total
        assert tuples(table, "driver_uuid", "num_of_trips") == [("a", 1.0), ("a", 2.0), ("b", 3.0), ("b", 4.0)]


def test_a_table_from_before_the_ledger(spark, tmp_path):
    put(tmp_path / "in", "connections_1.csv", HEADER + "a,open,2024-01-04 10:00:00,\n")
    run(spark, tmp_path, FA.CONNECTIONS)
    (tmp_path / "bronze_files").rename(tmp_path / "elsewhere")
    _, report = run(spark, tmp_path, FA.CONNECTIONS)
    assert report.total == 0


def test_retention_drops_old_days_and_keeps_unreadable_dates(spark, tmp_path):
    put(tmp_path / "in", "connections_1.csv",
        HEADER + "a,open,2024-01-04 10:00:00,\nb,open,2024-01-04 08:00:00,\n"
        "c,open,2024-01-03 10:00:00,\nd,open,bad,\ne,open,2024-01-20 00:00:00,\n")
    run(spark, tmp_path, FA.CONNECTIONS)
    later = datetime(2024, 3, 4, 9)  # sixty days after 4 January 09:00
    table, _ = run(spark, tmp_path, FA.CONNECTIONS, later)
    assert [r[0] for r in tuples(table, "courier_uuid")] == ["a", "d", "e"]
    days = sorted(p.name for p in (tmp_path / "bronze").glob("_day=*"))
    assert days == ["_day=2024-01-04", "_day=2024-01-20", "_day=__HIVE_DEFAULT_PARTITION__"]


def test_null_offer_ids_collapse_to_one(spark, tmp_path):
    put(tmp_path / "in", "CANCELLATION_20240105_000000.csv",
        "offer_id,timestamp,courier_uuid\n,2024-01-04 10:00:00,a\n,2024-01-04 11:00:00,b\n"
        "o,2024-01-04 12:00:00,c\n")
    table, _ = run(spark, tmp_path, FA.OFFERS)
    assert tuples(table, "offer_id", "courier_uuid") == [("o", "c"), (None, "a")]
    put(tmp_path / "in", "CANCELLATION_20240106_000000.csv",
        "offer_id,timestamp,courier_uuid\n,2024-01-05 10:00:00,z\n")
    table, _ = run(spark, tmp_path, FA.OFFERS)
    assert tuples(table, "offer_id", "courier_uuid") == [("o", "c"), (None, "a")]


OFFERS_HEAD = "offer_id,timestamp,courier_uuid\n"


def test_first_offers_are_found_in_the_touched_buckets_only(spark, tmp_path):
    put(tmp_path / "in", "CANCELLATION_20240105_000000.csv", OFFERS_HEAD + "".join(f"o{i},2024-01-04 10:00:00,a\n" for i in range(300)))
    run(spark, tmp_path, FA.OFFERS)
    path = str(tmp_path / "bronze")
    new = spark.createDataFrame([("o7",), ("new",)], "offer_id string")
    known = known_keys(spark, path, FA.OFFERS, new, CFG)
    bucket = {r[0] for r in new.selectExpr(f"pmod(xxhash64(offer_id), {CFG.key_buckets})").collect()}
    scan = next(line for line in known._jdf.queryExecution().toString().splitlines() if "FileScan" in line)
    assert "_bucket" in scan.split("PartitionFilters:")[1].split("]")[0]
    assert 0 < known.count() < 40 and known.where("offer_id = 'o7'").count() == 1
    # a run with one new and one known offer reads no key outside these buckets
    for part in (tmp_path / "bronze_keys").glob("_day=*/_bucket=*"):
        if int(part.name.removeprefix("_bucket=")) not in bucket:
            shutil.rmtree(part)
    put(tmp_path / "in", "CANCELLATION_20240106_000000.csv", OFFERS_HEAD + "o7,2024-01-05 10:00:00,b\nnew,2024-01-05 10:00:00,b\n")
    table, _ = run(spark, tmp_path, FA.OFFERS)
    assert table.count() == 301 and tuples(table.where("offer_id in ('o7', 'new')"), "offer_id", "courier_uuid") == [("new", "b"), ("o7", "a")]


@pytest.mark.parametrize("broken", ["after rows", "after keys", "keys lost"])
def test_offers_of_a_broken_run_are_read_again(spark, tmp_path, monkeypatch, broken):
    put(tmp_path / "in", "CANCELLATION_20240105_000000.csv", OFFERS_HEAD + "a,2024-01-04 10:00:00,x\nold,2023-11-20 10:00:00,x\n")
    run(spark, tmp_path, FA.OFFERS)
    put(tmp_path / "in", "CANCELLATION_20240106_000000.csv", OFFERS_HEAD + "a,2024-01-05 10:00:00,y\nb,2024-01-05 10:00:00,y\n")
    append = plan._append_keys

    def lost(*args):
        if broken == "after keys":
            append(*args)
        raise OSError("lost")

    if broken == "keys lost":
        shutil.rmtree(tmp_path / "bronze_keys")
    else:
        monkeypatch.setattr(plan, "_append_keys", lost)
        with pytest.raises(OSError):
            run(spark, tmp_path, FA.OFFERS)
        monkeypatch.setattr(plan, "_append_keys", append)
    for total in (1, 0):
        table, report = run(spark, tmp_path, FA.OFFERS)
        assert report.total == total
        assert tuples(table, "offer_id", "courier_uuid") == [("a", "x"), ("b", "y")]
    # keys expire with their rows: an offer whose first row has gone is new again
    later = datetime(2024, 3, 6, 12)
    put(tmp_path / "in", "CANCELLATION_20240305_000000.csv", OFFERS_HEAD + "a,2024-03-05 10:00:00,z\n")
    run(spark, tmp_path, FA.OFFERS, later)
    put(tmp_path / "in", "CANCELLATION_20240306_000000.csv", OFFERS_HEAD + "b,2024-03-05 10:00:00,z\n")
    table, _ = run(spark, tmp_path, FA.OFFERS, later)
    assert ("b", "z") in tuples(table, "offer_id", "courier_uuid")


def test_reprocessing_reads_files_again_that_are_still_there(spark, tmp_path):
    head = "datestr,weekstr,driver_uuid,num_of_trips\n"
    folder = tmp_path / "in"
    put(folder, "COURIER_DAILY_20240105_060000.csv", head + "2024-01-04,,a,1\n2024-01-03,,a,1\n")
    put(folder, "COURIER_DAILY_20240106_060000.csv", head + "2024-01-04,,b,1\nbad,,n,1\n")
    put(folder, "COURIER_DAILY_20240107_060000.csv", head + "2024-01-06,,c,1\n")
    run(spark, tmp_path, FA.DAILY)
    put(folder, "COURIER_DAILY_20240105_060000.csv", head + "2024-01-04,,a,9\n")
    put(folder, "COURIER_DAILY_20240106_060000.csv", head + "2024-01-04,,b,9\nbad,,n,9\n")
    (folder / "COURIER_DAILY_20240107_060000.csv").rename(tmp_path / "kept_elsewhere.csv")
    cfg = Config(reprocess_from=date(2024, 1, 6))
    table, report = run(spark, tmp_path, FA.DAILY, cfg=cfg)
    assert report.total == 1
    assert tuples(table, "driver_uuid", "datestr", "num_of_trips") == [
        ("a", ts("2024-01-03"), 1.0),
        ("a", ts("2024-01-04"), 1.0),
        ("b", ts("2024-01-04"), 9.0),
        ("c", ts("2024-01-06"), 1.0),
        ("n", None, 9.0),
    ]


def test_nothing_new_writes_nothing(spark, tmp_path):
    put(tmp_path / "in", "COURIER_DAILY_20240105_060000.csv", "datestr,weekstr\n2024-01-04,\n")
    run(spark, tmp_path, FA.DAILY)
    before = sorted((p, p.stat().st_mtime_ns) for p in (tmp_path / "bronze").rglob("*.parquet"))
    _, report = run(spark, tmp_path, FA.DAILY)
    after = sorted((p, p.stat().st_mtime_ns) for p in (tmp_path / "bronze").rglob("*.parquet"))
    assert before == after and report.total == 0


def test_no_files_and_no_bronze(spark, tmp_path):
    table, report = run(spark, tmp_path, FA.OFFERS)
    assert table is None and report.total == 0


def quoted(value):
    return '"' + value.replace('"', '""') + '"'


@pytest.mark.parametrize("end, block, seed", [("\n", 7, 1), ("\n", 40, 2), ("\r\n", 40, 3), ("\r\n", 300, 4), ("\n", 300, 5)])
def test_a_large_file_cut_by_quote_parity_equals_the_unsplit_read(spark, tmp_path, end, block, seed):
    """Line breaks, quotes and separators in quotes, blocks of a few bytes, records longer than a block."""
    pick = random.Random(seed)
    text = lambda: "".join(pick.choice(["a", "b", ",", '"', "\n", "\n", "\r\n", " ", "é"]) for _ in range(pick.randrange(12)))
    for name in ("one", "two"):
        rows = [(text(), text() * pick.choice([1, 1, 9])) for _ in range(40)]
        lines = ["a,b", *[",".join(map(quoted, r)) for r in rows], "plain,row", "", "short"]
        (tmp_path / f"{name}.csv").write_text(end.join(lines) + end * pick.randrange(2), newline="")
    paths = [f"file:{tmp_path}/{n}.csv" for n in ("one", "two")]
    order = ["_name", "_block", "_row"]
    read = lambda how: how(spark, paths, ",", "c0 string, c1 string").orderBy(*order).select("_name", "c0", "c1").collect()
    whole = read(csv_files._read_whole)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert read(csv_files._read_split) == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    body = "".join(f'c{i},open,2024-01-0{1 + i % 9} 00:00:00,,"fleet {i}\nof, ""{i % 3}""",x\n' for i in range(400))
    put(tmp_path, "connections_20240110_060000.csv", "courier_uuid,status,start_time,end_time,fleet_name,contact_number\n" + body)
    want = tuples(scan(spark, tmp_path, FA.CONNECTIONS).rows.drop("_block", "_row"))
    assert len(want) == 400 and any("\\n" in str(r) for r in want)
    monkeypatch.setattr(csv_files, "WHOLE_FILE_BYTES", 1000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = scan(spark, tmp_path, FA.CONNECTIONS).rows
        assert tuples(read.drop("_block", "_row")) == want
        assert read.select("_block").distinct().count() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_file_without_line_ends_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_files, "_HEADER_BYTES", 1000)
    put(tmp_path, "connections_1.csv", "x," * 50_000)
    # workers are other processes: the bound is tested in this one
    found = next(csv_files._first_lines(iter([pd.DataFrame({"path": [f"file:{tmp_path}/connections_1.csv"], "file_name": ["connections_1.csv"], "size": [100_000]})])))
    assert found["error"].tolist() == ["no line end in the first part of the file"]
