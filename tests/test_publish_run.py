from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from helpers import shares, silver, ts, tuples

from fleetday import schema as S
from fleetday.config import Config
from fleetday.operators import bronze as B
from fleetday.operators import publish as P
from fleetday.operators import quality as Q
from fleetday.operators import transfer as T
from fleetday.plans.publish import publish_daily
from fleetday.plans.run import NoDailyData, _arguments, bronze_path, catch_up, run, settings, show
from fleetday.sources.publication import Publication, read_published
from fleetday.sources.tables import stage, staging

CFG = Config()
AS_OF = date(2024, 1, 10)
CLOSED = datetime(2024, 1, 10, 6, tzinfo=timezone.utc)


def adjusted(spark, frac, *rows):
    return T.apply_transfer(silver(spark, *rows), shares(spark, *frac), None)


def day(n, **kw):
    return {"datestr": ts(f"2024-01-{n:02d}"), "num_of_trips": 4.0, "online_hours": 2.0, **kw}


def test_projection_of_both_branches(spark):
    rows = [day(9, accept_trips=3.0, reject_trips=1.0, cancel_trips=1.0, city_name="m")]
    full = P.published_daily(adjusted(spark, [], *rows), AS_OF, 7)
    assert full.columns == S.PUBLISHED_COLUMNS + S.LIVE_COLUMNS
    columns = ["day", "courier_uuid", "city", "tph", "pct_accept", "pct_cancel", "flow_type"]
    assert tuples(full, *columns) == [
        ("2024-01-09", "a", "m", 2.0, 0.75, 1 / 3 * 100 / 100, None)
    ]
    plain = P.published_daily(T.unadjusted(silver(spark, *rows)), AS_OF, 7, live=False)
    assert plain.columns == S.PUBLISHED_COLUMNS
    assert tuples(plain, *columns) == [("2024-01-09", "a", "m", 2.0, 0.0, 0.0, None)]


def test_window_includes_its_first_day(spark):
    out = P.published_daily(adjusted(spark, [], day(2), day(3), day(10)), AS_OF, 7)
    assert [r[0] for r in tuples(out, "day")] == ["2024-01-03", "2024-01-10"]


def test_deletes_stay_strictly_inside_the_window_and_off_uploaded_keys(spark):
    emptied = spark.createDataFrame(
        [("a", date(2024, 1, 3)), ("a", date(2024, 1, 4)), ("a", date(2024, 1, 5))],
        "courier_uuid string, day date",
    )
    uploaded = spark.createDataFrame([("a", "2024-01-05")], "courier_uuid string, day string")
    assert tuples(P.rows_to_delete(emptied, uploaded, AS_OF, 7)) == [("a", "2024-01-04")]


def publish(spark, root, frame):
    return publish_daily(
        Q.drop_empty_days(frame), Q.emptied_keys(frame), str(root), AS_OF, CLOSED, CFG
    )


def stats(spark, root):
    return tuples(read_published(spark, str(root), S.DAILY_STATS), "courier_uuid", "day", "num_of_trips")


def test_publish_upserts_deletes_and_closes(spark, tmp_path):
    root = tmp_path / "published"
    b = {"driver_uuid": "b"}
    # first run: the sessions had not arrived, nothing moved
    assert publish(spark, root, adjusted(spark, [], day(8), day(9), day(8, **b))) == 3
    # second run: all of the 9th was early work; the day is left without any row
    second = adjusted(spark, [("a", "2024-01-09", 1.0, 2.0)], day(8), day(9), day(7, **b))
    for _ in range(2):
        assert publish(spark, root, second) == 2
        got = [(c, str(d), n) for c, d, n in stats(spark, root)]
        assert got == [("a", "2024-01-08", 8.0), ("b", "2024-01-07", 4.0), ("b", "2024-01-08", 4.0)]
        closed = tuples(read_published(spark, str(root), S.DAYS_CLOSED), "dia", "filas", "cerrado_en")
        assert [(str(d), n) for d, n, _ in closed] == [
            ("2024-01-07", 1), ("2024-01-08", 1), ("2024-01-09", 1)
        ]


def test_nothing_in_the_window_changes_nothing(spark, tmp_path):
    root = tmp_path / "published"
    assert publish(spark, root, adjusted(spark, [], day(8))) == 1
    old = adjusted(spark, [], {**day(8), "datestr": ts("2023-06-01")})
    emptied = spark.createDataFrame([("a", date(2024, 1, 8))], "courier_uuid string, day date")
    assert publish_daily(old, emptied, str(root), AS_OF, CLOSED, CFG) == 0
    assert len(stats(spark, root)) == 1


def test_a_narrow_target_gets_narrow_rows(spark, tmp_path):
    root = tmp_path / "published"
    narrow = P.published_daily(adjusted(spark, [], day(7)), AS_OF, 7, live=False)
    first = Publication(spark, str(root))
    first.merge(S.DAILY_STATS, S.TABLE_KEYS[S.DAILY_STATS], "day", narrow)
    first.commit()
    publish(spark, root, adjusted(spark, [], day(8)))
    assert set(read_published(spark, str(root), S.DAILY_STATS).columns) == set(S.PUBLISHED_COLUMNS)
    assert len(stats(spark, root)) == 2


@pytest.mark.parametrize(
    "newest, expected",
    [
        ("2024-01-10 08:00:00", 2), ("2024-01-09 13:00:00", 2), ("2024-01-08 12:00:00", 4),
        ("2024-01-08 12:00:01", 3), ("2024-01-12 00:00:00", 2), ("2023-06-01 00:00:00", 30),
        ("unreadable", 30),
    ],
)
def test_catch_up_days(spark, newest, expected):
    offers = spark.createDataFrame([(newest,), ("2023-01-01 00:00:00",)][: 1], "timestamp string")
    now = datetime(2024, 1, 10, 12)
    assert B.catch_up_days(offers, None, now, CFG).first()[0] == expected


def test_whole_run(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"

    def put(folder, name, text):
        (source / folder).mkdir(parents=True, exist_ok=True)
        (source / folder / name).write_text(text)

    head = "weekstr,datestr,driver_uuid,market_name,num_of_trips,online_hours,accept_trips\n"
    put("COURIER_DAILY", "COURIER_DAILY_20240109_060000.csv",
        head + "2024-01-08,2024-01-08,a,M,4,4,4\n2024-01-08,2024-01-09,a,M,1,1,1\n")
    put("COURIER_DAILY", "COURIER_DAILY_20240110_060000.csv",
        head + "2024-01-08,2024-01-09,a,M,2,2,2\n2024-01-08,2024-01-09,b,M,2,2,2\n")
    put("CONNECTIONS", "connections_20240110_060000.csv",
        "courier_uuid\tstatus\tstart_time\tend_time\n"
        "a\topen\t2024-01-09 00:30:00\t\na\toffline\t2024-01-09 01:30:00\t\n"
        # before the recomputed window: stored, but not read for the shares
        "a\topen\t2023-12-10 23:00:00\t2023-12-10 23:30:00\n")
    put("CANCEL", "CANCEL_20240110_060000.csv",
        ",".join(S.CANCEL_COLUMNS) + "\n2024-01-09 10:00:00,a,t,o,CANCEL,why,bike\n")
    put("CANCEL", "CANCEL_20240111_060000.csv", "hour,driver_uuid\n2024-01-10 10:00:00,a\n")
    as_of = datetime(2024, 1, 10, 12)
    assert catch_up(spark, str(target), as_of, CFG) == 30
    for _ in range(2):
        report = run(spark, str(source), str(target), as_of, CFG)
        assert tuples(report.steps) == [("adjusted", 3), ("bronze", 4), ("final", 2), ("silver", 3)]
        assert tuples(report.final, "driver_uuid", "num_of_trips", "online_hours") == [
            ("a", 6.0, 6.0), ("b", 2.0, 2.0)
        ]
        assert report.published_rows == 2 and report.feed_error is None
        assert report.feeds == {
            "cancels": "published", "late report": "no files", "late trips": "no files",
            "kilometres": "no files",
        }
        assert report.duplicates.count() == 0
        assert tuples(report.file_errors, "family", "file_name") == [("cancels", "CANCEL_20240111_060000.csv")]
        assert tuples(report.moved) == [(3, 2)] and report.without_destination.count() == 0
        show(report)
    assert catch_up(spark, str(target), as_of, CFG) == 3
    events = read_published(spark, f"{target}/published", S.ORDER_EVENTS)
    assert tuples(events, "courier_uuid", "reason") == [("a", "why")]


def test_a_runs_staging_goes_with_it(spark):
    with pytest.raises(ZeroDivisionError), staging(spark) as folder:
        assert stage(spark.range(3).toDF("n"), "numbers").count() == 3
        assert list(Path(folder).glob("numbers-*/*.parquet"))
        1 / 0  # noqa: B018
    assert not Path(folder).exists()
    assert folder not in stage(spark.range(3).toDF("n"), "numbers").inputFiles()[0]


def test_settings_from_the_command_line():
    given = _arguments(["run", "in", "out", "--sync-days", "21", "--reprocess-from", "2024-01-05", "--trace", "7", "--late-dir", "L"])
    assert settings(given) == Config(sync_days=21, reprocess_from=date(2024, 1, 5), traced_rider="7", late_dir="L")
    assert settings(_arguments(["catch-up", "out"])) == Config()


@pytest.mark.parametrize("damaged", [slice(4, 24), slice(4, 400)])  # a page; a page and the footer
def test_catch_up_leaves_a_damaged_table_out(spark, tmp_path, damaged):
    rows = spark.createDataFrame([("2024-01-08 12:00:00", "2024-01-08")], "timestamp string, day string")
    path = bronze_path(str(tmp_path), "offers", CFG)
    rows.write.parquet(path)
    path = bronze_path(str(tmp_path), "connections", CFG)
    spark.createDataFrame([("2024-01-09 13:00:00",)], "start_time string").write.parquet(path)
    for file in Path(path).glob("*.parquet"):
        data = bytearray(file.read_bytes())
        data[damaged] = bytes(len(data[damaged]))
        file.write_bytes(data)
        file.with_name(f".{file.name}.crc").unlink()
    assert catch_up(spark, str(tmp_path), datetime(2024, 1, 10, 12), CFG) == 4


def test_a_failing_order_feed_does_not_undo_the_daily_table(spark, tmp_path):
    (tmp_path / "in" / "COURIER_DAILY").mkdir(parents=True)
    (tmp_path / "in" / "CANCEL").mkdir()
    (tmp_path / "in" / "COURIER_DAILY" / "COURIER_DAILY_1.csv").write_text(
        "weekstr,datestr,driver_uuid,num_of_trips\n,2024-01-09,a,1\n")
    (tmp_path / "in" / "CANCEL" / "CANCEL_1.csv").write_text("a,b\n1,2\n")
    report = run(spark, str(tmp_path / "in"), str(tmp_path / "out"), datetime(2024, 1, 10), CFG)
    assert "cancels: 1 of 1" in report.feed_error and report.published_rows == 1


def test_no_daily_export_stops_the_run(spark, tmp_path):
    with pytest.raises(NoDailyData):
        run(spark, str(tmp_path / "in"), str(tmp_path / "out"), datetime(2024, 1, 10), CFG)
