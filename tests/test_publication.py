"""Publications: merges by key that readers see whole, the key index, and the newest export wins."""

import json
import shutil
from pathlib import Path

import pytest
from helpers import ts, tuples

from fleetday import schema as S
from fleetday.config import Config
from fleetday.operators import orders as O
from fleetday.plans import publish as plan
from fleetday.plans.orders import stored_trips
from fleetday.sources import publication as N
from fleetday.sources.tables import RepeatedKeys

SCHEMA = "k string, day string, v int"


def frame(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def merged(spark, root, *rows, deletes=None, keys=("k",), schema=SCHEMA, **kw):
    p = N.Publication(spark, str(root))
    p.merge("t", list(keys), "day", frame(spark, *rows, schema=schema), deletes, **kw)
    p.commit()


def stored(spark, root, *columns, table="t", number=None):
    return tuples(N.read_published(spark, str(root), table, number), *(columns or ("k", "day", "v")))


def folders(root, kind, table="t"):
    return {p.parent.name for p in Path(root, table, kind).glob("*/commit=*")}


def test_a_key_moves_to_its_new_day(spark, tmp_path):
    assert N.read_published(spark, str(tmp_path), "t") is None
    merged(spark, tmp_path, ("a", "2024-01-01", 1), ("b", "2024-01-02", 1))
    for _ in range(2):
        merged(spark, tmp_path, ("a", "2024-01-03", 2), ("c", "2024-01-02", 2))
        assert stored(spark, tmp_path) == [("a", "2024-01-03", 2), ("b", "2024-01-02", 1), ("c", "2024-01-02", 2)]
    assert N.read_published(spark, str(tmp_path), "other") is None


def test_deletes_and_empty_tables(spark, tmp_path):
    merged(spark, tmp_path, ("a", "2024-01-01", 1), ("b", "2024-01-01", 1), ("c", None, 3))
    gone = frame(spark, ("a",), ("x",), ("a",), schema="k string")
    merged(spark, tmp_path, ("d", "2024-01-01", 4), deletes=gone)
    assert stored(spark, tmp_path, "k", "v") == [("b", 1), ("c", 3), ("d", 4)]
    # a row that is sent and deleted at once is deleted
    merged(spark, tmp_path, ("a", "2024-01-04", 1), deletes=frame(spark, ("a",), ("b",), ("c",), ("d",), schema="k string"))
    assert stored(spark, tmp_path) == [] and N.read_published(spark, str(tmp_path), "t").columns == ["k", "day", "v"]
    before = N.commits(spark, str(tmp_path))
    p = N.Publication(spark, str(tmp_path))
    p.merge("t", ["k"], "day", frame(spark))
    assert p.commit() == before[-1] and N.commits(spark, str(tmp_path)) == before
    merged(spark, tmp_path, ("a", "2024-01-05", 6))
    assert stored(spark, tmp_path) == [("a", "2024-01-05", 6)]


def test_new_columns_are_empty_in_older_rows(spark, tmp_path):
    merged(spark, tmp_path, ("a", "2024-01-01", 1), ("b", "2024-01-02", 1))
    merged(spark, tmp_path, ("c", "2024-01-02", 2, 9), schema=SCHEMA + ", w int")
    assert stored(spark, tmp_path, "k", "v", "w") == [("a", 1, None), ("b", 1, None), ("c", 2, 9)]
    merged(spark, tmp_path, ("a", "2024-01-01", 7))
    assert stored(spark, tmp_path, "k", "v", "w") == [("a", 7, None), ("b", 1, None), ("c", 2, 9)]


@pytest.mark.parametrize("keys", [("k",), ("k", "day")])
def test_a_broken_merge_is_invisible(spark, tmp_path, monkeypatch, keys):
    merged(spark, tmp_path, ("a", "2024-01-01", 1), ("b", "2024-01-02", 1), ("c", "2024-01-03", 1), keys=keys)
    want, opened = stored(spark, tmp_path), N.read_published(spark, str(tmp_path), "t")
    write = N._write

    def broken(rows, base, part, uid):
        # the first of the touched days is written, then the run is lost
        write(rows.where("day = '2024-01-01'"), base, part, uid)
        raise OSError("lost")

    monkeypatch.setattr(N, "_write", broken)
    update = [("a", "2024-01-01", 2), ("b", "2024-01-02", 2)]
    with pytest.raises(OSError):
        merged(spark, tmp_path, *update, keys=keys)
    assert stored(spark, tmp_path) == want
    monkeypatch.setattr(N, "_write", write)
    merged(spark, tmp_path, *update, keys=keys)
    assert stored(spark, tmp_path) == [("a", "2024-01-01", 2), ("b", "2024-01-02", 2), ("c", "2024-01-03", 1)]
    # a reader that opened the table before still reads what it opened
    assert tuples(opened, "k", "day", "v") == want == stored(spark, tmp_path, number=1)


def test_tables_of_one_publication_appear_together(spark, tmp_path):
    p = N.Publication(spark, str(tmp_path))
    p.merge("t", ["k"], "day", frame(spark, ("a", "2024-01-01", 1)))
    p.merge("u", ["k"], "day", frame(spark, ("a", "2024-01-01", 1)))
    p.merge("u", ["k"], "day", frame(spark, ("a", "2024-01-02", 2), ("b", "2024-01-02", 2)))  # on top of its own merge
    assert N.read_published(spark, str(tmp_path), "t") is None
    p.commit()
    assert stored(spark, tmp_path) == [("a", "2024-01-01", 1)]
    assert stored(spark, tmp_path, table="u") == [("a", "2024-01-02", 2), ("b", "2024-01-02", 2)]


def test_two_runs_at_once_conflict(spark, tmp_path):
    first, second = (N.Publication(spark, str(tmp_path)) for _ in range(2))
    first.merge("t", ["k"], "day", frame(spark, ("a", "2024-01-01", 1)))
    second.merge("t", ["k"], "day", frame(spark, ("b", "2024-01-01", 1)))
    first.commit()
    with pytest.raises(N.Conflict):
        second.commit()
    assert stored(spark, tmp_path) == [("a", "2024-01-01", 1)] and len(N.commits(spark, str(tmp_path))) == 1


def test_repeated_keys_are_refused(spark, tmp_path):
    with pytest.raises(RepeatedKeys):
        merged(spark, tmp_path, ("a", "2024-01-01", 1), ("a", "2024-01-02", 1))


def test_a_merge_reads_touched_days_and_buckets_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(N, "BUCKET_KEYS", 4)
    rows = [(f"k{i}", f"2024-01-{1 + i % 20:02d}", i) for i in range(100)]
    merged(spark, tmp_path, *rows)
    assert len(folders(tmp_path, "keys")) > 8
    p = N.Publication(spark, str(tmp_path))
    n = p.tables["t"].n_buckets
    one = frame(spark, ("k7", "2024-01-15", -7))
    bucket = one.selectExpr(f"pmod(xxhash64(k), {n}) AS b").first()[0]
    # everything that a merge of this key has no business with is gone
    for kind, keep in (("data", {"day=2024-01-08", "day=2024-01-15"}), ("keys", {f"bucket={bucket}"})):
        for part in Path(tmp_path, "t", kind).iterdir():
            if part.is_dir() and part.name not in keep:
                shutil.rmtree(part)
    read = []
    keys_read = N._Keys._read
    monkeypatch.setattr(N._Keys, "_read", lambda self, buckets: read.append(keys_read(self, buckets)) or read[-1])
    p.merge("t", ["k"], "day", one)
    p.commit()
    assert {Path(f).parent.parent.name for r in read for f in r.inputFiles()} == {f"bucket={bucket}"}
    after = N.tables_of(spark, str(tmp_path), 2)["t"]
    assert {d for d, c in after.days.items() if c != p.tables["t"].days["2024-01-01"]} == {"2024-01-08", "2024-01-15"}
    moved = N.read_days(spark, str(tmp_path), "t", after, ["2024-01-08", "2024-01-15"])
    assert ("k7", "2024-01-15", -7) in tuples(moved, "k", "day", "v") and moved.where("k = 'k7'").count() == 1


def test_the_index_grows_with_its_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(N, "BUCKET_KEYS", 5)
    for at in range(0, 120, 40):
        merged(spark, tmp_path, *[(f"k{i}", "2024-01-01", i) for i in range(at, at + 40)])
    state = N.tables_of(spark, str(tmp_path), 3)["t"]
    assert state.n_keys == 120 and 120 / state.n_buckets <= 20 and len(state.buckets) <= state.n_buckets
    merged(spark, tmp_path, *[(f"k{i}", "2024-01-02", -i) for i in range(0, 120, 2)], deletes=frame(spark, ("k1",), schema="k string"))
    assert N.tables_of(spark, str(tmp_path), 4)["t"].n_keys == 119
    assert stored(spark, tmp_path) == sorted((f"k{i}", f"2024-01-0{1 + (i % 2 == 0)}", i if i % 2 else -i) for i in range(120) if i != 1)


def test_updates_meet_the_index_once(spark, tmp_path, monkeypatch):
    """Days and counts come from one staged table of accepted rows, with what each found in the index."""
    schema = SCHEMA + ", at timestamp_ntz"
    kw = {"schema": schema, "version": "at"}
    merged(spark, tmp_path, *[(f"k{i}", "2024-01-01", i, ts("2024-01-02")) for i in range(4)], **kw)
    staged, stage = [], N.stage
    monkeypatch.setattr(N, "stage", lambda df, name: staged.append(name) or stage(df, name))
    rows = [("k0", "2024-01-05", -1, ts("2024-01-01")), ("k1", "2024-01-05", -1, ts("2024-01-03")), ("k9", None, 9, ts("2024-01-03"))]
    merged(spark, tmp_path, *rows, deletes=frame(spark, ("k2",), ("x",), schema="k string"), **kw)
    assert staged == ["t-accepted"]
    assert stored(spark, tmp_path) == [("k0", "2024-01-01", 0), ("k1", "2024-01-05", -1), ("k3", "2024-01-01", 3), ("k9", None, 9)]
    assert N.tables_of(spark, str(tmp_path), 2)["t"].n_keys == 4


def test_an_older_version_changes_nothing(spark, tmp_path):
    schema = SCHEMA + ", at timestamp_ntz"
    kw = {"schema": schema, "version": "at"}
    merged(spark, tmp_path, ("a", "2024-01-05", 5, ts("2024-01-05")), ("b", "2024-01-05", 5, ts("2024-01-05")), ("c", "2024-01-05", 5, None), **kw)
    assert N.read_published(spark, str(tmp_path), "t").columns == ["k", "day", "v"]
    merged(spark, tmp_path, ("a", "2024-01-04", 4, ts("2024-01-04")), ("b", "2024-01-06", 6, ts("2024-01-06")), ("c", "2024-01-05", 6, ts("2024-01-01")),
           ("d", "2024-01-01", 1, ts("2024-01-01")), **kw)
    assert stored(spark, tmp_path) == [("a", "2024-01-05", 5), ("b", "2024-01-06", 6), ("c", "2024-01-05", 6), ("d", "2024-01-01", 1)]
    merged(spark, tmp_path, ("a", "2024-01-05", 55, ts("2024-01-05")), ("b", "2024-01-06", 7, None), **kw)
    assert stored(spark, tmp_path, "k", "v") == [("a", 55), ("b", 6), ("c", 6), ("d", 1)]


def test_expired_commits_leave_the_last_ones_readable(spark, tmp_path):
    for v in range(4):
        merged(spark, tmp_path, ("a", "2024-01-01", v), ("b", f"2024-02-0{v + 1}", v))
    (tmp_path / "t" / "data" / "day=2024-01-01" / "commit=left-by-a-broken-run").mkdir()
    N.expire(spark, str(tmp_path), 2)
    assert N.commits(spark, str(tmp_path)) == [3, 4]
    assert stored(spark, tmp_path) == [("a", "2024-01-01", 3), ("b", "2024-02-04", 3)]
    assert stored(spark, tmp_path, number=3) == [("a", "2024-01-01", 2), ("b", "2024-02-03", 2)]
    assert len(list((tmp_path / "t" / "data" / "day=2024-01-01").glob("commit=*"))) == 2


# --- the order feeds

CANCELS = ", ".join(f"{c} string" for c in S.CANCEL_COLUMNS) + ", _ts_fichero timestamp_ntz"


def cancels(spark, *rows):
    return frame(spark, *[("2024-01-02 10:00:00", "a", t, "o", "CANCEL", r, None, ts(f)) for t, r, f in rows], schema=CANCELS)


def late(spark, *rows):
    schema = ("driver_uuid string, delivery_trip_uuid string, order_id string, courier_accept_timestamp_local string, "
              "actual_p2_driving double, estimated_p2_driving double, actual_p3_driving double, estimated_p3_driving double, _ts_fichero timestamp_ntz")
    return frame(spark, *[("a", t, "o", "2024-01-02 10:00:00", s, 0.0, 0.0, 0.0, ts(f)) for t, s, f in rows], schema=schema)


def test_the_newest_export_wins_in_any_order(spark, tmp_path):
    cfg = Config()
    for rows in ((("t", "new", "2024-01-04"),), (("t", "old", "2024-01-03"), ("u", "old", "2024-01-03"))):
        report = plan.publish_events(spark, {"cancels": cancels(spark, *rows)}, str(tmp_path), cfg)
        assert report == {"cancels": "published", "late report": "no files", "late trips": "no files", "kilometres": "no files"}
    assert stored(spark, tmp_path, "delivery_trip_uuid", "reason", table=S.ORDER_EVENTS) == [("t", "new"), ("u", "old")]


def test_feeds_are_published_together_or_not_at_all(spark, tmp_path, monkeypatch):
    cfg, root = Config(), str(tmp_path)
    plan.publish_events(spark, {"cancels": cancels(spark, ("t", "old", "2024-01-03"))}, root, cfg)
    inputs = {"cancels": cancels(spark, ("t", "new", "2024-01-04")), "late": late(spark, ("t", 5.0, "2024-01-04"))}
    merge = plan.merge_feed

    def broken(publication, name, rows, cfg):
        merge(publication, name, rows, cfg)
        if name == "late report":
            raise OSError("lost after the second table")

    monkeypatch.setattr(plan, "merge_feed", broken)
    with pytest.raises(OSError):
        plan.publish_events(spark, inputs, root, cfg)
    assert stored(spark, root, "reason", table=S.ORDER_EVENTS) == [("old",)]
    assert N.read_published(spark, root, S.ORDER_DELAYS) is None
    monkeypatch.setattr(plan, "merge_feed", merge)
    plan.publish_events(spark, inputs, root, cfg)
    assert stored(spark, root, "reason", table=S.ORDER_EVENTS) == [("new",)]
    assert stored(spark, root, "retraso_p2", table=S.ORDER_DELAYS) == [(5.0,)]
    assert set(json.loads(Path(root, "_commits", "000000002.json").read_text())) == {S.ORDER_EVENTS, S.ORDER_DELAYS}


def test_a_missing_target_is_skipped(spark, tmp_path):
    inputs = {"cancels": cancels(spark, ("t", "x", "2024-01-04")), "late": late(spark, ("t", 5.0, "2024-01-04"))}
    report = plan.publish_events(spark, inputs, str(tmp_path), Config(), (S.ORDER_EVENTS,))
    assert report["cancels"] == "published" and report["late report"] == f"skipped: no table {S.ORDER_DELAYS}"
    assert N.read_published(spark, str(tmp_path), S.ORDER_DELAYS) is None


def test_trips_are_stored_with_their_times_parsed(spark, tmp_path):
    """Parsed once for all feeds; the drop-off stays text, as unreadable text fills it."""
    columns = "_ts_fichero timestamp_ntz, courier_uuid string, trip_uuid string, momento string, km string, form_factor string, _row long, " + ", ".join(
        f"{c} string" for c in S.TRIP_OPTIONAL
    )

    def trip(n, momento, accept, dropoff):
        values = dict.fromkeys(S.TRIP_OPTIONAL) | {"courier_accept_timestamp_local": accept, "courier_dropoff_timestamp_local": dropoff}
        return (ts("2024-01-04"), "a", f"t{n}", momento, "1.5", None, n, *values.values())

    rows = frame(
        spark,
        trip(1, "2024-01-02 10:00:00", "2024-01-02 10:00:00", "soon"),
        trip(2, "2/1/2024 01:00:00", "2024/01/02 01:00:00.5", "2024-01-02 02:00:00"),
        trip(3, "2024-01-02 10:00:00", "2024-13-02 10:00:00", None),
        trip(4, "2024", "2024-01-02 10:00:00", None),
        trip(5, "2024-01-02", "2024-01-02T10:00", None),
        schema=columns,
    )
    kept = stored_trips(rows, Config())
    typed = dict(kept.dtypes)
    assert {typed[c] for c in ("momento", "courier_accept_timestamp_local")} == {"timestamp_ntz"}
    assert typed["courier_dropoff_timestamp_local"] == "string"
    for read in (O.usable_trips, O.order_km):
        assert sorted(map(str, read(kept, Config()).collect())) == sorted(map(str, read(rows, Config()).collect()))
    assert tuples(O.usable_trips(kept, Config()), "trip_uuid", "_has_dropoff") == [("t1", True), ("t2", True), ("t5", False)]
