from helpers import ts, tuples

from fleetday import schema as S
from fleetday.config import Config
from fleetday.streaming.order_feed import run_feed

SCHEMA = ", ".join(f"{c} string" for c in S.CANCEL_COLUMNS) + ", _ts_fichero timestamp_ntz"


def test_each_run_takes_the_newly_landed_files(spark, tmp_path):
    def land(name, *rows):
        df = spark.createDataFrame(
            [("2024-01-02 10:00:00", "a", t, "o", "CANCEL", r, None, ts(f)) for t, r, f in rows], SCHEMA
        )
        df.write.mode("append").parquet(str(tmp_path / "landed"))
        return df.schema

    def run(schema):
        table = run_feed(
            spark, S.ORDER_EVENTS, str(tmp_path / "landed"), schema, str(tmp_path / "out"),
            str(tmp_path / "ck"), Config(),
        )
        return tuples(table, "delivery_trip_uuid", "reason")

    schema = land("1", ("t", "old", "2024-01-03"), ("t", "new", "2024-01-04"), ("u", "x", "2024-01-03"))
    assert run(schema) == [("t", "new"), ("u", "x")]
    assert run(schema) == [("t", "new"), ("u", "x")]
    land("2", ("u", "y", "2024-01-05"))
    assert run(schema) == [("t", "new"), ("u", "y")]
    # an export that lands late changes nothing that a newer one has given
    land("3", ("u", "z", "2024-01-04"), ("w", "z", "2024-01-01"))
    assert run(schema) == [("t", "new"), ("u", "y"), ("w", "z")]
