"""The registered queries as SQL for another engine, over the same Parquet tables.

Written with joins and group-bys where the Spark side uses windows, so that the two do not share a
formulation.
"""

from __future__ import annotations

from fleetday import schema as S

_CTES: dict[str, str] = {}
_NEEDS: dict[str, list[str]] = {}


def _cte(name: str, sql: str, *needs: str) -> None:
    _CTES[name], _NEEDS[name] = sql, list(needs)


def _with(sql: str, *needs: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS[name]:
            add(n)
        if name not in ordered:
            ordered.append(name)

    for n in needs:
        add(n)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in ordered) + "\n" + sql


# ------------------------------------------------------------------ inputs

_cte(
    "ev",
    """SELECT event_id, ts, user_id, event_type, value,
              CAST(floor(value * 60) AS BIGINT) AS secs, CAST(floor(value) AS BIGINT) AS whole,
              CAST(user_id AS VARCHAR) AS rider
       FROM events""",
)
_cte(
    "conn",
    """SELECT rider AS courier_uuid,
              CASE event_type WHEN 'view' THEN 'open' WHEN 'click' THEN 'enroute'
                   WHEN 'purchase' THEN 'ontrip' WHEN 'signup' THEN 'offline'
                   WHEN 'error' THEN 'unavailable' END AS status,
              CAST(ts AS VARCHAR) AS start_time,
              CASE WHEN event_id % 3 <> 0
                   THEN CAST(ts + INTERVAL 1 SECOND * secs AS VARCHAR) END AS end_time,
              'connections_20240131_000000.csv' AS conn_file
       FROM ev
       UNION ALL
       SELECT rider, 'open', 'n/a ' || event_id, NULL, 'connections_20240131_000000.csv'
       FROM ev WHERE event_id % 97 = 0""",
    "ev",
)
_cte(
    "conn2",
    """SELECT courier_uuid, status, start_time, end_time, conn_file FROM conn
       UNION ALL
       SELECT courier_uuid, status, start_time, NULL, 'connections_20240116_000000.csv'
       FROM conn WHERE start_time < '2024-01-16 00:00:00'""",
    "conn",
)
_cte(
    "offers",
    """SELECT CAST(ts AS VARCHAR) AS "timestamp", rider AS courier_uuid,
              CASE WHEN event_id % 50 <> 0 THEN 'O' || event_id END AS offer_id,
              CASE WHEN event_type = 'error' THEN 'REJECT' ELSE 'ACCEPT' END AS courier_action,
              'r' || user_id AS email, 'CANCELLATION_RTA_20240131_000000.csv' AS rta_file
       FROM ev""",
    "ev",
)
_cte(
    "offers2",
    """SELECT "timestamp", courier_uuid, offer_id, courier_action, email, rta_file FROM offers
       UNION ALL
       SELECT "timestamp", courier_uuid, offer_id, courier_action, NULL,
              'CANCELLATION_RTA_20240116_000000.csv'
       FROM offers WHERE CAST("timestamp" AS TIMESTAMP) < TIMESTAMP '2024-01-16 00:00:00'""",
    "offers",
)

_EMPTY_DOUBLES = [
    "unavailable_hours", "cancel_not_at_fault_trips", "p2_km_avg", "p2_min_avg", "p3_km", "p3_min",
    "p3_km_avg", "p3_min_avg", "total_km_avg", "total_min_avg",
]
_cte(
    "daily_once",
    f"""SELECT CAST(date_trunc('week', d) AS TIMESTAMP) AS weekstr, CAST(d AS TIMESTAMP) AS datestr,
              rider AS driver_uuid, 'rider ' || rider AS driver_name,
              CAST(NULL AS VARCHAR) AS driver_number, 'r' || rider || '@example.org' AS driver_email,
              'fleet ' || (user_id % 3) AS fleet_name, CAST(user_id % 7 AS DOUBLE) AS city_id,
              'city ' || (user_id % 7) AS city_name, 'M' || m AS market_name,
              CAST(NULL AS VARCHAR) AS form_factor,
              secs / 3600.0::DOUBLE AS online_hours,
              0.75::DOUBLE * secs / 3600.0::DOUBLE AS active_hours,
              view_secs / 3600.0::DOUBLE AS open_hours,
              click_secs / 3600.0::DOUBLE AS enroute_p2_hours,
              purchase_secs / 3600.0::DOUBLE AS ontrip_p3_hours,
              CAST(n AS DOUBLE) AS num_of_trips, CAST(views AS DOUBLE) AS single_trips_total,
              CASE WHEN user_id % 2 <> 0 THEN CAST(purchases AS DOUBLE) END AS late_p2_trips,
              CASE WHEN user_id % 3 <> 0 THEN CAST(clicks AS DOUBLE) END AS late_p3_trips,
              CAST(n - errors AS DOUBLE) AS accept_trips, CAST(errors AS DOUBLE) AS reject_trips,
              CAST(signups AS DOUBLE) AS cancel_trips,
              whole / 10.0::DOUBLE AS p2_km, secs / 60.0::DOUBLE AS p2_min,
              whole / 5.0::DOUBLE AS total_km, secs / 30.0::DOUBLE AS total_min,
              {", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in _EMPTY_DOUBLES)},
              'COURIER_DAILY_2024020' || (v + 1) || '_060000.csv' AS file_name,
              strptime('2024020' || (v + 1) || '060000', '%Y%m%d%H%M%S') AS file_date
       FROM (SELECT user_id, rider, CAST(ts AS DATE) AS d, event_id % 2 AS m, event_id % 3 AS v,
                    count(*) AS n, CAST(sum(secs) AS BIGINT) AS secs,
                    CAST(sum(whole) AS BIGINT) AS whole,
                    CAST(sum(CASE WHEN event_type = 'view' THEN secs ELSE 0 END) AS BIGINT) AS view_secs,
                    CAST(sum(CASE WHEN event_type = 'click' THEN secs ELSE 0 END) AS BIGINT) AS click_secs,
                    CAST(sum(CASE WHEN event_type = 'purchase' THEN secs ELSE 0 END) AS BIGINT)
                        AS purchase_secs,
                    count(*) FILTER (event_type = 'view') AS views,
                    count(*) FILTER (event_type = 'purchase') AS purchases,
                    count(*) FILTER (event_type = 'click') AS clicks,
                    count(*) FILTER (event_type = 'error') AS errors,
                    count(*) FILTER (event_type = 'signup') AS signups
             FROM ev GROUP BY ALL)""",
    "ev",
)
_MEASURES = [c for c in S.SUMMED_COLUMNS if c != "num_of_trips"]
_cte(
    "daily",
    f"""SELECT * FROM daily_once
        UNION ALL
        SELECT * REPLACE (
            CASE WHEN city_id = 0 THEN num_of_trips - 1 WHEN city_id = 2 THEN NULL
                 WHEN city_id = 3 THEN 1 ELSE num_of_trips END AS num_of_trips,
            {", ".join(f"CASE WHEN city_id = 3 AND {c} IS NOT NULL THEN 0 ELSE {c} END AS {c}" for c in _MEASURES)},
            CASE WHEN city_id <> 3 THEN market_name END AS market_name,
            CASE WHEN city_id <> 4 OR CAST(driver_uuid AS BIGINT) % 2 = 0 THEN driver_uuid END AS driver_uuid,
            CASE WHEN city_id <> 4 OR CAST(driver_uuid AS BIGINT) % 2 = 1 THEN datestr END AS datestr)
        FROM daily_once WHERE city_id < 5 AND market_name = 'M0'""",
    "daily_once",
)
_cte(
    "exports",
    """SELECT CAST(t AS DATE) AS d
       FROM (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)) + 3,
                                           INTERVAL 1 DAY)) AS t FROM ev)
       WHERE day(t) % 2 = 0""",
    "ev",
)
_cte(
    "src",
    """SELECT ev.*, d, CAST(d AS TIMESTAMP) AS _ts_fichero, 'T' || event_id AS trip
       FROM ev JOIN exports ON ts >= d - INTERVAL 5 DAY AND ts < d""",
    "ev",
    "exports",
)
_cte(
    "cancels",
    """SELECT ts AS hour, rider AS driver_uuid, trip AS delivery_trip_uuid, trip AS order_id,
              CASE event_type WHEN 'error' THEN 'CANCEL' WHEN 'signup' THEN 'REJECT'
                   WHEN 'click' THEN 'CANCEL_NOT_AT_FAULT' WHEN 'view' THEN 'OTHER' END AS event_type,
              'R' || day(d) AS reason, CAST(NULL AS VARCHAR) AS form_factor, _ts_fichero
       FROM src""",
    "src",
)
_cte(
    "late",
    """SELECT rider AS driver_uuid, trip AS delivery_trip_uuid, trip AS order_id, ts,
              CASE WHEN event_id % 19 <> 0 THEN CAST(secs AS DOUBLE) END - 300.0::DOUBLE AS delay2,
              secs / 2.0::DOUBLE - 900.0::DOUBLE AS delay3, _ts_fichero
       FROM src""",
    "src",
)
_cte(
    "trips",
    """SELECT rider AS courier_uuid, trip AS trip_uuid, ts AS accepted, event_id,
              CASE WHEN event_id % 11 <> 0 THEN ts + INTERVAL 1 SECOND * secs END AS dropped,
              CASE WHEN event_id % 13 <> 0 THEN value / 10.0::DOUBLE END AS km, trip AS order_id,
              CASE WHEN unmarked THEN NULL WHEN event_id % 3 = 0 THEN '0' ELSE '1' END AS p2_on_time,
              CASE WHEN unmarked THEN NULL WHEN event_id % 4 = 0 THEN '0' ELSE '1' END AS p3_on_time,
              value - CAST(floor(value / 2) AS DOUBLE) AS delay2,
              value - CAST(floor(value / 4) AS DOUBLE) AS delay3,
              CASE WHEN d = DATE '2024-01-20' THEN NULL
                   WHEN event_id % 5 = 0 THEN 'BATCH' ELSE 'NO BATCH' END AS batch_order,
              CAST(ts - INTERVAL 2 HOUR AS DATE) AS day, _ts_fichero
       FROM (SELECT *, event_id % 10 <> 0
                    AND (CAST(ts AS DATE) = d - 1 OR (CAST(ts AS DATE) = d - 3 AND day(d) % 4 = 0))
                    AS unmarked
             FROM src)""",
    "src",
)

# ------------------------------------------------------------------ silver

_cte(
    "newest",
    """SELECT daily.* FROM daily
       JOIN (SELECT driver_uuid, datestr, max(file_date) AS file_date FROM daily GROUP BY ALL) AS m
       USING (driver_uuid, datestr, file_date)""",
    "daily",
)
_cte(
    "markets",
    """SELECT * FROM newest
       QUALIFY row_number() OVER (PARTITION BY driver_uuid, datestr, city_id, city_name, market_name
                                  ORDER BY num_of_trips DESC NULLS LAST) = 1""",
    "newest",
)
_sums = ", ".join(
    f"sum({c}) AS {c}" if c in S.LATE_COUNTERS else f"coalesce(sum({c}), 0.0::DOUBLE) AS {c}"
    for c in S.SUMMED_COLUMNS
)
_firsts = ", ".join(
    f"first({c} ORDER BY num_of_trips DESC NULLS LAST, market_name NULLS FIRST, city_id, city_name) AS {c}"
    for c in S.IDENTITY_COLUMNS
)
_averages = ", ".join(
    f"CASE WHEN num_of_trips > 0 THEN {c} / num_of_trips ELSE 0.0::DOUBLE END AS {c}_avg"
    for c in S.DISTANCE_COLUMNS
)
_cte(
    "silver",
    f"""SELECT *, {_averages} FROM
        (SELECT driver_uuid, datestr, {_sums}, {_firsts} FROM markets GROUP BY driver_uuid, datestr)""",
    "markets",
)

# ---------------------------------------------------------------- sessions

_cte(
    "sess",
    """SELECT courier_uuid, status, CAST(start_time AS TIMESTAMP) AS start_dt,
              CAST(end_time AS TIMESTAMP) AS end_dt FROM conn WHERE start_time NOT LIKE 'n/a%'""",
    "conn",
)
_cte(
    "closed",
    """SELECT * FROM (
         SELECT courier_uuid, status, start_dt, end_eff, CAST(start_dt AS DATE) AS dia,
                datesub('second', start_dt, end_eff) AS seconds,
                CASE WHEN start_dt < CAST(start_dt AS DATE) + INTERVAL 2 HOUR
                     THEN datesub('second', start_dt,
                                  least(end_eff, CAST(start_dt AS DATE) + INTERVAL 2 HOUR))
                     ELSE 0 END AS early_seconds
         FROM (SELECT courier_uuid, status, start_dt,
                      coalesce(end_dt, lead(start_dt) OVER (PARTITION BY courier_uuid
                                                            ORDER BY start_dt, status)) AS end_eff
               FROM sess)
         WHERE status IN ('open', 'enroute', 'ontrip') AND end_eff > start_dt)
       WHERE seconds <= 64800""",
    "sess",
)
_cte(
    "share",
    """SELECT courier_uuid, dia,
              CASE WHEN seconds > 0 THEN least(early::DOUBLE / seconds::DOUBLE, 1.0::DOUBLE)
                   ELSE 0.0::DOUBLE END AS frac_horas,
              seconds::DOUBLE / 3600.0::DOUBLE AS horas_conn,
              early::DOUBLE / 3600.0::DOUBLE AS horas_madrugada
       FROM (SELECT courier_uuid, dia, CAST(sum(seconds) AS BIGINT) AS seconds,
                    CAST(sum(early_seconds) AS BIGINT) AS early
             FROM closed GROUP BY ALL)""",
    "closed",
)
_cte(
    "rta",
    """SELECT courier_uuid, dia, early::DOUBLE / total::DOUBLE AS frac_rta,
              total AS rta_total, early AS rta_madrugada
       FROM (SELECT courier_uuid, CAST(CAST("timestamp" AS TIMESTAMP) AS DATE) AS dia,
                    count(*) AS total,
                    count(*) FILTER (hour(CAST("timestamp" AS TIMESTAMP)) < 2) AS early
             FROM offers WHERE courier_action = 'ACCEPT' GROUP BY ALL)""",
    "offers",
)

# ---------------------------------------------------------------- transfer

_cte(
    "shared",
    """SELECT s.*, CAST(datestr AS DATE) AS _dia, coalesce(c.frac_horas, 0.0::DOUBLE) AS frac_raw,
              c.horas_conn, coalesce(r.frac_rta, 0.0::DOUBLE) AS frac_rta,
              coalesce(r.rta_madrugada, 0) AS rta_madrugada
       FROM silver AS s
       LEFT JOIN share AS c ON c.courier_uuid = driver_uuid AND c.dia = CAST(datestr AS DATE)
       LEFT JOIN rta AS r ON r.courier_uuid = driver_uuid AND r.dia = CAST(datestr AS DATE)""",
    "silver",
    "share",
    "rta",
)
_cte(
    "settled",
    """SELECT s.*, CASE WHEN p.driver_uuid IS NULL THEN 0.0::DOUBLE ELSE frac_raw END AS frac
       FROM shared AS s
       LEFT JOIN (SELECT DISTINCT driver_uuid, _dia + 1 AS _dia FROM shared) AS p
       USING (driver_uuid, _dia)""",
    "shared",
)


def _value(c: str) -> str:
    return c if c in S.LATE_COUNTERS else f"coalesce({c}, 0.0::DOUBLE)"


def _moved(c: str) -> str:
    amount = f"{_value(c)} * frac"
    return f"round_even({amount}, 0)" if c in S.COUNT_COLUMNS else amount


_cte(
    "moving",
    f"SELECT *, {', '.join(f'{_moved(c)} AS mv_{c}' for c in S.MOVED_COLUMNS)} FROM settled",
    "settled",
)
_cte(
    "arriving",
    f"""SELECT driver_uuid, _dia - 1 AS _dia,
               {', '.join(f'coalesce(sum(mv_{c}), 0.0::DOUBLE) AS in_{c}' for c in S.MOVED_COLUMNS)}
        FROM moving GROUP BY ALL""",
    "moving",
)
_new_totals = ", ".join(
    f"{_value(c)} - mv_{c} + coalesce(in_{c}, 0.0::DOUBLE) AS {c}" for c in S.MOVED_COLUMNS
)
_kept = [
    "driver_uuid", "datestr", *S.IDENTITY_COLUMNS, *[f"{c}_avg" for c in S.DISTANCE_COLUMNS],
    "_dia", "frac", "frac_rta",
]
_cte(
    "moved",
    f"""SELECT {', '.join('m.' + c for c in _kept)},
               in_num_of_trips IS NOT NULL AS has_next, {_new_totals}
        FROM moving AS m LEFT JOIN arriving AS a
        ON a.driver_uuid = m.driver_uuid AND a._dia = m._dia""",
    "moving",
    "arriving",
)
_TPH = "CASE WHEN online_hours > 0 THEN num_of_trips / online_hours ELSE 0.0::DOUBLE END AS tph_adj"
_cte(
    "adjusted",
    f"""SELECT * EXCLUDE (frac, frac_rta, has_next), {_TPH},
               CASE WHEN accept_trips + reject_trips > 0
                    THEN accept_trips / (accept_trips + reject_trips) * 100.0::DOUBLE
                    ELSE 0.0::DOUBLE END AS pct_aceptacion,
               CASE WHEN accept_trips > 0 THEN cancel_trips / accept_trips * 100.0::DOUBLE
                    ELSE 0.0::DOUBLE END AS pct_cancelacion,
               frac > 0 OR has_next AS ajustado_connections,
               frac AS _frac_horas_dbg, frac_rta AS _frac_rta_dbg
        FROM moved""",
    "moved",
)
_cte(
    "final",
    "SELECT * FROM adjusted WHERE NOT (num_of_trips = 0 AND online_hours = 0)",
    "adjusted",
)
_cte(
    "plain",
    f"""SELECT *, {_TPH}, false AS ajustado_connections, 0.0::DOUBLE AS _frac_rta_dbg,
               0.0::DOUBLE AS _frac_horas_dbg
        FROM silver WHERE NOT (num_of_trips = 0 AND online_hours = 0)""",
    "silver",
)
_cte(
    "emptied",
    """SELECT DISTINCT driver_uuid AS courier_uuid, CAST(datestr AS DATE) AS day FROM adjusted
       WHERE _frac_horas_dbg > 0 AND num_of_trips = 0 AND online_hours = 0""",
    "adjusted",
)

# ----------------------------------------------------------------- publish

_BASE = """CAST({day} AS VARCHAR) AS day, driver_uuid AS courier_uuid, driver_name, driver_number,
           driver_email AS email, city_name AS city, CAST(NULL AS VARCHAR) AS flow_type,
           num_of_trips, online_hours, active_hours, accept_trips, reject_trips, cancel_trips,
           cancel_not_at_fault_trips AS cancel_not_at_fault, tph_adj AS tph,
           {accept} AS pct_accept, {cancel} AS pct_cancel"""
_LIVE = ", market_name, form_factor, late_p2_trips, late_p3_trips, total_km"
_ADJUSTED_BASE = _BASE.format(
    day="_dia", accept="pct_aceptacion / 100.0::DOUBLE", cancel="pct_cancelacion / 100.0::DOUBLE"
)
_PLAIN_BASE = _BASE.format(
    day="CAST(datestr AS DATE)", accept="0.0::DOUBLE", cancel="0.0::DOUBLE"
)
_cte(
    "published",
    f"SELECT {_ADJUSTED_BASE}{_LIVE} FROM final WHERE _dia >= DATE '2024-01-22'",
    "final",
)
_cte("earlier", f"SELECT {_PLAIN_BASE}{_LIVE} FROM plain", "plain")

# ------------------------------------------------------------------ orders

_cte(
    "orders",
    """SELECT t.*,
              (SELECT max(coalesce(p.dropped, p.accepted)) FROM trips AS p
               WHERE p._ts_fichero = t._ts_fichero AND p.courier_uuid = t.courier_uuid
                 AND (p.accepted, p.event_id) < (t.accepted, t.event_id)) AS previous
       FROM trips AS t""",
    "trips",
)
_cte(
    "flagged",
    """SELECT *, coalesce(alone AND delay2 > 10 AND p2_on_time = '0', false) AS late2,
              coalesce(alone AND delay3 > 10 AND p3_on_time = '0', false) AS late3
       FROM (SELECT *, coalesce(batch_order = 'NO BATCH', false)
                       AND NOT coalesce(accepted < previous, false) AS alone FROM orders)""",
    "orders",
)
_cte(
    "per_day",
    """SELECT _ts_fichero, day, count(*) AS orders,
              count(*) FILTER (p2_on_time IS NOT NULL OR p3_on_time IS NOT NULL) AS marked_orders
       FROM trips GROUP BY ALL""",
    "trips",
)
_cte(
    "per_file",
    """SELECT _ts_fichero, min(day) AS first_day, max(day) AS last_day,
              count(batch_order) > 0 AND count(accepted) > 0 AND count(dropped) > 0
              AND count(delay2) > 0 AND count(delay3) > 0 AS complete
       FROM trips GROUP BY ALL""",
    "trips",
)
_cte(
    "file_days",
    """SELECT _ts_fichero, day, orders, marked_orders, complete,
              marked_orders * 2 >= orders AS marked,
              day > first_day AND day < last_day AS interior
       FROM per_day JOIN per_file USING (_ts_fichero)""",
    "per_day",
    "per_file",
)
_cte(
    "late_report",
    """SELECT driver_uuid AS courier_uuid, delivery_trip_uuid,
              CAST(CAST(ts - INTERVAL 2 HOUR AS DATE) AS VARCHAR) AS day, order_id,
              delay2 AS retraso_p2, delay3 AS retraso_p3,
              coalesce(delay2 > 600, false) AS tarde_p2, coalesce(delay3 > 600, false) AS tarde_p3
       FROM late AS l
       WHERE _ts_fichero = (SELECT max(_ts_fichero) FROM late AS n
                            WHERE n.driver_uuid = l.driver_uuid
                              AND n.delivery_trip_uuid = l.delivery_trip_uuid)""",
    "late",
)
_cte(
    "off_time",
    """SELECT f.* FROM flagged AS f JOIN file_days AS d USING (_ts_fichero, day)
       WHERE (p2_on_time = '0' OR p3_on_time = '0') AND complete AND marked AND interior
         AND day >= DATE '2024-01-10'""",
    "flagged",
    "file_days",
)
_cte(
    "delays",
    """SELECT courier_uuid, trip_uuid AS delivery_trip_uuid, CAST(day AS VARCHAR) AS day, order_id,
              delay2 AS retraso_p2, delay3 AS retraso_p3, late2 AS tarde_p2, late3 AS tarde_p3
       FROM off_time AS o
       WHERE _ts_fichero = (SELECT max(_ts_fichero) FROM off_time AS n
                            WHERE n.courier_uuid = o.courier_uuid AND n.trip_uuid = o.trip_uuid)""",
    "off_time",
)

_SILVER_TEXT = "* REPLACE (CAST(datestr AS VARCHAR) AS datestr, CAST(weekstr AS VARCHAR) AS weekstr)"
_FINAL_TEXT = _SILVER_TEXT[:-1] + ", CAST(_dia AS VARCHAR) AS _dia)"
_MARKET_ROW = """driver_uuid, CAST(datestr AS VARCHAR) AS datestr, city_id, city_name, market_name,
                 file_name, num_of_trips, online_hours"""


def oracle_sql() -> dict[str, str]:
    from fleetday.plans import csv_oracle as C

    sql = {
        "logical_day_counts": _with(
            """SELECT CAST(CAST(ts - INTERVAL 2 HOUR AS DATE) AS VARCHAR) AS day, count(*) AS n
               FROM ev GROUP BY ALL""",
            "ev",
        ),
        "parsed_dates": """
            SELECT event_id, CAST(CASE WHEN event_id % 5 = 3 THEN date_trunc('day', ts)
                                       ELSE date_trunc('second', ts) END AS VARCHAR) AS parsed
            FROM (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts FROM events)""",
        "dedup_keep_first": _with(
            """SELECT courier_uuid, start_time, status,
                      first(end_time ORDER BY conn_file) AS end_time, min(conn_file) AS conn_file
               FROM conn2 GROUP BY courier_uuid, start_time, status""",
            "conn2",
        ),
        "dedup_offers": _with(
            """SELECT offer_id, "timestamp", courier_uuid, courier_action, email, rta_file
               FROM (SELECT *, row_number() OVER (PARTITION BY offer_id
                                                  ORDER BY rta_file, "timestamp") AS rn FROM offers2)
               WHERE rn = 1""",
            "offers2",
        ),
        "ingest_first_wins": _with(
            """SELECT courier_uuid, start_time, status,
                      first(end_time ORDER BY conn_file) AS end_time, min(conn_file) AS conn_file
               FROM conn2 GROUP BY courier_uuid, start_time, status""",
            "conn2",
        ),
        "dedup_latest_by_file": _with(
            """SELECT courier_uuid, trip_uuid, CAST(accepted AS VARCHAR) AS momento, km, p2_on_time,
                      CAST(_ts_fichero AS VARCHAR) AS _ts_fichero
               FROM trips JOIN (SELECT courier_uuid, trip_uuid, max(_ts_fichero) AS _ts_fichero
                                FROM trips GROUP BY ALL)
               USING (courier_uuid, trip_uuid, _ts_fichero)""",
            "trips",
        ),
        "latest_lineitem": """
            SELECT * EXCLUDE (rn) REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate)
            FROM (SELECT *, row_number() OVER (
                      PARTITION BY l_orderkey, l_linenumber
                      ORDER BY l_shipdate DESC NULLS LAST, l_partkey NULLS FIRST,
                               l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
                               l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
                               l_tax NULLS FIRST, l_returnflag NULLS FIRST,
                               l_linestatus NULLS FIRST) AS rn FROM lineitem)
            WHERE rn = 1""",
        "prune_retention": _with(
            """SELECT courier_uuid, start_time, status, end_time, conn_file FROM conn2
               WHERE TRY_CAST(start_time AS TIMESTAMP) IS NULL OR TRY_CAST(start_time AS TIMESTAMP)
                     >= TIMESTAMP '2024-03-10 10:30:00' - INTERVAL 60 DAY""",
            "conn2",
        ),
        "ledger_new_files": _with(
            """SELECT DISTINCT file_name FROM daily
               WHERE file_name NOT IN
                     (SELECT file_name FROM daily WHERE file_date < TIMESTAMP '2024-02-03')""",
            "daily",
        ),
        "reprocess_from": _with(
            """SELECT driver_uuid, CAST(datestr AS VARCHAR) AS datestr, market_name, file_name,
                      num_of_trips
               FROM daily WHERE file_date < TIMESTAMP '2024-02-03'""",
            "daily",
        ),
        "catch_up_days": """
            SELECT CAST(least(greatest(CAST(floor(date_diff('microsecond', max(ts),
                       TIMESTAMP '2024-02-05 09:00:00') / 86400000000) AS BIGINT) + 2, 2), 30)
                   AS BIGINT) AS days
            FROM events""",
        "export_times": _with(
            """SELECT file_name, "rows", CAST(strptime(regexp_extract(file_name,
                          '[0-9]{8}_[0-9]{6}'), '%Y%m%d_%H%M%S') AS VARCHAR) AS export_time
               FROM (SELECT file_name, count(*) AS "rows"
                     FROM (SELECT 'trips_' || strftime(_ts_fichero, '%Y%m%d') || '_000000.csv'
                                  AS file_name FROM trips
                           UNION ALL SELECT file_name FROM daily) GROUP BY ALL)""",
            "trips",
            "daily",
        ),
        "latest_export": _with(f"SELECT {_MARKET_ROW} FROM newest", "newest"),
        "market_dedup": _with(
            f"SELECT {_MARKET_ROW} FROM markets", "markets",
        ),
        "silver": _with(f"SELECT {_SILVER_TEXT} FROM silver", "silver"),
        "silver_window": _with(
            f"""SELECT {_SILVER_TEXT} FROM silver
                WHERE datestr >= (SELECT max(datestr) FROM silver) - INTERVAL 22 DAY""",
            "silver",
        ),
        "multi_market": _with(
            """SELECT driver_uuid, CAST(datestr AS VARCHAR) AS datestr,
                      count(DISTINCT coalesce(market_name, '<empty>')) AS markets
               FROM daily WHERE driver_uuid IS NOT NULL AND datestr IS NOT NULL
               GROUP BY ALL HAVING markets > 1""",
            "daily",
        ),
        "trace_rider": _with(
            """SELECT CAST(datestr AS VARCHAR) AS datestr, market_name, city_name, file_name,
                      online_hours, active_hours, num_of_trips
               FROM daily WHERE driver_uuid = '7' AND datestr IS NOT NULL""",
            "daily",
        ),
        "closed_sessions": _with(
            """SELECT courier_uuid, status, CAST(start_dt AS VARCHAR) AS start_dt,
                      CAST(end_eff AS VARCHAR) AS end_eff, CAST(dia AS VARCHAR) AS dia, seconds,
                      greatest(early_seconds, 0) AS early_seconds FROM closed""",
            "closed",
        ),
        "early_share": _with(
            "SELECT * REPLACE (CAST(dia AS VARCHAR) AS dia) FROM share", "share"
        ),
        "offer_early_share": _with(
            "SELECT * REPLACE (CAST(dia AS VARCHAR) AS dia) FROM rta", "rta"
        ),
        "attached_shares": _with(
            """SELECT driver_uuid, CAST(_dia AS VARCHAR) AS _dia, frac_raw AS frac_horas, frac_rta,
                      rta_madrugada FROM shared""",
            "shared",
        ),
        "moved_amounts": _with(
            f"""SELECT driver_uuid, CAST(_dia AS VARCHAR) AS _dia,
                       {', '.join(f'mv_{c}' for c in S.MOVED_COLUMNS)} FROM moving""",
            "moving",
        ),
        "transfer": _with(
            f"""SELECT driver_uuid, CAST(_dia AS VARCHAR) AS _dia, {', '.join(S.MOVED_COLUMNS)}
                FROM moved""",
            "moved",
        ),
        "rates": _with(
            """SELECT driver_uuid, CAST(_dia AS VARCHAR) AS _dia, tph_adj, pct_aceptacion,
                      pct_cancelacion FROM adjusted""",
            "adjusted",
        ),
        "adjusted_flag": _with(
            """SELECT driver_uuid, CAST(_dia AS VARCHAR) AS _dia, ajustado_connections
               FROM adjusted""",
            "adjusted",
        ),
        "without_destination": _with(
            """SELECT driver_uuid, CAST(_dia AS VARCHAR) AS _dia, frac_raw AS frac_horas
               FROM shared AS s WHERE frac_raw > 0 AND NOT EXISTS (
                   SELECT 1 FROM shared AS p
                   WHERE p.driver_uuid = s.driver_uuid AND p._dia = s._dia - 1)""",
            "shared",
        ),
        "final_daily": _with(f"SELECT {_FINAL_TEXT} FROM final", "final"),
        "unadjusted_daily": _with(f"SELECT {_SILVER_TEXT} FROM plain", "plain"),
        "hours_mismatch": _with(
            """SELECT mismatched, "rows", 100.0::DOUBLE * mismatched / greatest("rows", 1) AS pct,
                      100.0::DOUBLE * mismatched / greatest("rows", 1) > 10 AS alert
               FROM (SELECT count(*) FILTER (abs(horas_conn - online_hours) > 1.0) AS mismatched,
                            count(*) AS "rows" FROM shared)""",
            "shared",
        ),
        "emptied_keys": _with(
            "SELECT courier_uuid, CAST(day AS VARCHAR) AS day FROM emptied", "emptied"
        ),
        "utilisation_weekday": _with(
            """SELECT CAST(isodow(_dia) AS BIGINT) AS weekday, count(*) AS "rows",
                      round(avg(active_hours / online_hours), 6) AS utilisation,
                      (SELECT count(*) FROM final
                       WHERE online_hours > 2 AND active_hours > 0.5) > 100 AS enough_rows
               FROM final WHERE online_hours > 2 AND active_hours > 0.5
               GROUP BY ALL""",
            "final",
        ),
        "duplicate_keys": _with(
            """SELECT driver_uuid, CAST(CAST(datestr AS DATE) AS VARCHAR) AS day, count(*) AS n
               FROM daily GROUP BY ALL HAVING count(*) > 1""",
            "daily",
        ),
        "step_rows": _with(
            """SELECT 'bronze' AS step, count(*) AS "rows" FROM daily
               UNION ALL SELECT 'silver', count(*) FROM silver
               UNION ALL SELECT 'adjusted', count(*) FROM adjusted
               UNION ALL SELECT 'final', count(*) FROM final""",
            "daily", "silver", "adjusted", "final",
        ),
        "moved_rows": _with(
            """SELECT count(*) AS "rows", count(*) FILTER (ajustado_connections) AS adjusted
               FROM adjusted""",
            "adjusted",
        ),
        "published_daily": _with("SELECT * FROM published", "published"),
        "published_daily_narrow": _with(
            f"SELECT {_ADJUSTED_BASE} FROM final WHERE _dia >= DATE '2024-01-08'", "final"
        ),
        "upsert_merge": _with(
            """SELECT * FROM published
               UNION ALL BY NAME
               SELECT * FROM earlier AS e WHERE NOT EXISTS (
                   SELECT 1 FROM published AS p
                   WHERE p.courier_uuid = e.courier_uuid AND p.day = e.day)""",
            "published", "earlier",
        ),
        "delete_emptied": _with(
            """SELECT * FROM earlier AS e WHERE NOT EXISTS (
                   SELECT 1 FROM emptied AS x
                   WHERE x.courier_uuid = e.courier_uuid AND CAST(x.day AS VARCHAR) = e.day
                     AND x.day > DATE '2024-01-22'
                     AND NOT EXISTS (SELECT 1 FROM published AS p
                                     WHERE p.courier_uuid = x.courier_uuid
                                       AND p.day = CAST(x.day AS VARCHAR)))""",
            "earlier", "emptied", "published",
        ),
        "days_closed": _with(
            """SELECT day AS dia, count(*) AS filas, '2024-01-29T06:00:00+00:00' AS cerrado_en
               FROM published GROUP BY ALL""",
            "published",
        ),
        "published_table": _with(
            """SELECT * FROM published
               UNION ALL BY NAME
               SELECT * FROM earlier AS e WHERE day >= '2024-01-22'
               AND NOT EXISTS (SELECT 1 FROM published AS p
                               WHERE p.courier_uuid = e.courier_uuid AND p.day = e.day)
               AND NOT EXISTS (SELECT 1 FROM emptied AS x
                               WHERE x.courier_uuid = e.courier_uuid
                                 AND CAST(x.day AS VARCHAR) = e.day
                                 AND x.day > DATE '2024-01-22')""",
            "published", "earlier", "emptied",
        ),
        "closed_table": _with(
            """SELECT day AS dia, count(*) AS filas, '2024-01-29T06:00:00+00:00' AS cerrado_en
               FROM published GROUP BY ALL
               UNION ALL
               SELECT day, count(*), '2024-01-29T06:00:00+00:00' FROM earlier
               WHERE day >= '2024-01-22' AND day NOT IN (SELECT day FROM published)
               GROUP BY ALL""",
            "published", "earlier",
        ),
        "cancel_events": _with(
            """SELECT driver_uuid AS courier_uuid, delivery_trip_uuid, event_type,
                      CAST(CAST(hour - INTERVAL 2 HOUR AS DATE) AS VARCHAR) AS day, order_id, reason,
                      form_factor
               FROM cancels AS c
               WHERE event_type IN ('CANCEL', 'CANCEL_NOT_AT_FAULT', 'REJECT')
                 AND _ts_fichero = (SELECT max(_ts_fichero) FROM cancels AS n
                                    WHERE n.driver_uuid = c.driver_uuid
                                      AND n.delivery_trip_uuid = c.delivery_trip_uuid
                                      AND n.event_type = c.event_type)""",
            "cancels",
        ),
        "late_events": _with("SELECT * FROM late_report", "late_report"),
        "order_km": _with(
            """SELECT courier_uuid, trip_uuid, CAST(day AS VARCHAR) AS day, km,
                      CAST(NULL AS VARCHAR) AS form_factor
               FROM trips JOIN (SELECT courier_uuid, trip_uuid, max(_ts_fichero) AS _ts_fichero
                                FROM trips WHERE km IS NOT NULL GROUP BY ALL)
               USING (courier_uuid, trip_uuid, _ts_fichero)""",
            "trips",
        ),
        "dedup_within_file": _with(
            """SELECT CAST(_ts_fichero AS VARCHAR) AS _ts_fichero, courier_uuid, trip_uuid,
                      p2_on_time, CAST(day AS VARCHAR) AS day FROM trips""",
            "trips",
        ),
        "chained_orders": _with(
            """SELECT CAST(_ts_fichero AS VARCHAR) AS _ts_fichero, courier_uuid, trip_uuid,
                      CAST(previous AS VARCHAR) AS _entrega_previa,
                      coalesce(accepted < previous, false) AS _chained FROM orders""",
            "orders",
        ),
        "legacy_late": _with(
            """SELECT CAST(_ts_fichero AS VARCHAR) AS _ts_fichero, courier_uuid, trip_uuid,
                      alone AS _suelto, delay2 AS retraso_p2, delay3 AS retraso_p3,
                      late2 AS tarde_p2, late3 AS tarde_p3 FROM flagged""",
            "flagged",
        ),
        "file_days": _with(
            """SELECT * REPLACE (CAST(_ts_fichero AS VARCHAR) AS _ts_fichero,
                                 CAST(day AS VARCHAR) AS day) FROM file_days""",
            "file_days",
        ),
        "valid_days": _with(
            """SELECT CAST(_ts_fichero AS VARCHAR) AS _ts_fichero, CAST(day AS VARCHAR) AS day
               FROM file_days WHERE complete AND marked AND interior""",
            "file_days",
        ),
        "incomplete_files": _with(
            "SELECT count(*) AS incomplete_files FROM per_file WHERE NOT complete", "per_file"
        ),
        "marked_trips": _with(
            """SELECT CAST(_ts_fichero AS VARCHAR) AS _ts_fichero, courier_uuid, trip_uuid,
                      CAST(day AS VARCHAR) AS day, late2 AS tarde_p2, late3 AS tarde_p3,
                      complete AND marked AND interior AS _dia_valido
               FROM flagged JOIN file_days USING (_ts_fichero, day)""",
            "flagged", "file_days",
        ),
        "trip_delays": _with("SELECT * FROM delays", "delays"),
        "order_delays_published": _with(
            """SELECT * FROM delays
               UNION ALL
               SELECT * FROM late_report AS l WHERE NOT EXISTS (
                   SELECT 1 FROM delays AS d WHERE d.courier_uuid = l.courier_uuid
                                               AND d.delivery_trip_uuid = l.delivery_trip_uuid)""",
            "delays", "late_report",
        ),
        "publish_events": _with(
            """SELECT 'order_events' AS "table", driver_uuid AS courier_uuid, delivery_trip_uuid, event_type,
                      CAST(CAST(hour - INTERVAL 2 HOUR AS DATE) AS VARCHAR) AS day, order_id, reason, form_factor
               FROM cancels AS c
               WHERE event_type IN ('CANCEL', 'CANCEL_NOT_AT_FAULT', 'REJECT')
                 AND _ts_fichero = (SELECT max(_ts_fichero) FROM cancels AS n
                                    WHERE n.driver_uuid = c.driver_uuid
                                      AND n.delivery_trip_uuid = c.delivery_trip_uuid
                                      AND n.event_type = c.event_type)
               UNION ALL BY NAME
               SELECT 'order_delays' AS "table", * FROM delays
               UNION ALL BY NAME
               SELECT 'order_delays' AS "table", * FROM late_report AS l WHERE NOT EXISTS (
                   SELECT 1 FROM delays AS d WHERE d.courier_uuid = l.courier_uuid
                                               AND d.delivery_trip_uuid = l.delivery_trip_uuid)
               UNION ALL BY NAME
               SELECT 'order_km' AS "table", courier_uuid, trip_uuid, CAST(day AS VARCHAR) AS day, km,
                      CAST(NULL AS VARCHAR) AS form_factor
               FROM trips JOIN (SELECT courier_uuid, trip_uuid, max(_ts_fichero) AS _ts_fichero
                                FROM trips WHERE km IS NOT NULL GROUP BY ALL)
               USING (courier_uuid, trip_uuid, _ts_fichero)""",
            "cancels", "delays", "late_report", "trips",
        ),
    }
    return {**sql, **C.oracle_sql(_with)}
