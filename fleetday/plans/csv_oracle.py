"""SQL for the queries over CSV exports: the same tables without the detour through files."""

from __future__ import annotations

from fleetday import schema as S


def oracle_sql(with_ctes) -> dict[str, str]:
    names = ", ".join(c for c in S.DAILY_COLUMNS if c not in ("weekstr", "datestr", "driver_name"))
    delivered = (
        "NOT (day(_ts_fichero) % 4 = 0 AND trip_uuid LIKE '%7')"
    )
    sql = {
        "csv_daily": with_ctes(
            f"""SELECT CAST(weekstr AS VARCHAR) AS weekstr, CAST(datestr AS VARCHAR) AS datestr,
                       'rider "' || driver_uuid || '",' || chr(10) || 'night' AS driver_name,
                       {names}, CAST(file_date AS VARCHAR) AS file_date
                FROM daily""",
            "daily",
        ),
        "csv_connections": with_ctes(
            """SELECT courier_uuid, start_time, status, first(end_time ORDER BY conn_file) AS end_time,
                      'fleet ' || (CAST(courier_uuid AS BIGINT) % 3) AS fleet_name,
                      regexp_extract(min(conn_file), '[0-9]{8}_[0-9]{6}') AS stamp
               FROM conn2
               WHERE TRY_CAST(start_time AS TIMESTAMP) IS NULL OR TRY_CAST(start_time AS TIMESTAMP)
                     >= TIMESTAMP '2024-03-10 10:30:00' - INTERVAL 60 DAY
               GROUP BY courier_uuid, start_time, status""",
            "conn2",
        ),
        "csv_offers": with_ctes(
            """SELECT offer_id, first(email ORDER BY rta_file) AS email,
                      regexp_extract(min(rta_file), '[0-9]{8}_[0-9]{6}') AS stamp
               FROM offers2 GROUP BY offer_id""",
            "offers2",
        ),
        "ingest_daily": with_ctes(
            """SELECT driver_uuid, CAST(datestr AS VARCHAR) AS datestr, market_name, num_of_trips, online_hours,
                      regexp_extract(file_name, '[0-9]{8}_[0-9]{6}') AS stamp
               FROM daily""",
            "daily",
        ),
        "ingest_offers": with_ctes(
            """SELECT offer_id, first(email ORDER BY rta_file) AS email,
                      regexp_extract(min(rta_file), '[0-9]{8}_[0-9]{6}') AS stamp
               FROM offers2 GROUP BY offer_id
               HAVING NOT coalesce(offer_id LIKE '%1' AND min(rta_file) LIKE '%20240116%', false)""",
            "offers2",
        ),
        "noop_run": with_ctes("SELECT CAST(0 AS BIGINT) AS changed_files, count(*) AS \"rows\" FROM daily", "daily"),
        "no_input_gate": with_ctes(
            """SELECT 'daily' AS exports, count(*) = 0 AS stopped, count(*) AS "rows" FROM daily
               UNION ALL SELECT 'other', true, CAST(0 AS BIGINT)""",
            "daily",
        ),
        "file_error_gate": with_ctes(
            """SELECT 'cancels' AS family, count(DISTINCT d) FILTER (d = DATE '2024-01-20') AS failed,
                      count(DISTINCT d) AS total, failed > total / 2 AS abort FROM src
               UNION ALL
               SELECT 'late', count(DISTINCT d) FILTER (d <> DATE '2024-01-20'), count(DISTINCT d),
                      count(DISTINCT d) FILTER (d <> DATE '2024-01-20') > count(DISTINCT d) / 2 FROM src""",
            "src",
        ),
        "csv_cancels": with_ctes(
            """SELECT driver_uuid AS courier_uuid, delivery_trip_uuid, event_type,
                      CAST(CAST(hour - INTERVAL 2 HOUR AS DATE) AS VARCHAR) AS day, order_id, reason,
                      form_factor
               FROM (SELECT *, max(_ts_fichero) OVER (
                            PARTITION BY driver_uuid, delivery_trip_uuid, event_type) AS newest
                     FROM cancels WHERE _ts_fichero <> TIMESTAMP '2024-01-20')
               WHERE event_type IN ('CANCEL', 'CANCEL_NOT_AT_FAULT', 'REJECT')
                 AND _ts_fichero = newest""",
            "cancels",
        ),
        "csv_refused_files": """
            SELECT DISTINCT 'cancels' AS family, '20240120_000000' AS stamp,
                   'missing columns: event_type' AS reason
            FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-20'""",
        "csv_trips": with_ctes(
            f"""SELECT courier_uuid, trip_uuid AS delivery_trip_uuid, CAST(day AS VARCHAR) AS day,
                       order_id, delay2 AS retraso_p2, delay3 AS retraso_p3,
                       late2 AS tarde_p2, late3 AS tarde_p3
                FROM (SELECT *, max(_ts_fichero) OVER (PARTITION BY courier_uuid, trip_uuid) AS newest
                      FROM (SELECT t.*,
                                   coalesce(alone AND delay2 > 10 AND p2_on_time = '0', false) AS late2,
                                   coalesce(alone AND delay3 > 10 AND p3_on_time = '0', false) AS late3
                            FROM (SELECT *, coalesce(batch_order = 'NO BATCH', false)
                                            AND NOT coalesce(accepted < (
                                  max(coalesce(dropped, accepted)) OVER (
                                      PARTITION BY _ts_fichero, courier_uuid
                                      ORDER BY accepted, event_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), false) AS alone
                                  FROM trips WHERE {delivered}) AS t
                            JOIN (SELECT _ts_fichero, day,
                                         count(coalesce(p2_on_time, p3_on_time)) * 2 >= count(*) AS marked
                                  FROM trips WHERE {delivered} GROUP BY ALL) AS m
                            USING (_ts_fichero, day)
                            JOIN (SELECT _ts_fichero, min(day) AS first_day, max(day) AS last_day,
                                         count(batch_order) > 0 AND count(accepted) > 0
                                         AND count(dropped) > 0 AND count(delay2) > 0
                                         AND count(delay3) > 0 AS complete
                                  FROM trips WHERE {delivered} GROUP BY ALL) AS f
                            USING (_ts_fichero)
                            WHERE marked AND complete AND day > first_day AND day < last_day
                              AND (p2_on_time = '0' OR p3_on_time = '0')
                              AND day >= DATE '2024-01-10'))
                WHERE _ts_fichero = newest""",
            "trips",
        ),
    }
    return {**sql, "bronze_two_runs": sql["csv_connections"]}
