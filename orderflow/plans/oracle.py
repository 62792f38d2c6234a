"""The registered queries restated in SQL over the test tables."""

from __future__ import annotations

_ID = "CAST(event_id AS VARCHAR)"
_REQUEST_ID = (
    f"strftime(ts, '%Y%m%d%H%M%S%g') || lpad({_ID}, greatest(8, length({_ID}))::INTEGER, '0')"
)

# One row per usable message of every service. The mapping is that of
# ``sources.fixtures``; nothing here goes through JSON text.
_ORDERS = f"""
events_read AS (
  SELECT event_id,
         {_REQUEST_ID} AS request_id,
         CASE WHEN event_type = 'view' THEN 'reChargeReq' ELSE 'reChargeNotifyReq' END
           AS service_name,
         CASE WHEN event_type = 'error' THEN '1001' ELSE '0000' END AS result_code,
         event_type <> 'error' AS ok,
         CAST(round(value * 100) AS BIGINT) AS fee,
         date_trunc('milliseconds', ts) AS start_ts,
         CASE WHEN event_id % 10 = 0 THEN 0 ELSE (event_id * 37) % 5000 END AS ms,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 27 AS VARCHAR)
           AS province_code,
         event_id % 997 AS kind
  FROM events
),
orders_all AS (SELECT * FROM events_read WHERE kind > 4),
dimension AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS province_code, n_name AS province FROM nation
),
located AS (SELECT * FROM orders_all JOIN dimension USING (province_code)),
notified AS (SELECT * FROM orders_all WHERE service_name = 'reChargeNotifyReq'),
notified_located AS (SELECT * FROM notified JOIN dimension USING (province_code))
"""

# Positions in the message log, and the ledger of two groups.
_LOG = """
placed AS (
  SELECT event_id, ts, CAST(event_id % 3 AS INTEGER) AS "partition",
         CASE WHEN event_type = 'error' THEN 'orders_failed' ELSE 'orders' END AS topic,
         event_id // 1000 AS batch_id
  FROM events
),
log AS (
  SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY event_id) - 1 AS "offset"
  FROM placed
),
ranges AS (
  SELECT batch_id, topic, "partition", CAST(min("offset") AS BIGINT) AS from_offset,
         CAST(max("offset") + 1 AS BIGINT) AS until_offset
  FROM log GROUP BY ALL
)
"""

_WEEKDAY = "CAST(dayofweek(start_ts) AS INTEGER)"
_HOUR = "CAST(hour(start_ts) AS INTEGER)"
_MINUTE = "CAST(minute(start_ts) AS INTEGER)"
_DAY = "strftime(start_ts, '%Y-%m-%d')"


def _count(condition: str) -> str:
    return f"CAST(count(*) FILTER ({condition}) AS BIGINT)"


def _money(condition: str = "true") -> str:
    return f"CAST(coalesce(sum(fee) FILTER ({condition}), 0) AS BIGINT)"


def _rounded(part: str, whole: str, digits: int) -> str:
    """Half up, on integers."""
    scale = 10**digits
    return f"CAST(({2 * scale} * {part} + {whole}) // (2 * {whole}) AS DOUBLE) / {scale}.0::DOUBLE"


def _orders(body: str) -> str:
    return f"WITH {_ORDERS} {body}"


def _log(body: str) -> str:
    return f"WITH {_LOG} {body}"


_N = "CAST(count(*) AS BIGINT)"

_SHOWN = """
  request_id, service_name, result_code, ok AS is_success, CAST(fee AS INTEGER) AS fee,
  strftime(start_ts, '%Y-%m-%d %H:%M:%S.%g') AS start_time,
  strftime(start_ts + to_milliseconds(ms), '%Y-%m-%d %H:%M:%S.%g') AS end_time,
  CAST(ms AS BIGINT) AS duration_ms, province_code,
  strftime(start_ts, '%Y-%m-%d') AS day
"""

_PARSE = _orders(f"SELECT {_SHOWN} FROM orders_all")

_DAILY = _orders(
    f"""SELECT {_DAY} AS day, {_N} AS orders, {_money('ok')} AS fee_total,
      {_count('ok')} AS successes, CAST(sum(ms) AS BIGINT) AS total_ms,
      {_rounded(_count('ok'), 'count(*)', 5)} AS success_rate,
      CAST(sum(ms) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 1000.0::DOUBLE AS avg_seconds
    FROM notified GROUP BY 1"""
)

_FAILURES = _orders(
    f"""SELECT {_WEEKDAY} AS weekday, {_HOUR} AS hour, province, {_count('NOT ok')} AS failures
    FROM notified_located GROUP BY 1, 2, 3"""
)

_WEEKDAY_HOURS = _orders(
    f"""SELECT {_WEEKDAY} AS weekday, {_HOUR} AS hour, {_N} AS orders, {_money()} AS fee_total
    FROM notified GROUP BY 1, 2"""
)

_PROVINCE_HOUR_FAILURES = _orders(
    f"""SELECT province, {_HOUR} AS hour, {_N} AS failures
    FROM located WHERE NOT ok GROUP BY 1, 2"""
)

_HOURLY = _orders(
    f"""SELECT {_HOUR} AS hour, {_N} AS successes, {_money()} AS fee_total
    FROM located WHERE ok GROUP BY 1"""
)

_MINUTES_OF_DAY = _orders(
    f"""SELECT province, {_HOUR} AS hour, {_MINUTE} AS minute, {_N} AS successes,
      {_money()} AS fee_total
    FROM located WHERE ok GROUP BY 1, 2, 3"""
)

_PROVINCE_MINUTES = _orders(
    f"""SELECT strftime(date_trunc('minute', start_ts), '%Y-%m-%d %H:%M:%S') AS minute_start,
      province, {_N} AS orders, {_money()} AS fee_total
    FROM notified_located GROUP BY 1, 2"""
)

_PROVINCE_HOURS = _orders(
    f"""SELECT strftime(date_trunc('hour', start_ts), '%Y-%m-%d %H:%M:%S') AS hour_start,
      province, {_N} AS orders, {_money()} AS fee_total
    FROM notified_located GROUP BY 1, 2"""
)


def _success_board(direction: str) -> str:
    return _orders(
        f"""SELECT province, {_count('ok')} AS successes, {_N} AS orders,
          {_rounded(_count('ok'), 'count(*)', 3)} AS success_rate
        FROM located GROUP BY 1 ORDER BY orders {direction}, province LIMIT 10"""
    )


# The daily report looks at day, province and result only, and strips nothing.
_DAY_ROWS = """day_rows AS (
  SELECT strftime(start_ts, '%Y%m%d') AS day, province_code,
    result_code || CASE WHEN padded THEN chr(9) ELSE '' END AS result_code, ok AND NOT padded AS ok
  FROM (SELECT *, kind BETWEEN 5 AND 7 AND service_name = 'reChargeReq' AS padded
    FROM events_read WHERE kind NOT IN (0, 1, 3))
)"""
_DAILY_FAILURES = f"""{_DAY_ROWS}, daily AS (
  SELECT day, province, {_count('NOT ok')} AS failures,
    {_N} AS orders, {_rounded(_count('NOT ok'), 'count(*)', 2)} AS failure_rate
  FROM day_rows JOIN dimension USING (province_code) GROUP BY 1, 2
)"""


def _daily(body: str) -> str:
    return f"WITH {_ORDERS}, {_DAILY_FAILURES} {body}"


def _saved(rows: str, where: str = "true", back: int = 700) -> str:
    """The last save of each place; every fifth goes back by some messages."""
    rows = f"CASE WHEN batch_id % 5 = 4 THEN greatest(0, {rows} - {back}) ELSE {rows} END"
    return f"""SELECT topic, "partition", CAST(arg_max({rows}, batch_id) AS BIGINT) AS saved_offset
    FROM ranges WHERE {where} GROUP BY 1, 2"""


# The text of every message, put together field by field.
_TEXTS = f"""
texts AS (
  SELECT event_id,
    '{{"requestId":"' || CASE WHEN event_id % 997 = 3 THEN '20240231' || substr({_REQUEST_ID}, 9)
         ELSE {_REQUEST_ID} END || '"'
    || CASE WHEN event_id % 997 = 4 THEN ',"receiveNotifyTime":"soon"'
       WHEN event_id % 10 = 0 THEN ''
       ELSE ',"receiveNotifyTime":"'
         || strftime(ts + to_milliseconds((event_id * 37) % 5000), '%Y%m%d%H%M%S%g') || '"' END
    || ',"provinceCode":"' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 27) || '"'
    || CASE WHEN event_id % 997 = 1 THEN '' ELSE ',"bussinessRst":"'
         || CASE WHEN event_type = 'error' THEN '1001' ELSE '0000' END || '"' END
    || ',"chargefee":"'
    || CASE WHEN event_id % 997 = 2 THEN '12x' ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END
    || '"'
    || ',"serviceName":"'
    || CASE WHEN event_type = 'view' THEN 'reChargeReq' ELSE 'reChargeNotifyReq' END || '"}}'
    AS whole
  FROM events
)
"""

_GLOBAL = f"""SELECT {_N} AS orders, {_count('ok')} AS successes,
  CAST({_count('ok')} AS DOUBLE) / nullif(count(*), 0)::DOUBLE AS success_rate,
  CAST(sum(ms) // nullif(count(*), 0) AS BIGINT) AS avg_ms, {_money()} AS fee_total
FROM located"""

_FANOUT = _orders(
    f"""SELECT 'global_overview' AS result, '' AS key, {_N} AS orders, {_count('ok')} AS successes,
      CAST(NULL AS BIGINT) AS failures, {_money()} AS fee_total FROM located
    UNION ALL
    SELECT 'failures_province_hour', province || '-' || {_HOUR}, NULL, NULL, {_N}, NULL
    FROM located WHERE NOT ok GROUP BY province, {_HOUR}
    UNION ALL
    SELECT 'hourly_success_volume', CAST({_HOUR} AS VARCHAR), NULL, {_N}, NULL, {_money()}
    FROM located WHERE ok GROUP BY {_HOUR}
    UNION ALL
    SELECT 'province_minute_of_day_success', province || '-' || {_HOUR} || '-' || {_MINUTE},
      NULL, {_N}, NULL, {_money()}
    FROM located WHERE ok GROUP BY province, {_HOUR}, {_MINUTE}
    UNION ALL
    SELECT * FROM (
      SELECT 'top10_province_success', province, {_N} AS n, {_count('ok')}, NULL::BIGINT, NULL::BIGINT
      FROM located GROUP BY province ORDER BY n DESC, province LIMIT 10)"""
)

_SAVED_PARTITIONS = "NOT (topic = 'orders' AND \"partition\" = 1)"

ORACLE_SQL: dict[str, str] = {
    "daily_overview": _DAILY,
    "parse_orders": _PARSE,
    "notify_orders": _orders(f"SELECT {_SHOWN} FROM notified"),
    "rejected_orders": f"""WITH {_TEXTS}
      SELECT CAST(event_id AS VARCHAR) AS key,
        CASE WHEN event_id % 997 = 0 THEN left(whole, length(whole) // 2) ELSE whole END AS value,
        CASE event_id % 997 WHEN 0 THEN 'unreadable' WHEN 1 THEN 'missing_field'
          WHEN 2 THEN 'bad_fee' WHEN 3 THEN 'bad_start_time' ELSE 'bad_end_time' END AS reason
      FROM texts WHERE event_id % 997 < 5""",
    "daily_rejected": f"""WITH {_TEXTS}
      SELECT CAST(event_id AS VARCHAR) AS key,
        CASE WHEN event_id % 997 = 0 THEN left(whole, length(whole) // 2) ELSE whole END AS value,
        CASE event_id % 997 WHEN 0 THEN 'unreadable' WHEN 1 THEN 'missing_field'
          ELSE 'bad_day' END AS reason
      FROM texts WHERE event_id % 997 IN (0, 1, 3)""",
    "daily_unknown_codes": f"""WITH {_ORDERS}, {_DAY_ROWS}
      SELECT province_code, {_N} AS orders FROM day_rows
      WHERE province_code NOT IN (SELECT province_code FROM dimension) GROUP BY 1""",
    "province_dimension": _orders("SELECT province_code, province FROM dimension"),
    "offline_orders_scan": f"""WITH {_ORDERS}, {_DAY_ROWS}
      SELECT day, province_code, result_code, ok AS is_success FROM day_rows""",
    "province_lookup": _orders(
        """SELECT request_id, province_code, province
        FROM orders_all LEFT JOIN dimension USING (province_code)"""
    ),
    "unknown_province_codes": _orders(
        f"""SELECT province_code, {_N} AS orders FROM orders_all
        WHERE province_code NOT IN (SELECT province_code FROM dimension) GROUP BY 1"""
    ),
    "order_time_keys": _orders(
        f"""SELECT request_id, {_DAY} AS day, strftime(start_ts, '%Y%m%d') AS compact_day,
          {_WEEKDAY} AS weekday, {_HOUR} AS hour, {_MINUTE} AS minute
        FROM orders_all"""
    ),
    "order_durations": f"WITH shown AS ({_PARSE}) "
    "SELECT request_id, start_time, end_time, duration_ms FROM shown",
    "failures_weekday_hour_province": _FAILURES,
    "weekday_hour_volume": _WEEKDAY_HOURS,
    "top10_province_orders": _orders(
        f"""SELECT province, {_N} AS orders,
          CAST({_count('ok')} AS DOUBLE) / CAST(count(*) AS DOUBLE) AS success_rate
        FROM notified_located GROUP BY 1 ORDER BY orders DESC, province LIMIT 10"""
    ),
    "province_day_throughput_literal": _orders(
        f"""SELECT {_DAY} AS day, province,
          CAST(count(*) // 3600 AS BIGINT) AS orders_per_3600,
          CAST(count(*) // 216000 AS BIGINT) AS orders_per_216000,
          CAST({_money()} // 3600 AS BIGINT) AS fee_per_3600,
          CAST({_money()} // 216000 AS BIGINT) AS fee_per_216000
        FROM notified_located GROUP BY 1, 2"""
    ),
    "province_minute_volume": _PROVINCE_MINUTES,
    "province_hour_volume": _PROVINCE_HOURS,
    "global_overview": _orders(_GLOBAL),
    "failures_province_hour": _PROVINCE_HOUR_FAILURES,
    "province_orders": _orders(
        f"SELECT province, {_N} AS orders FROM located GROUP BY 1"
    ),
    "province_successes": _orders(
        f"SELECT province, {_N} AS successes FROM located WHERE ok GROUP BY 1"
    ),
    "province_success_join": _orders(
        f"""SELECT province, successes, orders, {_rounded('successes', 'orders', 3)} AS success_rate
        FROM (SELECT province, {_N} AS successes FROM located WHERE ok GROUP BY 1)
        JOIN (SELECT province, {_N} AS orders FROM located GROUP BY 1) USING (province)"""
    ),
    "top10_province_success": _success_board("DESC"),
    "bottom10_province_success": _success_board("ASC"),
    "hourly_success_volume": _HOURLY,
    "province_minute_of_day_success": _MINUTES_OF_DAY,
    "province_failure_rate": f"""WITH {_ORDERS}, {_DAY_ROWS}
      SELECT province, {_count('NOT ok')} AS failures, {_N} AS total,
        {_rounded(_count('NOT ok'), 'count(*)', 5)} AS failure_rate
      FROM day_rows JOIN dimension USING (province_code) GROUP BY 1""",
    "daily_province_failures": _daily("SELECT * FROM daily"),
    "top3_failures": _daily(
        "SELECT * FROM daily ORDER BY failures DESC, day, province LIMIT 3"
    ),
    "top3_failures_per_day": _daily(
        """SELECT * FROM (SELECT *, CAST(row_number() OVER (
            PARTITION BY day ORDER BY failures DESC, province) AS INTEGER) AS place FROM daily)
        WHERE place <= 3"""
    ),
    "stream_orders_ingest": _PARSE,
    "stream_failures_update": _FAILURES,
    "stream_weekday_hour_update": _WEEKDAY_HOURS,
    "stream_province_day_volume": _orders(
        f"""SELECT {_DAY} AS day, province, {_N} AS orders, {_money()} AS fee_total
        FROM notified_located GROUP BY 1, 2"""
    ),
    "stream_province_hour_windows": _PROVINCE_HOURS,
    "stream_province_minute_windows": _PROVINCE_MINUTES,
    "stream_reseed": _orders(_GLOBAL),
    "stream_hourly_complete": _HOURLY,
    "stream_top10_complete": _success_board("DESC"),
    "stream_daily_overview": _DAILY,
    "stream_fanout": _FANOUT,
    "stream_restart_resume": _FAILURES,
    "sink_keyed_upsert": f"""WITH volume AS ({_WEEKDAY_HOURS})
      SELECT weekday || '-' || hour AS dayhour, orders, fee_total FROM volume""",
    "sink_additive_counters": _DAILY,
    "sink_compacted_views": _DAILY,
    "sink_append_history": _PROVINCE_HOUR_FAILURES,
    "offset_ranges": _log("SELECT * FROM ranges"),
    "offset_ledger_latest": _log(_saved("until_offset", "topic = 'orders'")),
    "offset_ledger_by_group": _log(_saved("from_offset")),
    "offset_resume_plan": f"""WITH {_LOG},
      saved AS ({_saved('from_offset')}),
      earliest AS (
        SELECT topic, "partition", CAST(min("offset") AS BIGINT) AS earliest_offset
        FROM log WHERE ts >= TIMESTAMP '2024-01-30' GROUP BY 1, 2)
      SELECT topic, "partition", saved_offset, earliest_offset,
        greatest(saved_offset, earliest_offset) AS start_offset
      FROM saved LEFT JOIN earliest USING (topic, "partition")""",
    "sink_partition_output": _PARSE,
    "rejected_trailing_text": f"""WITH checked AS (
        SELECT event_id % 997 AS kind, event_id % 1009 IN (5, 6) AS glued FROM events),
      reasons AS (
        SELECT 'orders' AS report, CASE WHEN kind = 0 THEN 'unreadable' WHEN glued THEN 'trailing_text' WHEN kind = 1 THEN 'missing_field'
          WHEN kind = 2 THEN 'bad_fee' WHEN kind = 3 THEN 'bad_start_time' WHEN kind = 4 THEN 'bad_end_time' END AS reason FROM checked
        UNION ALL
        SELECT 'daily', CASE WHEN kind = 0 THEN 'unreadable' WHEN glued THEN 'trailing_text' WHEN kind = 1 THEN 'missing_field'
          WHEN kind = 3 THEN 'bad_day' END FROM checked)
      SELECT report, reason, {_N} AS messages FROM reasons WHERE reason IS NOT NULL GROUP BY 1, 2""",
    "stream_from_positions": f"""WITH {_LOG},
      halves AS (
        SELECT *, "offset" < (max("offset") OVER (PARTITION BY topic, "partition") + 1) // 2 AS first_half FROM log)
      SELECT CASE WHEN first_half THEN 'before' ELSE 'stream' END AS part, topic, "partition",
        CAST(min("offset") AS BIGINT) AS from_offset, CAST(max("offset") + 1 AS BIGINT) AS until_offset, {_N} AS messages
      FROM halves GROUP BY ALL""",
    "stream_running_reseed": _FAILURES,
    "stream_province_day_closing": _orders(
        f"""SELECT {_DAY} AS day, province, {_N} AS orders, {_money()} AS fee_total,
          date_trunc('day', start_ts) + INTERVAL 3 DAY
            <= (SELECT date_trunc('day', max(start_ts)) + INTERVAL 1 DAY FROM notified) AS closed
        FROM notified_located GROUP BY day, province, date_trunc('day', start_ts)"""
    ),
    "stream_late_minutes": _orders(
        f"""SELECT strftime(minute_start, '%Y-%m-%d %H:%M:%S') AS minute_start, province,
          {_count('NOT late')} AS orders, {_money('NOT late')} AS fee_total, {_count('late')} AS late_orders, {_money('late')} AS late_fee
        FROM (
          SELECT *, date_trunc('minute', start_ts) AS minute_start,
            coalesce(date_trunc('minute', start_ts) + INTERVAL 1 MINUTE <= (seen - INTERVAL 2 HOUR), false) AS late
          FROM (
            SELECT n.*, max(start_ts) OVER (ORDER BY batch RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
            FROM notified n JOIN (
              SELECT event_id, CASE WHEN place >= lo + (hi - lo) * 3 / 4.0 THEN 3 WHEN place >= lo + (hi - lo) * 2 / 4.0 THEN 2
                WHEN place >= lo + (hi - lo) / 4.0 THEN 1 ELSE 0 END AS batch
              FROM (SELECT *, min(place) OVER () AS lo, max(place) OVER () AS hi FROM (
                SELECT event_id, epoch(date_trunc('second', ts)) + CASE WHEN event_id % 10 = 0 THEN 864000 ELSE 0 END AS place FROM events))
            ) placed USING (event_id)))
        JOIN dimension USING (province_code) GROUP BY minute_start, province"""
    ),
    "offset_resume_positions": f"""WITH {_LOG},
      saved AS ({_saved('from_offset', _SAVED_PARTITIONS)}),
      earliest AS (
        SELECT topic, "partition", CAST(min("offset") AS BIGINT) AS earliest_offset
        FROM log WHERE ts >= TIMESTAMP '2024-01-30' AND NOT (topic = 'orders_failed' AND "partition" = 2) GROUP BY 1, 2)
      SELECT topic, "partition", saved_offset, earliest_offset,
        CASE WHEN earliest_offset IS NOT NULL THEN greatest(coalesce(saved_offset, earliest_offset), earliest_offset) END AS start_offset,
        CASE WHEN earliest_offset IS NULL THEN 'vanished' WHEN saved_offset IS NULL THEN 'new'
          WHEN saved_offset < earliest_offset THEN 'behind' ELSE 'saved' END AS status
      FROM saved FULL OUTER JOIN earliest USING (topic, "partition")""",
    "offset_ledger_append": _log(_saved("until_offset", back=0)),
}
