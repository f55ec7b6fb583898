"""Reference SQL (DuckDB dialect) for each batch plan.

Each statement starts from the pre-registered ``events`` view and rebuilds
the tap table with CTEs (FIXTURES.md §2), then states the query the plain
way: one window per key, no slicing.  Column names match the Spark plans.
"""

from __future__ import annotations

from tapflow.config import (
    BUS_ID_PATTERN, CARD_ID_PATTERN, CROWD_IDLE_SECONDS, CROWD_MESSAGE_FORMAT,
    CROWD_THRESHOLD, MAX_TRIP_MINUTES, MIN_TRANSFER_MINUTES, PAIRING_TIMEOUT_SECONDS,
    STOPS, TIMETABLE_HEAD_STOPS, TOPIC_NAME, TOPIC_PARTITIONS, TRANSACTION_ID_PATTERN,
)

N_STOPS = len(STOPS)

_STOPS_VALUES = ", ".join(
    f"({i}, '{sid}', {lat!r}e0, {lon!r}e0)" for i, (sid, lat, lon) in enumerate(STOPS))
_STOP_IDS = "[" + ", ".join(f"'{s[0]}'" for s in STOPS) + "]"

TAP_COLS = "transaction_id, card_id, bus_id, event_type, event_time, latitude, longitude"

_TAPS = f"""
taps_base AS (
  SELECT event_id,
    CASE WHEN event_id % 107 = 0 THEN NULL
         ELSE '00000000-0000-4000-8000-' || lpad(CAST(event_id AS VARCHAR), CAST(greatest(12, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0') END AS transaction_id,
    CASE WHEN event_id % 109 = 0 THEN 'C-' || CAST(user_id AS VARCHAR)
         ELSE 'C' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(3, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') END AS card_id,
    CASE WHEN event_id % 113 = 0 THEN 'TRAM-1'
         ELSE 'BUS-0' || CAST(event_id % 7 + 1 AS VARCHAR) END AS bus_id,
    CASE WHEN event_type IN ('view', 'signup') THEN 'tap_in'
         WHEN event_type IN ('click', 'purchase') THEN 'tap_out'
         ELSE event_type END AS event_type,
    CASE WHEN event_id % 103 = 0 THEN NULL ELSE CAST(ts AS TIMESTAMP) END AS event_time,
    CASE WHEN event_id % 97 = 0 THEN 9.1e1
         ELSE -6.1375e0 - CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE) * 8.9e-4 END AS latitude,
    CASE WHEN event_id % 101 = 0 THEN NULL
         ELSE 1.068135e2 + CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE) * 3.0e-5 END AS longitude
  FROM events
),
taps_n AS (
  SELECT *, 0 AS copy_no FROM taps_base
  UNION ALL SELECT * REPLACE (CASE WHEN event_id % 30 = 0 THEN event_time + INTERVAL 1 SECOND ELSE event_time END AS event_time),
    1 AS copy_no FROM taps_base WHERE event_id % 10 = 0
),
taps AS (SELECT event_id, {TAP_COLS} FROM taps_n)"""

_PAT_TX = f"regexp_matches(transaction_id, '{TRANSACTION_ID_PATTERN}')"
_PAT_CARD = f"regexp_matches(card_id, '{CARD_ID_PATTERN}')"
_PAT_BUS = f"regexp_matches(bus_id, '{BUS_ID_PATTERN}')"
_TYPE_OK = "event_type IN ('tap_in', 'tap_out')"
_LAT_OK = "(latitude IS NOT NULL AND latitude BETWEEN -90 AND 90)"
_LON_OK = "(longitude IS NOT NULL AND longitude BETWEEN -180 AND 180)"
_GOOD_COND = (f"transaction_id IS NOT NULL AND card_id IS NOT NULL AND bus_id IS NOT NULL "
              f"AND event_type IS NOT NULL AND event_time IS NOT NULL AND {_TYPE_OK} "
              f"AND {_LAT_OK} AND {_LON_OK} AND {_PAT_TX} AND {_PAT_CARD} AND {_PAT_BUS}")
_REASON = f"""CASE
    WHEN transaction_id IS NULL THEN 'missing_transaction_id'
    WHEN card_id IS NULL THEN 'missing_card_id'
    WHEN bus_id IS NULL THEN 'missing_bus_id'
    WHEN NOT coalesce({_TYPE_OK}, false) THEN 'invalid_event_type'
    WHEN event_time IS NULL THEN 'missing_timestamp'
    WHEN NOT {_LAT_OK} THEN 'invalid_latitude'
    WHEN NOT {_LON_OK} THEN 'invalid_longitude'
    WHEN NOT {_PAT_TX} THEN 'malformed_transaction_id'
    WHEN NOT {_PAT_CARD} THEN 'malformed_card_id'
    WHEN NOT {_PAT_BUS} THEN 'malformed_bus_id'
    ELSE NULL END"""

# Of the copies of a tap the earliest stays.
_EARLIEST = "row_number() OVER (PARTITION BY transaction_id ORDER BY event_time) AS copy"
_REASON_ENV = _REASON.replace(
    "WHEN event_time IS NULL THEN", "WHEN event_time IS NULL AND NOT unreadable THEN").replace(
    "WHEN NOT " + _LAT_OK, "WHEN unreadable THEN 'invalid_timestamp_parse'\n    WHEN NOT " + _LAT_OK)

_GOOD = f"""good AS (
  SELECT {TAP_COLS} FROM (SELECT *, {_EARLIEST} FROM taps WHERE {_GOOD_COND}) c WHERE copy = 1
)"""

_STOPS = f"stops AS (SELECT * FROM (VALUES {_STOPS_VALUES}) s(idx, stop_id, lat, lon))"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([_TAPS.strip()] + [c.strip() for c in ctes]) + "\n"


def _segment_cte(src: str, name: str = "seg") -> str:
    return f"""{name} AS (
  SELECT transaction_id, min(stop_id) || ' -> ' || max(stop_id) AS segment
  FROM (SELECT g.transaction_id, s.stop_id, row_number() OVER (PARTITION BY g.transaction_id ORDER BY
          (s.lat - g.latitude) * (s.lat - g.latitude) + (s.lon - g.longitude) * (s.lon - g.longitude), s.idx) AS rn
        FROM {src} g CROSS JOIN stops s) y
  WHERE rn <= 2 GROUP BY transaction_id
)"""


def _message(ts: str, bus: str, seg: str, n: str) -> str:
    fmt = CROWD_MESSAGE_FORMAT.replace("'", "''")
    return (f"printf('{fmt}', strftime({ts}, '%Y-%m-%d %H:%M:%S'), {bus}, {seg}, {n}, "
            f"{CROWD_THRESHOLD})")


_JSON = """'{"transaction_id":' || coalesce('"' || transaction_id || '"', 'null')
    || ',"card_id":' || coalesce('"' || card_id || '"', 'null')
    || ',"bus_id":' || coalesce('"' || bus_id || '"', 'null')
    || ',"event_type":' || coalesce('"' || event_type || '"', 'null')
    || ',"timestamp":' || CASE WHEN event_id % 211 = 0 THEN '9223372036854775807'
         ELSE coalesce(CAST(epoch_us(event_time) // 1000 AS VARCHAR), 'null') END
    || ',"latitude":' || coalesce(CAST(latitude AS VARCHAR), 'null')
    || ',"longitude":' || coalesce(CAST(longitude AS VARCHAR), 'null') || '}'"""

_ENVELOPE = f"""env AS (
  SELECT {_JSON} AS value_raw,
    '{TOPIC_NAME}' AS kafka_topic,
    CAST(event_id % {TOPIC_PARTITIONS} AS INTEGER) AS kafka_partition,
    event_id * 2 + copy_no AS kafka_offset,
    event_time AS kafka_timestamp,
    transaction_id, card_id, bus_id, event_type,
    CASE WHEN event_id % 211 <> 0 THEN CAST(date_trunc('millisecond', event_time) AS TIMESTAMP) END AS event_time,
    event_id % 211 = 0 AS unreadable, latitude, longitude
  FROM taps_n
)"""

_TRIPS = f"""trips AS (
  SELECT sha256(concat_ws('|', card_id, tx_in, transaction_id)) AS trip_id,
    card_id, bus_in AS bus_id, tx_in AS tap_in_tx_id, transaction_id AS tap_out_tx_id,
    t_in AS tap_in_time, event_time AS tap_out_time, lat_in AS tap_in_lat, lon_in AS tap_in_lon,
    latitude AS tap_out_lat, longitude AS tap_out_lon
  FROM (SELECT *,
          lag(event_type) OVER w AS prev_type, lag(transaction_id) OVER w AS tx_in,
          lag(bus_id) OVER w AS bus_in, lag(event_time) OVER w AS t_in,
          lag(latitude) OVER w AS lat_in, lag(longitude) OVER w AS lon_in
        FROM good WINDOW w AS (PARTITION BY card_id ORDER BY event_time, transaction_id)) x
  WHERE prev_type = 'tap_in' AND event_type = 'tap_out'
)"""

_OCC = """occ AS (
  SELECT transaction_id, bus_id, event_time, latitude, longitude,
    CAST(greatest(0, sum(CASE event_type WHEN 'tap_in' THEN 1 ELSE -1 END)
      OVER (PARTITION BY bus_id ORDER BY event_time, transaction_id ROWS UNBOUNDED PRECEDING)) AS INTEGER) AS pending
  FROM good
)"""

_STOP_LAT = "[" + ", ".join(f"{s[1]!r}e0" for s in STOPS) + "]"
_STOP_LON = "[" + ", ".join(f"{s[2]!r}e0" for s in STOPS) + "]"
_TIMETABLE = f"""at_stop AS (
  SELECT *, CAST(event_time AS DATE) AS service_date,
    list_position(ds, list_min(ds)) - 1 AS stop_idx
  FROM (SELECT *, list_transform(range(1, {N_STOPS + 1}), lambda k:
          ({_STOP_LAT}[k] - latitude) * ({_STOP_LAT}[k] - latitude)
          + ({_STOP_LON}[k] - longitude) * ({_STOP_LON}[k] - longitude)) AS ds FROM good) z
),
seen AS (
  SELECT *, lag(stop_idx) OVER (PARTITION BY bus_id, service_date ORDER BY event_time, transaction_id) AS prev_idx
  FROM at_stop
),
visits AS (
  SELECT *, row_number() OVER w AS n, lead(stop_idx) OVER w AS next_idx
  FROM seen WHERE prev_idx IS NULL OR prev_idx <> stop_idx
  WINDOW w AS (PARTITION BY bus_id, service_date ORDER BY event_time, transaction_id)
),
directed AS (
  SELECT *, CASE WHEN stop_idx > coalesce(prev_idx, stop_idx) OR (prev_idx IS NULL AND coalesce(next_idx, 99) > stop_idx)
                 THEN 'forward' ELSE 'backward' END AS direction
  FROM visits
),
turns AS (
  SELECT *, coalesce(CAST(lag(direction) OVER (PARTITION BY bus_id, service_date ORDER BY n) <> direction AS INTEGER), 0) AS turn
  FROM directed
),
tt AS (
  SELECT bus_id, service_date, CAST(n - 1 AS INTEGER) AS seq_no,
    CAST(sum(turn) OVER (PARTITION BY bus_id, service_date ORDER BY n ROWS UNBOUNDED PRECEDING) AS INTEGER) AS leg_no,
    direction, CAST(stop_idx AS INTEGER) AS stop_idx, {_STOP_IDS}[stop_idx + 1] AS stop_id, event_time AS arrival
  FROM turns
)"""

_LEGS = """dlegs AS (
  SELECT bus_id, service_date, CAST(leg_no + 1 AS INTEGER) AS leg, direction,
    count(*) AS n_stops, min(arrival) AS first_arrival, max(arrival) AS last_arrival,
    arg_min(stop_id, seq_no) AS first_stop, arg_max(stop_id, seq_no) AS last_stop,
    string_agg(stop_id, ',' ORDER BY seq_no) AS stop_list
  FROM tt GROUP BY bus_id, service_date, leg_no, direction
  HAVING count(*) >= 2
)"""


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["tap_envelope"] = _with(_ENVELOPE) + """
SELECT value_raw, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp,
  transaction_id, card_id, bus_id, event_type, event_time, latitude, longitude FROM env"""

ORACLE_SQL["tap_pattern_filter"] = _with() + f"""
SELECT * FROM taps WHERE {_PAT_TX} AND {_PAT_CARD} AND {_PAT_BUS}"""

ORACLE_SQL["tap_type_filter"] = _with() + f"SELECT * FROM taps WHERE {_TYPE_OK}"

ORACLE_SQL["tap_range_filter"] = _with() + f"""
SELECT * FROM taps WHERE {_LAT_OK} AND {_LON_OK} AND event_time IS NOT NULL"""

ORACLE_SQL["good_taps"] = _with(_GOOD) + "SELECT * FROM good"
ORACLE_SQL["good_taps_strict"] = ORACLE_SQL["good_taps"]

ORACLE_SQL["tap_dedup"] = _with() + f"""
SELECT * EXCLUDE (copy) FROM (SELECT *, {_EARLIEST} FROM taps WHERE transaction_id IS NOT NULL) c WHERE copy = 1"""

ORACLE_SQL["reject_reason"] = _with() + f"SELECT *, {_REASON} AS error_reason FROM taps"

ORACLE_SQL["reject_counts"] = _with() + f"""
SELECT coalesce({_REASON}, 'none') AS error_reason, count(*) AS n_rows FROM taps GROUP BY 1"""

ORACLE_SQL["dead_letter"] = _with(_ENVELOPE) + f"""
SELECT value_raw, {_REASON_ENV} AS error_reason, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp
FROM env WHERE NOT coalesce({_GOOD_COND}, false)"""

ORACLE_SQL["dead_letter_strict"] = _with(_ENVELOPE) + f"""
SELECT value_raw, {_REASON_ENV} AS error_reason, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp
FROM env WHERE coalesce({_PAT_TX} AND {_PAT_CARD} AND {_PAT_BUS} AND {_TYPE_OK}, false)
  AND NOT coalesce({_GOOD_COND}, false)"""

ORACLE_SQL["trips"] = _with(_GOOD, _TRIPS) + "SELECT * FROM trips"

ORACLE_SQL["open_taps"] = _with(_GOOD) + """
SELECT card_id, transaction_id AS tap_in_tx_id, bus_id, event_time AS tap_in_time,
  latitude AS tap_in_lat, longitude AS tap_in_lon
FROM (SELECT *, row_number() OVER (PARTITION BY card_id ORDER BY event_time DESC, transaction_id DESC) AS rn
      FROM good) x
WHERE rn = 1 AND event_type = 'tap_in'"""

ORACLE_SQL["trips_max_open"] = _with(_GOOD, _TRIPS) + f"""
SELECT * FROM trips WHERE epoch_us(tap_out_time) - epoch_us(tap_in_time) <= {PAIRING_TIMEOUT_SECONDS * 1_000_000}"""

ORACLE_SQL["expired_taps"] = _with(_GOOD) + f"""
SELECT card_id, transaction_id AS tap_in_tx_id, bus_id, event_time AS tap_in_time,
  latitude AS tap_in_lat, longitude AS tap_in_lon, next_time AS next_event_time
FROM (SELECT *, lead(event_time) OVER (PARTITION BY card_id ORDER BY event_time, transaction_id) AS next_time,
        max(event_time) OVER () AS end_time
      FROM good) x
WHERE event_type = 'tap_in'
  AND epoch_us(coalesce(next_time, end_time)) - epoch_us(event_time) > {PAIRING_TIMEOUT_SECONDS * 1_000_000}"""

ORACLE_SQL["trip_rule_violations"] = _with(_GOOD, _TRIPS, """tp AS (
  SELECT *, lag(tap_out_time) OVER (PARTITION BY card_id ORDER BY tap_in_time, tap_in_tx_id) AS prev_tap_out_time
  FROM trips
)""") + f"""
SELECT trip_id, card_id, tap_in_time, tap_out_time, prev_tap_out_time, 'tap_out_not_after_tap_in' AS violation
FROM tp WHERE tap_out_time <= tap_in_time
UNION ALL
SELECT trip_id, card_id, tap_in_time, tap_out_time, prev_tap_out_time, 'trip_too_long'
FROM tp WHERE epoch_us(tap_out_time) - epoch_us(tap_in_time) > {MAX_TRIP_MINUTES * 60 * 1_000_000}
UNION ALL
SELECT trip_id, card_id, tap_in_time, tap_out_time, prev_tap_out_time, 'transfer_too_soon'
FROM tp WHERE prev_tap_out_time IS NOT NULL
  AND tap_in_time <= prev_tap_out_time + INTERVAL {MIN_TRANSFER_MINUTES} MINUTE"""

ORACLE_SQL["bus_tap_counts"] = _with(_GOOD) + """
SELECT bus_id,
  CAST(sum(CASE WHEN event_type = 'tap_in' THEN 1 ELSE 0 END) AS BIGINT) AS tap_in_count,
  CAST(sum(CASE WHEN event_type = 'tap_out' THEN 1 ELSE 0 END) AS BIGINT) AS tap_out_count
FROM good GROUP BY bus_id"""

ORACLE_SQL["bus_aboard"] = _with(_GOOD) + """
SELECT bus_id, CAST(greatest(0, sum(CASE WHEN event_type = 'tap_in' THEN 1 ELSE -1 END)) AS INTEGER) AS pending_count
FROM good GROUP BY bus_id"""

ORACLE_SQL["occupancy"] = _with(_GOOD, _OCC) + \
    "SELECT transaction_id, bus_id, event_time, pending FROM occ"

ORACLE_SQL["crowd_flags"] = _with(_GOOD, _STOPS, _OCC, _segment_cte(
    f"(SELECT * FROM occ WHERE pending > {CROWD_THRESHOLD})")) + f"""
SELECT o.bus_id, o.transaction_id, o.event_time AS flagged_at, o.pending AS pending_count,
  s.segment, {_message('o.event_time', 'o.bus_id', 's.segment', 'o.pending')} AS message
FROM occ o JOIN seg s USING (transaction_id)
WHERE o.pending > {CROWD_THRESHOLD}"""

_HOUR_US = 3600 * 1_000_000
ORACLE_SQL["crowd_flags_windowed"] = _with(_GOOD, _STOPS, f"""wb AS (
  SELECT *, CAST(floor(epoch_us(event_time) / {_HOUR_US}) AS BIGINT) AS w,
    CASE WHEN event_type = 'tap_in' THEN 1 ELSE -1 END AS d
  FROM good
),
per AS (
  SELECT bus_id, w, sum(d) AS delta FROM wb GROUP BY bus_id, w
),
lastpos AS (
  SELECT bus_id, w, transaction_id, event_time, latitude, longitude
  FROM (SELECT *, row_number() OVER (PARTITION BY bus_id, w ORDER BY event_time DESC, transaction_id DESC) AS rn
        FROM wb) z WHERE rn = 1
),
closing AS (
  SELECT p.bus_id, p.w, sum(p.delta) OVER (PARTITION BY p.bus_id ORDER BY p.w ROWS UNBOUNDED PRECEDING) AS aboard,
    l.transaction_id, l.event_time, l.latitude, l.longitude
  FROM per p JOIN lastpos l USING (bus_id, w)
),
flag AS (SELECT * FROM closing WHERE aboard > {CROWD_THRESHOLD})""", _segment_cte("flag")) + f"""
SELECT f.bus_id, make_timestamp(f.w * {_HOUR_US}) AS window_start,
  make_timestamp((f.w + 1) * {_HOUR_US}) AS window_end,
  f.event_time AS flagged_at, CAST(greatest(0, f.aboard) AS INTEGER) AS pending_count, s.segment,
  {_message('f.event_time', 'f.bus_id', 's.segment', 'CAST(greatest(0, f.aboard) AS INTEGER)')} AS message
FROM flag f JOIN seg s USING (transaction_id)"""

_SESSIONS = f"""g1 AS (
  SELECT *, CASE WHEN lag(event_time) OVER w IS NULL
      OR epoch_us(event_time) - epoch_us(lag(event_time) OVER w) > {CROWD_IDLE_SECONDS * 1_000_000}
      THEN 1 ELSE 0 END AS is_new
  FROM good WINDOW w AS (PARTITION BY bus_id ORDER BY event_time, transaction_id)
),
g2 AS (
  SELECT *, sum(is_new) OVER (PARTITION BY bus_id ORDER BY event_time, transaction_id ROWS UNBOUNDED PRECEDING) AS session_no
  FROM g1
)"""

ORACLE_SQL["occupancy_idle_reset"] = _with(_GOOD, _SESSIONS) + """
SELECT transaction_id, bus_id, event_time, CAST(session_no AS BIGINT) AS session_no,
  CAST(greatest(0, sum(CASE WHEN event_type = 'tap_in' THEN 1 ELSE -1 END)
    OVER (PARTITION BY bus_id, session_no ORDER BY event_time, transaction_id ROWS UNBOUNDED PRECEDING)) AS INTEGER) AS pending
FROM g2"""

ORACLE_SQL["nearest_segment"] = _with(_GOOD, _STOPS, _segment_cte("good")) + "SELECT * FROM seg"

ORACLE_SQL["nearest_segment_join"] = ORACLE_SQL["nearest_segment"]

ORACLE_SQL["tap_type_counts"] = _with(_GOOD) + \
    "SELECT event_type, count(*) AS n_rows FROM good GROUP BY event_type"

ORACLE_SQL["first_taps"] = _with(_GOOD) + \
    "SELECT * FROM good ORDER BY event_time, transaction_id LIMIT 10"

# The producer's key partitioner: crc32 of the key, as an unsigned number,
# modulo the partitions.  Stated here bit by bit: crc32 is the remainder of a
# division over GF(2), eight shifts per byte.
_CRC_STEP = "CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END"


def _crc_byte(state: str, byte: str) -> str:
    s = f"xor({state}, {byte})"
    return f"list_reduce([{s}, 0, 0, 0, 0, 0, 0, 0, 0], lambda s, x: {_CRC_STEP})"


_CRC32 = ("xor(list_reduce(list_concat([4294967295], list_transform(string_split(bus_id, ''), lambda c: ascii(c)::BIGINT)), "
          f"lambda a, b: {_crc_byte('a', 'b')}), 4294967295)")
ORACLE_SQL["bus_partition_sizes"] = _with(_GOOD) + f"""
SELECT CAST(crc % {TOPIC_PARTITIONS} AS INTEGER) AS partition, count(*) AS n_buses, CAST(sum(n) AS BIGINT) AS n_rows
FROM (SELECT bus_id, n, CAST({_CRC32} AS BIGINT) AS crc
      FROM (SELECT bus_id, count(*) AS n FROM good GROUP BY bus_id) b) x
GROUP BY 1"""

ORACLE_SQL["timetable"] = _with(_GOOD, _TIMETABLE) + "SELECT * FROM tt"

ORACLE_SQL["timetable_head"] = _with(_GOOD, _TIMETABLE) + \
    f"SELECT * FROM tt WHERE seq_no < {TIMETABLE_HEAD_STOPS}"

ORACLE_SQL["direction_legs"] = _with(_GOOD, _TIMETABLE, _LEGS) + "SELECT * FROM dlegs"

ORACLE_SQL["leg_stops"] = _with(_GOOD, _TIMETABLE, _LEGS) + \
    "SELECT bus_id, service_date, leg, direction, stop_list FROM dlegs"

ORACLE_SQL["leg_direction_counts"] = _with(_GOOD, _TIMETABLE, _LEGS) + """
SELECT bus_id, service_date,
  CAST(sum(CASE WHEN direction = 'forward' THEN 1 ELSE 0 END) AS BIGINT) AS forward_legs,
  CAST(sum(CASE WHEN direction = 'backward' THEN 1 ELSE 0 END) AS BIGINT) AS backward_legs,
  CAST(count(*) AS BIGINT) AS total_legs
FROM dlegs GROUP BY bus_id, service_date"""

# --- sinks (round trips equal their inputs) ---------------------------------

ORACLE_SQL["json_roundtrip"] = ORACLE_SQL["good_taps"]
ORACLE_SQL["sink_raw_roundtrip"] = ORACLE_SQL["good_taps"]
ORACLE_SQL["sink_trips_roundtrip"] = ORACLE_SQL["trips"]
ORACLE_SQL["sink_dlq_roundtrip"] = ORACLE_SQL["dead_letter"]
ORACLE_SQL["scalar_json"] = ORACLE_SQL["good_taps"]

# --- scalar functions --------------------------------------------------------

ORACLE_SQL["scalar_strings"] = _with() + f"""
SELECT event_id, transaction_id, CAST(length(transaction_id) AS INTEGER) AS tx_len,
  substring(transaction_id, 25, 12) AS tx_tail, lpad(card_id, CAST(greatest(6, length(card_id)) AS INTEGER), '0') AS card_padded,
  {_PAT_BUS} AS bus_ok, printf('%s@%s', card_id, bus_id) AS card_at_bus,
  upper(substring(bus_id, 1, 3)) AS vehicle_kind
FROM taps"""

# Asia/Jakarta has been UTC+7 without daylight saving since 1964, so the
# local view is a fixed shift for every date in the data.
ORACLE_SQL["scalar_times"] = _with(_GOOD, _TRIPS) + """
SELECT trip_id, epoch_us(tap_in_time) // 1000 AS tap_in_ms,
  tap_in_time + INTERVAL 7 HOUR AS tap_in_local,
  strftime(tap_in_time + INTERVAL 7 HOUR, '%H:%M') AS tap_in_hhmm,
  CAST(tap_in_time + INTERVAL 7 HOUR AS DATE) AS service_date_local,
  (epoch_us(tap_out_time) - epoch_us(tap_in_time)) // 60000000 AS duration_min
FROM trips"""

# --- streams, run as one micro-batch over the events file -------------------

ORACLE_SQL["tap_dedup_stream"] = ORACLE_SQL["good_taps"]
ORACLE_SQL["trips_stream"] = ORACLE_SQL["trips"]
ORACLE_SQL["trips_max_open_stream"] = ORACLE_SQL["trips_max_open"]
ORACLE_SQL["bus_aboard_stream"] = ORACLE_SQL["bus_aboard"]
ORACLE_SQL["crowd_flags_stream"] = _with(_GOOD, _STOPS, f"""fin AS (
  SELECT bus_id, CAST(greatest(0, sum(CASE WHEN event_type = 'tap_in' THEN 1 ELSE -1 END)) AS INTEGER) AS pending_count,
    arg_max(transaction_id, (event_time, transaction_id)) AS transaction_id
  FROM good GROUP BY bus_id
),
flag AS (
  SELECT f.bus_id, f.pending_count, g.transaction_id, g.event_time, g.latitude, g.longitude
  FROM fin f JOIN good g USING (transaction_id) WHERE f.pending_count > {CROWD_THRESHOLD}
)""", _segment_cte("flag")) + f"""
SELECT f.bus_id, f.event_time AS flagged_at, f.pending_count, s.segment,
  {_message('f.event_time', 'f.bus_id', 's.segment', 'f.pending_count')} AS message
FROM flag f JOIN seg s USING (transaction_id)"""

# A pending tap_in with no later event expires when the final watermark
# (latest event time in ms minus the 5 minute delay) passes its deadline.
ORACLE_SQL["expired_taps_stream"] = _with(_GOOD, f"""nx AS (
  SELECT *, lead(event_time) OVER (PARTITION BY card_id ORDER BY event_time, transaction_id) AS next_time
  FROM good
),
wm AS (SELECT max(epoch_us(event_time)) // 1000 - 300000 AS wm_ms FROM good)""") + f"""
SELECT card_id, transaction_id AS tap_in_tx_id, bus_id, event_time AS tap_in_time,
  latitude AS tap_in_lat, longitude AS tap_in_lon
FROM nx, wm
WHERE event_type = 'tap_in'
  AND ((next_time IS NOT NULL AND epoch_us(next_time) - epoch_us(event_time) > {PAIRING_TIMEOUT_SECONDS * 1_000_000})
    OR (next_time IS NULL AND (epoch_us(event_time) + {PAIRING_TIMEOUT_SECONDS * 1_000_000}) // 1000 < wm_ms))"""

ORACLE_SQL["trips_ordered_stream"] = ORACLE_SQL["trips"]

# --- replays in event-time order over several micro-batches -----------------

ORACLE_SQL["occupancy_idle_reset_stream"] = ORACLE_SQL["occupancy_idle_reset"]
ORACLE_SQL["crowd_sessions_stream"] = _with(_GOOD, _SESSIONS) + """
SELECT bus_id, min(event_time) AS session_start, max(event_time) AS last_event_time,
  count(*) FILTER (event_type = 'tap_in') AS tap_in_count, count(*) FILTER (event_type = 'tap_out') AS tap_out_count,
  CAST(greatest(0, sum(CASE event_type WHEN 'tap_in' THEN 1 ELSE -1 END)) AS INTEGER) AS pending_count
FROM g2 GROUP BY bus_id, session_no"""
ORACLE_SQL["crowd_flags_windowed_stream"] = ORACLE_SQL["crowd_flags_windowed"]
ORACLE_SQL["open_taps_state"] = ORACLE_SQL["open_taps"]
ORACLE_SQL["trips_resumed_stream"] = ORACLE_SQL["trips"]
ORACLE_SQL["sink_raw_exactly_once"] = ORACLE_SQL["good_taps"]
ORACLE_SQL["tap_dedup_unbounded_stream"] = ORACLE_SQL["good_taps"]
ORACLE_SQL["late_tap_counts"] = _with(f"valid AS (SELECT * FROM taps WHERE {_GOOD_COND})", """
bounds AS (SELECT min(epoch_us(event_time)) AS lo, max(epoch_us(event_time)) AS hi FROM valid)""", """
judged AS (SELECT transaction_id, right(transaction_id, 1) = '7' AND epoch_us(event_time) < lo + (hi - lo) // 4 AS late
           FROM valid, bounds)""") + """
SELECT (SELECT count(*) FROM taps) AS rows_in, (SELECT count(*) FROM taps) - count(*) AS dead_lettered,
  count(*) FILTER (late) AS late, count(*) FILTER (NOT late) - count(DISTINCT transaction_id) FILTER (NOT late) AS duplicate,
  count(DISTINCT transaction_id) FILTER (NOT late) AS kept
FROM judged"""
