"""DuckDB SQL that computes each registered query independently (correctness oracle).

Tables ``events orders lineitem ...`` are views over the same parquet files.
"""

from __future__ import annotations

# The availability view, written for DuckDB (same definition as plans.derived.avail).
AVAIL = """
avail AS (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS request_timestamp,
         ts AS kafka_timestamp,
         'ds' AS dataset_id,
         CAST(user_id AS VARCHAR) AS stationcode,
         'st-' || CAST(user_id AS VARCHAR)
           || CASE WHEN user_id % 7 = 0 AND ts >= TIMESTAMP '2024-01-15 00:00:00' THEN '-b' ELSE '' END AS name,
         'OUI' AS is_installed,
         CAST(10 + user_id % 50 AS INTEGER) AS capacity,
         CAST(10 + user_id % 50 - floor(value / 50) AS INTEGER) AS numdocksavailable,
         CAST(floor(value / 50) AS INTEGER) AS numbikesavailable,
         CAST(floor(value / 50) - floor(value / 100) AS INTEGER) AS mechanical,
         CAST(floor(value / 100) AS INTEGER) AS ebike,
         CASE WHEN event_type = 'error' THEN NULL ELSE 'OUI' END AS is_renting,
         'NON' AS is_returning,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0 THEN 'n/a'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS duedate,
         CAST(48000 + user_id % 100 AS DOUBLE) / 1000.0 AS lat,
         CAST(2000 + user_id % 100 AS DOUBLE) / 1000.0 AS lon,
         'arr-' || CAST(user_id % 20 AS VARCHAR) AS nom_arrondissement_communes,
         CAST(75101 + user_id % 20 AS VARCHAR) AS code_insee_commune,
         'Oui' AS station_opening_hours,
         ts AS insert_timestamp,
         event_id, event_type, props, value, user_id
  FROM events
)"""

TYPED = AVAIL + """,
typed AS (
  SELECT stationcode, request_timestamp, name,
         is_installed = 'OUI' AS is_installed,
         capacity, numdocksavailable, numbikesavailable, mechanical, ebike,
         is_renting = 'OUI' AS is_renting,
         is_returning = 'OUI' AS is_returning,
         TRY_CAST(duedate AS TIMESTAMP) AS duedate,
         lat, lon, nom_arrondissement_communes, code_insee_commune, station_opening_hours,
         kafka_timestamp, insert_timestamp,
         CAST(request_timestamp AS DATE) AS request_date
  FROM avail
)"""

DEDUP = TYPED + """,
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY stationcode, request_timestamp
                                 ORDER BY kafka_timestamp ASC NULLS FIRST, name, insert_timestamp) AS rn
    FROM typed) WHERE rn = 1
)"""

CMP = ["is_installed", "capacity", "numdocksavailable", "numbikesavailable",
       "mechanical", "ebike", "is_renting", "is_returning"]


def _differs(a: str, b: str) -> str:
    return " OR ".join(f"{a}.{c} IS DISTINCT FROM {b}.{c}" for c in CMP)


def _lag_cols(part: str, order: str) -> str:
    return ", ".join(f"LAG({c}) OVER (PARTITION BY {part} ORDER BY {order}) AS p_{c}" for c in CMP)


def _lag_differs() -> str:
    return " OR ".join(f"{c} IS DISTINCT FROM p_{c}" for c in CMP)


# Sequential change filter over the whole deduplicated feed.
KEPT = DEDUP + f""",
lagged AS (
  SELECT *, {_lag_cols('stationcode', 'request_timestamp')},
         LAG(request_timestamp) OVER (PARTITION BY stationcode ORDER BY request_timestamp) AS p_ts
  FROM dedup
),
kept AS (
  SELECT * EXCLUDE ({', '.join('p_' + c for c in CMP)}, p_ts) FROM lagged
  WHERE stationcode IS NULL OR p_ts IS NULL OR {_lag_differs()}
)"""

SILVER_COLS = ("stationcode, request_timestamp, name, is_installed, capacity, numdocksavailable, "
               "numbikesavailable, mechanical, ebike, is_renting, is_returning, duedate, lat, lon, "
               "nom_arrondissement_communes, code_insee_commune, station_opening_hours, "
               "kafka_timestamp, insert_timestamp, request_date")

ORACLE: dict[str, str] = {}

ORACLE["envelope_roundtrip"] = "WITH " + AVAIL + """
SELECT request_timestamp, kafka_timestamp, dataset_id, stationcode, name, is_installed, capacity,
       numdocksavailable, numbikesavailable, mechanical, ebike, is_renting, is_returning, duedate,
       lat, lon, nom_arrondissement_communes, code_insee_commune, station_opening_hours
FROM avail"""

ORACLE["typed_snapshot"] = "WITH " + TYPED + f"\nSELECT {SILVER_COLS} FROM typed"

ORACLE["dedup_earliest"] = "WITH " + DEDUP + f"\nSELECT {SILVER_COLS} FROM dedup"

ORACLE["change_filter_asof"] = "WITH " + KEPT + f"\nSELECT {SILVER_COLS} FROM kept"

BATCH = "TIMESTAMP '2024-01-20 00:00:00'"
CMP_COLS = ", ".join(CMP)


def _latest(src: str, cols: str, where: str = "TRUE") -> str:
    return f"""SELECT stationcode, request_timestamp, {cols} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY stationcode ORDER BY request_timestamp DESC) AS rn
  FROM {src} WHERE request_timestamp IS NOT NULL AND {where}) WHERE rn = 1"""


ORACLE["last_known_state"] = "WITH " + KEPT + "\n" + _latest(
    "kept", CMP_COLS, f"request_timestamp >= {BATCH} - INTERVAL 7 DAY AND request_timestamp < {BATCH}")

ORACLE["change_filter_batch"] = "WITH " + KEPT + f""",
last_known AS ({_latest('kept', CMP_COLS, f"request_timestamp >= {BATCH} - INTERVAL 7 DAY AND request_timestamp < {BATCH}")}),
batch AS (SELECT * FROM dedup WHERE request_date = DATE '2024-01-20')
SELECT {', '.join('b.' + c for c in SILVER_COLS.split(', '))}
FROM batch b LEFT JOIN last_known l ON b.stationcode = l.stationcode
WHERE b.stationcode IS NULL OR l.stationcode IS NULL OR {_differs('b', 'l')}"""

# C2 for one batch: stored kept rows within the look-back + the batch's new rows.
_STEP = KEPT + f""",
batch AS (SELECT * FROM dedup WHERE request_date = DATE '2024-01-20'),
hist AS (SELECT * FROM kept WHERE request_timestamp < {BATCH}),
lo AS (SELECT min(request_timestamp) AS lo, max(request_timestamp) AS hi FROM batch),
stored AS (SELECT h.* FROM hist h, lo WHERE h.request_timestamp >= lo.lo - INTERVAL 7 DAY
                                          AND h.request_timestamp <= lo.hi),
fresh AS (SELECT b.* FROM batch b WHERE NOT EXISTS (
            SELECT 1 FROM stored s WHERE s.stationcode = b.stationcode AND s.request_timestamp = b.request_timestamp)),
u AS (SELECT *, FALSE AS is_new FROM stored UNION ALL SELECT *, TRUE AS is_new FROM fresh),
ul AS (SELECT *, {_lag_cols('stationcode', 'request_timestamp')},
              LAG(request_timestamp) OVER (PARTITION BY stationcode ORDER BY request_timestamp) AS p_ts FROM u),
step AS (SELECT * FROM ul WHERE is_new AND (stationcode IS NULL OR p_ts IS NULL OR {_lag_differs()}))"""

ORACLE["change_filter_step"] = "WITH " + _STEP + f"\nSELECT {SILVER_COLS} FROM step"

ORACLE["replay_noop"] = "WITH " + KEPT.replace("kept AS (", "kept0 AS (") + f""",
kept AS (SELECT * FROM kept0),
batch AS (SELECT * FROM dedup WHERE request_date = DATE '2024-01-20'),
lo AS (SELECT min(request_timestamp) AS lo, max(request_timestamp) AS hi FROM batch),
stored AS (SELECT h.* FROM kept h, lo WHERE h.request_timestamp >= lo.lo - INTERVAL 7 DAY
                                          AND h.request_timestamp <= lo.hi),
fresh AS (SELECT b.* FROM batch b WHERE NOT EXISTS (
            SELECT 1 FROM stored s WHERE s.stationcode = b.stationcode AND s.request_timestamp = b.request_timestamp)),
u AS (SELECT *, FALSE AS is_new FROM stored UNION ALL SELECT *, TRUE AS is_new FROM fresh),
ul AS (SELECT *, {_lag_cols('stationcode', 'request_timestamp')},
              LAG(request_timestamp) OVER (PARTITION BY stationcode ORDER BY request_timestamp) AS p_ts FROM u)
SELECT (SELECT count(*) FROM batch) AS n_batch,
       (SELECT count(*) FROM batch b WHERE EXISTS (SELECT 1 FROM kept k WHERE k.stationcode = b.stationcode
                                                   AND k.request_timestamp = b.request_timestamp)) AS n_already_stored,
       (SELECT count(*) FROM ul WHERE is_new AND (stationcode IS NULL OR p_ts IS NULL OR {_lag_differs()})) AS n_inserted"""

ORACLE["merge_insert_only"] = "WITH " + KEPT + f""",
target AS (SELECT * FROM kept WHERE request_date <= DATE '2024-01-20'),
source AS (SELECT * FROM kept WHERE request_date BETWEEN DATE '2024-01-20' AND DATE '2024-01-21')
SELECT {SILVER_COLS} FROM source s WHERE NOT EXISTS (
  SELECT 1 FROM target t WHERE t.stationcode = s.stationcode AND t.request_timestamp = s.request_timestamp
    AND t.request_date IN (DATE '2024-01-20', DATE '2024-01-21'))"""

# Every change row once, under the load that first brought it.
ORACLE["merge_bucketed"] = "WITH " + KEPT + f"""
SELECT {SILVER_COLS}, CASE WHEN request_date <= DATE '2024-01-20' THEN 'load-0' ELSE 'load-1' END AS batch_id
FROM kept WHERE request_date IS NOT NULL"""

ORACLE["current_state"] = "WITH " + KEPT + "\n" + _latest("kept", "name, " + CMP_COLS)

ORACLE["state_as_of"] = "WITH " + KEPT + "\n" + _latest(
    "kept", CMP_COLS, "request_timestamp <= TIMESTAMP '2024-01-15 12:00:00'")

ORACLE["history_intervals"] = "WITH " + KEPT + f"""
SELECT stationcode, request_timestamp AS valid_from,
       LEAD(request_timestamp) OVER (PARTITION BY stationcode ORDER BY request_timestamp) AS valid_to,
       {CMP_COLS}
FROM kept"""

# The newest change at or before each cycle, for every station that has one.
ORACLE["dense_grid"] = "WITH " + KEPT + f""",
cycles AS (SELECT DISTINCT request_timestamp AS at FROM typed WHERE request_timestamp IS NOT NULL),
stations AS (SELECT DISTINCT stationcode FROM kept),
grid AS (SELECT s.stationcode, c.at FROM stations s, cycles c)
SELECT g.stationcode, g.at AS request_timestamp, k.request_timestamp AS changed_at,
       {', '.join('k.' + c for c in CMP)}
FROM grid g ASOF JOIN kept k ON g.stationcode = k.stationcode AND g.at >= k.request_timestamp"""

ORACLE["station_dimension"] = "WITH " + DEDUP + """
SELECT stationcode, name, capacity, lat, lon, nom_arrondissement_communes, code_insee_commune,
       station_opening_hours, first_seen, request_timestamp AS last_seen FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY stationcode ORDER BY request_timestamp DESC) AS rn,
         min(request_timestamp) OVER (PARTITION BY stationcode) AS first_seen
  FROM dedup WHERE request_timestamp IS NOT NULL) WHERE rn = 1"""

ORACLE["duplicate_audit"] = "WITH " + TYPED + """
SELECT stationcode, request_timestamp, count(*) AS n FROM typed
GROUP BY stationcode, request_timestamp HAVING count(*) > 1"""

ORACLE["write_avoidance"] = "WITH " + KEPT + """,
b AS (SELECT count(*) AS n_snapshot_rows, count(DISTINCT request_timestamp) AS n_cycles,
             count(DISTINCT stationcode) AS n_keys FROM dedup),
h AS (SELECT count(*) AS n_history_rows FROM kept)
SELECT n_snapshot_rows, n_cycles, n_keys, n_history_rows,
       1.0 - CAST(n_history_rows AS DOUBLE) / CAST(n_cycles * n_keys AS DOUBLE) AS grid_ratio,
       1.0 - CAST(n_history_rows AS DOUBLE) / CAST(n_snapshot_rows AS DOUBLE) AS dense_ratio
FROM b, h"""

ORACLE["recent_rows"] = "WITH " + KEPT + """
SELECT stationcode, request_timestamp, numbikesavailable, kafka_timestamp FROM kept
ORDER BY request_timestamp DESC, stationcode ASC LIMIT 20"""

ORACLE["rows_per_cycle"] = "WITH " + AVAIL + """
SELECT request_timestamp, count(*) AS n_rows, count(DISTINCT stationcode) AS n_keys
FROM avail GROUP BY request_timestamp"""

_PAGES = DEDUP + """,
numbered AS (SELECT request_timestamp, stationcode, capacity, numbikesavailable,
                    ROW_NUMBER() OVER (PARTITION BY request_timestamp ORDER BY stationcode) - 1 AS rn
             FROM dedup),
pages0 AS (
  SELECT request_timestamp, CAST(rn // 4 AS INTEGER) AS page_no, count(*) AS n FROM numbered GROUP BY 1, 2
  UNION ALL
  SELECT request_timestamp, CAST(count(*) // 4 AS INTEGER) AS page_no, 0 AS n FROM numbered
  GROUP BY 1 HAVING count(*) % 4 = 0),
pages AS (SELECT * FROM pages0 WHERE NOT (hour(request_timestamp) = 7 AND page_no = 1))"""

ORACLE["snapshot_completeness"] = "WITH " + _PAGES + """,
g AS (SELECT request_timestamp, count(*) AS n_pages, CAST(sum(n) AS BIGINT) AS n_records,
             max(page_no) AS last_page, arg_max(n, page_no) AS last_n,
             sum(CASE WHEN n < 4 THEN 1 ELSE 0 END) AS n_short
      FROM pages GROUP BY request_timestamp)
SELECT request_timestamp, n_pages, n_records,
       (n_pages = last_page + 1 AND last_n < 4 AND n_short = 1) AS complete
FROM g"""

ORACLE["paged_records"] = "WITH " + _PAGES + """
SELECT n.request_timestamp, CAST(n.rn // 4 AS INTEGER) AS page_no, n.stationcode, n.capacity, n.numbikesavailable
FROM numbered n"""

ORACLE["path_routing"] = """
WITH names AS (
  SELECT event_id,
    CASE WHEN event_type = 'error' THEN 'avail/' || strftime(ts, '%Y/%m/%d') || '/epoch-' || event_id || '.txt'
         WHEN event_type = 'signup' AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 = 0
              THEN 'other/' || strftime(ts, '%Y/%m/%d') || '/epoch-' || event_id || '.json'
         WHEN event_type = 'purchase' AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 = 0
              THEN 'avail/' || strftime(ts, '%Y/%m') || '/epoch-' || event_id || '.json'
         WHEN event_type = 'view' AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 9 = 0
              THEN 'avail/a/b/c/epoch-' || event_id || '.json'
         ELSE 'avail/' || strftime(ts, '%Y/%m/%d') || '/epoch-' || event_id || '.json' END AS object_name
  FROM events),
r AS (
  SELECT object_name, string_split(object_name, '/') AS parts,
         starts_with(object_name, 'avail/') AND ends_with(object_name, '.json') AS in_scope
  FROM names),
d AS (
  SELECT object_name, in_scope, len(parts) = 5 AS five,
         TRY_CAST(parts[2] || '-' || parts[3] || '-' || parts[4] AS DATE) AS day FROM r)
SELECT object_name,
       CASE WHEN NOT in_scope THEN 'ignored' WHEN NOT five OR day IS NULL THEN 'quarantined' ELSE 'accepted' END AS route,
       CASE WHEN in_scope AND five AND day IS NOT NULL THEN day END AS batch_date
FROM d"""

_PARIS = "CAST(timezone('Europe/Paris', timezone('UTC', ts)) AS TIMESTAMP)"
_NIGHT = f"(isodow({_PARIS}) <= 5 AND hour({_PARIS}) >= 2 AND hour({_PARIS}) < 5)"

ORACLE["night_flag"] = f"""
SELECT event_id, ts, {_PARIS} AS local_ts, {_NIGHT} AS is_night FROM events"""

ORACLE["effective_interval"] = f"""
SELECT event_id, CASE WHEN {_NIGHT} THEN CAST(60 * 4.0 AS INTEGER) ELSE 60 END AS interval_seconds FROM events"""

ORACLE["cadence_thin"] = f"""
WITH x AS (
  SELECT user_id, ts, event_id, {_NIGHT} AS night,
         CASE WHEN {_NIGHT} THEN CAST(21600 * 4.0 AS INTEGER) ELSE 21600 END AS iv
  FROM events),
s AS (SELECT *, CAST(floor(epoch_us(ts) / (iv * 1000000.0)) AS BIGINT) AS slot FROM x)
SELECT user_id, night, slot, min(ts) AS ts, arg_min(event_id, ts) AS event_id
FROM s GROUP BY user_id, night, slot"""

# Row by row: each row is kept when the interval in force at the last kept row has passed.
ORACLE["cadence_gap"] = f"""
WITH RECURSIVE n AS (
  SELECT user_id, ts, event_id, {_NIGHT} AS night,
         CASE WHEN {_NIGHT} THEN CAST(21600 * 4.0 AS INTEGER) ELSE 21600 END AS iv,
         row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM events),
f AS (
  SELECT user_id, i, ts + to_seconds(iv) AS due, TRUE AS keep FROM n WHERE i = 1
  UNION ALL
  SELECT n.user_id, n.i, CASE WHEN n.ts >= f.due THEN n.ts + to_seconds(n.iv) ELSE f.due END, n.ts >= f.due
  FROM f JOIN n ON n.user_id = f.user_id AND n.i = f.i + 1)
SELECT n.user_id, n.ts, n.night, n.iv AS interval_seconds, n.event_id
FROM n JOIN f ON f.user_id = n.user_id AND f.i = n.i WHERE f.keep"""

_MNIGHT = _NIGHT.replace("ts", "minute")
ORACLE["expected_cycles"] = f"""
WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
m AS (SELECT day, unnest(range(CAST(day AS TIMESTAMP), CAST(day AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 MINUTE)) AS minute
      FROM days)
SELECT day, count(*) AS n_minutes, CAST(sum(CASE WHEN {_MNIGHT} THEN 1 ELSE 0 END) AS BIGINT) AS night_minutes,
       CAST(sum(CASE WHEN {_MNIGHT} THEN 0.25 ELSE 1.0 END) AS DOUBLE) AS expected_cycles
FROM m GROUP BY day"""

_CHECK_NIGHT = _NIGHT.replace("ts", "check_timestamp")

_PRODUCER = f"""
hb0 AS (SELECT event_type AS topic, CAST(date_trunc('hour', ts) AS TIMESTAMP) + INTERVAL 1 HOUR AS check_timestamp,
               max(ts) AS last_ts, count(*) AS n FROM events GROUP BY 1, 2),
hb AS (SELECT check_timestamp, topic, last_ts,
              sum(n) OVER (PARTITION BY topic ORDER BY check_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS high
       FROM hb0),
hb2 AS (SELECT *, (epoch_us(check_timestamp) - epoch_us(last_ts)) / 1e6 AS age, {_CHECK_NIGHT} AS night FROM hb),
hb3 AS (SELECT *, 600.0 * CASE WHEN night THEN 4.0 ELSE 1.0 END * 2 AS tol FROM hb2),
producer AS (
  SELECT check_timestamp, 'producer_' || topic AS component,
         CASE WHEN age <= tol THEN 'healthy' WHEN age <= tol * 3 THEN 'degraded' ELSE 'down' END AS status,
         CAST(NULL AS DOUBLE) AS latency_ms, round_even(age, 1) AS lag_seconds, CAST(NULL AS BIGINT) AS lag_messages,
         '{{"latest_offset":' || CAST(high AS BIGINT) || '}}' AS details, CAST(NULL AS VARCHAR) AS error_message,
         night AS night_mode_active
  FROM hb3)"""

ORACLE["freshness_status"] = "WITH " + _PRODUCER + "\nSELECT * FROM producer"

_OFFSETS = """
so0 AS (SELECT CAST(user_id % 3 AS INTEGER) AS partition,
               CAST(date_trunc('hour', ts) AS TIMESTAMP) + INTERVAL 1 HOUR AS check_timestamp,
               max(ts) AS last_ts, count(*) AS n FROM events GROUP BY 1, 2),
so AS (SELECT check_timestamp, 'events' AS stream, partition,
              sum(n) OVER (PARTITION BY partition ORDER BY check_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS committed,
              sum(n) OVER (PARTITION BY partition ORDER BY check_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS high,
              LAG(last_ts) OVER (PARTITION BY partition ORDER BY check_timestamp) AS commit_time
       FROM so0)"""

ORACLE["partition_lag"] = "WITH " + _OFFSETS + """
SELECT check_timestamp, stream, partition, CAST(committed AS BIGINT) AS committed, CAST(high AS BIGINT) AS high,
       CAST(greatest(high - committed, 0) AS BIGINT) AS lag_messages FROM so"""

_STREAM = _OFFSETS + f""",
sg AS (SELECT check_timestamp, stream, max(commit_time) AS commit_time, sum(committed) AS committed,
              sum(high) AS high, sum(greatest(high - committed, 0)) AS lag_messages
       FROM so GROUP BY 1, 2),
sg2 AS (SELECT *, (epoch_us(check_timestamp) - epoch_us(commit_time)) / 1e6 AS age FROM sg),
stream AS (
  SELECT check_timestamp, 'pyspark_' || stream AS component,
         CASE WHEN commit_time IS NULL THEN 'down' WHEN age <= 3600.0 THEN 'healthy'
              WHEN age <= 3600.0 * 3 THEN 'degraded' ELSE 'down' END AS status,
         CAST(NULL AS DOUBLE) AS latency_ms, round_even(age, 1) AS lag_seconds,
         CASE WHEN commit_time IS NULL THEN NULL ELSE CAST(lag_messages AS BIGINT) END AS lag_messages,
         CASE WHEN commit_time IS NULL THEN '{{}}'
              ELSE '{{"committed_offset":' || CAST(committed AS BIGINT) || ',"kafka_high_watermark":' || CAST(high AS BIGINT) || '}}' END AS details,
         CASE WHEN commit_time IS NULL THEN 'stream has committed nothing so far' END AS error_message,
         {_CHECK_NIGHT} AS night_mode_active
  FROM sg2)"""

ORACLE["stream_lag"] = "WITH " + _STREAM + "\nSELECT * FROM stream"

_BROKER = f"""
bp AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) + INTERVAL 1 HOUR AS check_timestamp,
              count(*) AS n, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS n_err,
              max(value) AS latency_ms, count(DISTINCT event_type) AS topic_count
       FROM events GROUP BY 1),
kafka AS (
  SELECT check_timestamp, 'kafka' AS component,
         CASE WHEN n_err <= 3 THEN 'healthy' ELSE 'down' END AS status,
         CASE WHEN n_err <= 3 THEN latency_ms END AS latency_ms,
         CAST(NULL AS DOUBLE) AS lag_seconds, CAST(NULL AS BIGINT) AS lag_messages,
         CASE WHEN n_err <= 3 THEN '{{"broker_count":1,"topic_count":' || topic_count || ',"controller_id":' || (n % 4 - 1) || '}}'
              ELSE '{{}}' END AS details,
         CASE WHEN n_err > 3 THEN 'broker not reachable' END AS error_message,
         {_CHECK_NIGHT} AS night_mode_active,
         CASE WHEN n_err <= 3 THEN n % 4 - 1 END AS controller_id
  FROM bp),
kraft AS (
  SELECT check_timestamp, 'kraft_controller' AS component,
         CASE WHEN status = 'healthy' AND coalesce(controller_id, -1) < 0 THEN 'down' ELSE status END AS status,
         latency_ms, lag_seconds, lag_messages, details,
         CASE WHEN status = 'healthy' AND coalesce(controller_id, -1) < 0
              THEN 'cluster reports no controller id' ELSE error_message END AS error_message,
         night_mode_active
  FROM kafka),
brokers AS (SELECT * EXCLUDE (controller_id) FROM kafka UNION ALL SELECT * FROM kraft)"""

ORACLE["controller_status"] = "WITH " + _BROKER + "\nSELECT * FROM brokers"

_HEALTH = _BROKER + "," + _STREAM + "," + _PRODUCER + """,
health AS (SELECT * FROM brokers UNION ALL SELECT * FROM stream UNION ALL SELECT * FROM producer)"""

ORACLE["status_board"] = "WITH " + _HEALTH + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY component ORDER BY check_timestamp DESC) AS rn FROM health) WHERE rn = 1
ORDER BY component"""

ORACLE["incidents_24h"] = "WITH " + _HEALTH + """
SELECT check_timestamp, component, status, error_message FROM health
WHERE status != 'healthy' AND check_timestamp >= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 24 HOUR
  AND check_timestamp <= TIMESTAMP '2024-01-15 12:00:00'
ORDER BY check_timestamp DESC, component"""

ORACLE["retention_candidates"] = """
SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS n_rows,
       CAST(o_orderdate AS DATE) < DATE '1998-08-02' - INTERVAL 365 DAY AS expired
FROM orders GROUP BY 1"""


def _dedup_lag(src: str, key: str, cycle: str, order: str, cmp: list[str], cols: str) -> str:
    lags = ", ".join(f"LAG({c}) OVER (PARTITION BY {key} ORDER BY {cycle}) AS p_{c}" for c in cmp)
    diff = " OR ".join(f"{c} IS DISTINCT FROM p_{c}" for c in cmp)
    return f"""
WITH d AS (SELECT * EXCLUDE (rn) FROM (
  SELECT {cols}, ROW_NUMBER() OVER (PARTITION BY {key}, {cycle} ORDER BY {order}) AS rn FROM {src}) WHERE rn = 1),
l AS (SELECT *, {lags}, LAG({cycle}) OVER (PARTITION BY {key} ORDER BY {cycle}) AS p_cycle FROM d)
SELECT {cols} FROM l WHERE {key} IS NULL OR p_cycle IS NULL OR {diff}"""


ORACLE["orders_change_history"] = _dedup_lag(
    "orders", "o_custkey", "o_orderdate", "o_orderkey", ["o_orderstatus", "o_orderpriority"],
    "o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_orderpriority, o_totalprice")

_LI_ORDER = ("l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
             "l_returnflag, l_linestatus")
ORACLE["lineitem_change_history"] = _dedup_lag(
    "lineitem", "l_partkey", "l_shipdate", _LI_ORDER, ["l_returnflag", "l_linestatus"],
    "l_partkey, l_shipdate, " + _LI_ORDER)

ORACLE["decode_malformed"] = "WITH " + AVAIL + """,
m AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS k5 FROM avail)
SELECT event_id, kafka_timestamp,
       CASE WHEN event_type != 'error' THEN request_timestamp END AS request_timestamp,
       CASE WHEN event_type != 'error' THEN dataset_id WHEN k5 = 3 THEN 'ds' END AS dataset_id,
       CASE WHEN event_type != 'error' THEN stationcode WHEN k5 = 3 THEN '12' END AS stationcode,
       CASE WHEN event_type != 'error' THEN capacity END AS capacity,
       CASE WHEN event_type != 'error' THEN numbikesavailable END AS numbikesavailable,
       CASE WHEN event_type != 'error' THEN ebike END AS ebike,
       CASE WHEN event_type != 'error' THEN is_renting END AS is_renting,
       event_type = 'error' AND k5 != 3 AS malformed
FROM m"""

# C2 with the 7-day look-back, row by row: a row is kept when its key's last kept row is absent,
# more than 7 days older, or has other values.
_VALS = "row(" + ", ".join(CMP) + ")"
ORACLE["stream_silver"] = "WITH RECURSIVE " + DEDUP + f""",
n AS (SELECT stationcode, request_timestamp, {_VALS} AS v,
             ROW_NUMBER() OVER (PARTITION BY stationcode ORDER BY request_timestamp) AS i FROM dedup),
f AS (
  SELECT stationcode, request_timestamp, i, v AS kept_v, request_timestamp AS kept_at, TRUE AS keep FROM n WHERE i = 1
  UNION ALL
  SELECT n.stationcode, n.request_timestamp, n.i,
         CASE WHEN n.v IS DISTINCT FROM f.kept_v OR f.kept_at < n.request_timestamp - INTERVAL 7 DAY THEN n.v ELSE f.kept_v END,
         CASE WHEN n.v IS DISTINCT FROM f.kept_v OR f.kept_at < n.request_timestamp - INTERVAL 7 DAY
              THEN n.request_timestamp ELSE f.kept_at END,
         n.v IS DISTINCT FROM f.kept_v OR f.kept_at < n.request_timestamp - INTERVAL 7 DAY
  FROM f JOIN n ON n.stationcode = f.stationcode AND n.i = f.i + 1)
SELECT {', '.join('d.' + c for c in SILVER_COLS.split(', '))}
FROM dedup d JOIN f ON d.stationcode = f.stationcode AND d.request_timestamp = f.request_timestamp WHERE f.keep"""

# Rows that arrive in any order leave the history of the feed in order.
ORACLE["late_rows"] = ORACLE["stream_silver"]
ORACLE["silver_snapshots"] = ORACLE["stream_silver"]

# The first batch meets an empty history, so all its rows are stored; every row of the day, and
# then of the rest, is compared with the newest stored row of the 7 days before its batch's first cycle.
_OWN = ", ".join("b." + c for c in SILVER_COLS.split(", "))
ORACLE["silver_faithful"] = "WITH " + DEDUP + f""",
s0 AS (SELECT {SILVER_COLS} FROM dedup WHERE request_timestamp < {BATCH}),
day AS (SELECT * FROM dedup WHERE request_date = DATE '2024-01-20'),
rest AS (SELECT * FROM dedup WHERE request_date > DATE '2024-01-20'),
last0 AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY stationcode ORDER BY request_timestamp DESC) AS rn FROM s0
  WHERE request_timestamp >= (SELECT min(request_timestamp) FROM day) - INTERVAL 7 DAY) WHERE rn = 1),
s1 AS (SELECT * FROM s0 UNION ALL
       SELECT {_OWN} FROM day b LEFT JOIN last0 l ON b.stationcode = l.stationcode
       WHERE l.stationcode IS NULL OR {_differs('b', 'l')}),
last1 AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY stationcode ORDER BY request_timestamp DESC) AS rn FROM s1
  WHERE request_timestamp >= (SELECT min(request_timestamp) FROM rest) - INTERVAL 7 DAY) WHERE rn = 1)
SELECT * FROM s1 UNION ALL
SELECT {_OWN} FROM rest b LEFT JOIN last1 l ON b.stationcode = l.stationcode
WHERE l.stationcode IS NULL OR {_differs('b', 'l')}"""

# Loads of ten days: the good rows of all of them are filtered row by row with the look-back; damaged
# ones have neither key nor cycle, and a load that keeps them stores the earliest copy of them.
ORACLE["silver_malformed"] = "WITH RECURSIVE " + DEDUP.replace("FROM avail", "FROM avail WHERE event_type != 'error'") + f""",
n AS (SELECT stationcode, request_timestamp, {_VALS} AS v,
             ROW_NUMBER() OVER (PARTITION BY stationcode ORDER BY request_timestamp) AS i FROM dedup),
f AS (
  SELECT stationcode, request_timestamp, i, v AS kept_v, request_timestamp AS kept_at, TRUE AS keep FROM n WHERE i = 1
  UNION ALL
  SELECT n.stationcode, n.request_timestamp, n.i, n.v,
         CASE WHEN n.v IS DISTINCT FROM f.kept_v OR f.kept_at < n.request_timestamp - INTERVAL 7 DAY
              THEN n.request_timestamp ELSE f.kept_at END,
         n.v IS DISTINCT FROM f.kept_v OR f.kept_at < n.request_timestamp - INTERVAL 7 DAY
  FROM f JOIN n ON n.stationcode = f.stationcode AND n.i = f.i + 1),
bad AS (SELECT ts, CAST(floor(date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) / 10) AS INTEGER) AS part
        FROM events WHERE event_type = 'error')
SELECT d.stationcode, d.request_timestamp, d.kafka_timestamp, d.request_date, 'stored' AS place
FROM dedup d JOIN f ON d.stationcode = f.stationcode AND d.request_timestamp = f.request_timestamp WHERE f.keep
UNION ALL
SELECT NULL, NULL, min(ts), NULL, 'stored' FROM bad WHERE part % 3 = 0 GROUP BY part
UNION ALL
SELECT NULL, NULL, ts, NULL, 'quarantine' FROM bad WHERE part % 3 = 1"""

# A batch a day: batches and log offsets count the feed's days; every batch commits one file.
ORACLE["checkpoint_offsets"] = """
SELECT CAST(range AS BIGINT) AS batch_id, 0 AS source_index, CAST(range AS BIGINT) AS log_offset
FROM range((SELECT count(DISTINCT CAST(ts AS DATE)) FROM events))"""
ORACLE["sink_manifest"] = """
SELECT count(DISTINCT CAST(ts AS DATE)) AS n_files, count(*) AS n_rows FROM events"""

# Without a look-back the stream's final table equals the sequential change filter.
ORACLE["stream_resume"] = ORACLE["change_filter_asof"]
ORACLE["stream_stateful"] = ORACLE["change_filter_asof"]
ORACLE["distinct_by_range"] = "WITH " + DEDUP + """
SELECT e.end_date, COUNT(DISTINCT d.request_timestamp) AS n_cycles, COUNT(DISTINCT d.stationcode) AS n_keys,
       COUNT(*) AS n_rows
FROM (SELECT DISTINCT request_date AS end_date FROM dedup WHERE request_date IS NOT NULL) e
JOIN dedup d ON d.request_date BETWEEN e.end_date - 6 AND e.end_date
GROUP BY e.end_date"""
ORACLE["run_metrics"] = f"""
SELECT (WITH {TYPED} SELECT COUNT(*) FROM typed) AS rows_in,
       (SELECT COUNT(*) FROM ({ORACLE["change_filter_asof"]})) AS inserted,
       CAST(0 AS BIGINT) AS batches_that_differ"""

ORACLE["topic_watermarks"] = """
SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS partition, min(event_id) AS low,
       max(event_id) + 1 AS high, max(ts) AS last_ts
FROM events GROUP BY 1, 2"""

ORACLE["raw_landing"] = "WITH " + AVAIL + """
SELECT request_timestamp, kafka_timestamp, dataset_id, stationcode, name, is_installed, capacity,
       numdocksavailable, numbikesavailable, mechanical, ebike, is_renting, is_returning, duedate,
       lat, lon, nom_arrondissement_communes, code_insee_commune, station_opening_hours,
       TIMESTAMP '2024-02-01 00:00:00' AS insert_timestamp
FROM avail"""

ORACLE["hot_key_change_history"] = _dedup_lag(
    "(SELECT CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END AS station, ts, event_id, event_type, value FROM events)",
    "station", "ts", "event_id", ["event_type"], "station, ts, event_id, event_type, value")

# Rebuilding every feed row from the change history gives back the feed (lossless).
ORACLE["history_reconstruction"] = "WITH " + DEDUP + f"\nSELECT stationcode, request_timestamp, {CMP_COLS} FROM dedup"

# Compaction keeps every row once; retention drops dates before 2024-01-30 - 20 days.
ORACLE["history_maintenance"] = "WITH " + KEPT + f"""
SELECT {SILVER_COLS}, 'compact' AS batch_id FROM kept
WHERE request_date >= DATE '2024-01-10'"""

# No checkpoint: every expected stream is down. A topic without a message is down too.
_AT = "TIMESTAMP '2024-01-15 12:00:00'"
ORACLE["health_outage"] = f"""
WITH topics AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view', 'never-written']) AS topic),
m AS (SELECT event_type AS topic, max(ts) AS last_ts, max(event_id) + 1 AS high FROM events
      WHERE ts <= {_AT} GROUP BY 1),
j AS (SELECT t.topic, {_AT} AS check_timestamp, m.last_ts, m.high,
             (epoch_us({_AT}) - epoch_us(m.last_ts)) / 1e6 AS age FROM topics t LEFT JOIN m USING (topic)),
k AS (SELECT *, {_CHECK_NIGHT} AS night FROM j),
p AS (SELECT *, 600.0 * CASE WHEN night THEN 4.0 ELSE 1.0 END * 2 AS tol FROM k)
SELECT check_timestamp, 'pyspark_' || topic AS component, 'down' AS status, CAST(NULL AS DOUBLE) AS latency_ms,
       CAST(NULL AS DOUBLE) AS lag_seconds, CAST(NULL AS BIGINT) AS lag_messages, '{{}}' AS details,
       'stream has committed nothing so far' AS error_message, night AS night_mode_active FROM k
UNION ALL
SELECT check_timestamp, 'producer_' || topic,
       CASE WHEN last_ts IS NULL THEN 'down' WHEN age <= tol THEN 'healthy' WHEN age <= tol * 3 THEN 'degraded'
            ELSE 'down' END,
       CAST(NULL AS DOUBLE), round_even(age, 1), CAST(NULL AS BIGINT),
       CASE WHEN last_ts IS NULL THEN '{{}}' ELSE '{{"latest_offset":' || CAST(high AS BIGINT) || '}}' END,
       CASE WHEN last_ts IS NULL THEN 'topic is silent: nothing to read' END, night
FROM p"""

ORACLE["broker_summary"] = """
SELECT count(DISTINCT topic) AS topic_count, count(*) AS partition_count
FROM (SELECT DISTINCT event_type AS topic, user_id % 3 AS partition FROM events)"""
