"""SQL for DuckDB that computes what each registered query computes, written independently of it."""

from __future__ import annotations

EVENTS = """
sensor_events AS (
  SELECT event_id,
         'city_' || (user_id % 12) AS city_id,
         ts AS poll_timestamp,
         CAST(epoch_us(ts) // 600000000 * 600 AS BIGINT) AS dt,
         CASE WHEN event_type <> 'error' THEN value END AS temp,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 + 1 AS INTEGER) AS aqi,
         value / 10 AS pm2_5,
         value / 5 AS pm10,
         CAST(ts AS DATE) AS ingestion_date,
         ts + to_minutes(CAST(json_extract_string(props, '$.k') AS INTEGER) % 10) AS arrival_ts,
         event_type
  FROM events)
"""


def mean(column: str) -> str:
    return f"round(avg({column}), 10)"


DAILY = f"""
  {mean('temp')} AS avg_temp, min(temp) AS min_temp, max(temp) AS max_temp,
  {mean('humidity')} AS avg_humidity, {mean('aqi')} AS avg_aqi, max(aqi) AS max_aqi,
  {mean('pm2_5')} AS avg_pm2_5, {mean('pm10')} AS avg_pm10,
  CAST(count(*) AS INTEGER) AS observation_count
"""

ROLLING = f"""
  {mean('temp')} AS avg_temp, min(temp) AS min_temp, max(temp) AS max_temp,
  {mean('humidity')} AS avg_humidity, {mean('aqi')} AS avg_aqi,
  {mean('pm2_5')} AS avg_pm2_5, {mean('pm10')} AS avg_pm10,
  count(*) AS observation_count
"""

GOLD_DAY = f"""
WITH {EVENTS},
today AS (SELECT city_id, {DAILY} FROM sensor_events WHERE ingestion_date = DATE '2024-01-15' GROUP BY city_id),
week AS (SELECT city_id, {mean('temp')} AS rolling_7day_avg_temp FROM sensor_events
         WHERE ingestion_date BETWEEN DATE '2024-01-09' AND DATE '2024-01-15' GROUP BY city_id)
SELECT today.*, DATE '2024-01-15' AS date, rolling_7day_avg_temp FROM today LEFT JOIN week USING (city_id)
"""

ROLLING_7DAY = f"""
per_day AS (SELECT city_id, ingestion_date AS date, sum(temp) AS s, count(temp) AS n
            FROM sensor_events GROUP BY ALL),
weekly AS (SELECT a.city_id, a.date, round(sum(b.s) / nullif(sum(b.n), 0), 10) AS rolling_7day_avg_temp
             FROM per_day a JOIN per_day b ON a.city_id = b.city_id AND b.date BETWEEN a.date - 6 AND a.date
             GROUP BY a.city_id, a.date)
"""


def hopping(time: str, source: str = "sensor_events") -> str:
    """Window ends reached by an event: the five multiples of two minutes after it."""
    return f"""
SELECT city_id, {ROLLING},
       make_timestamp((epoch_us({time}) // 120000000 + 1 + hop) * 120000000) AS window_end_time
FROM {source}, range(0, 5) AS hops(hop)
GROUP BY city_id, make_timestamp((epoch_us({time}) // 120000000 + 1 + hop) * 120000000)
"""


SLIDING = """
anchors AS (SELECT city_id, poll_timestamp AS instant FROM sensor_events
            UNION SELECT city_id, poll_timestamp + INTERVAL 15 MINUTE FROM sensor_events),
swept AS (SELECT a.city_id, a.instant, max(temp) AS hi, min(temp) AS lo, max(aqi) AS worst, max(pm2_5) AS dust
          FROM anchors a JOIN sensor_events e
            ON a.city_id = e.city_id AND e.poll_timestamp <= a.instant AND e.poll_timestamp > a.instant - INTERVAL 15 MINUTE
          GROUP BY a.city_id, a.instant
          HAVING max(temp) - min(temp) > 8 OR max(aqi) >= 5),
alerts AS (SELECT city_id || '-' || (epoch_us(instant) // 1000000) AS id, city_id,
                  hi AS window_max_temp, lo AS window_min_temp, hi - lo AS temp_swing,
                  worst AS window_max_aqi, dust AS window_max_pm2_5,
                  coalesce(hi - lo > 8, false) AS temperature_swing_triggered,
                  coalesce(worst >= 5, false) AS aqi_threshold_triggered,
                  instant AS detected_at
           FROM swept)
"""

LATE = """
late AS (SELECT *, greatest(poll_timestamp, arrival_ts - INTERVAL 5 MINUTE) AS late_ts FROM sensor_events)
"""


def out_of_order(time: str, source: str) -> str:
    return f"""
SELECT *, greatest({time}, max({time}) OVER (PARTITION BY city_id ORDER BY arrival_ts, {time}
                                             ROWS UNBOUNDED PRECEDING) - INTERVAL 30 SECOND) AS adjusted_timestamp
FROM {source}"""


RESPONSES = f"""
{EVENTS},
calls(event_type, endpoint, attempt, status) AS (VALUES
  ('click', 'weather', 1, 200), ('click', 'air_pollution', 1, 200),
  ('view', 'weather', 1, 429), ('view', 'weather', 2, 200),
  ('view', 'air_pollution', 1, 503), ('view', 'air_pollution', 2, 500), ('view', 'air_pollution', 3, 200),
  ('purchase', 'weather', 1, 200),
  ('purchase', 'air_pollution', 1, 500), ('purchase', 'air_pollution', 2, 502), ('purchase', 'air_pollution', 3, 504),
  ('purchase', 'air_pollution', 4, 200),
  ('signup', 'weather', 1, NULL), ('signup', 'weather', 2, NULL), ('signup', 'weather', 3, NULL),
  ('signup', 'air_pollution', 1, 500), ('signup', 'air_pollution', 2, 502), ('signup', 'air_pollution', 3, 504),
  ('error', 'weather', 1, 401)),
polls AS (SELECT event_id // 100 AS cycle_id, 'city_' || (event_id % 100) AS city_id, event_type,
                 poll_timestamp AS responded_at, temp, humidity, aqi, pm2_5
          FROM sensor_events),
responses AS (SELECT * FROM polls JOIN calls USING (event_type))
"""

BROKER = """
broker AS (
  SELECT ts AS "TimeGenerated",
         CASE event_type WHEN 'signup' THEN 'OTHER' ELSE 'MICROSOFT.EVENTHUB' END AS provider,
         CASE WHEN event_type IN ('view', 'click') THEN 'ConsumerLag' ELSE event_type END AS activity,
         CASE user_id % 3 WHEN 0 THEN '$Default' WHEN 1 THEN 'stream-analytics-local-emulation' ELSE 'other' END
           AS "ConsumerGroup",
         'hub_' || (user_id % 5) AS "EventHubName", CAST(user_id % 4 AS VARCHAR) AS "PartitionId",
         value * 10 AS "LagCount"
  FROM events),
lag AS (SELECT "TimeGenerated", "ConsumerGroup", "EventHubName", "PartitionId", "LagCount" FROM broker
        WHERE provider = 'MICROSOFT.EVENTHUB' AND activity = 'ConsumerLag' AND "ConsumerGroup" <> 'other')
"""

METRICS = f"""
used AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS "TimeGenerated",
                {mean('value')} AS "AvgUtilization",
                max(CASE WHEN user_id % 2 = 0 THEN 0.0 ELSE value END) AS "MaxUtilization"
         FROM events WHERE event_type IN ('view', 'click') GROUP BY 1),
waiting AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS "TimeGenerated",
                   max(CASE WHEN user_id % 2 = 0 THEN 0.0 ELSE value END) AS "MaxBacklog"
            FROM events WHERE event_type = 'error' GROUP BY 1
            HAVING max(CASE WHEN user_id % 2 = 0 THEN 0.0 ELSE value END) > 0)
"""

STAGES = """
activities AS (
  SELECT l_orderkey AS run, l_linenumber, l_partkey, l_returnflag,
         CASE l_linenumber % 4 WHEN 0 THEN 'bronze_ingest' WHEN 1 THEN 'silver_clean_dedup'
                               WHEN 2 THEN 'gold_aggregate_zorder' ELSE 'other' END AS name
  FROM lineitem WHERE l_returnflag IN ('A', 'R'))
"""

UPSERTED = """
upserted AS (SELECT * FROM alerts QUALIFY row_number() OVER (PARTITION BY id ORDER BY detected_at DESC) = 1)
"""

OBSERVED = "make_timestamp(dt * 1000000) AS observation_timestamp"

ORACLES: dict[str, str] = {
    "gold_daily": GOLD_DAY,
    "gold_daily_one_scan": GOLD_DAY,
    "gold_backfill": f"""
WITH {EVENTS}, {ROLLING_7DAY},
stats AS (SELECT city_id, ingestion_date AS date, {DAILY} FROM sensor_events GROUP BY ALL)
SELECT stats.*, rolling_7day_avg_temp FROM stats JOIN weekly USING (city_id, date)""",
    "rolling_7day_all": f"WITH {EVENTS}, {ROLLING_7DAY} SELECT * FROM weekly",
    "daily_stats_lineitem": f"""
SELECT l_suppkey AS sensor, CAST(l_shipdate AS DATE) AS date,
       {mean('l_quantity')} AS avg_quantity, min(l_quantity) AS min_quantity, max(l_quantity) AS max_quantity,
       {mean('l_extendedprice')} AS avg_price, max(l_extendedprice) AS max_price, count(*) AS observation_count
FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    "hopping_avg": f"WITH {EVENTS} {hopping('poll_timestamp')}",
    "hopping_avg_right_closed": f"WITH {EVENTS} {hopping('(poll_timestamp - INTERVAL 1 MICROSECOND)')}",
    "tumbling_avg": f"""
WITH {EVENTS}
SELECT city_id, {ROLLING}, time_bucket(INTERVAL 10 MINUTE, poll_timestamp) + INTERVAL 10 MINUTE AS window_end_time
FROM sensor_events GROUP BY city_id, time_bucket(INTERVAL 10 MINUTE, poll_timestamp)""",
    "sliding_anomalies": f"WITH {EVENTS}, {SLIDING} SELECT * FROM alerts",
    "alerts_upserted": f"""
WITH {EVENTS}, {SLIDING}
SELECT * FROM alerts QUALIFY row_number() OVER (PARTITION BY id ORDER BY detected_at DESC) = 1""",
    "late_adjusted": f"""
WITH {EVENTS}, {LATE}
SELECT event_id, city_id, poll_timestamp, arrival_ts, late_ts AS adjusted_timestamp FROM late""",
    "ooo_adjusted": f"""
WITH {EVENTS}
SELECT event_id, city_id, poll_timestamp, arrival_ts, adjusted_timestamp
FROM ({out_of_order('poll_timestamp', 'sensor_events')})""",
    "event_time_policy": f"""
WITH {EVENTS}, {LATE}, ordered AS ({out_of_order('late_ts', 'late')})
{hopping('adjusted_timestamp', 'ordered')}""",
    "silver_clean": f"""
WITH {EVENTS}
SELECT event_id, city_id, {OBSERVED}, temp, aqi, ingestion_date FROM sensor_events
WHERE city_id IS NOT NULL AND dt IS NOT NULL AND temp IS NOT NULL AND aqi IS NOT NULL""",
    "silver_quarantine": f"""
WITH {EVENTS}
SELECT event_id, city_id, {OBSERVED}, aqi, ingestion_date, 'missing temp' AS reason FROM sensor_events
WHERE temp IS NULL""",
    "silver_dedup": f"""
WITH {EVENTS}
SELECT city_id, {OBSERVED}, ingestion_date, temp, humidity, aqi, pm2_5, pm10 FROM sensor_events
WHERE temp IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY city_id, dt ORDER BY poll_timestamp, event_id) = 1""",
    "quality_counters": f"""
WITH {EVENTS}, counted AS (
  SELECT ingestion_date, count(*) AS rows_in, count(*) FILTER (temp IS NULL) AS quarantined,
         count(*) FILTER (temp IS NOT NULL) AS good,
         count(DISTINCT (city_id, dt)) FILTER (temp IS NOT NULL) AS after_dedup
  FROM sensor_events GROUP BY ingestion_date)
SELECT *, good - after_dedup AS duplicates_removed, round(100.0 * quarantined / rows_in, 1) AS quarantined_pct
FROM counted""",
    "critical_field_warnings": f"""
WITH {EVENTS}
SELECT city_id, ingestion_date, count(*) AS events, count(*) FILTER (temp IS NULL) AS missing_temp,
       count(*) FILTER (aqi IS NULL) AS missing_aqi
FROM sensor_events GROUP BY ALL HAVING count(*) FILTER (temp IS NULL OR aqi IS NULL) > 0""",
    "payload_flatten": f"""
WITH {EVENTS}
SELECT 'city_' || event_id AS city_id, poll_timestamp, 'azure-function-timer' AS source, '1.0' AS schema_version,
       ingestion_date, dt, temp, humidity, CAST(NULL AS INTEGER) AS visibility,
       CASE WHEN humidity % 5 <> 0 THEN event_type END AS weather_main,
       CASE WHEN humidity % 5 <> 0 THEN upper(event_type) END AS weather_description,
       CASE WHEN humidity % 10 <> 9 THEN aqi END AS aqi, CASE WHEN humidity % 10 <> 9 THEN pm2_5 END AS pm2_5,
       CASE WHEN humidity % 10 <> 9 THEN pm10 END AS pm10, CAST(NULL AS DOUBLE) AS no2
FROM sensor_events WHERE event_id % 100 <> 99""",
    "coord_fallback": f"""
WITH {EVENTS}
SELECT 'city_' || (event_id % 25) AS city_id, poll_timestamp,
       CASE humidity % 4 WHEN 0 THEN event_id % 90 + 0.5::DOUBLE WHEN 3 THEN NULL ELSE n_nationkey + 0.5::DOUBLE END AS lat,
       CASE WHEN humidity % 4 IN (0, 3) THEN event_id % 180 + 0.25::DOUBLE ELSE n_regionkey + 0.25::DOUBLE END AS lon
FROM sensor_events JOIN nation ON n_nationkey = event_id % 25
WHERE event_id % 100 <> 99""",
    "corrupt_isolated": f"""
WITH {EVENTS}
SELECT 'city_' || event_id AS city_id, poll_timestamp, 'unreadable payload: weather' AS reason,
       '{{"coord":{{"lat":1.0' AS weather_text
FROM sensor_events WHERE event_id % 100 = 99""",
    "payload_pairing": f"""
WITH {EVENTS}
SELECT 'city_' || (event_id % 100) AS city_id, poll_timestamp, temp, humidity,
       CASE WHEN humidity % 10 <> 9 THEN aqi END AS aqi, CASE WHEN humidity % 10 <> 9 THEN pm2_5 END AS pm2_5
FROM sensor_events WHERE event_type IN ('click', 'view', 'purchase')""",
    "city_lookup": f"""
WITH {EVENTS}
SELECT event_id, city_id, n_name AS city_name, n_nationkey + 0.5::DOUBLE AS city_lat,
       n_regionkey + 0.25::DOUBLE AS city_lon, temp
FROM sensor_events LEFT JOIN nation ON city_id = 'city_' || n_nationkey""",
    "response_outcomes": f"""
WITH {RESPONSES},
ended AS (SELECT cycle_id, city_id, endpoint, max(attempt) AS attempts, arg_max_null(status, attempt) AS last_status
          FROM responses GROUP BY ALL)
SELECT *, CASE WHEN last_status = 200 THEN 'ok' WHEN last_status IS NULL THEN 'network_error'
               WHEN last_status = 401 THEN 'unauthorized' ELSE 'retries_exhausted' END AS outcome
FROM ended""",
    "failure_details": f"""
WITH {RESPONSES}
SELECT cycle_id, city_id, endpoint, status, left('{{"cod":401,"message":"' || repeat('no ', 90) || '"}}', 200) AS error_text,
       '{{"cod":401,"message":"' || repeat('no ', 90) || '"}}' AS body, true AS concerns_all_cities
FROM responses WHERE status = 401""",
    "poll_summary": f"""
WITH {RESPONSES},
per_city AS (SELECT cycle_id, city_id, event_type IN ('click', 'view', 'purchase') AS succeeded, count(*) AS calls
             FROM responses GROUP BY ALL)
SELECT cycle_id, count(*) AS cities, count(*) FILTER (succeeded) AS cities_succeeded,
       count(*) FILTER (NOT succeeded) AS cities_failed, CAST(sum(calls) AS BIGINT) AS calls
FROM per_city GROUP BY cycle_id""",
    "failed_cities": f"""
WITH {RESPONSES} SELECT cycle_id, city_id FROM polls WHERE event_type NOT IN ('click', 'view', 'purchase')""",
    "rate_budget": f"""
WITH {RESPONSES}
SELECT count(*) AS calls, time_bucket(INTERVAL 1 MINUTE, responded_at) + INTERVAL 1 MINUTE AS minute_end,
       count(*) > 5 AS over_budget
FROM responses GROUP BY time_bucket(INTERVAL 1 MINUTE, responded_at)""",
    "schema_drift": f"""
WITH {EVENTS}, counted AS (
  SELECT event_type, count(*) AS n, count(*) FILTER (WHERE humidity % 10 <> 9) AS filled,
         count(*) FILTER (WHERE humidity % 10 = 5) AS fifth
  FROM sensor_events GROUP BY ALL)
SELECT 'weather.uvi' || below AS path, n AS payloads FROM counted, (VALUES (''), ('.now')) v(below) WHERE event_type = 'view'
UNION ALL
SELECT 'weather.deep' || below, n FROM counted,
       (VALUES (''), ('.a'), ('.a.b'), ('.a.b.c'), ('.a.b.c.d'), ('.a.b.c.d.e'), ('.a.b.c.d.e.f')) v(below)
WHERE event_type = 'purchase'
UNION ALL SELECT 'air_pollution.coord', CAST(sum(filled) AS BIGINT) FROM counted
UNION ALL SELECT 'air_pollution.list.late' || below, filled FROM counted, (VALUES (''), ('.by')) v(below) WHERE event_type = 'click'
UNION ALL SELECT 'air_pollution.list.odd', fifth FROM counted WHERE event_type = 'error'""",
    "schema_conformance": f"""
WITH {EVENTS},
said AS (SELECT ingestion_date, event_type, humidity, event_id % 100 = 99 AS cut,
                event_type = 'click' AND humidity % 10 = 5 AS listed FROM sensor_events),
rows_of AS (
  SELECT ingestion_date, '(unreadable)' AS field, 'unreadable' AS difference, NULL AS expected, NULL AS found FROM said WHERE cut
  UNION ALL
  SELECT ingestion_date, name, 'missing', kind, NULL
  FROM said, (VALUES ('main.feels_like', 'number'), ('main.temp_min', 'number'), ('main.temp_max', 'number'),
                     ('main.pressure', 'number'), ('wind', 'object'), ('clouds', 'object')) v(name, kind) WHERE NOT cut
  UNION ALL SELECT ingestion_date, 'visibility', 'missing', 'number', NULL FROM said WHERE NOT cut AND NOT listed
  UNION ALL SELECT ingestion_date, 'coord', 'missing', 'object', NULL FROM said WHERE NOT cut AND humidity % 4 = 1
  UNION ALL SELECT ingestion_date, 'uvi', 'extra', NULL, 'object' FROM said WHERE NOT cut AND event_type = 'view'
  UNION ALL SELECT ingestion_date, 'dt', 'type', 'number', 'string' FROM said WHERE NOT cut AND event_type = 'signup'
  UNION ALL SELECT ingestion_date, 'visibility', 'type', 'number', 'list' FROM said WHERE NOT cut AND listed)
SELECT *, count(*) AS payloads FROM rows_of GROUP BY ALL""",
    "trend_30d": f"""
WITH {EVENTS}, {ROLLING_7DAY},
stats AS (SELECT city_id, ingestion_date AS date, {DAILY} FROM sensor_events GROUP BY ALL)
SELECT city_id, date, avg_temp, avg_aqi, rolling_7day_avg_temp FROM stats JOIN weekly USING (city_id, date)
WHERE date >= DATE '2024-02-10' - 30 ORDER BY city_id, date""",
    "alerts_for_city": f"WITH {EVENTS}, {SLIDING}, {UPSERTED} SELECT * FROM upserted WHERE city_id = 'city_3'",
    "recent_alerts": f"""
WITH {EVENTS}, {SLIDING}, {UPSERTED}
SELECT * FROM upserted WHERE detected_at >= TIMESTAMP '2024-01-10' AND detected_at < TIMESTAMP '2024-01-20'
ORDER BY detected_at DESC, id""",
    "newest_alerts": f"""
WITH {EVENTS}, {SLIDING}, {UPSERTED}
SELECT * FROM upserted WHERE detected_at >= TIMESTAMP '2024-01-10' ORDER BY detected_at DESC, id LIMIT 25""",
    "current_tiles": f"""
WITH {EVENTS}
SELECT city_id, poll_timestamp, temp, aqi FROM sensor_events
QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY poll_timestamp DESC, event_id) = 1""",
    "sparkline": f"""
WITH {EVENTS}, rolling AS ({hopping('poll_timestamp')})
SELECT city_id, CAST(window_end_time AS DATE) AS date,
       CAST(row_number() OVER (PARTITION BY city_id, CAST(window_end_time AS DATE) ORDER BY window_end_time) - 1
            AS INTEGER) AS position,
       window_end_time, avg_temp
FROM rolling""",
    "lag_listing": f'WITH {BROKER} SELECT * FROM lag ORDER BY "TimeGenerated" DESC, "PartitionId"',
    "lag_alert": f"""
WITH {BROKER}
SELECT "EventHubName", "PartitionId", max("LagCount") AS "MaxLag" FROM lag GROUP BY ALL HAVING max("LagCount") > 1000""",
    "log_presence": f"""
WITH {BROKER}
SELECT count(*) AS log_rows,
       count(*) FILTER (provider = 'MICROSOFT.EVENTHUB' AND activity = 'ConsumerLag') AS matching_rows FROM broker""",
    "util_bins": f"WITH {METRICS} SELECT * FROM used",
    "util_alert": f'WITH {METRICS} SELECT * FROM used WHERE "AvgUtilization" > 80',
    "backlog_bins": f"WITH {METRICS} SELECT * FROM waiting",
    "util_backlog_union": f"""
WITH {METRICS}
SELECT "TimeGenerated", "AvgUtilization", "MaxUtilization", NULL::DOUBLE AS "MaxBacklog", 'ResourceUtilization' AS metric
FROM used
UNION ALL SELECT "TimeGenerated", NULL, NULL, "MaxBacklog", 'BacklogedInputEvents' FROM waiting""",
    "failed_runs": f"""
WITH {STAGES}
SELECT o_orderdate AS "PipelineTimeGenerated", CAST(o_orderkey AS VARCHAR) AS "RunId", name AS "FailedActivityName",
       CAST(l_linenumber AS VARCHAR) AS "ErrorCode", 'part ' || l_partkey AS "ErrorMessage",
       o_orderdate AS "PipelineStart", o_orderdate + INTERVAL 1 HOUR AS "PipelineEnd", o_orderpriority AS "Parameters"
FROM orders JOIN activities ON o_orderkey = run
WHERE o_custkey % 2 = 0 AND o_orderstatus = 'F' AND name <> 'other'""",
    "failures_by_stage": f"""
WITH {STAGES}
SELECT name AS "ActivityName", count(*) AS "FailureCount" FROM activities WHERE name <> 'other' GROUP BY name""",
    "bronze_roundtrip": f"""
WITH {EVENTS}
SELECT city_id, poll_timestamp, event_type AS source, ingestion_date, dt, temp, humidity, aqi, pm2_5
FROM sensor_events""",
    "silver_roundtrip": f"""
WITH {EVENTS}
SELECT city_id, {OBSERVED}, ingestion_date, temp, humidity, aqi, pm2_5, pm10 FROM sensor_events
WHERE temp IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY city_id, ingestion_date, dt ORDER BY poll_timestamp, event_id) = 1""",
    "quarantine_roundtrip": f"""
WITH {EVENTS}
SELECT city_id, poll_timestamp, ingestion_date, aqi, 'missing temp' AS reason FROM sensor_events
WHERE temp IS NULL""",
    "rerun_idempotent": f"""
WITH {EVENTS},
kept AS (SELECT * FROM sensor_events
         WHERE temp IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY city_id, dt ORDER BY poll_timestamp, event_id) = 1)
SELECT city_id, ingestion_date AS date, min(temp) AS min_temp, max(temp) AS max_temp, max(aqi) AS max_aqi,
       CAST(count(*) AS INTEGER) AS observation_count
FROM kept GROUP BY city_id, ingestion_date""",
    "gold_merge": f"""
WITH {EVENTS},
stored AS (SELECT city_id, ingestion_date AS date, {DAILY} FROM sensor_events GROUP BY ALL),
again AS (SELECT city_id, ingestion_date AS date, {DAILY} FROM sensor_events
          WHERE event_type = 'purchase' AND ingestion_date IN (DATE '2024-01-15', DATE '2024-01-16') GROUP BY ALL)
SELECT city_id, date, avg_temp, max_temp, observation_count FROM again
UNION ALL
SELECT city_id, date, avg_temp, max_temp, observation_count FROM stored ANTI JOIN again USING (city_id, date)""",
    "gold_restored": f"""
WITH {EVENTS},
stored AS (SELECT city_id, ingestion_date AS date, {DAILY} FROM sensor_events GROUP BY ALL),
again AS (SELECT city_id, ingestion_date AS date, {DAILY} FROM sensor_events
          WHERE event_type = 'purchase' AND ingestion_date IN (DATE '2024-01-15', DATE '2024-01-16') GROUP BY ALL)
SELECT city_id, date, avg_temp, max_temp, observation_count FROM again
UNION ALL
SELECT city_id, date, avg_temp, max_temp, observation_count FROM stored ANTI JOIN again USING (city_id, date)""",
    "lake_table": f"""
WITH {EVENTS}
SELECT city_id, count(DISTINCT ingestion_date) AS days, max(temp) AS max_temp, count(*) AS observations
FROM sensor_events GROUP BY city_id""",
    "lake_view": f"""
WITH {EVENTS}
SELECT city_id, count(DISTINCT dt) AS observations, max(first_aqi) AS max_aqi FROM (
  SELECT city_id, dt, arg_min(aqi, (poll_timestamp, event_id)) AS first_aqi FROM sensor_events
  WHERE temp IS NOT NULL AND ingestion_date = DATE '2024-01-15' GROUP BY city_id, dt)
GROUP BY city_id""",
    "publish_decode": f"""
WITH {EVENTS}
SELECT city_id, poll_timestamp, ingestion_date, dt, temp, humidity, aqi, pm2_5, pm10, CAST(NULL AS DOUBLE) AS no2
FROM sensor_events""",
    "stream_hopping": f"WITH {EVENTS} {hopping('poll_timestamp')}",
    "stream_hopping_late": f"WITH {EVENTS}, {LATE} {hopping('late_ts', 'late')}",
    "stream_alerts": f"""
WITH {EVENTS}, {SLIDING},
due AS (SELECT alerts.* FROM alerts JOIN (SELECT city_id, max(poll_timestamp) AS clock FROM sensor_events GROUP BY city_id)
        USING (city_id) WHERE detected_at <= clock)
SELECT * FROM due QUALIFY row_number() OVER (PARTITION BY id ORDER BY detected_at DESC) = 1""",
    "stream_alerts_late": f"""
WITH {EVENTS.replace('sensor_events AS', 'arriving AS')},
late AS (SELECT *, greatest(poll_timestamp, arrival_ts - INTERVAL 5 MINUTE) AS late_ts FROM arriving),
ordered AS ({out_of_order('late_ts', 'late')}),
sensor_events AS (SELECT city_id, adjusted_timestamp AS poll_timestamp, temp, aqi, pm2_5 FROM ordered),
{SLIDING},
due AS (SELECT alerts.* FROM alerts JOIN (SELECT city_id, max(poll_timestamp) AS clock FROM sensor_events GROUP BY city_id)
        USING (city_id) WHERE detected_at <= clock)
SELECT * FROM due QUALIFY row_number() OVER (PARTITION BY id ORDER BY detected_at DESC) = 1""",
    "stream_passthrough": f"""
WITH {EVENTS} SELECT city_id, poll_timestamp, ingestion_date, dt, temp, aqi, pm10 FROM sensor_events""",
    "stream_dedup": f"WITH {EVENTS} SELECT city_id, poll_timestamp, temp, humidity, aqi FROM sensor_events",
    "stream_late_dropped": f"""
WITH {EVENTS},
days AS (SELECT min(ingestion_date) AS first, max(ingestion_date) AS last FROM sensor_events),
parted AS (
  SELECT sensor_events.*, CASE WHEN ingestion_date >= first + CAST((last - first) * 2 // 3 AS INTEGER) THEN 2
                               WHEN ingestion_date >= first + CAST((last - first) // 3 AS INTEGER) THEN 1 ELSE 0 END AS own
  FROM sensor_events, days),
arriving AS (SELECT *, least(own + CASE WHEN humidity % 7 = 0 THEN 1 ELSE 0 END, 2) AS part FROM parted),
marks AS (SELECT p.part, max(a.poll_timestamp) - INTERVAL 5 MINUTE AS mark
          FROM (SELECT DISTINCT part FROM arriving) p LEFT JOIN arriving a ON a.part < p.part GROUP BY p.part),
spread AS (
  SELECT arriving.*, mark, make_timestamp((epoch_us(poll_timestamp) // 120000000 + 1 + hop) * 120000000) AS window_end_time
  FROM arriving JOIN marks USING (part), range(0, 5) AS hops(hop))
SELECT city_id, window_end_time, {mean('temp')} AS avg_temp, max(temp) AS max_temp, count(*) AS observation_count,
       (SELECT count(DISTINCT (city_id, window_end_time, part)) FROM spread WHERE window_end_time <= mark) AS windows_lost
FROM spread WHERE mark IS NULL OR window_end_time > mark GROUP BY ALL""",
    "stream_replays": f"WITH {EVENTS} SELECT DISTINCT city_id, poll_timestamp AS observation_timestamp FROM sensor_events",
    "stream_pairing": f"""
WITH {EVENTS}
SELECT 'city_' || (event_id % 100) AS city_id, poll_timestamp, temp, humidity,
       CASE WHEN humidity % 10 <> 9 THEN aqi END AS aqi, CASE WHEN humidity % 10 <> 9 THEN pm2_5 END AS pm2_5
FROM sensor_events WHERE event_type IN ('click', 'view', 'purchase')""",
    "stream_corrupt_isolated": f"""
WITH {EVENTS}
SELECT city_id, CASE WHEN humidity % 7 = 0 THEN 'not readable as JSON' END AS reason, count(*) AS records
FROM sensor_events GROUP BY ALL""",
    "stream_fast_clock": f"""
WITH {EVENTS.replace('sensor_events AS', 'arriving AS')},
clocks AS (SELECT *, CASE WHEN CAST(substr(city_id, 6) AS INTEGER) % 3 = 0 THEN arrival_ts
                          ELSE greatest(poll_timestamp, arrival_ts - INTERVAL 5 MINUTE) END AS held_ts FROM arriving)
{hopping('held_ts', 'clocks')}""",
    "ingest_roundtrip": f"""
WITH {EVENTS}
SELECT 'city_' || (event_id % 100) AS city_id, poll_timestamp, 'azure-function-timer' AS source, ingestion_date, dt, temp, humidity,
       CASE WHEN humidity % 10 <> 9 THEN aqi END AS aqi, CASE WHEN humidity % 10 <> 9 THEN pm2_5 END AS pm2_5,
       CASE WHEN humidity % 10 <> 9 THEN pm10 END AS pm10, CASE WHEN humidity % 5 <> 0 THEN event_type END AS weather_main
FROM sensor_events WHERE event_type IN ('click', 'view', 'purchase')""",
    "gold_created_once": f"""
WITH {EVENTS}
SELECT city_id, ingestion_date AS date, max(temp) AS max_temp, CAST(count(*) AS INTEGER) AS observation_count, 1 AS made
FROM sensor_events GROUP BY ALL""",
}
ORACLES["responses_from_files"] = ORACLES["poll_summary"]
ORACLES["cities_from_file"] = ORACLES["city_lookup"]
ORACLES["log_from_files"] = ORACLES["lag_listing"]
ORACLES["stream_alerts_stateful"] = ORACLES["stream_alerts_late"]
ORACLES["stream_event_time_policy"] = ORACLES["event_time_policy"]
ORACLES["anomalies_by_contents"] = ORACLES["sliding_anomalies"]
ORACLES["stream_alert_members"] = f"""
WITH {EVENTS}, {SLIDING}
SELECT a.city_id, a.detected_at, count(*) AS events, CAST(sum(e.event_id) AS BIGINT) AS event_ids, max(e.temp) AS window_max_temp
FROM alerts a JOIN sensor_events e
  ON a.city_id = e.city_id AND e.poll_timestamp <= a.detected_at AND e.poll_timestamp > a.detected_at - INTERVAL 15 MINUTE
GROUP BY a.city_id, a.detected_at"""
ORACLES["stream_fan_out"] = f"""
WITH {EVENTS.replace('sensor_events AS', 'sent AS')},
sensor_events AS (SELECT * FROM sent WHERE humidity % 7 <> 0),
{SLIDING},
due AS (SELECT alerts.* FROM alerts JOIN (SELECT city_id, max(poll_timestamp) AS clock FROM sensor_events GROUP BY city_id)
        USING (city_id) WHERE detected_at <= clock),
kept AS (SELECT * FROM due QUALIFY row_number() OVER (PARTITION BY id ORDER BY detected_at DESC) = 1),
rolled AS ({hopping('poll_timestamp')})
SELECT 'raw' AS sink, count(*) AS n, CAST(sum(dt) AS BIGINT) AS total FROM sensor_events
UNION ALL SELECT 'dead', count(*), count(*) * 25 FROM sent WHERE humidity % 7 = 0
UNION ALL SELECT 'rolling', count(*), CAST(sum(observation_count) AS BIGINT) FROM rolled
UNION ALL SELECT 'alerts', count(*), CAST(sum(epoch_us(detected_at) // 1000000) AS BIGINT) FROM kept"""
