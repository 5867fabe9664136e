"""The named queries in ANSI SQL over the ``events`` table, for checking them elsewhere.

Written from the column definitions, not from the DataFrame code: typed columns are derived
straight from ``events``, without building or parsing JSON, except where the text itself is
the result.
"""

from __future__ import annotations

FEED = """
faulted AS (
  SELECT event_id AS n, event_id // 9 AS turn, user_id, event_type, ts AS arrival,
         CAST(floor(value) AS INTEGER) AS true_speed,
         CASE WHEN event_type = 'error' THEN event_id % 9 ELSE -1 END AS fault
  FROM events
),
fields AS (
  SELECT n, arrival, fault,
         'veh-' || user_id AS vehicle_id,
         'R' || ((1 + n % 4) * 100) AS road_id,
         CASE (n // 4) % 5 WHEN 0 THEN 'CBD' WHEN 1 THEN 'AIRPORT' WHEN 2 THEN 'TECHPARK'
              WHEN 3 THEN 'SUBURB' ELSE 'TRAINSTATION' END AS city_zone,
         CASE fault WHEN 0 THEN NULL WHEN 1 THEN -10 - n % 51 WHEN 2 THEN 250 + n % 351
              WHEN 6 THEN NULL ELSE true_speed END AS speed_number,
         CASE WHEN fault = 6 THEN
              CASE turn % 3 WHEN 0 THEN 'brisk' WHEN 1 THEN 'crawl' ELSE 'n/a' END
         END AS speed_word,
         CAST(1 + n % 5 AS INTEGER) AS congestion_level,
         CASE event_type WHEN 'view' THEN 'RAIN' WHEN 'signup' THEN 'FOG'
              WHEN 'purchase' THEN 'STORM' ELSE 'CLEAR' END AS weather,
         CASE fault WHEN 4 THEN arrival - to_minutes(10 + n % 111)
              WHEN 5 THEN arrival + to_minutes(5 + n % 56) ELSE arrival END AS event_at,
         CASE WHEN fault = 7 THEN
              CASE turn % 3 WHEN 0 THEN 'DRY' WHEN 1 THEN 'WET' ELSE 'ICY' END
         END AS road_condition
  FROM faulted
),
timed AS (
  SELECT *, strftime(event_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_text FROM fields
),
messages AS (
  SELECT timed.*, copy,
         CASE WHEN fault = 8 THEN '{"raw":"###CORRUPTED_EVENT###","corrupted":true}' ELSE
           '{"vehicle_id":"' || vehicle_id || '","road_id":"' || road_id ||
           '","city_zone":"' || city_zone || '","speed":' ||
           coalesce('"' || speed_word || '"', CAST(speed_number AS VARCHAR), 'null') ||
           ',"congestion_level":' || congestion_level || ',"weather":"' || weather ||
           '","event_time":"' || event_text || '"' ||
           coalesce(',"road_condition":"' || road_condition || '"', '') || '}'
         END AS raw_json
  FROM timed CROSS JOIN (SELECT unnest([1, 2]) AS copy) AS copies
  WHERE copy = 1 OR fault = 3
)"""

BRONZE = FEED + """,
bronze AS (
  SELECT raw_json, arrival AS kafka_timestamp, CAST(n % 3 AS INTEGER) AS kafka_partition,
         CAST(n AS BIGINT) AS kafka_offset,
         CASE WHEN fault <> 8 THEN vehicle_id END AS vehicle_id,
         CASE WHEN fault <> 8 THEN road_id END AS road_id,
         CASE WHEN fault <> 8 THEN city_zone END AS city_zone,
         CASE WHEN fault <> 8 THEN coalesce(speed_word, CAST(speed_number AS VARCHAR)) END
           AS speed,
         CASE WHEN fault <> 8 THEN congestion_level END AS congestion_level,
         CASE WHEN fault <> 8 THEN weather END AS weather,
         CASE WHEN fault <> 8 THEN event_text END AS event_time,
         CASE WHEN fault <> 8 THEN CAST(speed_number AS INTEGER) END AS speed_int,
         CASE WHEN fault <> 8 THEN event_at END AS event_ts,
         fault, (n + copy - 1) % 3 AS round
  FROM messages
)"""

CHECKED = BRONZE + """,
checked AS (
  SELECT * EXCLUDE (fault),
         CASE WHEN fault = 8 THEN 'CORRUPT_JSON' ELSE 'OK' END AS dq_flag,
         CAST(coalesce(speed_int BETWEEN 0 AND 160, false) AS INTEGER) AS speed_valid,
         CAST(coalesce(event_ts BETWEEN kafka_timestamp - INTERVAL 20 MINUTE
                                    AND kafka_timestamp + INTERVAL 10 MINUTE, false)
              AS INTEGER) AS time_valid
  FROM bronze
),
reasoned AS (
  SELECT *, CASE WHEN dq_flag <> 'OK' THEN dq_flag WHEN speed_valid = 0 THEN 'INVALID_SPEED'
                 WHEN time_valid = 0 THEN 'INVALID_TIME' ELSE 'OK' END AS row_reason
  FROM checked
),
counted AS (
  SELECT *, CASE WHEN row_reason = 'OK'
                 THEN count(*) OVER (PARTITION BY row_reason, vehicle_id, event_ts)
                 ELSE 1 END AS copies
  FROM reasoned
),
labelled AS (
  SELECT * EXCLUDE (row_reason, copies), row_reason, copies,
         CASE WHEN copies > 1 THEN 'DUPLICATE_EVENT' ELSE row_reason END AS reject_reason
  FROM counted
)"""

SILVER = CHECKED + """,
silver AS (
  SELECT * EXCLUDE (row_reason, copies, reject_reason, round),
         CAST(hour(event_ts) AS INTEGER) AS hour,
         CASE WHEN hour(event_ts) IN (8, 9, 10, 11, 17, 18, 19, 20) THEN 1 ELSE 0 END
           AS peak_flag,
         CASE WHEN speed_int < 30 THEN 'LOW' WHEN speed_int < 70 THEN 'MEDIUM' ELSE 'HIGH' END
           AS speed_band
  FROM labelled WHERE reject_reason = 'OK'
),
rejects AS (
  SELECT raw_json, kafka_timestamp, kafka_partition, kafka_offset, vehicle_id, road_id,
         city_zone, speed, congestion_level, weather, event_time, dq_flag, speed_int, event_ts,
         speed_valid, time_valid, reject_reason, kafka_timestamp AS rejected_at
  FROM labelled WHERE reject_reason <> 'OK'
)"""

STAR = SILVER + """,
dim_zone AS (
  SELECT city_zone,
         CASE WHEN city_zone = 'CBD' THEN 'Commercial' WHEN city_zone = 'TECHPARK' THEN 'IT Hub'
              WHEN city_zone IN ('AIRPORT', 'TRAINSTATION') THEN 'Transit Hub'
              ELSE 'Residential' END AS zone_type,
         CASE WHEN city_zone IN ('CBD', 'AIRPORT', 'TRAINSTATION') THEN 'HIGH'
              WHEN city_zone = 'TECHPARK' THEN 'MEDIUM' ELSE 'LOW' END AS traffic_risk
  FROM silver GROUP BY city_zone
),
dim_road AS (
  SELECT road_id,
         CASE WHEN road_id IN ('R100', 'R200') THEN 'Highway' ELSE 'City Road' END AS road_type,
         CASE WHEN road_id IN ('R100', 'R200') THEN 100 ELSE 60 END AS speed_limit
  FROM silver GROUP BY road_id
),
fact AS (
  SELECT vehicle_id, road_id, city_zone, speed_int AS speed, congestion_level, event_ts,
         peak_flag, speed_band, hour, weather, CAST(event_ts AS DATE) AS event_date,
         kafka_timestamp AS ingested_at
  FROM silver
)"""


# Rows with gaps in every column, checked and labelled.
GAPS = """
gappy AS (
  SELECT CASE WHEN n % 19 = 0 THEN '{"raw":"###CORRUPTED_EVENT###","corrupted":true}'
              ELSE '{}' END AS raw_json,
         ts AS kafka_timestamp, CAST(n % 3 AS INTEGER) AS kafka_partition,
         2 * n + copy AS kafka_offset,
         CASE WHEN n % 11 <> 0 THEN 'veh-' || user_id END AS vehicle_id,
         CASE WHEN n % 5 <> 0 THEN 'R' || ((1 + n % 4) * 100) END AS road_id,
         CASE WHEN n % 6 <> 0 THEN CASE (n // 4) % 5 WHEN 0 THEN 'CBD' WHEN 1 THEN 'AIRPORT'
              WHEN 2 THEN 'TECHPARK' WHEN 3 THEN 'SUBURB' ELSE 'TRAINSTATION' END
         END AS city_zone,
         CASE n % 8 WHEN 0 THEN v || '.5' WHEN 1 THEN '  ' || v || ' ' WHEN 2 THEN ''
              ELSE CAST(v AS VARCHAR) END AS speed,
         CASE WHEN n % 7 <> 0 THEN CAST(1 + n % 5 AS INTEGER) END AS congestion_level,
         'CLEAR' AS weather,
         CASE WHEN n % 13 = 0 THEN NULL WHEN n % 17 = 0 THEN 'soon'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS event_time,
         CASE WHEN n % 8 <> 2 THEN v END AS speed_int,
         CASE WHEN n % 13 <> 0 AND n % 17 <> 0 THEN ts END AS event_ts,
         CASE WHEN n % 19 = 0 THEN 'CORRUPT_JSON' WHEN n % 11 = 0 THEN 'MISSING_VEHICLE'
              WHEN n % 13 = 0 THEN 'MISSING_TIME' WHEN n % 7 = 0 THEN 'MISSING_CONGESTION'
              ELSE 'OK' END AS dq_flag, 0 AS round
  FROM (SELECT event_id AS n, user_id, ts, CAST(floor(value) AS INTEGER) AS v FROM events)
       CROSS JOIN (SELECT unnest([0, 1]) AS copy) AS copies
  WHERE copy = 0 OR n % 23 = 0
),
checked AS (
  SELECT * EXCLUDE (round, dq_flag), round, dq_flag,
         CAST(coalesce(speed_int BETWEEN 0 AND 160, false) AS INTEGER) AS speed_valid,
         CAST(event_ts IS NOT NULL AS INTEGER) AS time_valid
  FROM gappy
),
reasoned AS (""" + CHECKED.split("reasoned AS (", 1)[1]


def _gappy(tables: str) -> str:
    """The tables that build on ``CHECKED``, over rows with gaps."""
    return GAPS + tables.removeprefix(CHECKED)


def _in_rounds(tables: str) -> str:
    """The tables if every copy is a message of its own, and copies are looked for within each
    round of messages only."""
    numbered = tables.replace(
        "CAST(n AS BIGINT) AS kafka_offset", "CAST(2 * n + copy - 1 AS BIGINT) AS kafka_offset"
    )
    return numbered.replace(
        "PARTITION BY row_reason, vehicle_id", "PARTITION BY round, row_reason, vehicle_id"
    )


def _evolved(tables: str) -> str:
    """The tables with a column more, which odd messages fill."""
    condition = "CASE WHEN n % 2 = 1 AND fault <> 8 THEN road_condition END AS road_condition"
    kept = tables.replace("(n + copy - 1) % 3 AS round", f"(n + copy - 1) % 3 AS round, {condition}")
    return kept.replace("AS rejected_at", "AS rejected_at, road_condition")


def _rounded(value: str, digits: int) -> str:
    # Through DECIMAL, so that halves round up as written and not as stored in binary.
    return f"CAST(round(CAST({value} AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


def _average(column: str, digits: int) -> str:
    return _rounded(f"sum(CAST({column} AS DOUBLE)) / count({column})", digits)


def _share(condition: str) -> str:
    return _rounded(f"100.0 * count(*) FILTER (WHERE {condition}) / count(*)", 1)


MESSAGE = "kafka_partition, kafka_offset"
PAYLOAD = (
    "raw_json, kafka_timestamp, kafka_partition, kafka_offset, vehicle_id, road_id, city_zone, "
    "speed, congestion_level, weather, event_time"
)
PEAKS = "CAST(sum(peak_flag) AS BIGINT)"

ZONE_KPIS = f"""
SELECT fact.city_zone, zone_type, traffic_risk, {_average('speed', 1)} AS avg_speed,
       {_average('congestion_level', 2)} AS avg_congestion,
       count(DISTINCT vehicle_id) AS unique_vehicles, count(*) AS total_events,
       {PEAKS} AS peak_events, min(event_ts) AS first_event, max(event_ts) AS last_event
FROM fact JOIN dim_zone ON fact.city_zone = dim_zone.city_zone
GROUP BY fact.city_zone, zone_type, traffic_risk"""

REJECT_MONITORING = """
SELECT reject_reason, count(*) AS rejected_rows, min(rejected_at) AS first_seen,
       max(rejected_at) AS last_seen
FROM rejects GROUP BY reject_reason"""

FACT = "SELECT * FROM fact"
DIM_ZONE = "SELECT * FROM dim_zone"
DIM_ROAD = "SELECT * FROM dim_road"

# Query name -> (tables it builds on, final SELECT).
_SELECTS = {
    "envelope_decode": (
        BRONZE,
        "SELECT raw_json, kafka_timestamp, kafka_partition, kafka_offset FROM bronze",
    ),
    "bronze_parse": (BRONZE, f"SELECT {PAYLOAD} FROM bronze"),
    "dq_flags": (CHECKED, f"SELECT {MESSAGE}, dq_flag FROM checked"),
    "type_casting": (
        BRONZE,
        f"SELECT {MESSAGE}, speed, event_time, speed_int, event_ts FROM bronze",
    ),
    "speed_validation": (CHECKED, f"SELECT {MESSAGE}, speed_int, speed_valid FROM checked"),
    "time_validation": (CHECKED, f"SELECT {MESSAGE}, event_ts, time_valid FROM checked"),
    "reject_reason": (CHECKED, f"SELECT {MESSAGE}, row_reason AS reject_reason FROM reasoned"),
    "clean_records": (
        CHECKED,
        f"SELECT {PAYLOAD}, speed_int, event_ts FROM reasoned WHERE row_reason = 'OK'",
    ),
    "copy_counts": (
        CHECKED,
        f"SELECT {MESSAGE}, vehicle_id, event_ts, copies FROM counted WHERE row_reason = 'OK'",
    ),
    "duplicate_events": (
        CHECKED,
        f"SELECT {MESSAGE}, vehicle_id, event_ts, reject_reason FROM labelled "
        "WHERE reject_reason = 'DUPLICATE_EVENT'",
    ),
    "labelled_rows": (
        CHECKED,
        f"SELECT {MESSAGE}, dq_flag, speed_valid, time_valid, reject_reason FROM labelled",
    ),
    "deduped_clean": (
        CHECKED,
        f"SELECT {PAYLOAD}, speed_int, event_ts FROM labelled WHERE reject_reason = 'OK'",
    ),
    "quarantine": (SILVER, "SELECT * FROM rejects"),
    "features": (
        SILVER,
        f"SELECT {MESSAGE}, event_ts, speed_int, hour, peak_flag, speed_band FROM silver",
    ),
    "silver": (SILVER, "SELECT * FROM silver"),
    "dq_breakdown": (CHECKED, "SELECT dq_flag, count(*) AS count FROM checked GROUP BY dq_flag"),
    "batch_metrics": (
        CHECKED,
        "SELECT count(*) AS in_rows, count(*) FILTER (WHERE reject_reason = 'OK') AS out_rows, "
        "count(*) FILTER (WHERE reject_reason <> 'OK') AS quarantined_rows, "
        "count(*) FILTER (WHERE speed_valid = 0) AS speed_rejects, "
        "count(*) FILTER (WHERE time_valid = 0) AS time_rejects, "
        "count(*) FILTER (WHERE reject_reason = 'DUPLICATE_EVENT') AS duplicate_rejects, "
        "count(*) FILTER (WHERE dq_flag = 'OK') AS flag_ok, "
        "count(*) FILTER (WHERE dq_flag = 'CORRUPT_JSON') AS flag_corrupt_json, "
        "count(*) FILTER (WHERE dq_flag = 'MISSING_VEHICLE') AS flag_missing_vehicle, "
        "count(*) FILTER (WHERE dq_flag = 'MISSING_TIME') AS flag_missing_time, "
        "count(*) FILTER (WHERE dq_flag = 'MISSING_CONGESTION') AS flag_missing_congestion, "
        + _share("reject_reason <> 'OK'")
        + " AS reject_rate FROM labelled",
    ),
    "dim_zone": (STAR, DIM_ZONE),
    "dim_road": (STAR, DIM_ROAD),
    "fact_traffic": (STAR, FACT),
    "upsert_fact": (STAR, FACT),
    "upsert_dim_zone": (STAR, DIM_ZONE),
    "upsert_dim_road": (STAR, DIM_ROAD),
    "bi_fact_traffic": (
        STAR,
        "SELECT vehicle_id, road_id, city_zone, CAST(speed AS DOUBLE) AS speed, "
        "congestion_level, event_ts AS event_time, peak_flag, speed_band, weather, event_date, "
        "hour AS event_hour, ingested_at FROM fact",
    ),
    "bi_dim_zone": (STAR, DIM_ZONE),
    "bi_dim_road": (STAR, DIM_ROAD),
    "bi_rejects": (
        SILVER,
        "SELECT vehicle_id, road_id, city_zone, reject_reason, rejected_at, raw_json FROM rejects",
    ),
    "v_hourly_congestion": (
        STAR,
        f"SELECT hour AS event_hour, zone_type, fact.city_zone, "
        f"{_average('congestion_level', 2)} AS avg_congestion, "
        f"{_average('speed', 1)} AS avg_speed, count(*) AS event_count "
        "FROM fact JOIN dim_zone ON fact.city_zone = dim_zone.city_zone "
        "GROUP BY hour, zone_type, fact.city_zone",
    ),
    "v_road_performance": (
        STAR,
        f"SELECT fact.road_id, road_type, speed_limit, {_average('speed', 1)} AS avg_speed, "
        f"{_average('congestion_level', 2)} AS avg_congestion, count(*) AS total_events, "
        f"{PEAKS} AS peak_hour_events, {_share('peak_flag = 1')} AS peak_pct "
        "FROM fact JOIN dim_road ON fact.road_id = dim_road.road_id "
        "GROUP BY fact.road_id, road_type, speed_limit",
    ),
    "v_weather_impact": (
        STAR,
        f"SELECT weather, {_average('congestion_level', 2)} AS avg_congestion, "
        f"{_average('speed', 1)} AS avg_speed, count(*) AS event_count, "
        + _share("speed_band = 'LOW'")
        + " AS pct_low_speed, "
        + _share("speed_band = 'HIGH'")
        + " AS pct_high_speed FROM fact GROUP BY weather",
    ),
    "v_speed_distribution": (
        STAR,
        "SELECT city_zone, speed_band, count(*) AS vehicle_count, "
        f"{_average('congestion_level', 2)} AS avg_congestion "
        "FROM fact GROUP BY city_zone, speed_band",
    ),
    "v_zone_kpis": (STAR, ZONE_KPIS),
    "v_live_summary": (
        STAR,
        "SELECT count(DISTINCT vehicle_id) AS total_unique_vehicles, "
        f"{_average('speed', 1)} AS avg_speed_kmh, "
        f"{_average('congestion_level', 2)} AS avg_congestion, count(*) AS total_events, "
        f"{PEAKS} AS peak_hour_events, "
        + _share("speed_band = 'LOW'")
        + " AS pct_low_speed_traffic FROM fact",
    ),
    "v_reject_monitoring": (SILVER, REJECT_MONITORING),
    "verification_counts": (
        STAR,
        "SELECT 'fact_traffic' AS table_name, count(*) AS row_count FROM fact UNION ALL "
        "SELECT 'dim_zone', count(*) FROM dim_zone UNION ALL "
        "SELECT 'dim_road', count(*) FROM dim_road UNION ALL "
        "SELECT 'traffic_rejects', count(*) FROM rejects",
    ),
    "stream_bronze": (BRONZE, f"SELECT {PAYLOAD} FROM bronze"),
    "stream_silver": (SILVER, "SELECT * FROM silver"),
    "stream_rejects": (SILVER, "SELECT * EXCLUDE (rejected_at) FROM rejects"),
    "stream_dim_zone": (STAR, DIM_ZONE),
    "stream_dim_road": (STAR, DIM_ROAD),
    "stream_fact": (STAR, "SELECT * EXCLUDE (ingested_at) FROM fact"),
    "stream_capped_bronze": (_in_rounds(BRONZE), f"SELECT {PAYLOAD} FROM bronze"),
    "stream_capped_silver": (_in_rounds(SILVER), "SELECT * FROM silver"),
    "stream_capped_rejects": (_in_rounds(SILVER), "SELECT * EXCLUDE (rejected_at) FROM rejects"),
    # A copy that another round brings passes the rules and is stopped by the merge.
    "stream_capped_fact": (_in_rounds(STAR), "SELECT DISTINCT * EXCLUDE (ingested_at) FROM fact"),
    "stream_evolved_silver": (_evolved(SILVER), "SELECT * FROM silver"),
    "stream_evolved_rejects": (_evolved(SILVER), "SELECT * EXCLUDE (rejected_at) FROM rejects"),
    "catalog_evolved_rejects": (
        _evolved(SILVER),
        "SELECT vehicle_id, road_id, city_zone, reject_reason, raw_json, road_condition "
        "FROM rejects",
    ),
    "stream_progress": (
        STAR,
        "SELECT 'bronze' AS query, 1::BIGINT AS batches, count(*) AS input_rows, "
        "count(*) AS written_rows, true AS timed FROM bronze UNION ALL "
        "SELECT 'silver', 1, count(*), count(*), true FROM bronze UNION ALL "
        "SELECT 'gold', 1, (SELECT count(*) FROM silver), "
        "(SELECT count(*) FROM (SELECT DISTINCT vehicle_id, road_id, city_zone, event_ts FROM fact)) "
        "+ (SELECT count(*) FROM dim_zone) + (SELECT count(*) FROM dim_road), true",
    ),
    "gaps_dq_flags": (GAPS, f"SELECT {MESSAGE}, dq_flag FROM checked"),
    "gaps_type_casting": (
        GAPS,
        f"SELECT {MESSAGE}, speed, event_time, speed_int, event_ts FROM checked",
    ),
    "gaps_reject_reason": (GAPS, f"SELECT {MESSAGE}, reject_reason FROM labelled"),
    "gaps_upsert_fact": (_gappy(STAR), FACT),
    "gaps_v_reject_monitoring": (_gappy(SILVER), REJECT_MONITORING),
}

# However often the jobs start, fail or find nothing, the tables end up the same.
_SELECTS.update(
    {
        f"stream_{kind}_{name}": _SELECTS[f"stream_{name}"]
        for kind in ("fresh", "crashed", "interval", "by_day")
        for name in ("bronze", "silver", "rejects", "fact")
    }
)
_SELECTS["catalog_live_counts"] = _SELECTS["verification_counts"]
_SELECTS["catalog_live_zone_kpis"] = _SELECTS["v_zone_kpis"]

# The views read through the catalog give what they give as DataFrames.
_SELECTS.update(
    {f"catalog_{name}": _SELECTS[name] for name in [*_SELECTS] if name.startswith(("bi_", "v_"))}
)

ORACLE_SQL = {name: f"WITH {base.strip()}\n{select}" for name, (base, select) in _SELECTS.items()}
