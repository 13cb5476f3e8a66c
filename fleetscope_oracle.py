"""Independent SQL for every named query, written for DuckDB.

Nothing here comes from the package: the mapping from events to readings, the
lookup tables and the queries are spelled out a second time, so that agreement
means something.
"""

from __future__ import annotations

# The lookup tables and parameters that results depend on.
ANCHORS = """(VALUES ('A1', 'Production'), ('A2', 'Storage'), ('A3', 'WIP'), ('A4', 'Packing'),
    ('A5', 'Production'), ('A6', 'Charging'), ('A7', 'Maintenance'), ('A8', 'WIP'))
    AS a(anchor, zone)"""

PROFILES = """(VALUES
    ('FL_01', 'high', 'high', ['Production', 'WIP']),
    ('FL_02', 'high', 'high', ['Production', 'Storage']),
    ('FL_03', 'high', 'medium', ['WIP', 'Packing']),
    ('FL_04', 'medium', 'medium', ['Storage', 'Packing']),
    ('FL_05', 'medium', 'low', ['Storage', 'Charging']),
    ('FL_06', 'medium', 'low', ['Production', 'WIP']),
    ('FL_07', 'medium', 'low', ['Packing', 'Storage']),
    ('FL_08', 'low', 'low', ['Charging', 'Maintenance']),
    ('FL_09', 'low', 'low', ['Maintenance', 'Storage']),
    ('FL_10', 'low', 'low', ['Charging', 'Maintenance']))
    AS p(forklift_id, usage_level, risk_level, preferred_zones)"""

CATEGORY = """CASE
    WHEN {visible} = 0 OR status = 'offline' THEN 'signal_loss_or_offline'
    WHEN mov = 1 AND occ = 1 THEN 'active_work'
    WHEN mov = 0 AND occ = 1 THEN 'idle_waiting'
    WHEN mov = 1 AND occ = 0 THEN 'unauthorized_operation'
    WHEN mov = 0 AND occ = 0 AND {zone} IN ('Charging', 'Maintenance')
        THEN 'parked_or_charging_candidate'
    WHEN mov = 0 AND occ = 0 THEN 'available'
    ELSE 'unknown' END"""

TELEMETRY = f"""
staged AS (
    SELECT event_id, ts, value,
        'FL_' || lpad(CAST(user_id % 10 + 1 AS VARCHAR), 2, '0') AS forklift_id,
        'A' || CAST((event_id * 7 + user_id) % 8 + 1 AS VARCHAR) AS anchor,
        CASE WHEN extract(hour FROM ts) BETWEEN 6 AND 13 THEN 'morning'
             WHEN extract(hour FROM ts) BETWEEN 14 AND 21 THEN 'afternoon'
             ELSE 'night' END AS shift,
        CASE WHEN event_type IN ('click', 'purchase', 'error') THEN 1 ELSE 0 END AS mov,
        CASE WHEN event_type IN ('click', 'purchase', 'view') THEN 1 ELSE 0 END AS occ
    FROM events
), placed AS (
    SELECT s.*, a.zone,
        CASE WHEN value < CASE shift WHEN 'morning' THEN 1.0 WHEN 'afternoon' THEN 1.5
             ELSE 3.0 END THEN 1 ELSE 0 END AS off
    FROM staged s LEFT JOIN {ANCHORS} USING (anchor)
), stated AS (
    SELECT *, CASE WHEN off = 1 THEN 'offline' ELSE 'online' END AS status FROM placed
), telemetry AS (
    SELECT ts AS "timestamp", CAST(ts AS DATE) AS "date",
        CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS day_index,
        forklift_id, anchor, zone, shift,
        CAST(CASE WHEN off = 1 THEN 0
             WHEN zone IN ('Production', 'WIP') THEN -(50 + event_id % 26)
             WHEN zone IN ('Storage', 'Packing') THEN -(55 + event_id % 31)
             ELSE -(60 + event_id % 31) END AS INTEGER) AS rssi,
        1 - off AS visible, mov, occ, status,
        {CATEGORY.format(visible="1 - off", zone="zone")} AS downtime_category,
        event_id, off
    FROM stated
)"""

DAMAGED = """
, damaged AS (
    SELECT "timestamp", "date", day_index,
        CASE WHEN event_id % 31 = 0 THEN 'TRK_' || right(forklift_id, 2)
             ELSE forklift_id END AS forklift_id,
        anchor,
        CASE WHEN event_id % 13 = 0 THEN 'Charging' ELSE zone END AS zone,
        CASE WHEN event_id % 29 = 0 THEN 'evening' ELSE shift END AS shift,
        CASE WHEN off = 1 AND event_id % 5 = 0 THEN -60
             WHEN off = 0 AND event_id % 19 = 0 THEN -95 ELSE rssi END AS rssi,
        CASE WHEN off = 1 AND event_id % 7 = 0 THEN 1 ELSE visible END AS visible,
        mov, occ, status,
        CASE WHEN event_id % 23 = 0 THEN NULL
             WHEN event_id % 17 = 0 OR (off = 1 AND event_id % 3 = 0)
             THEN 'unauthorized_operation' ELSE downtime_category END AS downtime_category,
        event_id, off
    FROM telemetry
)"""


def _count(key: str, where: str = "TRUE", name: str = '"count"') -> str:
    return f"SELECT {key}, COUNT(*) AS {name} FROM telemetry WHERE {where} GROUP BY {key}"


OFFLINE = "status = 'offline'"
UNAUTHORIZED = "downtime_category = 'unauthorized_operation'"
DOWN = "downtime_category <> 'active_work'"


def _rate(keys: str, event: str, count: str, share: str, table: str = "telemetry") -> str:
    return f"""SELECT {keys}, COUNT(*) AS total_records,
        CAST(SUM(CASE WHEN {event} THEN 1 ELSE 0 END) AS BIGINT) AS {count},
        ROUND(SUM(CASE WHEN {event} THEN 1 ELSE 0 END) / COUNT(*), 4) AS {share}
        FROM {table} GROUP BY {keys}"""


def _composite(table: str) -> str:
    return f"""SELECT *, offline_count + unauthorized_count AS total_risk_events,
        ROUND((offline_count + unauthorized_count) / total_records, 4) AS risk_score
        FROM (SELECT zone, shift, COUNT(*) AS total_records,
              COUNT(*) FILTER (WHERE {OFFLINE}) AS offline_count,
              COUNT(*) FILTER (WHERE {UNAUTHORIZED}) AS unauthorized_count
              FROM {table} GROUP BY zone, shift)"""


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _rates_over(keys: tuple[str, ...]) -> str:
    columns = ", ".join(
        name if name in keys else f"CAST(NULL AS VARCHAR) AS {name}"
        for name in ("forklift_id", "zone", "shift")
    )
    return f"""SELECT '{"+".join(keys)}' AS "grouping", {columns},
        COUNT(*) AS total_records,
        COUNT(*) FILTER (WHERE {OFFLINE}) AS offline_count,
        COUNT(*) FILTER (WHERE {UNAUTHORIZED}) AS unauthorized_count,
        COUNT(*) FILTER (WHERE {DOWN}) AS downtime_count
        FROM telemetry GROUP BY {", ".join(keys)}"""


LABELS = ("shift", "status", "downtime_category", "visible", "mov", "occ", "zone")
COLUMNS = (
    "timestamp", "date", "day_index", "forklift_id", "anchor", "zone", "shift", "rssi",
    "visible", "mov", "occ", "status", "downtime_category",
)
LOGIC = {
    "offline_but_visible": "status = 'offline' AND visible = 1",
    "hidden_with_signal": "visible = 0 AND rssi <> 0",
    "moving_unoccupied": "mov = 1 AND occ = 0",
}
DOMAIN = {
    "shift": "shift NOT IN ('morning', 'afternoon', 'night')",
    "status": "status NOT IN ('online', 'offline')",
    "forklift_id": "NOT starts_with(forklift_id, 'FL_')",
}

PER_DAY = """SELECT day_index, {n} * COUNT(*) AS record_count,
    CAST({n} * SUM(rssi) AS BIGINT) AS rssi_sum,
    CAST(MIN("timestamp") AS VARCHAR) AS first_timestamp,
    CAST(MAX("timestamp") AS VARCHAR) AS last_timestamp,
    {n} * COUNT(downtime_category) AS categorised
    FROM telemetry GROUP BY day_index"""

BROKEN = "event_id % 37 = 0 OR event_id % 41 = 0"

SHARD = "CAST(CAST('0x' || substr(md5(forklift_id), 1, 8) AS BIGINT) % 2 AS INTEGER)"

EXPECTED = f"""expected AS (
    SELECT forklift_id, shift, offline,
        active / (((active + idle) + available) + abnormal) AS active,
        idle / (((active + idle) + available) + abnormal) AS idle,
        available / (((active + idle) + available) + abnormal) AS available,
        abnormal / (((active + idle) + available) + abnormal) AS abnormal
    FROM (
        SELECT p.forklift_id, m.shift,
            greatest(CAST(m.active AS DOUBLE) + CAST(CASE usage_level WHEN 'high' THEN 0.10
                WHEN 'low' THEN -0.08 ELSE 0 END AS DOUBLE), 0.0) AS active,
            greatest(CAST(m.idle AS DOUBLE) + CAST(CASE usage_level WHEN 'high' THEN 0.03
                WHEN 'low' THEN -0.02 ELSE 0 END AS DOUBLE), 0.0) AS idle,
            greatest(CAST(m.available AS DOUBLE) + CAST(CASE usage_level WHEN 'high' THEN -0.10
                WHEN 'low' THEN 0.08 ELSE 0 END AS DOUBLE) + CAST(CASE risk_level
                WHEN 'high' THEN -0.02 ELSE 0 END AS DOUBLE), 0.0) AS available,
            greatest(CAST(m.abnormal AS DOUBLE) + CAST(CASE usage_level WHEN 'high' THEN 0.03
                WHEN 'low' THEN -0.02 ELSE 0 END AS DOUBLE) + CAST(CASE risk_level
                WHEN 'high' THEN 0.03 WHEN 'medium' THEN 0.01 ELSE 0 END AS DOUBLE), 0.0)
                AS abnormal,
            CAST(m.offline AS DOUBLE) + CAST(CASE risk_level WHEN 'high' THEN 0.005
                ELSE 0 END AS DOUBLE) AS offline
        FROM {PROFILES}, (VALUES ('morning', 0.50, 0.25, 0.20, 0.05, 0.02),
            ('afternoon', 0.40, 0.30, 0.25, 0.05, 0.03),
            ('night', 0.15, 0.15, 0.62, 0.08, 0.06))
            AS m(shift, active, idle, available, abnormal, offline)))"""

RESULT_ROWS = {
    "category_counts": ("SELECT COUNT(DISTINCT downtime_category) FROM telemetry", 2),
    "shift_counts": ("SELECT COUNT(DISTINCT shift) FROM telemetry", 2),
    "zone_counts": ("SELECT COUNT(DISTINCT zone) FROM telemetry", 2),
    "status_counts": ("SELECT COUNT(DISTINCT status) FROM telemetry", 2),
    "avg_rssi_by_zone": ("SELECT COUNT(DISTINCT zone) FROM telemetry WHERE visible = 1", 2),
    "active_work_by_forklift": (
        "SELECT COUNT(DISTINCT forklift_id) FROM telemetry WHERE downtime_category = 'active_work'",
        2,
    ),
    "unauthorized_by_forklift": (
        "SELECT COUNT(DISTINCT forklift_id) FROM telemetry WHERE mov = 1 AND occ = 0",
        2,
    ),
    "spark_sql_zone_shift_summary": (
        "SELECT COUNT(DISTINCT (zone, shift)) FROM telemetry WHERE visible = 1",
        4,
    ),
    "spark_sql_offline_summary": (
        "SELECT COUNT(DISTINCT shift) FROM telemetry WHERE status = 'offline'",
        2,
    ),
    "predict_downtime_by_forklift": ("SELECT COUNT(DISTINCT forklift_id) FROM telemetry", 4),
    "predict_offline_risk": ("SELECT COUNT(DISTINCT (forklift_id, shift)) FROM telemetry", 5),
    "predict_unauthorized_risk": ("SELECT COUNT(DISTINCT (forklift_id, shift)) FROM telemetry", 5),
    "predict_composite_risk_zone_shift": (
        "SELECT COUNT(DISTINCT (zone, shift)) FROM telemetry",
        7,
    ),
    "predict_zone_risk": ("SELECT COUNT(DISTINCT zone) FROM telemetry", 4),
    "predict_shift_risk": ("SELECT COUNT(DISTINCT shift) FROM telemetry", 4),
}

RATE_KEYS = (
    ("forklift_id", "shift"), ("zone", "shift"), ("forklift_id",), ("zone",), ("shift",)
)

CLEAN = {
    "derive_shift": "SELECT event_id, shift FROM telemetry",
    "derive_zone": "SELECT event_id, anchor, zone FROM telemetry",
    "derive_day_index": 'SELECT event_id, CAST("date" AS VARCHAR) AS "date", day_index FROM telemetry',
    "classify_downtime": "SELECT event_id, downtime_category FROM telemetry",
    "record_keys": """SELECT event_id,
        forklift_id || '_' || strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS _id FROM telemetry""",
    "zone_anchors": """SELECT zone, string_agg(DISTINCT anchor, ',' ORDER BY anchor) AS anchors
        FROM telemetry GROUP BY zone""",
    "category_counts": _count("downtime_category"),
    "shift_counts": _count("shift"),
    "shift_counts_by_size": _count("shift"),
    "zone_counts": _count("zone"),
    "status_counts": _count("status"),
    "flag_counts": _union(
        [
            f"SELECT '{f}' AS flag, {f} AS value, COUNT(*) AS \"count\" FROM telemetry GROUP BY {f}"
            for f in ("visible", "mov", "occ")
        ]
    ),
    "active_work_by_forklift": _count("forklift_id", "downtime_category = 'active_work'"),
    "unauthorized_by_forklift_flags": _count("forklift_id", "mov = 1 AND occ = 0"),
    "unauthorized_by_forklift_category": _count("forklift_id", UNAUTHORIZED),
    "offline_summary": _count("shift", OFFLINE, "offline_count"),
    "offline_by_shift_ranked": _count("shift", OFFLINE, "offline_count"),
    "shift_status_counts": _count("shift, status", name="cnt"),
    "record_count": "SELECT COUNT(*) AS total_records FROM telemetry",
    "status_totals": f"""SELECT
        (SELECT COUNT(*) FROM telemetry WHERE downtime_category = 'active_work')
            AS active_work_count,
        (SELECT COUNT(*) FROM telemetry WHERE {UNAUTHORIZED}) AS unauthorized_count,
        (SELECT COUNT(*) FROM telemetry WHERE {OFFLINE}) AS offline_count""",
    "distinct_values": _union(
        [
            f"""SELECT DISTINCT '{c}' AS "column", CAST({c} AS VARCHAR) AS value
            FROM telemetry WHERE {c} IS NOT NULL"""
            for c in ("status", "downtime_category", "shift", "day_index")
        ]
    ),
    "avg_rssi_by_zone": """SELECT zone, AVG(rssi) AS avg_rssi FROM telemetry
        WHERE visible = 1 GROUP BY zone""",
    "zone_shift_summary": """SELECT zone, shift, COUNT(*) AS record_count,
        ROUND(AVG(rssi), 2) AS avg_rssi FROM telemetry WHERE visible = 1 GROUP BY zone, shift""",
    "unauthorized_spread": f"""SELECT MIN(n) AS min_count, MAX(n) AS max_count,
        ROUND(stddev_samp(n), 6) AS std_count
        FROM (SELECT COUNT(*) AS n FROM telemetry WHERE {UNAUTHORIZED} GROUP BY forklift_id)""",
    "offline_risk_by_forklift_shift": _rate(
        "forklift_id, shift", OFFLINE, "offline_count", "offline_risk"
    ),
    "unauthorized_risk_by_forklift_shift": _rate(
        "forklift_id, shift", UNAUTHORIZED, "unauthorized_count", "unauthorized_risk"
    ),
    "offline_risk_by_zone_shift": _rate("zone, shift", OFFLINE, "offline_count", "offline_risk"),
    "offline_prediction_sql": _rate(
        "forklift_id, shift", OFFLINE, "offline_count", "predicted_offline_risk"
    ),
    "downtime_by_forklift": _rate("forklift_id", DOWN, "downtime_count", "downtime_rate"),
    "predict_offline_risk": _rate("forklift_id, shift", OFFLINE, "offline_count", "offline_rate"),
    "predict_unauthorized_risk": _rate(
        "forklift_id, shift", UNAUTHORIZED, "unauthorized_count", "unauthorized_rate"
    ),
    "composite_risk_zone_shift": _composite("telemetry"),
    "zone_risk": _rate("zone", OFFLINE, "offline_count", "offline_rate"),
    "shift_risk": _rate("shift", OFFLINE, "offline_count", "offline_rate"),
    "all_rates": f"""SELECT *, offline_count + unauthorized_count AS total_risk_events,
        ROUND(offline_count / total_records, 4) AS offline_rate,
        ROUND(unauthorized_count / total_records, 4) AS unauthorized_rate,
        ROUND(downtime_count / total_records, 4) AS downtime_rate,
        ROUND((offline_count + unauthorized_count) / total_records, 4) AS risk_score
        FROM ({_union([_rates_over(keys) for keys in RATE_KEYS])})""",
    "shift_status_crosstab": f"""SELECT shift, COUNT(*) FILTER (WHERE {OFFLINE}) AS offline,
        COUNT(*) FILTER (WHERE status = 'online') AS online FROM telemetry GROUP BY shift""",
    "shift_status_crosstab_normalized": f"""SELECT shift,
        COUNT(*) FILTER (WHERE {OFFLINE}) / COUNT(*) AS offline,
        COUNT(*) FILTER (WHERE status = 'online') / COUNT(*) AS online
        FROM telemetry GROUP BY shift""",
    "composite_risk_matrix": f"""SELECT zone,
        MAX(risk_score) FILTER (WHERE shift = 'morning') AS morning,
        MAX(risk_score) FILTER (WHERE shift = 'afternoon') AS afternoon,
        MAX(risk_score) FILTER (WHERE shift = 'night') AS night
        FROM ({_composite("telemetry")}) GROUP BY zone""",
    "top_unauthorized_forklifts": _count("forklift_id", UNAUTHORIZED)
    + ' ORDER BY "count" DESC, forklift_id LIMIT 5',
    "top_forklifts_by_records": _count("forklift_id")
    + ' ORDER BY "count" DESC, forklift_id LIMIT 5',
    "first_records_by_forklift": """SELECT CAST("timestamp" AS VARCHAR) AS "timestamp",
        CAST("date" AS VARCHAR) AS "date", * EXCLUDE ("timestamp", "date", event_id, off)
        FROM telemetry ORDER BY forklift_id, telemetry."timestamp", event_id LIMIT 5""",
    "top3_downtime": _rate("forklift_id", DOWN, "downtime_count", "downtime_rate")
    + " ORDER BY downtime_rate DESC, forklift_id LIMIT 3",
    "top10_downtime": _rate("forklift_id", DOWN, "downtime_count", "downtime_rate")
    + " ORDER BY downtime_rate DESC, forklift_id LIMIT 10",
    "profile_enriched_counts": f"""SELECT COALESCE(usage_level, 'unknown') AS usage_level,
        COALESCE(risk_level, 'unknown') AS risk_level,
        COUNT(DISTINCT forklift_id) AS vehicles, COUNT(*) AS total_records
        FROM telemetry LEFT JOIN {PROFILES} USING (forklift_id) GROUP BY 1, 2""",
    "preferred_zone_share": f"""SELECT *,
        ROUND(preferred_records / total_records, 4) AS preferred_share,
        ROUND(candidate_records / NULLIF(eligible_records, 0), 4) AS candidate_share
        FROM (SELECT forklift_id, COUNT(*) AS total_records,
            COUNT(*) FILTER (WHERE list_contains(preferred_zones, zone)) AS preferred_records,
            COUNT(*) FILTER (WHERE len(candidates) > 0) AS eligible_records,
            COUNT(*) FILTER (WHERE list_contains(candidates, zone)) AS candidate_records
            FROM (SELECT *, list_intersect(preferred_zones, CASE
                WHEN mov = 1 AND occ = 1 THEN ['Production', 'WIP', 'Storage', 'Packing']
                WHEN mov = 0 AND occ = 1 THEN ['WIP', 'Packing', 'Storage']
                WHEN mov = 0 AND occ = 0 THEN ['Charging', 'Maintenance', 'Storage']
                ELSE ['Storage', 'Packing', 'WIP', 'Maintenance'] END) AS candidates
                FROM telemetry LEFT JOIN {PROFILES} USING (forklift_id))
            GROUP BY forklift_id)""",
    "state_mix_drift": """SELECT o.forklift_id, o.shift, o.total_records,
        ROUND(o.active / total_records - e.active, 6) AS active_drift,
        ROUND(o.idle / total_records - e.idle, 6) AS idle_drift,
        ROUND(o.available / total_records - e.available, 6) AS available_drift,
        ROUND(o.abnormal / total_records - e.abnormal, 6) AS abnormal_drift,
        ROUND(o.offline / total_records
            - (e.offline + (1 - e.offline) * (CAST(bonus AS DOUBLE) / total_records)), 6)
            AS offline_drift
        FROM (SELECT forklift_id, shift, COUNT(*) AS total_records,
            COUNT(*) FILTER (WHERE mov = 1 AND occ = 1) AS active,
            COUNT(*) FILTER (WHERE mov = 0 AND occ = 1) AS idle,
            COUNT(*) FILTER (WHERE mov = 0 AND occ = 0) AS available,
            COUNT(*) FILTER (WHERE mov = 1 AND occ = 0) AS abnormal,
            COUNT(*) FILTER (WHERE status = 'offline') AS offline,
            SUM(CASE zone WHEN 'Charging' THEN 0.010 WHEN 'Maintenance' THEN 0.015
                WHEN 'Storage' THEN 0.003 WHEN 'Packing' THEN 0.002 ELSE 0.000 END) AS bonus
            FROM telemetry GROUP BY forklift_id, shift) o
        LEFT JOIN expected e ON o.forklift_id = e.forklift_id AND o.shift = e.shift""",
    "duplicate_keys": """SELECT forklift_id || '_' || strftime("timestamp", '%Y-%m-%d %H:%M:%S')
        AS _id, COUNT(*) AS "count" FROM telemetry GROUP BY 1 HAVING COUNT(*) > 1""",
    "repeated_key_days": """SELECT forklift_id, CAST(day AS VARCHAR) AS "date", COUNT(*) AS record_count,
        COUNT(DISTINCT second) AS seconds, COUNT(*) - COUNT(DISTINCT second) AS surplus
        FROM (SELECT forklift_id, CAST("timestamp" AS DATE) AS day, date_trunc('second', "timestamp")
              AS second FROM telemetry)
        GROUP BY forklift_id, day HAVING COUNT(*) > COUNT(DISTINCT second)""",
    "cadence_completeness": """SELECT forklift_id, CAST("date" AS VARCHAR) AS "date",
        COUNT(*) AS record_count, CAST(24 AS BIGINT) AS expected_count,
        CAST(24 - COUNT(*) AS BIGINT) AS missing_count,
        ROUND(COUNT(*) / 24, 4) AS completeness
        FROM telemetry GROUP BY forklift_id, telemetry."date" """,
    "summary_document": f"""SELECT 'mongodb_summary' AS report_type,
        (SELECT COUNT(*) FROM telemetry) AS total_records,
        (SELECT COUNT(*) FROM telemetry WHERE downtime_category = 'active_work')
            AS active_work_count,
        (SELECT COUNT(*) FROM telemetry WHERE {UNAUTHORIZED}) AS unauthorized_count,
        (SELECT COUNT(*) FROM telemetry WHERE {OFFLINE}) AS offline_count,
        (SELECT string_agg(forklift_id || ':' || n, ',' ORDER BY n DESC, forklift_id)
            FROM (SELECT forklift_id, COUNT(*) AS n FROM telemetry WHERE {UNAUTHORIZED}
                  GROUP BY forklift_id ORDER BY n DESC, forklift_id LIMIT 5))
            AS top_unauthorized_forklifts,
        (SELECT string_agg(zone || ':' || n, ',' ORDER BY n DESC, zone)
            FROM (SELECT zone, COUNT(*) AS n FROM telemetry GROUP BY zone)) AS zone_counts""",
    "shard_balance": f"""SELECT shard, record_count, vehicles,
        ROUND(record_count * 2 / (SELECT COUNT(*) FROM telemetry), 4) AS load_over_mean
        FROM (SELECT {SHARD} AS shard, COUNT(*) AS record_count,
              COUNT(DISTINCT forklift_id) AS vehicles FROM telemetry GROUP BY 1)""",
    "csv_scan": PER_DAY.format(n=1),
    "parquet_scan": PER_DAY.format(n=1),
    "parquet_text_scan": PER_DAY.format(n=1),
    "csv_quarantine": f"""SELECT good.*, coalesce(rejected, 0) AS rejected
        FROM ({PER_DAY.format(n=1).replace("FROM telemetry", f"FROM telemetry WHERE NOT ({BROKEN})")}) good
        LEFT JOIN (SELECT day_index, COUNT(*) AS rejected FROM telemetry WHERE {BROKEN}
                   GROUP BY day_index) bad USING (day_index)""",
    "document_scan": PER_DAY.format(n=1),
    "full_replace_load": PER_DAY.format(n=1),
    "snapshot_load": PER_DAY.format(n=1),
    "append_load": PER_DAY.format(n=2),
    "slice_replace_load": PER_DAY.format(n=1),
    "vehicle_layout": f"SELECT {SHARD} AS shard, COUNT(*) AS record_count FROM telemetry GROUP BY 1",
    "time_layout": PER_DAY.format(n=1),
    "clustered_layout": PER_DAY.format(n=1).replace(
        "FROM telemetry", "FROM telemetry WHERE zone = 'WIP' AND shift = 'night'"
    ),
    "result_tables": _union(
        [
            f"""SELECT '{name}' AS result, ({rows}) AS "rows", {columns} AS "columns" """
            for name, (rows, columns) in RESULT_ROWS.items()
        ]
    ),
}

DAMAGED_QUERIES = {
    "signal_sentinel": """SELECT event_id, CASE WHEN visible = 0 THEN 0 ELSE rssi END AS rssi
        FROM damaged""",
    "null_counts": _union(
        [
            f"""SELECT '{c}' AS "column", COUNT(*) - COUNT("{c}") AS nulls FROM damaged"""
            for c in COLUMNS
        ]
    ),
    "value_distributions": _union(
        [
            f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, COUNT(*) AS "count"
            FROM damaged WHERE {c} IS NOT NULL GROUP BY {c}"""
            for c in LABELS
        ]
    ),
    "logic_checks": _union(
        [
            f"SELECT '{name}' AS \"check\", COUNT(*) AS violations FROM damaged WHERE {condition}"
            for name, condition in LOGIC.items()
        ]
    ),
    "domain_violations": _union(
        [
            f"SELECT '{name}' AS \"check\", COUNT(*) AS violations FROM damaged WHERE {condition}"
            for name, condition in DOMAIN.items()
        ]
    ),
    "classification_mismatch": f"""SELECT expected_category, COUNT(*) AS total_records,
        COUNT(*) FILTER (WHERE downtime_category IS DISTINCT FROM expected_category)
            AS mismatches
        FROM (SELECT *, {CATEGORY.format(visible="visible", zone="zone")} AS expected_category
              FROM damaged) GROUP BY expected_category""",
    "rssi_out_of_range": """SELECT zone, COUNT(*) AS visible_records, COUNT(*) FILTER (WHERE NOT
        CASE WHEN zone IN ('Production', 'WIP') THEN rssi BETWEEN -75 AND -50
             WHEN zone IN ('Storage', 'Packing') THEN rssi BETWEEN -85 AND -55
             WHEN zone IN ('Charging', 'Maintenance') THEN rssi BETWEEN -90 AND -60
             ELSE rssi BETWEEN -90 AND -50 END) AS out_of_range
        FROM damaged WHERE visible = 1 GROUP BY zone""",
    "zone_anchor_mismatch": f"""SELECT d.zone, COUNT(*) AS total_records,
        COUNT(*) FILTER (WHERE d.zone IS DISTINCT FROM a.zone) AS mismatches
        FROM damaged d LEFT JOIN {ANCHORS} ON d.anchor = a.anchor GROUP BY d.zone""",
    "validation_report": _union(
        [
            "SELECT 'shape' AS section, 'rows' AS metric, COUNT(*) AS value FROM damaged",
            "SELECT 'shape', 'columns', 13",
        ]
        + [
            f"SELECT 'missing_values', '{c}', COUNT(*) - COUNT(\"{c}\") FROM damaged"
            for c in COLUMNS
        ]
        + [
            f"""SELECT '{c}_distribution', CAST({c} AS VARCHAR), COUNT(*) FROM damaged
            WHERE {c} IS NOT NULL GROUP BY {c}"""
            for c in LABELS
        ]
        + [
            f"SELECT 'logical_checks', '{name}', COUNT(*) FROM damaged WHERE {condition}"
            for name, condition in LOGIC.items()
        ]
    ),
    "category_counts_damaged": """SELECT downtime_category, COUNT(*) AS "count" FROM damaged
        GROUP BY downtime_category""",
    "downtime_by_forklift_damaged": _rate(
        "forklift_id", DOWN, "downtime_count", "downtime_rate", "damaged"
    ),
    "composite_risk_zone_shift_damaged": _composite("damaged"),
    "composite_risk_matrix_observed": f"""SELECT zone,
        MAX(risk_score) FILTER (WHERE shift = 'morning') AS morning,
        MAX(risk_score) FILTER (WHERE shift = 'afternoon') AS afternoon,
        MAX(risk_score) FILTER (WHERE shift = 'night') AS night,
        MAX(risk_score) FILTER (WHERE shift = 'evening') AS evening
        FROM ({_composite("damaged")}) GROUP BY zone""",
}


VEHICLES = " UNION ALL ".join(f"SELECT 'FL_{k:02}' AS forklift_id" for k in range(1, 11))

SILENCED_QUERIES = {
    "cadence_gaps": f"""
        , heard AS (
            SELECT DISTINCT forklift_id, date_trunc('hour', "timestamp") AS hour FROM damaged
            WHERE forklift_id <> 'FL_07'
              AND NOT (forklift_id = 'FL_03' AND day_index BETWEEN 11 AND 15)
        ), everyone AS (
            SELECT forklift_id FROM heard UNION SELECT forklift_id FROM ({VEHICLES})
        ), hours AS (
            SELECT unnest(generate_series(date_trunc('day', min(hour)),
                date_trunc('day', max(hour)) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS hour FROM heard
        ), missing AS (
            SELECT forklift_id, hour,
                epoch(hour) / 3600 - row_number() OVER (PARTITION BY forklift_id ORDER BY hour) AS run
            FROM (SELECT * FROM everyone, hours) ANTI JOIN heard USING (forklift_id, hour)
        )
        SELECT forklift_id, strftime(min(hour), '%Y-%m-%d %H:%M:%S') AS first_missing,
            strftime(max(hour), '%Y-%m-%d %H:%M:%S') AS last_missing, COUNT(*) AS missing_slots
        FROM missing GROUP BY forklift_id, run""",
}


def oracle_sql() -> dict[str, str]:
    texts = {}
    for name, body in CLEAN.items():
        extra = f", {EXPECTED}" if name == "state_mix_drift" else ""
        texts[name] = f"WITH {TELEMETRY}{extra} {body}"
    for name, body in DAMAGED_QUERIES.items():
        texts[name] = f"WITH {TELEMETRY}{DAMAGED} {body}"
    for name, body in SILENCED_QUERIES.items():
        texts[name] = f"WITH {TELEMETRY}{DAMAGED}{body}"
    return texts
