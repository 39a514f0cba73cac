"""Independent SQL oracle (DuckDB dialect) for every SQL-checkable query.

Each statement is self-contained: ``WITH <adapter>, <models> SELECT ...``
over the driver's pre-registered views.  The model CTEs restate the
reference semantics directly in SQL (joins, ``lag``, ``date_diff``), with
the documented determinism rules: ``event_id`` breaks timestamp ties, hour
sums and means are taken over integer minutes, money sums are
DECIMAL(38,2), means and percentages are DOUBLE, integer sums BIGINT.
"""

from __future__ import annotations

import re

ADAPTER = """
n_sup AS (SELECT count(*) AS n FROM supplier),
raw_facilities AS (
    SELECT CAST(s.s_suppkey AS BIGINT) AS facility_id,
           s.s_name AS facility_name,
           CASE s.s_suppkey % 3 WHEN 0 THEN 'National Hub' WHEN 1 THEN 'Regional' ELSE 'Local Branch' END
               AS facility_type,
           nn.n_name AS city,
           CAST(2 + s.s_suppkey % 5 AS BIGINT) AS max_capacity_per_day
    FROM supplier s JOIN nation nn ON s.s_nationkey = nn.n_nationkey
),
raw_shipments AS (
    SELECT CAST(o.o_orderkey AS VARCHAR) AS shipment_id,
           CAST(o.o_custkey AS BIGINT) AS sender_id,
           CAST(o.o_orderkey % (c.n + 1) AS BIGINT) AS origin_facility_id,
           CAST((o.o_orderkey * 7 + 3) % c.n AS BIGINT) AS destination_facility_id,
           CAST(((o.o_orderkey * 37) % 3000) / CAST(100 AS DOUBLE) AS DECIMAL(5,2)) AS weight_kg,
           CAST(o.o_totalprice AS DECIMAL(10,2)) AS declared_value,
           CAST(40 + ((o.o_orderkey * 37) % 3000) * CAST(0.15 AS DOUBLE) AS DECIMAL(10,2)) AS shipping_cost,
           TIMESTAMP '2024-01-01 00:00:00' + ((o.o_orderkey * 7919) % 43200) * INTERVAL '1' MINUTE AS created_at,
           CAST(TIMESTAMP '2024-01-01 00:00:00' + ((o.o_orderkey * 7919) % 43200) * INTERVAL '1' MINUTE AS DATE)
               + CAST(1 + o.o_orderkey % 7 AS INTEGER) AS estimated_delivery_date
    FROM orders o CROSS JOIN n_sup c
),
raw_tracking_events AS (
    SELECT CAST(e.event_id AS VARCHAR) AS event_id,
           CAST(e.event_id // 5 AS VARCHAR) AS shipment_id,
           CAST(CASE e.event_type
                    WHEN 'signup' THEN 10 WHEN 'click' THEN 20 WHEN 'view' THEN 30 WHEN 'purchase' THEN 50
                    WHEN 'error' THEN CASE e.event_id % 3 WHEN 0 THEN 60 WHEN 1 THEN 70 ELSE 80 END
                END AS INTEGER) AS status_code,
           CAST(CASE WHEN e.event_id % 9 = 0 THEN NULL ELSE e.event_id % c.n END AS INTEGER) AS facility_id,
           strftime(e.ts, '%Y-%m-%dT%H:%M:%SZ') AS event_timestamp,
           CASE e.event_id % 12
               WHEN 4 THEN 'Customer not at home' WHEN 5 THEN 'Signature collected'
               WHEN 6 THEN 'Left at front desk' WHEN 7 THEN 'Weather delay' WHEN 8 THEN 'Weather delay'
           END AS courier_notes,
           'events_' || strftime(e.ts, '%Y-%m-%d_%H') || '.json' AS source_file
    FROM events e CROSS JOIN n_sup c
),
raw_weather_base AS (
    SELECT dd.d AS date,
           nn.n_name AS city,
           CASE (day(dd.d) + nn.n_nationkey) % 8
               WHEN 0 THEN 'Clear' WHEN 1 THEN 'Cloudy' WHEN 2 THEN 'Light Rain' WHEN 3 THEN 'Heavy Rain'
               WHEN 4 THEN 'Thunderstorm' WHEN 5 THEN 'Light Snow' WHEN 6 THEN 'Heavy Snow' WHEN 7 THEN 'Fog'
           END AS weather_condition,
           CAST((day(dd.d) * 7 + nn.n_nationkey * 3) % 40 AS DOUBLE) AS precipitation_mm
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) dd CROSS JOIN nation nn
),
raw_weather AS (
    SELECT date, city, weather_condition, precipitation_mm,
           (weather_condition IN ('Heavy Rain', 'Heavy Snow', 'Thunderstorm') AND precipitation_mm > 10)
               AS regional_delay_flag
    FROM raw_weather_base
),
status_codes_mapping AS (
    SELECT * FROM (VALUES
        (10, 'Label Created', false, false),
        (20, 'Picked Up', false, false),
        (30, 'Arrived At Hub', false, false),
        (35, 'Departed Hub', false, false),
        (40, 'Out For Delivery', false, false),
        (50, 'Delivered', true, false),
        (60, 'Delivery Failed', false, true),
        (70, 'Damaged', true, true),
        (80, 'Lost', true, true)
    ) AS t(status_code, status_name, is_final_state, is_exception)
)"""

MODELS = """
stg_facilities AS (
    SELECT facility_id, facility_name, facility_type, city, max_capacity_per_day FROM raw_facilities
),
stg_shipments AS (
    SELECT shipment_id, sender_id, origin_facility_id, destination_facility_id, weight_kg, declared_value,
           shipping_cost, CAST(created_at AS TIMESTAMP) AS created_at_ts, estimated_delivery_date
    FROM raw_shipments
),
stg_tracking_events AS (
    SELECT event_id, shipment_id, status_code, facility_id, CAST(event_timestamp AS TIMESTAMP) AS event_timestamp_ts,
           courier_notes, source_file
    FROM raw_tracking_events
),
stg_weather_delays AS (
    SELECT date AS weather_date, city, weather_condition, precipitation_mm, regional_delay_flag FROM raw_weather
),
int_shipments_enriched AS (
    SELECT s.shipment_id, s.sender_id,
           s.origin_facility_id, o.facility_name AS origin_facility_name, o.city AS origin_city,
           s.destination_facility_id, d.facility_name AS destination_facility_name, d.city AS destination_city,
           s.weight_kg, s.declared_value, s.shipping_cost, s.created_at_ts, s.estimated_delivery_date
    FROM stg_shipments s
    LEFT JOIN stg_facilities o ON s.origin_facility_id = o.facility_id
    LEFT JOIN stg_facilities d ON s.destination_facility_id = d.facility_id
),
windowed_tracking AS (
    SELECT t.event_id, t.shipment_id, t.status_code, s.status_name, s.is_exception, t.facility_id,
           t.event_timestamp_ts, t.courier_notes,
           lag(t.event_timestamp_ts) OVER (
               PARTITION BY t.shipment_id
               ORDER BY t.event_timestamp_ts ASC NULLS LAST, t.event_id ASC NULLS LAST
           ) AS previous_event_timestamp_ts
    FROM stg_tracking_events t LEFT JOIN status_codes_mapping s ON t.status_code = s.status_code
),
int_tracking_with_lag AS (
    SELECT *,
           CAST(date_diff('minute', previous_event_timestamp_ts, event_timestamp_ts) AS DOUBLE) / 60.0
               AS hours_since_last_event,
           date_diff('minute', previous_event_timestamp_ts, event_timestamp_ts) AS minutes_since_last_event
    FROM windowed_tracking
),
mart_exceptions_analysis AS (
    SELECT t.event_id, t.shipment_id, s.origin_city, s.destination_city,
           t.status_name AS exception_type, t.event_timestamp_ts AS exception_time,
           t.courier_notes, s.declared_value AS potential_financial_loss
    FROM int_tracking_with_lag t JOIN int_shipments_enriched s ON t.shipment_id = s.shipment_id
    WHERE t.is_exception = true
),
lifecycle_full AS (
    SELECT s.shipment_id, s.origin_city, s.destination_city, s.weight_kg, s.shipping_cost,
           count(t.event_id) AS total_tracking_events,
           sum(t.minutes_since_last_event) AS total_transit_minutes,
           bool_or(t.is_exception) AS had_exception
    FROM int_shipments_enriched s LEFT JOIN int_tracking_with_lag t ON s.shipment_id = t.shipment_id
    GROUP BY 1, 2, 3, 4, 5
),
mart_route_performance AS (
    SELECT origin_city, destination_city,
           count(shipment_id) AS total_shipments,
           (CAST(sum(total_transit_minutes) AS DOUBLE) / count(total_transit_minutes)) / 60.0 AS avg_transit_hours,
           CAST(sum(CASE WHEN had_exception THEN 1 ELSE 0 END) AS BIGINT) AS exception_count
    FROM lifecycle_full
    GROUP BY 1, 2
),
mart_daily_revenue_summary AS (
    SELECT CAST(created_at_ts AS DATE) AS shipment_date,
           count(shipment_id) AS total_shipments,
           CAST(sum(shipping_cost) AS DECIMAL(38,2)) AS total_revenue,
           CAST(sum(weight_kg) AS DECIMAL(38,2)) AS total_weight_kg
    FROM int_shipments_enriched
    GROUP BY 1
),
mart_facility_traffic AS (
    SELECT f.facility_id, f.facility_name, f.city,
           count(t.event_id) AS total_scans,
           count(DISTINCT t.shipment_id) AS unique_shipments_handled
    FROM stg_facilities f LEFT JOIN int_tracking_with_lag t ON f.facility_id = t.facility_id
    GROUP BY 1, 2, 3
),
mart_weight_brackets_pricing AS (
    SELECT CASE WHEN weight_kg < 5.0 THEN 'Light (<5kg)'
                WHEN weight_kg < 15.0 THEN 'Medium (5-15kg)'
                ELSE 'Heavy (>15kg)' END AS weight_bracket,
           count(shipment_id) AS shipment_count,
           CAST(sum(shipping_cost) AS DOUBLE) / count(shipping_cost) AS avg_cost_per_shipment
    FROM int_shipments_enriched
    GROUP BY 1
)"""

PREFIX = "WITH " + ADAPTER.strip() + ",\n" + MODELS.strip() + "\n"

FINAL: dict[str, str] = {
    # ---------------------------------------------------------------- sources
    "scan_facilities": "SELECT facility_id, facility_name, facility_type, city, max_capacity_per_day FROM raw_facilities",
    "scan_shipments": """SELECT shipment_id, sender_id, origin_facility_id, destination_facility_id, weight_kg,
        declared_value, shipping_cost, created_at, estimated_delivery_date FROM raw_shipments""",
    "scan_shipments_incremental": """SELECT shipment_id, sender_id, origin_facility_id, destination_facility_id,
        weight_kg, declared_value, shipping_cost, created_at, estimated_delivery_date
        FROM raw_shipments WHERE created_at > TIMESTAMP '2024-01-25 00:00:00'""",
    "shipments_high_water_mark": "SELECT max(created_at) AS high_water_mark FROM raw_shipments",
    "hub_facilities": """SELECT facility_id, facility_name, facility_type FROM raw_facilities
        WHERE facility_type IN ('National Hub', 'Regional')""",
    "shipments_ordered": """SELECT shipment_id, origin_facility_id, destination_facility_id, created_at
        FROM raw_shipments ORDER BY created_at, shipment_id""",
    "new_files_antijoin": """SELECT f.file_name FROM (SELECT DISTINCT source_file AS file_name FROM raw_tracking_events) f
        WHERE NOT EXISTS (
            SELECT 1 FROM raw_tracking_events l
            WHERE CAST(l.event_timestamp AS TIMESTAMP) < TIMESTAMP '2024-01-15 00:00:00'
              AND l.source_file = f.file_name)""",
    # ------------------------------------------------------- staging / int
    "stg_facilities": "SELECT * FROM stg_facilities",
    "stg_shipments": "SELECT * FROM stg_shipments",
    "stg_tracking_events": "SELECT * FROM stg_tracking_events",
    "stg_weather_delays": "SELECT * FROM stg_weather_delays",
    "int_shipments_enriched": "SELECT * FROM int_shipments_enriched",
    "int_tracking_with_lag": """SELECT event_id, shipment_id, status_code, status_name, is_exception, facility_id,
        event_timestamp_ts, courier_notes, previous_event_timestamp_ts, hours_since_last_event
        FROM int_tracking_with_lag""",
    # ------------------------------------------------------------------ marts
    "mart_courier_issues_summary": """SELECT courier_notes, count(event_id) AS frequency_count
        FROM int_tracking_with_lag WHERE courier_notes IS NOT NULL GROUP BY 1 ORDER BY frequency_count DESC""",
    "mart_daily_active_network": """SELECT CAST(event_timestamp_ts AS DATE) AS network_date,
        count(DISTINCT facility_id) AS active_facilities_count
        FROM int_tracking_with_lag WHERE facility_id IS NOT NULL GROUP BY 1""",
    "mart_daily_revenue_summary": "SELECT * FROM mart_daily_revenue_summary",
    "mart_delivery_performance": """SELECT s.shipment_id, s.estimated_delivery_date,
        CAST(d.actual_delivery_time AS DATE) AS actual_delivery_date,
        CASE WHEN CAST(d.actual_delivery_time AS DATE) <= s.estimated_delivery_date THEN true ELSE false END AS is_on_time
        FROM int_shipments_enriched s
        JOIN (SELECT shipment_id, event_timestamp_ts AS actual_delivery_time FROM int_tracking_with_lag
              WHERE status_code = 50) d ON s.shipment_id = d.shipment_id""",
    "mart_exceptions_analysis": "SELECT * FROM mart_exceptions_analysis",
    "mart_facility_bottlenecks": """SELECT f.facility_name, f.city,
        (CAST(sum(t.minutes_since_last_event) AS DOUBLE) / count(t.minutes_since_last_event)) / 60.0 AS avg_hours_delayed
        FROM stg_facilities f JOIN int_tracking_with_lag t ON f.facility_id = t.facility_id
        WHERE t.hours_since_last_event IS NOT NULL GROUP BY 1, 2 ORDER BY avg_hours_delayed DESC""",
    "mart_facility_capacity_utilization": """SELECT f.facility_name, f.city,
        CAST(t.event_timestamp_ts AS DATE) AS scan_date, count(t.event_id) AS daily_scans, f.max_capacity_per_day,
        CAST(count(t.event_id) AS DOUBLE) * 100.0 / CAST(f.max_capacity_per_day AS DOUBLE) AS utilization_pct
        FROM stg_facilities f JOIN int_tracking_with_lag t ON f.facility_id = t.facility_id
        GROUP BY 1, 2, 3, 5""",
    "mart_facility_traffic": "SELECT * FROM mart_facility_traffic",
    "mart_financial_exposure": """SELECT origin_city, exception_type, count(shipment_id) AS lost_or_damaged_count,
        CAST(sum(potential_financial_loss) AS DECIMAL(38,2)) AS total_financial_exposure
        FROM mart_exceptions_analysis WHERE exception_type IN ('Lost', 'Damaged') GROUP BY 1, 2""",
    "mart_route_performance": "SELECT * FROM mart_route_performance",
    "mart_shipment_lifecycle": """SELECT shipment_id, origin_city, destination_city, weight_kg, shipping_cost,
        total_tracking_events, CAST(total_transit_minutes AS DOUBLE) / 60.0 AS total_transit_time_hours, had_exception
        FROM lifecycle_full""",
    "mart_weather_impact": """SELECT w.weather_date, w.city, w.weather_condition, w.regional_delay_flag,
        count(t.event_id) AS total_scans,
        CAST(sum(CASE WHEN t.is_exception THEN 1 ELSE 0 END) AS BIGINT) AS exception_count
        FROM stg_weather_delays w
        LEFT JOIN stg_facilities f ON w.city = f.city
        LEFT JOIN int_tracking_with_lag t ON f.facility_id = t.facility_id
             AND CAST(t.event_timestamp_ts AS DATE) = w.weather_date
        GROUP BY 1, 2, 3, 4""",
    "mart_weight_brackets_pricing": "SELECT * FROM mart_weight_brackets_pricing",
    # ---------------------------------------------------------------- reports
    "report_daily_revenue": "SELECT shipment_date, total_revenue FROM mart_daily_revenue_summary ORDER BY shipment_date",
    "report_top_routes": """SELECT route, total_shipments FROM (
        SELECT origin_city || ' -> ' || destination_city AS route, total_shipments, origin_city, destination_city
        FROM mart_route_performance
        ORDER BY total_shipments DESC, route ASC NULLS LAST, origin_city ASC NULLS LAST,
                 destination_city ASC NULLS LAST
        LIMIT 10)""",
    "report_top_facilities": """SELECT facility_name, total_scans FROM (
        SELECT facility_name, total_scans, facility_id FROM mart_facility_traffic
        ORDER BY total_scans DESC, facility_name ASC NULLS LAST, facility_id ASC LIMIT 10)""",
    "report_exceptions_breakdown": """SELECT exception_type, count(event_id) AS cnt,
        CAST(count(event_id) AS DOUBLE) * 100.0 / CAST(sum(count(event_id)) OVER () AS DOUBLE) AS share_pct
        FROM mart_exceptions_analysis GROUP BY exception_type""",
    "report_weight_pricing": "SELECT weight_bracket, avg_cost_per_shipment FROM mart_weight_brackets_pricing",
    # ------------------------------------------------------ scalar rules
    "event_hour_bucket": """SELECT substr(event_timestamp, 1, 10) || '_' || substr(event_timestamp, 12, 2) AS hour_bucket,
        count(*) AS event_count FROM raw_tracking_events GROUP BY 1""",
    # ---------------------------------------------------------- data quality
    "dq_unique": """
        SELECT 'stg_facilities' AS table_name, 'facility_id' AS column_name,
               CAST(facility_id AS VARCHAR) AS key_value, count(*) AS occurrences
        FROM stg_facilities WHERE facility_id IS NOT NULL GROUP BY facility_id HAVING count(*) > 1
        UNION ALL
        SELECT 'stg_shipments', 'shipment_id', shipment_id, count(*)
        FROM stg_shipments WHERE shipment_id IS NOT NULL GROUP BY shipment_id HAVING count(*) > 1
        UNION ALL
        SELECT 'stg_tracking_events', 'event_id', event_id, count(*)
        FROM stg_tracking_events WHERE event_id IS NOT NULL GROUP BY event_id HAVING count(*) > 1""",
    "dq_not_null": """
        SELECT 'stg_facilities' AS table_name, 'facility_id' AS column_name,
               count(*) FILTER (WHERE facility_id IS NULL) AS failures FROM stg_facilities
        UNION ALL SELECT 'stg_shipments', 'shipment_id', count(*) FILTER (WHERE shipment_id IS NULL) FROM stg_shipments
        UNION ALL SELECT 'stg_shipments', 'origin_facility_id', count(*) FILTER (WHERE origin_facility_id IS NULL) FROM stg_shipments
        UNION ALL SELECT 'stg_shipments', 'destination_facility_id', count(*) FILTER (WHERE destination_facility_id IS NULL) FROM stg_shipments
        UNION ALL SELECT 'stg_tracking_events', 'event_id', count(*) FILTER (WHERE event_id IS NULL) FROM stg_tracking_events
        UNION ALL SELECT 'stg_tracking_events', 'shipment_id', count(*) FILTER (WHERE shipment_id IS NULL) FROM stg_tracking_events
        UNION ALL SELECT 'stg_tracking_events', 'status_code', count(*) FILTER (WHERE status_code IS NULL) FROM stg_tracking_events
        UNION ALL SELECT 'stg_weather_delays', 'weather_date', count(*) FILTER (WHERE weather_date IS NULL) FROM stg_weather_delays
        UNION ALL SELECT 'stg_weather_delays', 'city', count(*) FILTER (WHERE city IS NULL) FROM stg_weather_delays
        UNION ALL SELECT 'stg_weather_delays', 'weather_condition', count(*) FILTER (WHERE weather_condition IS NULL) FROM stg_weather_delays""",
    "dq_accepted_values": """SELECT facility_type AS value, count(*) AS n_records FROM stg_facilities
        WHERE facility_type IS NOT NULL AND facility_type NOT IN ('National Hub', 'Regional', 'Local Branch')
        GROUP BY facility_type""",
    "dq_rel_origin": """SELECT s.shipment_id, s.origin_facility_id FROM stg_shipments s
        WHERE s.origin_facility_id IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM stg_facilities f WHERE f.facility_id = s.origin_facility_id)""",
    "dq_rel_destination": """SELECT s.shipment_id, s.destination_facility_id FROM stg_shipments s
        WHERE s.destination_facility_id IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM stg_facilities f WHERE f.facility_id = s.destination_facility_id)""",
    "dq_rel_event_shipment": """SELECT t.event_id, t.shipment_id FROM stg_tracking_events t
        WHERE t.shipment_id IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM stg_shipments s WHERE s.shipment_id = t.shipment_id)""",
    "dq_rel_event_status": """SELECT t.event_id, t.status_code FROM stg_tracking_events t
        WHERE t.status_code IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM status_codes_mapping c WHERE c.status_code = t.status_code)""",
}

FINAL["dq_summary"] = """
    SELECT 'stg_facilities' AS table_name, 'facility_id' AS column_name, 'unique' AS test_name,
           (SELECT count(*) FROM (SELECT facility_id FROM stg_facilities WHERE facility_id IS NOT NULL
                                  GROUP BY facility_id HAVING count(*) > 1)) AS failures
    UNION ALL SELECT 'stg_shipments', 'shipment_id', 'unique',
           (SELECT count(*) FROM (SELECT shipment_id FROM stg_shipments WHERE shipment_id IS NOT NULL
                                  GROUP BY shipment_id HAVING count(*) > 1))
    UNION ALL SELECT 'stg_tracking_events', 'event_id', 'unique',
           (SELECT count(*) FROM (SELECT event_id FROM stg_tracking_events WHERE event_id IS NOT NULL
                                  GROUP BY event_id HAVING count(*) > 1))
    UNION ALL SELECT table_name, column_name, 'not_null', failures FROM (""" + FINAL["dq_not_null"] + """)
    UNION ALL SELECT 'stg_facilities', 'facility_type', 'accepted_values',
           (SELECT count(*) FROM (""" + FINAL["dq_accepted_values"] + """))
    UNION ALL SELECT 'stg_shipments', 'origin_facility_id', 'relationships',
           (SELECT count(*) FROM (""" + FINAL["dq_rel_origin"] + """))
    UNION ALL SELECT 'stg_shipments', 'destination_facility_id', 'relationships',
           (SELECT count(*) FROM (""" + FINAL["dq_rel_destination"] + """))
    UNION ALL SELECT 'stg_tracking_events', 'shipment_id', 'relationships',
           (SELECT count(*) FROM (""" + FINAL["dq_rel_event_shipment"] + """))
    UNION ALL SELECT 'stg_tracking_events', 'status_code', 'relationships',
           (SELECT count(*) FROM (""" + FINAL["dq_rel_event_status"] + """))"""


# The same assertions over staging rows with planted violations.
_PLANTED = """WITH planted_facilities AS (
    SELECT * REPLACE (CASE WHEN facility_id % 7 = 0 THEN 'Depot' ELSE facility_type END AS facility_type)
    FROM (SELECT * FROM stg_facilities UNION ALL SELECT * FROM stg_facilities WHERE facility_id % 11 = 0)),
planted_shipments AS (
    SELECT * REPLACE (CASE WHEN CAST(shipment_id AS BIGINT) % 17 = 0 THEN 999999999
                           ELSE destination_facility_id END AS destination_facility_id)
    FROM (SELECT * FROM stg_shipments UNION ALL
          SELECT * FROM stg_shipments WHERE CAST(shipment_id AS BIGINT) % 13 = 0)),
planted_tracking_events AS (
    SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 19 = 0 THEN 'missing-' || event_id ELSE shipment_id END AS shipment_id,
                      CAST(CASE WHEN CAST(event_id AS BIGINT) % 23 = 0 THEN 99 ELSE status_code END AS INTEGER) AS status_code)
    FROM (SELECT * FROM stg_tracking_events UNION ALL
          SELECT * FROM stg_tracking_events WHERE CAST(event_id AS BIGINT) % 29 = 0))
"""
for _key in ("dq_unique", "dq_accepted_values", "dq_rel_destination", "dq_rel_event_shipment", "dq_rel_event_status"):
    _body = re.sub(r"(?<!')\bstg_(facilities|shipments|tracking_events)\b(?!')", r"planted_\1", FINAL[_key])
    FINAL[f"{_key}_planted"] = f"SELECT * FROM ({_PLANTED}{_body})"


# Round trips whose result must reproduce a relation exactly.
_RAW_RECORDS = """SELECT event_id, shipment_id, status_code, facility_id, event_timestamp, courier_notes
    FROM raw_tracking_events"""
FINAL["scan_tracking_json"] = _RAW_RECORDS
FINAL["json_schema_backfill"] = _RAW_RECORDS
FINAL["stream_ingest_events"] = _RAW_RECORDS
FINAL["full_refresh_events"] = _RAW_RECORDS
FINAL["stream_full_refresh"] = _RAW_RECORDS
FINAL["json_provenance"] = """SELECT source_file, count(*) AS event_count
    FROM raw_tracking_events GROUP BY 1"""
FINAL["export_hourly_json"] = """SELECT substr(source_file, 8, 13) AS hour_bucket, count(*) AS row_count,
    min(event_timestamp) AS first_ts, max(event_timestamp) AS last_ts, TRUE AS is_sorted
    FROM raw_tracking_events GROUP BY 1"""
FINAL["warehouse_shipments"] = "SELECT * FROM raw_shipments"
FINAL["ingest_ledger"] = """SELECT source_file AS file_name, CAST(count(*) AS INTEGER) AS row_count
    FROM raw_tracking_events GROUP BY 1"""
FINAL["stream_ledger"] = FINAL["ingest_ledger"]
FINAL["int_tracking_with_lag_hot"] = """SELECT event_id, facility_id, event_timestamp_ts,
    lag(event_timestamp_ts) OVER (PARTITION BY facility_id ORDER BY event_timestamp_ts ASC NULLS LAST,
        event_id ASC NULLS LAST) AS previous_event_ts FROM stg_tracking_events"""
FINAL["scan_weather_csv"] = "SELECT date, city, weather_condition, precipitation_mm, regional_delay_flag FROM raw_weather"
FINAL["stream_exceptions"] = "SELECT * FROM mart_exceptions_analysis"
FINAL["stream_exceptions_late"] = FINAL["stream_exceptions"]
# Maintained batch by batch or stored in buckets, these must equal the rebuild.
FINAL["int_tracking_with_lag_incremental"] = FINAL["int_tracking_with_lag"]
for _key in ("mart_facility_traffic", "mart_route_performance", "mart_daily_revenue_summary"):
    FINAL[f"{_key}_incremental"] = FINAL[_key]
FINAL["mart_shipment_lifecycle_bucketed"] = FINAL["mart_shipment_lifecycle"]


def oracle_sql() -> dict[str, str]:
    return {k: PREFIX + v.strip() for k, v in FINAL.items()}
