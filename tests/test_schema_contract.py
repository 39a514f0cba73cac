"""Published output columns and types of every model (order included).

Types are the documented ones mapped to Spark, with three intended
differences: money/weight keep the declared DDL decimals (decimal(10,2),
decimal(5,2)) instead of widths narrowed by inference; HUGEINT integer sums
are bigint; TIMESTAMP is timestamp_ntz.
"""

import pytest

from parcelspark.plans import queries as Q
from tests.conftest import SF_SMALL

S, L, I, D, TS, DBL, B = "string", "bigint", "int", "date", "timestamp_ntz", "double", "boolean"
M, W, SUM = "decimal(10,2)", "decimal(5,2)", "decimal(38,2)"

CONTRACT = {
    "stg_facilities": [("facility_id", L), ("facility_name", S), ("facility_type", S), ("city", S),
                       ("max_capacity_per_day", L)],
    "stg_shipments": [("shipment_id", S), ("sender_id", L), ("origin_facility_id", L),
                      ("destination_facility_id", L), ("weight_kg", W), ("declared_value", M),
                      ("shipping_cost", M), ("created_at_ts", TS), ("estimated_delivery_date", D)],
    "stg_tracking_events": [("event_id", S), ("shipment_id", S), ("status_code", I), ("facility_id", I),
                            ("event_timestamp_ts", TS), ("courier_notes", S), ("source_file", S)],
    "stg_weather_delays": [("weather_date", D), ("city", S), ("weather_condition", S),
                           ("precipitation_mm", DBL), ("regional_delay_flag", B)],
    "int_shipments_enriched": [("shipment_id", S), ("sender_id", L), ("origin_facility_id", L),
                               ("origin_facility_name", S), ("origin_city", S), ("destination_facility_id", L),
                               ("destination_facility_name", S), ("destination_city", S), ("weight_kg", W),
                               ("declared_value", M), ("shipping_cost", M), ("created_at_ts", TS),
                               ("estimated_delivery_date", D)],
    "int_tracking_with_lag": [("event_id", S), ("shipment_id", S), ("status_code", I), ("status_name", S),
                              ("is_exception", B), ("facility_id", I), ("event_timestamp_ts", TS),
                              ("courier_notes", S), ("previous_event_timestamp_ts", TS),
                              ("hours_since_last_event", DBL)],
    "mart_courier_issues_summary": [("courier_notes", S), ("frequency_count", L)],
    "mart_daily_active_network": [("network_date", D), ("active_facilities_count", L)],
    "mart_daily_revenue_summary": [("shipment_date", D), ("total_shipments", L), ("total_revenue", SUM),
                                   ("total_weight_kg", SUM)],
    "mart_delivery_performance": [("shipment_id", S), ("estimated_delivery_date", D),
                                  ("actual_delivery_date", D), ("is_on_time", B)],
    "mart_exceptions_analysis": [("event_id", S), ("shipment_id", S), ("origin_city", S),
                                 ("destination_city", S), ("exception_type", S), ("exception_time", TS),
                                 ("courier_notes", S), ("potential_financial_loss", M)],
    "mart_facility_bottlenecks": [("facility_name", S), ("city", S), ("avg_hours_delayed", DBL)],
    "mart_facility_capacity_utilization": [("facility_name", S), ("city", S), ("scan_date", D),
                                           ("daily_scans", L), ("max_capacity_per_day", L),
                                           ("utilization_pct", DBL)],
    "mart_facility_traffic": [("facility_id", L), ("facility_name", S), ("city", S), ("total_scans", L),
                              ("unique_shipments_handled", L)],
    "mart_financial_exposure": [("origin_city", S), ("exception_type", S), ("lost_or_damaged_count", L),
                                ("total_financial_exposure", SUM)],
    "mart_route_performance": [("origin_city", S), ("destination_city", S), ("total_shipments", L),
                               ("avg_transit_hours", DBL), ("exception_count", L)],
    "mart_shipment_lifecycle": [("shipment_id", S), ("origin_city", S), ("destination_city", S),
                                ("weight_kg", W), ("shipping_cost", M), ("total_tracking_events", L),
                                ("total_transit_time_hours", DBL), ("had_exception", B)],
    "mart_weather_impact": [("weather_date", D), ("city", S), ("weather_condition", S),
                            ("regional_delay_flag", B), ("total_scans", L), ("exception_count", L)],
    "mart_weight_brackets_pricing": [("weight_bracket", S), ("shipment_count", L),
                                     ("avg_cost_per_shipment", DBL)],
}


@pytest.mark.parametrize("model", sorted(CONTRACT))
def test_output_schema(spark, model):
    df = Q.sql_queries()[model](spark, SF_SMALL)
    assert df.dtypes == CONTRACT[model]
