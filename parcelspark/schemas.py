"""Declared schemas of the raw (source-aligned) tables.

Types follow the OLTP DDL (never inferred): ids are warehouse-width longs,
money is DECIMAL(10,2), weight DECIMAL(5,2), timestamps carry no zone.
"""

from pyspark.sql import types as T

FACILITIES = T.StructType([
    T.StructField("facility_id", T.LongType(), False),
    T.StructField("facility_name", T.StringType(), True),
    T.StructField("facility_type", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("max_capacity_per_day", T.LongType(), True),
])

SHIPMENTS = T.StructType([
    T.StructField("shipment_id", T.StringType(), False),
    T.StructField("sender_id", T.LongType(), True),
    T.StructField("origin_facility_id", T.LongType(), True),
    T.StructField("destination_facility_id", T.LongType(), True),
    T.StructField("weight_kg", T.DecimalType(5, 2), True),
    T.StructField("declared_value", T.DecimalType(10, 2), True),
    T.StructField("shipping_cost", T.DecimalType(10, 2), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
    T.StructField("estimated_delivery_date", T.DateType(), True),
])

# One JSON record of an hourly event file (the fields a producer writes).
TRACKING_EVENT_RECORD = T.StructType([
    T.StructField("event_id", T.StringType(), True),
    T.StructField("shipment_id", T.StringType(), True),
    T.StructField("status_code", T.IntegerType(), True),
    T.StructField("facility_id", T.IntegerType(), True),
    T.StructField("event_timestamp", T.StringType(), True),
    T.StructField("courier_notes", T.StringType(), True),
])

# raw.tracking_events = record fields + provenance.
TRACKING_EVENTS = T.StructType(
    TRACKING_EVENT_RECORD.fields + [T.StructField("source_file", T.StringType(), True)]
)

INGESTED_FILES = T.StructType([
    T.StructField("file_name", T.StringType(), False),
    T.StructField("row_count", T.IntegerType(), True),
    T.StructField("ingested_at", T.TimestampNTZType(), True),
])

WEATHER = T.StructType([
    T.StructField("date", T.DateType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("weather_condition", T.StringType(), True),
    T.StructField("precipitation_mm", T.DoubleType(), True),
    T.StructField("regional_delay_flag", T.BooleanType(), True),
])

STATUS_CODES = T.StructType([
    T.StructField("status_code", T.IntegerType(), False),
    T.StructField("status_name", T.StringType(), True),
    T.StructField("is_final_state", T.BooleanType(), True),
    T.StructField("is_exception", T.BooleanType(), True),
])

RAW_TABLES = {
    "facilities": FACILITIES,
    "shipments": SHIPMENTS,
    "tracking_events": TRACKING_EVENTS,
    "historical_weather_delays": WEATHER,
    "_ingested_files": INGESTED_FILES,
}
