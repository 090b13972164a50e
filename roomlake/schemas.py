"""Record schemas: messages, bronze, silver and gold tables."""

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

# Sensor reading message (value of the readings topic, one NDJSON line in bronze).
READING_MESSAGE = StructType([
    StructField("event_time", StringType()),
    StructField("device_id", StringType()),
    StructField("temperature", DoubleType()),
    StructField("humidity", DoubleType()),
    StructField("light", DoubleType()),
    StructField("co2", DoubleType()),
    StructField("humidity_ratio", DoubleType()),
    StructField("occupancy", IntegerType()),
])

# Bronze readings also carry the derived epoch milliseconds.
BRONZE_READING = StructType(READING_MESSAGE.fields + [
    StructField("eventTimeMillis", LongType()),
])

# Threshold configuration message (compacted config topic).
CONFIG_MESSAGE = StructType([
    StructField("updated_at", StringType()),
    StructField("user_id", StringType()),
    StructField("device_id", StringType()),
    StructField("temperature_warning_threshold", DoubleType()),
    StructField("temperature_violation_threshold", DoubleType()),
    StructField("no_occupancy_light_threshold", DoubleType()),
])

# Alert message (alerts topic, bronze alerts).
ALERT_MESSAGE = StructType([
    StructField("alert_time", StringType()),
    StructField("user_id", StringType()),
    StructField("device_id", StringType()),
    StructField("rule", StringType()),
    StructField("severity", StringType()),
    StructField("metric", StringType()),
    StructField("observed_value", DoubleType()),
    StructField("threshold_value", DoubleType()),
    StructField("window_start_ms", LongType()),
    StructField("window_end_ms", LongType()),
])

# Sensor CSV (replay input) and threshold CSV: required headers.
SENSOR_CSV_COLUMNS = ["date", "Temperature", "Humidity", "Light", "CO2",
                      "HumidityRatio", "Occupancy"]
THRESHOLD_CSV_COLUMNS = ["user_id", "device_id", "temperature_warning_threshold",
                         "temperature_violation_threshold", "light_threshold"]

MEASURES = ["temperature", "humidity", "light", "co2", "humidity_ratio"]

# Primary keys of the medallion tables.
TABLE_KEYS = {
    "silver_iot_sensor_readings": ("pk_sensor_event_id", ["device_id", "event_ts"]),
    "silver_threshold_breached_alerts": (
        "pk_alert_event_id", ["user_id", "device_id", "rule", "severity", "alert_ts"]),
    "gold_sensor_hourly_metrics": ("pk_sensor_device_hour_id", ["device_id", "hour_ts"]),
    "gold_hourly_occupancy_rate": ("pk_sensor_device_hour_id", ["device_id", "hour_ts"]),
    "gold_hourly_breach_counts": (
        "pk_alert_hour_id", ["device_id", "hour_ts", "severity", "rule"]),
}
