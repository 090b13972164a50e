"""Keyed JSON messages (PRJ-1/2/3 parse, PRJ-7/8 shape).

Shaping produces the columns a Kafka sink takes -- ``key``, ``value``
(compact JSON) and ``headers`` (array of name/binary value) -- with
built-in ``to_json``; parsing uses ``from_json`` with an explicit schema, so
unknown keys are ignored and malformed rows become NULL fields plus a
``_corrupt`` flag instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.functions.columns import epoch_millis, iso_instant
from roomlake.schemas import ALERT_MESSAGE, CONFIG_MESSAGE, READING_MESSAGE

SCHEMA_VERSION = "1"

# Fixed header values of the source's messages.
READING_EVENT_TYPE, READING_PRODUCER = "iot_reading", "iot-producer"
CONFIG_EVENT_TYPE, CONFIG_PRODUCER = "threshold_config", "config-producer"
ALERT_EVENT_TYPE, ALERT_PRODUCER = "threshold_breached_alert", "flink-alerting-job"
CONTENT_TYPE = "application/json"


def _headers(pairs: list[tuple[str, Column]]) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value"))
                     for k, v in pairs])


def to_messages(df: DataFrame, key: Column, schema: T.StructType, event_type: str,
                producer: str) -> DataFrame:
    """PRJ-8: rows -> (key, value, headers) for a Kafka sink."""
    value = F.to_json(F.struct(*[F.col(f.name) for f in schema.fields]), {"ignoreNullFields": "false"})
    headers = _headers([("schema_version", F.lit(SCHEMA_VERSION)),
                        ("content_type", F.lit(CONTENT_TYPE)),
                        ("event_type", F.lit(event_type)),
                        ("producer", F.lit(producer))])
    return df.select(key.cast("string").alias("key"), value.alias("value"),
                     headers.alias("headers"))


def message_key(*cols: str) -> Column:
    """Parts joined by ':'; a null part keeps its place as ``null``."""
    return F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols])


def reading_messages(readings: DataFrame) -> DataFrame:
    return to_messages(readings, F.col("device_id"), READING_MESSAGE,
                       READING_EVENT_TYPE, READING_PRODUCER)


def config_messages(configs: DataFrame) -> DataFrame:
    key = message_key("user_id", "device_id")
    return to_messages(configs, key, CONFIG_MESSAGE, CONFIG_EVENT_TYPE, CONFIG_PRODUCER)


def alert_message_key() -> Column:
    """Alerts with one key stay in order: the same user, device and rule."""
    return message_key("user_id", "device_id", "rule")


def alert_messages(alerts: DataFrame) -> DataFrame:
    """PRJ-7: key user:device:rule, JSON value, five headers."""
    value = F.to_json(F.struct(*[F.col(f.name) for f in ALERT_MESSAGE.fields]), {"ignoreNullFields": "false"})
    headers = _headers([("schema_version", F.lit(SCHEMA_VERSION)),
                        ("event_type", F.lit(ALERT_EVENT_TYPE)),
                        ("producer", F.lit(ALERT_PRODUCER)),
                        ("severity", F.col("severity")),
                        ("rule", F.col("rule"))])
    return alerts.select(alert_message_key().alias("key"), value.alias("value"),
                         headers.alias("headers"))


def header_value(name: str, headers: str = "headers") -> Column:
    """The string value of one header."""
    hit = F.filter(F.col(headers), lambda h: h["key"] == F.lit(name))
    return F.element_at(hit, 1)["value"].cast("string")


def _typed(messages: DataFrame, value_col: str, schema: T.StructType, time_col: str) -> DataFrame:
    """JSON value -> typed columns, the message's other columns, and ``_corrupt``.

    Numbers may come as numbers or as numeric text; a whole-number field takes ``1.0`` too (cut
    to a whole number).  An absent, null or empty number is NULL.  ``_corrupt``: not JSON, no valid instant
    in ``time_col``, or a number that is present but is none (NaN and infinity are none).
    """
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    parsed = F.from_json(F.col(value_col).cast("string"), raw, {"mode": "PERMISSIVE"})
    others = [c for c in messages.columns if c != value_col]
    cols, bad = [], iso_instant(F.col(f"_m.{time_col}")).isNull()
    for f in schema.fields:
        text = F.col(f"_m.{f.name}")
        if isinstance(f.dataType, T.StringType):
            cols.append(text.alias(f.name))
            continue
        text = F.when(F.trim(text) != "", F.trim(text))
        value = text.try_cast("bigint") if isinstance(f.dataType, T.LongType) else text.try_cast("double")
        if not isinstance(f.dataType, T.LongType):
            value = F.when(F.abs(value) < float("inf"), value)        # NaN and infinity are no measures
        if isinstance(f.dataType, T.IntegerType):
            value = F.when(F.abs(value) < 2**31, value).cast("int")
        cols.append(value.alias(f.name))
        bad = bad | (text.isNotNull() & value.isNull())
    return messages.select("*", parsed.alias("_m")).select(*others, *cols, bad.alias("_corrupt"))


def parse_readings(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """PRJ-1 + PRJ-3: JSON value -> typed reading + eventTimeMillis.

    ``_corrupt`` is true when the line is not JSON, event_time lacks a valid
    ISO-8601 instant with offset, or a measure is present but not a number (the source would stop
    on such a line).
    """
    df = _typed(messages, value_col, READING_MESSAGE, "event_time")
    return df.withColumn("eventTimeMillis", epoch_millis(iso_instant("event_time")))


def parse_configs(messages: DataFrame, value_col: str = "value", thresholds=()) -> DataFrame:
    """PRJ-2: JSON value -> typed config + updatedAtMillis + userDeviceKey.

    ``thresholds`` names threshold columns beyond the source's three.

    An absent threshold is 0, as in the source's typed message.  An
    optional ``seq`` (changelog position) is kept when present; it orders
    configs written at the same instant.
    """
    more = [T.StructField(c, T.DoubleType()) for c in thresholds if c not in CONFIG_MESSAGE.names]
    schema = T.StructType(CONFIG_MESSAGE.fields + more + [T.StructField("seq", T.LongType())])
    df = _typed(messages, value_col, schema, "updated_at")
    zero = {f.name: F.coalesce(F.col(f.name), F.lit(0.0)) for f in schema.fields
            if isinstance(f.dataType, T.DoubleType)}
    return (df.withColumns(zero)
              .withColumn("updatedAtMillis", epoch_millis(iso_instant("updated_at")))
              .withColumn("userDeviceKey", message_key("user_id", "device_id")))


MALFORMED = "malformed message: no valid time with offset, or a number that is none"


def quarantine(parsed: DataFrame, mode: str = "quarantine"):
    """Split parsed rows into (good, bad).

    ``mode='failfast'`` raises on bad rows: here for a batch frame, in the running query for a stream.
    """
    bad = parsed.where(F.col("_corrupt"))
    if mode == "failfast":
        if parsed.isStreaming:
            fail = F.when(F.col("_corrupt"), F.raise_error(F.lit(MALFORMED)).cast("boolean")).otherwise(F.lit(True))
            return parsed.where(fail).drop("_corrupt"), bad
        if not bad.isEmpty():
            raise ValueError(MALFORMED)
    return parsed.where(~F.col("_corrupt")).drop("_corrupt"), bad
