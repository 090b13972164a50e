"""Command line: ``spark-submit -m roomlake <command>`` or ``python -m roomlake``.

  lakehouse    JOB-1: bronze -> silver -> gold -> checks (run it hourly)
  alerts       JOB-2: the live alerting job (bronze copy + alert fold + sinks)
  publish-csv  SRC-7/8 + PRJ-5/6/8: sensor or threshold CSV -> keyed JSON
               messages, to NDJSON files or a Kafka topic (no replay pacing)

Defaults come from the environment (KAFKA_BOOTSTRAP_SERVERS, TOPIC_SENSOR,
TOPIC_CONFIG, TOPIC_ALERTS, rule durations / cooldowns); blank means default.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import os
import sys

from pyspark.sql import SparkSession


def _session(app: str) -> SparkSession:
    spark = (SparkSession.builder.appName(app)
             .config("spark.sql.session.timeZone", "UTC")
             # state on disk: the alert fold keeps a row per device
             .config("spark.sql.streaming.stateStore.providerClass",
                     "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
             .getOrCreate())
    from roomlake.session import ensure_checkpoint_dir, ship_package
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _now(value: str | None) -> _dt.datetime:
    if not value:
        return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    t = _dt.datetime.fromisoformat(value.replace("Z", "+00:00"))
    return t.astimezone(_dt.timezone.utc).replace(tzinfo=None) if t.tzinfo else t


def cmd_lakehouse(a) -> int:
    from roomlake.plans.lakehouse import LakePaths, run_lakehouse

    spark = _session("roomlake-lakehouse")
    rep = run_lakehouse(spark, LakePaths(a.bronze_readings, a.bronze_alerts, a.lake_root),
                        now=_now(a.now), full_refresh=a.full_refresh,
                        run_checks_after=not a.no_checks, lookback_hours=a.lookback_hours,
                        cutoff_from=a.cutoff_from)
    for table, action in rep.actions.items():
        print(f"{table}: {action}")
    for r in rep.checks:
        print(f"check {r.table_name}.{r.column_name} {r.check_name}: {r.failures} failures")
    return 0


def cmd_alerts(a) -> int:
    from roomlake.settings import rules_from_env, setting
    from roomlake.streaming.jobs import (DEFAULT_MAX_OFFSETS_PER_TRIGGER, console_sink, file_values,
                                         kafka_alert_sink, kafka_values, start_alert_job)

    spark = _session("roomlake-alerts")
    if a.source == "kafka":
        servers = a.kafka_servers or setting("KAFKA_BOOTSTRAP_SERVERS")
        readings = kafka_values(spark, servers, a.readings or setting("TOPIC_SENSOR", "iot-sensor-readings"), "latest",
                                DEFAULT_MAX_OFFSETS_PER_TRIGGER)
        configs = kafka_values(spark, servers, a.configs or setting("TOPIC_CONFIG", "user-threshold-config"), "earliest")
    else:
        readings = file_values(spark, a.readings, a.max_files)
        configs = file_values(spark, a.configs)
    sinks = [console_sink] if a.console else []
    if a.alerts_topic or a.source == "kafka":
        servers = a.kafka_servers or setting("KAFKA_BOOTSTRAP_SERVERS")
        sinks.append(kafka_alert_sink(servers, a.alerts_topic or setting("TOPIC_ALERTS", "threshold-breached-alerts")))
    trigger = {"availableNow": True} if a.once else None
    queries = start_alert_job(spark, readings, configs, a.bronze_readings, a.bronze_alerts,
                              a.checkpoint_root, rules_from_env(), trigger=trigger,
                              alert_sinks=sinks, quarantine_path=a.quarantine,
                              max_gap_s=a.max_gap_s, malformed="failfast" if a.fail_fast else "quarantine")
    if a.once:
        for q in queries:
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()
    return 0


def cmd_publish_csv(a) -> int:
    from pyspark.sql import functions as F

    from roomlake.functions.messages import config_messages, reading_messages
    from roomlake.sources.files import (read_sensor_csv, read_threshold_csv,
                                        sensor_csv_to_readings, threshold_csv_to_configs)

    spark = _session("roomlake-publish")
    if a.kind == "sensor":
        device = a.device_id or os.environ.get("DEVICE_ID") or "dev_123"
        msgs = reading_messages(sensor_csv_to_readings(read_sensor_csv(spark, a.csv), device))
    else:
        msgs = config_messages(threshold_csv_to_configs(read_threshold_csv(spark, a.csv)))
    if a.topic:
        from roomlake.settings import setting
        (msgs.write.format("kafka")
             .option("kafka.bootstrap.servers", a.kafka_servers or setting("KAFKA_BOOTSTRAP_SERVERS"))
             .option("topic", a.topic).option("includeHeaders", "true").save())
    else:
        msgs.select(F.col("value")).write.mode("append").text(a.out)
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="roomlake")
    sub = p.add_subparsers(dest="cmd", required=True)

    lk = sub.add_parser("lakehouse", help="one incremental lakehouse run")
    lk.add_argument("--bronze-readings", required=True)
    lk.add_argument("--bronze-alerts", required=True)
    lk.add_argument("--lake-root", required=True)
    lk.add_argument("--now", help="ISO-8601 instant; default: current UTC time")
    lk.add_argument("--full-refresh", action="store_true")
    lk.add_argument("--no-checks", action="store_true")
    lk.add_argument("--lookback-hours", type=int, default=2)
    lk.add_argument("--cutoff-from", choices=["clock", "high_water_mark"], default="clock")
    lk.set_defaults(fn=cmd_lakehouse)

    al = sub.add_parser("alerts", help="the live alerting job")
    al.add_argument("--source", choices=["kafka", "files"], default="kafka")
    al.add_argument("--readings", help="topic (kafka) or folder of NDJSON messages (files)")
    al.add_argument("--configs", help="topic (kafka) or folder of NDJSON messages (files)")
    al.add_argument("--kafka-servers")
    al.add_argument("--alerts-topic")
    al.add_argument("--bronze-readings", required=True)
    al.add_argument("--bronze-alerts", required=True)
    al.add_argument("--checkpoint-root", required=True)
    al.add_argument("--quarantine")
    al.add_argument("--fail-fast", action="store_true", help="stop at a malformed message")
    al.add_argument("--console", action="store_true")
    al.add_argument("--max-gap-s", type=int, help="silence that ends an episode (off)")
    al.add_argument("--max-files", type=int, help="reading files per micro-batch (files source)")
    al.add_argument("--once", action="store_true",
                    help="process what is available, then stop (catch-up / tests)")
    al.set_defaults(fn=cmd_alerts)

    pc = sub.add_parser("publish-csv", help="CSV rows -> keyed JSON messages")
    pc.add_argument("--kind", choices=["sensor", "threshold"], required=True)
    pc.add_argument("--csv", required=True)
    pc.add_argument("--device-id")
    pc.add_argument("--out", help="folder for NDJSON message files")
    pc.add_argument("--topic", help="Kafka topic instead of files")
    pc.add_argument("--kafka-servers")
    pc.set_defaults(fn=cmd_publish_csv)

    a = p.parse_args(argv)
    if a.cmd == "publish-csv" and not (a.out or a.topic):
        p.error("publish-csv needs --out or --topic")
    return a.fn(a)


if __name__ == "__main__":
    sys.exit(main())
