"""roomlake: room-sensor alerting and medallion tables on Apache Spark.

Layout
------
sources/    readers: CSV, NDJSON bronze, JSON messages, Kafka wrappers,
            and the views over the driver test tables
functions/  column expressions: ISO-8601 parsing, surrogate keys,
            look-back cutoffs, message shaping
operators/  DataFrame -> DataFrame operators: latest config, rule
            conditions, sustained-breach detection, silver, gold,
            table writes, data-quality checks
plans/      whole jobs: the lakehouse run and the contract queries
streaming/  Structured Streaming jobs: stateful alerting, bronze sinks,
            watermark rollups
"""

from roomlake.settings import DEFAULT_RULES, RuleSpec  # noqa: F401

__all__ = ["RuleSpec", "DEFAULT_RULES"]
