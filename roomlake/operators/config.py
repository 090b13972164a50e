"""Latest threshold config per device and the reading x config join (JOIN-1, FLT-7).

The source keeps one config per device: the last one written wins whoever
the user is.  In batch "last" is the greatest (updated time, sequence),
where sequence is the changelog order (topic offset, or any tie-break).
``max_by`` runs as a partial aggregate on every task, so a device with
millions of updates is reduced before the shuffle.

The join carries no hint and caches nothing: the config side is an aggregate, so
adaptive execution knows its bytes before it joins, broadcasts it below
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting
skewed partitions.  Every call reads the configs as they are then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomlake.functions.columns import iso_instant


def latest_config(updates: DataFrame, key: tuple[str, ...] = ("device_id",),
                  order: tuple[str, ...] = ("updated_ts", "updatedAtMillis", "seq",
                                            "user_id")) -> DataFrame:
    """One row per ``key``: the update with the greatest ``order`` tuple.

    ``key=("device_id",)`` reproduces the source (last writer wins per device);
    ``key=("user_id", "device_id")`` keeps one config per user and device.
    Order columns that are absent are skipped; configs that only carry the
    ISO ``updated_at`` string are ordered by its parsed instant.  ``user_id``
    last makes ties deterministic.
    """
    if not any(c in updates.columns for c in ("updated_ts", "updatedAtMillis")) \
            and "updated_at" in updates.columns:
        updates = updates.withColumn("updated_ts", iso_instant("updated_at"))
    order = tuple(c for c in order if c in updates.columns)
    if not order:
        raise ValueError("need at least one ordering column")
    payload = [c for c in updates.columns if c not in key]
    best = F.max_by(F.struct(*payload), F.struct(*order)).alias("cfg")
    return updates.groupBy(*key).agg(best).select(*key, "cfg.*")


def join_config(readings: DataFrame, config: DataFrame) -> DataFrame:
    """Inner join readings with their device's config; readings without one drop.

    Every config column that ends in ``_threshold`` comes along, for rules of any kind.
    With a per-(user, device) config the join fans a reading out to each user.
    """
    cfg = config.select("device_id", "user_id", *[c for c in config.columns if c.endswith("_threshold")])
    return readings.drop("user_id").join(cfg, on="device_id", how="inner")
