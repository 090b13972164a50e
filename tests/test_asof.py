"""The backward as-of join against a literal reading of it: hot keys, ties, NULLs, any partitioning."""
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from roomlake.operators.asof import asof_join, join_config_in_force

LEFT = "id int, k string, t long, v double"
RIGHT = "k string, t2 long, seq long, name string, nest struct<a: int, b: array<string>>"


def rows(seed, n_left, n_right):
    rnd = random.Random(seed)
    key = lambda: rnd.choice(["hot"] * 6 + ["a", "b", "c", None])
    left = [(i, key(), rnd.choice([None] + list(range(50))), rnd.random()) for i in range(n_left)]
    right = [(key(), rnd.choice([None] + list(range(-5, 45))), i, f"r{i}", (i, [str(i)] * (i % 3)) if i % 5 else None)
             for i in range(n_right)]
    return left, right


def brute(left, right, inner):
    out = Counter()
    for i, k, t, v in left:
        best = max(((t2, seq, n, name, nest) for n, (k2, t2, seq, name, nest) in enumerate(right)
                    if k is not None and k2 == k and t is not None and t2 is not None and t2 <= t), default=None,
                   key=lambda x: x[:2])
        if best is not None or not inner:
            name, nest = (best[3], best[4]) if best else (None, None)
            out[(i, k, t, v, name, None if nest is None else (nest[0], tuple(nest[1])))] += 1
    return out


def got(df):
    return Counter((r.id, r.k, r.t, r.v, r.name, None if r.nest is None else (r.nest.a, tuple(r.nest.b)))
                   for r in df.collect())


@pytest.mark.parametrize("how,parts,batch", [("inner", 1, 10000), ("left", 7, 10000), ("inner", 23, 7), ("left", 40, 3)])
def test_as_literal(spark, how, parts, batch):
    left, right = rows(parts, 600, 120)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "k", "t", "t2",
                        right_tie="seq", how=how, num_partitions=parts)
        assert got(out) == brute(left, right, how == "inner")
        assert out.columns == ["id", "k", "t", "v", "t2", "seq", "name", "nest"]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("n_left,n_right", [(0, 5), (5, 0), (0, 0)])
def test_empty_sides(spark, n_left, n_right):
    left, right = rows(1, n_left, n_right)
    out = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "k", "t", "t2", how="left")
    assert got(out) == brute(left, right, False)


def test_rows_before_the_first_partition_bound_carry_far(spark):
    """One right row, then readings of one key over many partitions: it enters all of them."""
    left = spark.range(2000).select(F.col("id").cast("int").alias("id"), F.lit("hot").alias("k"), (F.col("id") + 10).alias("t"),
                                    F.lit(0.5).alias("v"))
    right = spark.createDataFrame([("hot", 0, 0, "only", None), ("hot", 1500, 1, "late", None)], RIGHT)
    out = asof_join(left, right, "k", "t", "t2", num_partitions=16)
    assert Counter(r.name for r in out.collect()) == {"only": 1490, "late": 510}


def test_config_in_force(spark):
    ts = lambda c: F.timestamp_seconds(F.col(c))
    readings = spark.createDataFrame([(1, "d", 100), (2, "d", 200), (3, "d", 300), (4, "e", 300)],
                                     "event_id int, device_id string, s long").withColumn("event_ts", ts("s"))
    updates = spark.createDataFrame([("d", "u1", 150, 1, 20.0), ("d", "u2", 200, 2, 30.0), ("d", "u3", 200, 3, 40.0)],
                                    "device_id string, user_id string, s long, seq long, temperature_warning_threshold double"
                                    ).withColumn("updated_ts", ts("s")).drop("s")
    out = {r.event_id: (r.user_id, r.temperature_warning_threshold) for r in join_config_in_force(readings, updates).collect()}
    assert out == {2: ("u3", 40.0), 3: ("u3", 40.0)}
