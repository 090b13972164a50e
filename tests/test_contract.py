"""The driver's correctness gate in miniature: every registered query equals
its DuckDB oracle on the smallest driver tables (sf0.001)."""
import __spark_entry__ as E
from paths import SF001
from contract_check import compare, duck
from roomlake.plans.contract import QUERIES


def test_every_contract_query_matches_its_oracle(spark):
    con = duck(SF001)
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(QUERIES) <= set(sqls) <= set(qs)      # only operators that SQL cannot express have none
    bad = {}
    for name, q in ((n, qs[n]) for n in sqls):
        err = compare(q(spark, SF001).toPandas(), con.execute(sqls[name]).df())
        if err:
            bad[name] = err
    assert not bad, bad


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "window_end_ms" in df.columns


def test_totals_beyond_64_bits(spark):
    """Sums of epoch milliseconds pass a long from about six million readings on."""
    from pyspark.sql import functions as F
    from roomlake.plans.contract import _totals

    three, big = spark.range(3), F.lit(2 ** 62) + F.col("id")
    assert [tuple(r) for r in _totals(spark, {"big": (three, big), "none": (three.where("false"), big)}).collect()] == \
        [("big", 3, 3 * 2 ** 62 + 3), ("none", 0, None)]
    small = _totals(spark, {"small": (three, F.col("id"))})
    assert small.schema["total"].dataType.typeName() == "long" and small.first().total == 3
