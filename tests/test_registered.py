"""Every registered query equals its SQL counterpart."""

import pytest
from compare import connect, duck_rows, spark_rows
from helpers import DATA

import __spark_entry__ as contract
from adlake.workload.oracles import ORACLES
from adlake.workload.queries import QUERIES

SMALL = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    plan = result._jdf.queryExecution().executedPlan().toString()
    # Every join has a key, and no row passes through Python.
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    columns, rows = spark_rows(result)
    expected_columns, expected = duck_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == 132


# Counts of the three scales, worked out once in SQL.
COUNTS = {
    "sf0.001": ((188, 210, 202), (174, 202, 195), 4, 6, 0, 132),
    "sf0.01": ((1982, 2006, 1981), (1856, 1876, 1856), 49, 115, 4, 299),
    "sf0.1": ((19941, 19863, 20084), (18633, 18648, 18792), 479, 1213, 36, 300),
}


@pytest.mark.parametrize("scale", COUNTS)
def test_known_counts(spark, scale):
    from pyspark.sql import functions as F

    from adlake.operators.dedup import first_per_key
    from adlake.workload import queries

    raw, unique, clicks, conversions, both, gold_rows = COUNTS[scale]
    frames = queries.raws(spark, f"{DATA}/{scale}")
    assert tuple(f.count() for f in frames) == raw
    assert tuple(first_per_key(f, ["eid"]).count() for f in frames) == unique
    totals = queries.full(spark, f"{DATA}/{scale}").agg(
        F.count(F.lit(1)),
        F.sum("click"),
        F.sum("conversion"),
        F.count_if((F.col("click") == 1) & (F.col("conversion") == 1)),
    )
    assert tuple(totals.first()) == (unique[0], clicks, conversions, both)
    assert queries.full_gold(spark, f"{DATA}/{scale}").count() == gold_rows
