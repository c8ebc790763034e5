"""Filters of stored ids: no id is missed, and few others are hit."""

from pyspark.sql import functions as F

from adlake.operators import id_filter


def test_no_stored_id_is_missed_and_few_others_hit(spark):
    rows = spark.range(60_000).select(
        F.concat(F.lit("id-"), F.col("id")).alias("k"),
        # One day has half of all rows.
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 10).cast("int").alias("d"),
    )
    filters = id_filter.build(rows, "k", "d").cache()
    kinds = {(r.d, r.buckets) for r in filters.select("d", "buckets").distinct().collect()}
    # 30,000 and 6,000 ids at 32 bits need 29.3 and 5.9 bitmaps: 32 and 8.
    assert kinds == {(0, 32), *((d, 8) for d in (1, 3, 5, 7, 9))}
    for d in (0, 1, 9):
        mine = rows.where(F.col("d") == d)
        for part in mine.randomSplit([0.5, 0.5], 1):
            few = part.limit(50)
            assert d in {r.d for r in id_filter.probe(filters, few, "k", "d").collect()}
        # Every single id of the day is under it.
        near = filters.where(F.col("d") == d)
        hits = mine.select("k").withColumn("b", id_filter.bucket(F.col("k"), F.lit(32 if d == 0 else 8)))
        joined = hits.join(near, hits["b"] == near["bucket"])
        inside = F.lit(True)
        for at in id_filter.positions(id_filter._start(F.col("k")), id_filter._step(F.col("k"))):
            inside = inside & id_filter.holds(F.col("bits"), at)
        assert joined.where(inside).count() == mine.count()
    others = spark.range(60_000).select(F.concat(F.lit("id-"), F.col("id"), F.lit("x")).alias("k"))
    assert id_filter.probe(filters, others, "k", "d").count() <= 2
    plan = id_filter.probe(filters, others, "k", "d")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_tables(spark):
    rows = spark.createDataFrame([("a", 1)], "k string, d int")
    filters = id_filter.build(rows, "k", "d")
    assert id_filter.build(rows.where("false"), "k", "d").count() == 0
    assert id_filter.probe(filters.where("false"), rows, "k", "d").count() == 0
    assert id_filter.probe(filters, rows.where("false"), "k", "d").count() == 0
