import pytest
from helpers import seconds
from pyspark.sql import functions as F

from adlake import schemas
from adlake.operators import attribution as at
from adlake.operators import upsert
from adlake.operators.kpis import campaign_kpis, missing_campaigns

T = seconds("2024-03-01 12:00:00")


def moment(text):
    return F.lit(text).cast("timestamp")



def stored(events, *items):
    return at.silver_rows(events("impression", *items), moment("2024-03-02 00:00:00"))


def test_insert_absent_looks_at_the_id_alone(events):
    """A replayed id with a new date is not inserted: the first stored row wins."""
    target = stored(events, ("a", T))
    staged = stored(events, ("a", T + 5 * 86400), ("b", T))
    fresh = upsert.insert_absent(target, staged, "event_id")
    assert [r["event_id"] for r in fresh.collect()] == ["b"]


def update(target, clicks, conversions, at_time):
    """The pipeline's update of a table by matched clicks and conversions."""
    return upsert.apply_updates(target, upsert.pending_updates(clicks, conversions), moment(at_time))


def matches(events, target, kind, *items):
    window = at.CLICK_WINDOW if kind == "click" else at.CONVERSION_WINDOW
    return at.match_events(events(kind, *items), target, window)


def test_click_update_is_conditional(events):
    target = stored(events, ("a", T), ("b", T))
    clicks, none = matches(events, target, "click", ("a", T + 3)), matches(events, target, "conversion")
    once = update(target, clicks, none, "2024-03-09 00:00:00")
    result = {r["event_id"]: (r["click"], str(r["updated_at"])) for r in once.collect()}
    assert result == {"a": (1, "2024-03-09 00:00:00"), "b": (0, "2024-03-02 00:00:00")}
    again = update(once, clicks, none, "2024-03-20 00:00:00")
    assert again.exceptAll(once).count() == 0


def test_first_conversion_stays(events):
    target = stored(events, ("a", T))
    none = matches(events, target, "click")
    first = matches(events, target, "conversion", ("a", T + 100))
    second = matches(events, target, "conversion", ("a", T + 50))
    once = update(target, none, first, "2024-03-09 00:00:00")
    row = update(once, none, second, "2024-03-10 00:00:00").first()
    assert (row["conversion_timestamp"], row["conversion_delay_sec"]) == (T + 100, 100)


def test_both_updates_in_one_pass_equal_two(events):
    target = stored(events, ("a", T), ("b", T), ("c", T), ("d", T))
    clicks = matches(events, target, "click", ("a", T + 1), ("b", T + 2))
    conversions = matches(events, target, "conversion", ("b", T + 7), ("c", T + 8))
    when = "2024-03-09 00:00:00"
    one = update(target, clicks, conversions, when)
    two = update(update(target, clicks, conversions.limit(0), when), clicks.limit(0), conversions, when)
    assert one.columns == two.columns == target.columns
    assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0


def test_applied_updates_change_nothing_again(events):
    target = stored(events, ("a", T))
    none = matches(events, target, "conversion")
    done = update(target, matches(events, target, "click", ("a", T + 1)), none, "2024-03-09 00:00:00")
    rematched = matches(events, done, "click", ("a", T + 1))
    assert not upsert.pending_updates(rematched, none).first()["changes"]


def test_update_with_repeated_source_key_fails(events):
    target = stored(events, ("a", T))
    clicks, none = matches(events, target, "click", ("a", T + 1)), matches(events, target, "conversion")
    conversions = matches(events, target, "conversion", ("a", T + 1))
    with pytest.raises(Exception, match="several source rows"):
        update(target, clicks.unionByName(clicks), none, "2024-03-09 00:00:00").collect()
    with pytest.raises(Exception, match="several source rows"):
        update(target, none, conversions.unionByName(conversions), "2024-03-09 00:00:00").collect()
    assert update(target, clicks, conversions, "2024-03-09 00:00:00").count() == 1


def test_upsert_keeps_groups_absent_from_the_source(spark):
    target = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    staged = spark.createDataFrame([(2, "new"), (3, "z")], "k int, v string")
    rows = sorted(tuple(r) for r in upsert.upsert(target, staged, ["k"]).collect())
    assert rows == [(1, "x"), (2, "new"), (3, "z")]


def test_update_and_delete_where_treat_null_as_false(spark):
    rows = spark.createDataFrame([(1, 10.0), (None, 20.0), (2, 30.0)], "k int, v double")
    hit = F.col("k") == 1
    updated = upsert.update_where(rows, hit, {"v": F.col("v") * 2})
    assert sorted(r["v"] for r in updated.collect()) == [20.0, 20.0, 30.0]
    assert sorted(r["v"] for r in upsert.delete_where(rows, hit).collect()) == [20.0, 30.0]


def silver(spark, rows):
    schema = "event_date date, campaign int, uid string, click int, conversion int, "
    schema += "conversion_delay_sec bigint, cost double"
    return spark.createDataFrame(rows, schema).withColumn("event_date", F.lit("2024-03-01").cast("date"))


def test_kpis_with_zero_denominators(spark):
    row = campaign_kpis(silver(spark, [(None, 1, "u", 0, 0, -1, 2.0)])).first()
    assert (row["cvr"], row["cpc"], row["cpa"], row["avg_conversion_delay_sec"]) == (None,) * 4
    assert (row["ctr"], row["cpm"], row["frequency"]) == (0.0, 2000.0, 1.0)


def test_kpis_by_hand(spark):
    rows = [
        (None, 1, "u", 1, 1, 10, 1.0),
        (None, 1, "u", 0, 1, 30, 2.0),
        (None, 1, "v", 1, 0, -1, 3.0),
        (None, 1, "w", None, 1, -1, None),
        (None, 1, None, 0, 0, -1, 4.0),
    ]
    row = campaign_kpis(silver(spark, rows)).first().asDict()
    assert row["impressions"], row["clicks"] == (5, 2)
    assert (row["conversions"], row["unique_users"], row["converting_users"]) == (3, 3, 2)
    assert (row["click_through_conversions"], row["view_through_conversions"]) == (1, 1)
    assert row["avg_conversion_delay_sec"] == 20.0
    assert row["total_cost"] == 10.0 and row["cpc"] == 5.0 and row["ctr"] == 40.0
    assert row["frequency"] == pytest.approx(5 / 3)


def test_group_without_users_has_no_frequency(spark):
    row = campaign_kpis(silver(spark, [(None, 1, None, 0, 0, -1, 1.0)])).first()
    assert row["frequency"] is None


def test_rows_without_campaign_are_counted_apart(spark):
    rows = silver(spark, [(None, None, "u", 0, 0, -1, 1.0), (None, 2, "u", 0, 0, -1, 1.0)])
    assert [r["campaign"] for r in campaign_kpis(rows).collect()] == [2]
    assert missing_campaigns(rows).first()["rows_without_campaign"] == 1


def test_kpis_equal_plain_distinct_counts(spark):
    """The two-step plan against textbook aggregates, with one campaign holding most rows."""
    rows = spark.range(5000).selectExpr(
        "date_add(DATE '2024-03-01', cast(id % 3 as int)) AS event_date",
        "cast(if(id % 3 = 0, 7, id % 11) as int) AS campaign",
        "if(id % 4 = 0, 'hot', concat('u', id % 97)) AS uid",
        "cast(id % 5 = 0 as int) AS click",
        "cast(id % 7 = 0 as int) AS conversion",
        "if(id % 7 = 0, id, -1) AS conversion_delay_sec",
        "cast(id % 13 as double) AS cost",
    )
    plain = rows.groupBy(F.col("event_date").alias("summary_date"), "campaign").agg(
        F.count("*").alias("impressions"),
        F.count_distinct("uid").alias("unique_users"),
        F.count_distinct(F.when(F.col("conversion") == 1, F.col("uid"))).alias("converting_users"),
        F.sum("cost").alias("total_cost"),
    )
    ours = campaign_kpis(rows).select(*plain.columns)
    assert ours.exceptAll(plain).count() == plain.exceptAll(ours).count() == 0


def test_conform_orders_casts_and_checks(spark):
    rows = spark.createDataFrame([("7", "2024-03-01")], "campaign string, summary_date string")
    for name in schemas.GOLD.names[2:]:
        rows = rows.withColumn(name, F.lit(None))
    assert schemas.conform(rows, schemas.GOLD).dtypes == [
        (f.name, f.dataType.simpleString()) for f in schemas.GOLD
    ]
    bad = rows.withColumn("campaign", F.lit(None))
    with pytest.raises(Exception, match="NULL in required column campaign"):
        schemas.conform(bad, schemas.GOLD).collect()
