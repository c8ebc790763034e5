"""Compaction, row numbering and wide rows."""

from collections import Counter
from datetime import datetime

import pytest
from helpers import seconds
from pyspark.sql import functions as F

from adlake.operators import attribution as at
from adlake.operators import maintain, wide
from adlake.plans import maintenance

T = seconds("2024-03-01 12:00:00")
NOW = datetime(2024, 3, 3, 2)


def content(table):
    return sorted(tuple(r) for r in table.collect())


@pytest.fixture
def fragmented(lake, events):
    """Two days in four files each; one campaign holds most rows of the first day."""
    items = [
        {
            "eid": f"e{i:04d}",
            "timestamp": T + (i % 2) * 86400 + i,
            "campaign": 1 if i % 4 == 0 else i % 9,
        }
        for i in range(400)
    ]
    for part in range(4):
        lake.append("silver", at.silver_rows(events("impression", *items[part::4])))
    return lake


def listed(lake):
    """(day, bytes) of every file."""
    rows = maintenance.files_of(lake, "silver").collect()
    assert all(r.file_bytes > 0 for r in rows)
    return [(str(r.event_date), r.file_bytes) for r in rows]


def files_per_day(lake):
    return dict(Counter(day for day, _ in listed(lake)))


def test_binpack_makes_one_file_per_small_day(fragmented):
    before = content(fragmented.read("silver"))
    assert sum(files_per_day(fragmented).values()) > 2
    assert maintenance.compact_binpack(fragmented, "2024-03-03", now=NOW) == 400
    assert files_per_day(fragmented) == {"2024-03-01": 1, "2024-03-02": 1}
    assert content(fragmented.read("silver")) == before
    assert fragmented.last_run("silver")["operation"] == "compact"
    assert maintenance.compact_binpack(fragmented, "2024-03-03", now=NOW) is None


def test_old_days_are_left_alone(fragmented):
    assert maintenance.compact_binpack(fragmented, "2024-06-01", now=NOW) is None


def test_file_report_opens_no_data_file(fragmented):
    fragmented.summarize(fragmented.days("silver"))
    rows = {str(r.event_date): r for r in maintenance.report_files(fragmented).collect()}
    assert {d: r.file_count for d, r in rows.items()} == files_per_day(fragmented)
    assert {d: r.total_records for d, r in rows.items()} == {"2024-03-01": 200, "2024-03-02": 200}
    sizes = sum(size for _, size in listed(fragmented))
    assert abs(sum(r.total_mb for r in rows.values()) - sizes / 1048576) < 0.02


def file_spans(table):
    """(day, lowest, highest campaign) of every file."""
    per_file = table.groupBy("event_date", F.col("_metadata.file_path")).agg(
        F.min("campaign").alias("low"), F.max("campaign").alias("high")
    )
    by_day = {}
    for r in per_file.collect():
        by_day.setdefault(str(r["event_date"]), []).append((r["low"], r["high"]))
    return {day: sorted(spans) for day, spans in by_day.items()}


def test_sorted_files_cover_separate_ranges(fragmented):
    before = content(fragmented.read("silver"))
    small = sum(size for _, size in listed(fragmented)) // 6
    maintenance.compact_sorted(fragmented, "2024-03-03", target_bytes=small, now=NOW)
    table = fragmented.read("silver")
    assert content(table) == before
    spans = file_spans(table)
    assert all(len(s) >= 3 for s in spans.values())
    for found in spans.values():
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))


def test_every_day_gets_its_planned_files_in_order(fragmented, tmp_path):
    """One rule for days of one file and of several; no file holds two days."""
    table = fragmented.read("silver")
    plan = list(zip(fragmented.days("silver"), (1, 3)))
    placed = maintain.place_sorted_files(
        table, plan, "event_date", ["campaign", "event_id"], str(tmp_path / "numbered")
    )
    tasks = placed.groupBy(F.spark_partition_id().alias("t"), "event_date").agg(
        F.count(F.lit(1)).alias("n"), F.min("campaign").alias("low"), F.max("campaign").alias("high")
    )
    rows = sorted((str(r.event_date), r.low, r.high, r.n) for r in tasks.collect())
    assert [r[0] for r in rows] == ["2024-03-01"] + ["2024-03-02"] * 3
    assert max(r[3] for r in rows[1:]) - min(r[3] for r in rows[1:]) <= 1
    assert rows[1][2] <= rows[2][1] and rows[2][2] <= rows[3][1]


def test_sorted_single_files_are_left_alone_afterwards(fragmented, events):
    maintenance.compact_sorted(fragmented, "2024-03-03", now=NOW)
    assert files_per_day(fragmented) == {"2024-03-01": 1, "2024-03-02": 1}
    first = fragmented.read("silver").where("event_date = DATE '2024-03-01'").coalesce(1)
    campaigns = [r["campaign"] for r in first.collect()]
    assert campaigns == sorted(campaigns)
    assert maintenance.compact_sorted(fragmented, "2024-03-03", now=NOW) is None
    fragmented.append("silver", at.silver_rows(events("impression", ("new", T))))
    assert maintenance.compact_sorted(fragmented, "2024-03-03", now=NOW) == 201


def test_the_inventory_opens_no_file_and_prunes_days(fragmented):
    files = maintenance.files_of(fragmented, "silver").where("event_date = DATE '2024-03-02'")
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]
    assert "event_date#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert {str(r.event_date) for r in files.collect()} == {"2024-03-02"}


@pytest.fixture
def spread(lake, events):
    """One day of 4,096 rows whose campaigns and ids are independent."""
    items = [
        {"eid": f"e{(i * 2654435761) % 4096:04d}", "timestamp": T + i % 3600, "campaign": i % 64}
        for i in range(4096)
    ]
    lake.append("silver", at.silver_rows(events("impression", *items)))
    return lake


def files_met(table, low, high, column):
    """How many files have a range that meets the asked one."""
    spans = table.groupBy(F.col("_metadata.file_path")).agg(F.min(column).alias("a"), F.max(column).alias("b"))
    return spans.where((F.col("a") <= F.lit(high)) & (F.col("b") >= F.lit(low))).count(), spans.count()


def test_zorder_skips_files_for_filters_on_either_column(spread):
    before, target = content(spread.read("silver")), sum(b for _, b in listed(spread)) // 16
    maintenance.compact_sorted(spread, "2024-03-03", target_bytes=target, now=NOW)
    by_campaign, files = files_met(spread.read("silver"), 10, 10, "campaign")
    by_id, _ = files_met(spread.read("silver"), "e1000", "e1000", "event_id")
    assert files >= 12 and by_campaign <= 2 and by_id == files
    assert maintenance.compact_zorder(spread, "2024-03-03", target_bytes=target, now=NOW) == 4096
    table = spread.read("silver")
    assert content(table) == before
    z_campaign, z_files = files_met(table, 10, 10, "campaign")
    z_id, _ = files_met(table, "e1000", "e1000", "event_id")
    # Less than half of the files for either column; sorting serves one of them only.
    assert z_campaign < z_files / 2 and z_id < z_files / 2
    assert (z_campaign + z_id) / z_files < (by_campaign + by_id) / files
    assert spread.last_run("silver")["operation"] == "zorder"
    assert maintenance.compact_zorder(spread, "2024-03-03", target_bytes=target, now=NOW) is None


def test_zorder_ranks_are_even_under_skew_and_null(spread):
    """Half of the rows in one campaign, some without; ranks of the ids stay spread."""
    rows = spread.read("silver").withColumn(
        "campaign", F.when(F.col("campaign") < 32, 7).when(F.col("campaign") < 60, F.col("campaign"))
    )
    keyed = maintain.with_zorder(rows, "event_date", ("campaign", "event_id"))
    ends = keyed.agg(F.count_distinct("_z"), F.min("_z"), F.max("_z"), F.count(F.lit(1))).first()
    assert ends[0] > 800 and ends[1] >= 0 and ends[2] < 1 << (2 * maintain.ZORDER_BITS) and ends[3] == 4096
    evens = sum(1 << (2 * bit) for bit in range(maintain.ZORDER_BITS))  # bits of the second column
    spread_ids = keyed.groupBy(F.col("_z").bitwiseAND(F.lit(evens))).count().agg({"count": "max"}).first()[0]
    assert spread_ids < 4 * 4096 / (1 << maintain.ZORDER_BITS)


def test_gold_can_be_laid_out_as_well(lake, events):
    from adlake.plans import gold

    for part in range(2):
        items = [{"eid": f"g{part}-{i}", "timestamp": T, "campaign": i} for i in range(50)]
        lake.append("silver", at.silver_rows(events("impression", *items)))
    lake.summarize(lake.days("silver"))
    gold.run_daily(lake, NOW)
    before = content(lake.read("gold"))
    assert maintenance.compact_zorder(lake, "2024-03-03", layer="gold", now=NOW) == 50
    assert content(lake.read("gold")) == before


def test_large_day_is_spread_over_its_planned_files(fragmented):
    table = fragmented.read("silver")
    plan = [(day, 3) for day in fragmented.days("silver")]
    placed = maintain.place_files(table, plan, "event_date", ["event_id"])
    spread = placed.groupBy(F.spark_partition_id().alias("task"), "event_date").count().collect()
    assert len(spread) == 6 and len({r["task"] for r in spread}) == 6
    assert max(r["count"] for r in spread) < 120


def test_row_numbers_follow_the_order_under_skew(spark):
    """A third of all rows share one timestamp."""
    rows = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 500, pmod(id * 7919, 1000)) AS timestamp", "id AS event_id"
    )
    numbered = wide.number_rows(rows.repartition(8), ["timestamp", "event_id"], 6)
    found = [(r["timestamp"], r["event_id"]) for r in numbered.orderBy("row_index").collect()]
    assert found == sorted((r["timestamp"], r["event_id"]) for r in rows.collect())
    ends = numbered.agg(F.min("row_index"), F.max("row_index"), F.count_distinct("row_index"))
    assert tuple(ends.first()) == (0, 2999, 3000)


WIDE = "timestamp bigint, uid string, campaign int, click int, conversion int, "
WIDE += "conversion_id bigint, conversion_timestamp bigint, cost double"


def test_wide_rows_become_three_streams(spark):
    rows = spark.createDataFrame(
        [
            (100, "u", 1, 1, 1, 77, 400, 0.5),
            (300, "v", 2, 0, 1, 77, 900, None),
            (500, "w", 3, 0, 0, -1, -1, 0.0),
        ],
        WIDE,
    )
    numbered = wide.number_rows(rows, ["timestamp"])
    found = {}
    for row in wide.split_wide_events(numbered, real_start=1000, speed=100).collect():
        found.setdefault(row["event_type"], []).append(row)
    shown = sorted(found["impression"], key=lambda r: r["eid"])
    assert [(r["eid"], r["timestamp"], r["cost"]) for r in shown] == [
        ("evt_00000000", 1000, 0.5),
        ("evt_00000001", 1002, 0.0),
        ("evt_00000002", 1004, 0.0),
    ]
    assert shown[0]["event_time"] == "1970-01-01T00:16:40+00:00"
    assert [(r["eid"], r["timestamp"], r["cost"]) for r in found["conversion"]] == [
        ("evt_00000000", 1003, None)
    ]
    assert [r["eid"] for r in found["click"]] == ["evt_00000000"]


def test_click_delay_stays_in_its_range(spark):
    delays = spark.range(5000).select(
        wide.click_delay(F.format_string("evt_%08d", "id")).alias("d")
    )
    ends = delays.agg(F.min("d"), F.max("d"), F.count_distinct("d")).first()
    assert tuple(ends) == (1, 30, 30)
