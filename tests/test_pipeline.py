import shutil
from datetime import date, datetime
from pathlib import Path

import pytest
from helpers import seconds
from pyspark.sql import functions as F

from adlake.operators import changes
from adlake.plans import checks, daily, gold, reports, silver
from adlake.session import scratch_root
from adlake.sources.raw import append_raw, read_raw
from adlake.sources.tables import Lake

DAY1, DAY2, DAY3 = "2024-03-01", "2024-03-02", "2024-03-03"
T = seconds(f"{DAY1} 12:00:00")
DAY = 86400


def run_at(text):
    return datetime.fromisoformat(f"{text} 02:00:00")


@pytest.fixture
def raw_layer(events, tmp_path):
    """Writes raw events; event types that get none still have an empty folder."""
    base = str(tmp_path / "raw")

    def write(impressions=(), clicks=(), conversions=()):
        for event_type, items in (
            ("impression", impressions),
            ("click", clicks),
            ("conversion", conversions),
        ):
            if items:
                append_raw(events(event_type, *items), base, event_type)
        return base

    return write


def content(table):
    return sorted(tuple(r) for r in table.drop("updated_at").collect())


def flags(lake):
    rows = lake.read("silver").collect()
    return {r["event_id"]: (r["click"], r["conversion_timestamp"]) for r in rows}


def test_late_events_update_the_day_of_their_impression(lake, raw_layer):
    base = raw_layer(
        impressions=[("a", T), ("b", T), ("c", T + DAY)],
        clicks=[("a", T + DAY + 5), ("c", T + DAY + 9)],
        conversions=[("b", T + DAY + 7)],
    )
    silver.run_incremental(lake, base, DAY1, DAY1, now=run_at(DAY2), require_match=False)
    assert flags(lake) == {"a": (0, -1), "b": (0, -1)}
    silver.run_incremental(lake, base, DAY2, DAY2, now=run_at(DAY3))
    assert flags(lake) == {"a": (1, -1), "b": (0, T + DAY + 7), "c": (1, -1)}

    # The same dates again: same content, and no day is rewritten.
    before, runs = content(lake.read("silver")), lake.last_run("silver")["commit_id"]
    stored = sorted(lake.read("silver").inputFiles())
    silver.run_incremental(lake, base, DAY2, DAY2, now=run_at(DAY3))
    assert content(lake.read("silver")) == before
    assert [f for f in stored if f in lake.read("silver").inputFiles()] == stored
    last = lake.last_run("silver")
    assert (last["operation"], last["records"], last["commit_id"]) == ("incremental", 0, runs + 1)


def test_run_log_tells_what_runs_did(lake, raw_layer):
    base = raw_layer(
        impressions=[("a", T), ("b", T), ("c", T + DAY)], clicks=[("a", T + 5), ("c", T + DAY + 2)]
    )
    silver.run_incremental(lake, base, DAY1, DAY1, now=run_at(DAY2))
    silver.run_incremental(lake, base, DAY2, DAY2, now=run_at("2024-04-01"))
    log = {r["commit_id"]: r.asDict() for r in lake.log().collect()}
    assert [log[i]["parent_id"] for i in sorted(log)] == [None, 1]
    assert [log[i]["records"] for i in sorted(log)] == [3, 2]
    assert log[2]["committed_at"] == run_at("2024-04-01")
    assert Lake(lake.spark, lake.root).last_run("silver")["commit_id"] == 2
    assert len(lake.read("run_log").inputFiles()) == 2  # one file per run


def test_replayed_id_keeps_its_first_row(lake, raw_layer):
    base = raw_layer(impressions=[("a", T), {"eid": "a", "timestamp": T + DAY, "uid": "other"}])
    for run_date in (DAY1, DAY2):
        silver.run_incremental(lake, base, run_date, run_date, now=run_at(DAY3))
    assert [(r["uid"], r["event_date"]) for r in lake.read("silver").collect()] == [
        ("u1", date(2024, 3, 1))
    ]


def test_click_ingested_before_its_impression(lake, raw_layer):
    """Lost by incremental runs, which read a click once; found by a refresh."""
    base = raw_layer(
        impressions=[{"eid": "a", "timestamp": T, "at": T + DAY}, ("z", T)],
        clicks=[{"eid": "a", "timestamp": T + 5, "at": T + 10}, ("z", T + 1)],
    )
    for run_date in (DAY1, DAY2):
        silver.run_incremental(
            lake, base, run_date, run_date, now=run_at(DAY3), require_match=False
        )
    assert flags(lake) == {"a": (0, -1), "z": (1, -1)}
    silver.run_full_refresh(lake, base, DAY1, DAY2, now=run_at(DAY3))
    assert flags(lake) == {"a": (1, -1), "z": (1, -1)}


def test_later_duplicate_click_in_its_own_batch(lake, raw_layer):
    """Incremental runs deduplicate per batch, so a valid duplicate can still match."""
    base = raw_layer(
        impressions=[("a", T)],
        clicks=[
            {"eid": "a", "timestamp": T - 60, "at": T + 1},
            {"eid": "a", "timestamp": T + 60, "at": T + DAY},
        ],
    )
    silver.run_incremental(lake, base, DAY1, DAY1, now=run_at(DAY2), require_match=False)
    silver.run_incremental(lake, base, DAY2, DAY2, now=run_at(DAY3))
    assert flags(lake) == {"a": (1, -1)}
    silver.run_full_refresh(lake, base, DAY1, DAY2, now=run_at(DAY3))
    assert flags(lake) == {"a": (0, -1)}


def test_rows_without_keys_are_set_aside(lake, raw_layer):
    base = raw_layer(
        impressions=[
            ("a", T),
            {"eid": None, "timestamp": T},
            {"eid": "b", "timestamp": None, "at": T},
            {"eid": "c", "timestamp": T, "uid": None},
        ]
    )
    silver.run_incremental(lake, base, DAY1, DAY1, now=run_at(DAY2))
    assert set(flags(lake)) == {"a"}


def test_events_without_any_match_stop_the_run(lake, raw_layer):
    base = raw_layer(impressions=[("a", T)], clicks=[("other", T + 5)])
    with pytest.raises(silver.NothingMatched, match="click"):
        silver.run_incremental(lake, base, DAY1, DAY1, now=run_at(DAY2))
    assert lake.last_run("silver") is None


def test_refresh_reads_later_clicks_and_stays_partitioned(lake, raw_layer, tmp_path):
    base = raw_layer(
        impressions=[("a", T), ("b", T + DAY)],
        clicks=[("a", T + 7 * DAY), ("b", T + DAY + 1)],
        conversions=[("a", T + 30 * DAY)],
    )
    silver.run_full_refresh(lake, base, DAY1, DAY1, now=run_at(DAY2))
    assert flags(lake) == {"a": (1, T + 30 * DAY)}
    assert f"event_date={DAY1}" in lake.read("silver").inputFiles()[0]


def test_refresh_replaces_older_days(lake, raw_layer):
    base = raw_layer(impressions=[("a", T), ("b", T + DAY)])
    silver.run_full_refresh(lake, base, DAY1, DAY2, now=run_at(DAY3))
    gold.run_daily(lake, run_at(DAY3))
    assert len(lake.days("gold")) == 2
    silver.run_full_refresh(lake, base, DAY2, DAY2, now=run_at(DAY3))
    assert set(flags(lake)) == {"b"} and lake.last_run("silver")["records"] == 1
    assert [r["event_date"] for r in lake.read("silver_days").collect()] == [date(2024, 3, 2)]
    # The lost day goes from the KPI table as well.
    assert [str(d) for d in gold.changed_days(lake)] == [DAY1]
    gold.run_daily(lake, run_at(DAY3))
    assert [str(d) for d in lake.days("gold")] == [DAY2] and gold.changed_days(lake) == []


def test_update_and_delete_on_the_stored_table(lake, raw_layer):
    base = raw_layer(impressions=[("a", T), ("b", T + DAY), {"eid": "c", "timestamp": T + DAY, "campaign": 2}])
    silver.run_full_refresh(lake, base, DAY1, DAY2, now=run_at(DAY3))
    gold.run_daily(lake, run_at(DAY3))
    silver.update_stored(lake, F.col("campaign") == 2, {"cost": F.lit(9.0)}, now=run_at("2024-03-04"))
    assert {r["event_id"]: r["cost"] for r in lake.read("silver").collect()} == {"a": 1.0, "b": 1.0, "c": 9.0}
    assert [str(d) for d in gold.changed_days(lake)] == [DAY2]
    silver.delete_stored(lake, F.col("event_id") == "a", now=run_at(DAY3))
    assert set(flags(lake)) == {"b", "c"} and [str(d) for d in lake.days("silver")] == [DAY2]
    gold.run_daily(lake, run_at(DAY3))
    assert [str(d) for d in lake.days("gold")] == [DAY2]
    silver.delete_stored(lake, F.col("event_id") == "none", now=run_at(DAY3))
    assert lake.last_run("silver")["records"] == 0
    silver.delete_stored(lake, F.lit(True), now=run_at(DAY3))
    assert lake.days("silver") == [] and lake.read("silver").count() == 0


def test_kpis_follow_a_click_that_changes_no_row_count(lake, raw_layer):
    base = raw_layer(
        impressions=[("a", T), ("b", T + DAY)], clicks=[("a", T + DAY + 1), ("b", T + DAY + 2)]
    )
    silver.run_incremental(lake, base, DAY1, DAY1, now=run_at(DAY2), require_match=False)
    gold.run_daily(lake, run_at(DAY2))
    before = lake.spark.createDataFrame(lake.read("silver").collect(), lake.read("silver").schema)
    silver.run_incremental(lake, base, DAY2, DAY2, now=run_at(DAY3))

    after = lake.read("silver")
    seen = {r[0].isoformat() for r in changes.changed_by_count(before, after).collect()}
    assert seen == {DAY2}
    seen = {r[0].isoformat() for r in changes.changed_by_content(before, after).collect()}
    assert seen == {DAY1, DAY2} == {d.isoformat() for d in gold.changed_days(lake)}

    gold.run_daily(lake, run_at(DAY3))
    clicks = {str(r["summary_date"]): r["clicks"] for r in lake.read("gold").collect()}
    assert clicks == {DAY1: 1, DAY2: 1}

    # Nothing is left to do, and a run without work is logged as well.
    assert gold.changed_days(lake) == [] and gold.run_daily(lake, run_at("2024-03-09")) == 0
    last = lake.last_run("gold")
    assert (last["records"], last["committed_at"]) == (0, run_at("2024-03-09"))


def test_a_day_without_campaigns_is_not_lost(lake, raw_layer):
    base = raw_layer(impressions=[{"eid": "a", "timestamp": T, "campaign": None}, ("b", T + DAY)])
    silver.run_incremental(lake, base, DAY1, DAY2, now=run_at(DAY3))
    gold.run_daily(lake, run_at(DAY3))
    assert [str(d) for d in lake.days("gold")] == [DAY2] and gold.changed_days(lake) == []


def test_kpi_modes_agree(lake, raw_layer):
    base = raw_layer(
        impressions=[("a", T), ("b", T + DAY), {"eid": "c", "timestamp": T, "campaign": None}],
        conversions=[("a", T + 3)],
    )
    silver.run_incremental(lake, base, DAY1, DAY2, now=run_at(DAY3))
    gold.run_range(lake, DAY1, DAY2, run_at(DAY3))
    ranged = content(lake.read("gold"))
    assert len(ranged) == 2
    gold.run_trailing(lake, DAY3, 30, run_at(DAY3))
    assert content(lake.read("gold")) == ranged
    gold.run_full_refresh(lake, DAY1, DAY2, run_at(DAY3))
    assert content(lake.read("gold")) == ranged
    gold.run_full_refresh(lake, DAY2, DAY2, run_at(DAY3))
    assert len(content(lake.read("gold"))) == 1
    with pytest.raises(ValueError):
        gold.run_full_refresh(lake, None, DAY2)
    with pytest.raises(ValueError):
        gold.run_full_refresh(lake, DAY2, DAY1)


def test_daily_run_and_its_gates(lake, raw_layer):
    base = raw_layer(impressions=[("a", T), ("b", T + 60)], clicks=[("a", T + 5)])
    daily.run_range(lake, base, run_at(DAY2))
    assert lake.read("gold").first()["clicks"] == 1
    with pytest.raises(checks.UnhealthyData, match="bronze_present"):
        daily.run_range(lake, base, run_at(DAY3))
    # An old date again on a later day: nothing changes and every gate passes.
    daily.run_range(lake, base, run_at("2024-03-09"), DAY1, DAY1)
    with pytest.raises(checks.UnhealthyData, match=DAY2[-2:]):
        daily.run_range(lake, base, run_at("2024-03-09"), DAY1, DAY2)


def test_daily_runs_leave_no_scratch_and_few_jobs(lake, raw_layer, spark):
    days = [f"2024-03-{n:02d}" for n in range(1, 6)]
    base = raw_layer(
        impressions=[(f"e{n}", T + n * DAY) for n in range(5)],
        clicks=[(f"e{n}", T + n * DAY + 9) for n in range(5)],
    )
    tracker, folder = spark.sparkContext.statusTracker(), Path(scratch_root(spark)) / "adlake"
    kept = sorted(folder.glob("*")) if folder.exists() else []
    for n, run_date in enumerate(days):
        spark.sparkContext.setJobGroup(f"daily-{n}", "")
        daily.run_range(lake, base, run_at("2024-03-11"), run_date, run_date, compact=False)
    jobs = len(tracker.getJobIdsForGroup("daily-4"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not [f for f in Path(lake.root).rglob(".spark-staging*")]
    assert sorted(folder.glob("*")) == kept
    assert len(flags(lake)) == 5 and all(click == 1 for click, _ in flags(lake).values())
    assert jobs <= 60


def test_gate_stops_when_the_layers_disagree(lake, raw_layer, spark):
    base = raw_layer(impressions=[(f"e{i}", T) for i in range(10)])
    silver.run_incremental(lake, base, DAY1, DAY1, now=run_at(DAY2))
    gold.run_range(lake, DAY1, DAY1, run_at(DAY2))
    short = lake.read("gold").withColumn("impressions", F.lit(8).cast("bigint"))
    found = checks.run_mismatch(lake.read("silver"), short, DAY1).first()
    assert tuple(found) == (10, 8, 20.0)
    close = short.withColumn("impressions", F.lit(9).cast("bigint"))
    checks.gate(checks.run_mismatch(lake.read("silver"), close, DAY1), "consistency")


class Killed(Exception):
    """Stands for a driver that dies."""


@pytest.fixture(scope="module")
def prepared():
    """What the tests below begin with, made once: raw events, a lake after the first day, and
    the content of both layers after two days that nobody disturbed."""
    return {}


@pytest.fixture
def after_one_day(spark, tmp_path, tmp_path_factory, raw_layer, prepared):
    if not prepared:
        kept = tmp_path_factory.mktemp("kept")
        base = raw_layer(
            impressions=[("a", T), ("b", T + DAY), ("c", T + DAY)],
            clicks=[("a", T + DAY + 5), ("b", T + DAY + 6)],
            conversions=[("a", T + 7)],
        )
        shutil.copytree(base, kept / "raw")
        lake = Lake(spark, str(kept / "lake"))
        silver.run_incremental(lake, base, DAY1, DAY1, now=run_at(DAY2), require_match=False)
        gold.run_daily(lake, run_at(DAY2))
        shutil.copytree(kept / "lake", kept / "one-day")
        day_two(lake, base)
        prepared.update(kept=kept, whole=(content(lake.read("silver")), content(lake.read("gold"))))
    shutil.copytree(prepared["kept"] / "one-day", tmp_path / "broken")
    return Lake(spark, str(tmp_path / "broken")), str(prepared["kept"] / "raw"), prepared["whole"]


def day_two(lake, base):
    silver.run_incremental(lake, base, DAY2, DAY2, now=run_at(DAY3))
    gold.run_daily(lake, run_at(DAY3))


@pytest.mark.parametrize("lost", ["silver", "gold"])
def test_a_day_lost_within_a_commit_is_rebuilt(after_one_day, monkeypatch, lost):
    """The overwrite dies when it has removed a day and not yet put the new one in place."""
    lake, base, whole = after_one_day
    original = Lake._write

    def dies(self, rows, layer, mode):
        if layer == lost and mode == "overwrite":
            self.drop_days(layer, {date.fromisoformat(DAY1)})
            raise Killed
        return original(self, rows, layer, mode)

    with monkeypatch.context() as broken, pytest.raises(Killed):
        broken.setattr(Lake, "_write", dies)
        day_two(lake, base)
    assert date.fromisoformat(DAY1) not in lake.days(lost)
    day_two(lake, base)
    assert (content(lake.read("silver")), content(lake.read("gold"))) == whole


@pytest.mark.parametrize("step", ["append", "_write", "note", "summarize", "record"])
def test_a_run_killed_anywhere_is_repaired_by_the_next(after_one_day, monkeypatch, step):
    """Dies at calls of a step in turn; the repeated run's layers equal those of a run nobody
    disturbed."""
    lake, base, whole = after_one_day
    original, calls = getattr(Lake, step), {"n": 0, "die": 0}

    def dies(self, *args, **kwargs):
        calls["n"] += 1
        if calls["n"] == calls["die"]:
            raise Killed
        return original(self, *args, **kwargs)

    for die in (1, 3):
        calls.update(n=0, die=die)
        with monkeypatch.context() as broken:
            broken.setattr(Lake, step, dies)
            try:
                day_two(lake, base)
            except Killed:
                pass
    day_two(lake, base)
    assert (content(lake.read("silver")), content(lake.read("gold"))) == whole
    assert lake.last_run("gold")["committed_at"] == run_at(DAY3)


def test_views_and_reports_by_name(lake, raw_layer, spark):
    base = raw_layer(impressions=[("a", T), ("b", T + 60)], clicks=[("a", T + 5)])
    daily.run_range(lake, base, run_at(DAY2))
    lake.register_views()
    rows = spark.sql("SELECT campaign, impressions FROM gold JOIN run_log ON layer = 'gold'").collect()
    assert [tuple(r) for r in rows] == [(1, 2)]
    found = {name: reports.report(lake, name, DAY2).count() for name in reports.REPORTS}
    assert found["volume"] == found["files"] == found["quality"] == 1
    assert found["users"] == 3 and found["delays"] == 2
    assert found["recent-runs"] >= 2 and found["runs"] == found["retention"] == 2
    assert all(found[n] == 0 for n in found if n.startswith("gate-")) and found["stray-days"] == 0


def test_times_prune_days_in_sql(lake, raw_layer, spark):
    base = raw_layer(impressions=[(f"e{n}", T + n * DAY) for n in range(6)])
    silver.run_incremental(lake, base, DAY1, "2024-03-06", now=run_at("2024-03-07"))
    lake.register_views()
    found = spark.sql(
        "SELECT event_id FROM silver_between(TIMESTAMP '2024-03-02 13:00:00', TIMESTAMP '2024-03-04 12:00:01')"
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "event_date#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert sorted(r[0] for r in found.collect()) == ["e2", "e3"]
    read = spark.sql(
        "SELECT count(DISTINCT event_date) FROM silver_between(TIMESTAMP '2024-03-03', TIMESTAMP '2024-03-03 23:00:00')"
    )
    assert read.first()[0] == 1


def test_only_days_that_may_hold_an_id_are_opened(lake, raw_layer, events, monkeypatch):
    """New ids open no stored day; a replayed id opens the day that holds it."""
    base = raw_layer(impressions=[(f"e{n}", T + n * DAY) for n in range(8)])
    silver.run_incremental(lake, base, DAY1, "2024-03-08", now=run_at("2024-03-09"))

    def opened(*items):
        rows = silver.silver_rows(events("impression", *items))
        days = lake.days_holding(rows)
        ends = rows.agg(F.min("event_id"), F.max("event_id")).first()
        fresh = silver.absent_rows(lake, rows, *ends)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        return [str(d) for d in days], plan.count("FileScan"), {r["event_id"] for r in fresh.collect()}

    assert opened(("x1", T), ("e10", T), ("x2", T + 30 * DAY)) == ([], 0, {"x1", "e10", "x2"})
    days, scans, fresh = opened(("e3", T), ("x1", T), ("e3a", T))
    assert (days, scans, fresh) == (["2024-03-04"], 1, {"x1", "e3a"})
    assert opened(*[(f"e{n}", T) for n in range(8)])[2] == set()


def test_raw_reader_takes_both_end_dates(spark, raw_layer):
    base = raw_layer(impressions=[("a", T), ("b", T + DAY), ("c", T + 2 * DAY)])
    frame = read_raw(spark, base, "impression", DAY1, DAY2)
    assert {r["eid"] for r in frame.collect()} == {"a", "b"}
    assert read_raw(spark, base, "click", DAY1, DAY2).count() == 0


def test_windows_can_be_changed(lake, raw_layer):
    base = raw_layer(impressions=[("a", T), ("b", T)], clicks=[("a", T + 2 * DAY), ("b", T + 1)])
    silver.run_incremental(
        lake, base, DAY1, DAY3, silver.Windows(click_days=1), now=run_at(DAY3)
    )
    assert flags(lake) == {"a": (0, -1), "b": (1, -1)}
