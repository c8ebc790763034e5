from datetime import date

import pytest
from helpers import seconds
from pyspark.sql import functions as F

from adlake.operators import attribution as at
from adlake.operators.dedup import first_per_key, unique_by

T = seconds("2024-03-01 12:00:00")
EDGES = [
    (-1, None, None),
    (0, 0, 0),
    (at.CLICK_WINDOW, at.CLICK_WINDOW, at.CLICK_WINDOW),
    (at.CLICK_WINDOW + 1, None, at.CLICK_WINDOW + 1),
    (at.CONVERSION_WINDOW, None, at.CONVERSION_WINDOW),
    (at.CONVERSION_WINDOW + 1, None, None),
]


def by_eid(df, *columns):
    return {row["eid"]: tuple(row[c] for c in columns) for row in df.collect()}


def test_window_ends_are_inclusive(events):
    """The window holds both its ends, nothing before the impression and nothing after."""
    shown = events("impression", *((f"e{i}", T) for i in range(len(EDGES))))
    later = [(f"e{i}", T + delta) for i, (delta, _, _) in enumerate(EDGES)]
    result = by_eid(
        at.attribute_all(shown, events("click", *later), events("conversion", *later)),
        "click_ts",
        "conv_ts",
    )
    for i, (_, click, conversion) in enumerate(EDGES):
        expected = tuple(None if d is None else T + d for d in (click, conversion))
        assert result[f"e{i}"] == expected


def test_batch_match_uses_the_same_window(events):
    shown = events("impression", *((f"e{i}", T) for i in range(len(EDGES))))
    stored = at.silver_rows(first_per_key(shown, ["eid"]))
    later = events("click", *((f"e{i}", T + d) for i, (d, _, _) in enumerate(EDGES)))
    for window, column in ((at.CLICK_WINDOW, 1), (at.CONVERSION_WINDOW, 2)):
        near = at.candidates(at.describe_batch(later), window)
        for silver in (stored, stored.where(near)):
            found = {r["event_id"]: r for r in at.match_events(later, silver, window).collect()}
            wanted = {f"e{i}": e[column] for i, e in enumerate(EDGES) if e[column] is not None}
            assert {k: r["match_delay_sec"] for k, r in found.items()} == wanted


def test_unattributed_row_has_sentinels(events):
    row = at.silver_rows(events("impression", {"eid": "a", "timestamp": T, "cost": None})).first()
    assert (row["click"], row["conversion"]) == (0, 0)
    assert (row["conversion_timestamp"], row["conversion_delay_sec"]) == (-1, -1)
    assert row["cost"] == 0.0
    assert (row["event_date"], row["event_hour"]) == (date(2024, 3, 1), 12)


def test_bad_event_time_is_null_and_never_matches(events):
    shown = events("impression", {"eid": "a", "timestamp": T, "event_time": "soon"})
    clicks = events("click", ("a", T + 5))
    stored = at.silver_rows(shown)
    assert stored.first()["event_time"] is None
    assert at.match_events(clicks, stored, at.CLICK_WINDOW).count() == 0
    # A refresh compares unix seconds instead, so it does attribute the click.
    assert at.attribute_all(shown, clicks, events("conversion")).first()["click_ts"] == T + 5


def test_time_that_was_not_remapped_lands_in_1970(events):
    row = at.silver_rows(events("impression", ("a", 50307))).first()
    assert row["event_date"] == date(1970, 1, 1)


def test_absurd_time_does_not_fail_the_batch(events):
    frame = events("impression", ("a", T)).withColumn("timestamp", F.lit(2**62))
    assert at.silver_rows(frame).select("event_id").count() == 1


def test_earliest_arrival_is_kept_and_offset_breaks_ties(events):
    shown = events(
        "impression",
        {"eid": "a", "timestamp": T, "at": T + 9, "offset": 1, "uid": "late"},
        {"eid": "a", "timestamp": T, "at": T + 5, "offset": 8, "uid": "tie"},
        {"eid": "a", "timestamp": T, "at": T + 5, "offset": 3, "uid": "first"},
    )
    assert by_eid(first_per_key(shown, ["eid"]), "uid") == {"a": ("first",)}


def test_refresh_ignores_a_valid_duplicate_after_an_invalid_first(events):
    """Deduplication comes before the window test."""
    clicks = events(
        "click",
        {"eid": "a", "timestamp": T - 60, "at": T + 1},
        {"eid": "a", "timestamp": T + 60, "at": T + 90},
    )
    result = at.attribute_all(events("impression", ("a", T)), clicks, events("conversion"))
    assert result.first()["click_ts"] is None


def test_batch_is_bounded_by_its_earliest_day_and_its_keys(events):
    batch = at.describe_batch(events("click", ("a", T), ("b", T - 86400), ("c", T + 86400)))
    assert (batch.earliest, batch.first_key, batch.last_key) == (date(2024, 2, 29), "a", "c")
    assert at.first_day(batch, at.CLICK_WINDOW) == date(2024, 2, 22)
    text = str(at.candidates(batch, at.CLICK_WINDOW)._jc.toString())
    assert "2024-02-22" in text and "2024-03" not in text


def test_batch_of_a_thousand_days_has_the_same_filter(events):
    later = [(f"e{i}", T + i * 86400) for i in range(1000)]
    stored = at.silver_rows(events("impression", *((f"e{i}", T) for i in range(1000))))
    shapes = []
    for clicks in (later[:2], later):
        near = at.candidates(at.describe_batch(events("click", *clicks)), at.CLICK_WINDOW)
        matched = at.match_events(events("click", *clicks), stored.where(near), at.CLICK_WINDOW)
        shapes.append((str(near._jc.toString()).count("event_date"), matched.count()))
    assert shapes == [(1, 2), (1, 8)]


def test_match_across_midnight(events, spark):
    """The stored day comes from the timestamp, a minute after midnight; the event time, and
    the click, lie before it."""
    shown = {"eid": "a", "timestamp": T + 43260, "event_time": "2024-03-01T23:59:50+00:00"}
    stored = at.silver_rows(events("impression", shown))
    assert stored.first()["event_date"] == date(2024, 3, 2)
    clicks = events("click", ("a", seconds("2024-03-01 23:59:55")))
    near = stored.where(at.candidates(at.describe_batch(clicks), at.CLICK_WINDOW))
    assert at.match_events(clicks, near, at.CLICK_WINDOW).count() == 1


def test_empty_batch_reads_nothing(events):
    batch = at.describe_batch(events("click"))
    assert batch.earliest is None and at.first_day(batch, at.CLICK_WINDOW) is None
    stored = at.silver_rows(events("impression", ("a", T)))
    assert stored.where(at.candidates(batch, at.CLICK_WINDOW)).count() == 0


def test_unmatched_alert(events):
    clicks, none = events("click", ("a", T), ("b", T)), events("click")
    assert tuple(at.unmatched_alert("click", clicks, none).first()) == ("click", 2, 0)
    assert at.unmatched_alert("click", clicks, clicks.limit(1)).count() == 0
    assert at.unmatched_alert("click", none, none).count() == 0


def test_unique_by_fails_on_a_repeated_key(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    good = unique_by(rows.where("k = 1 or v = 'b'"), ["k"])
    assert sorted(tuple(r) for r in good.collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="several source rows"):
        unique_by(rows, ["k"]).collect()


def test_hot_key_against_brute_force(spark):
    """A third of all events share one id; the rest are random."""
    import random

    from pyspark.sql import types as ty

    rng, rows = random.Random(7), []
    for number in range(6000):
        eid = "hot" if number % 3 == 0 else f"e{rng.randrange(900)}"
        rows.append((eid, rng.randrange(10_000), number % 5, rng.randrange(4)))
    schema = "eid string, ingest_ts long, kafka_partition int, kafka_offset int"
    frame = spark.createDataFrame(rows, schema).repartition(8)
    expected = {}
    for eid, at_, part, offset in rows:
        best = (at_, offset, part)
        expected[eid] = min(expected.get(eid, best), best)
    found = first_per_key(frame, ["eid"]).collect()
    assert {r["eid"]: (r[1], r[3], r[2]) for r in found} == expected
    assert isinstance(frame.schema["eid"].dataType, ty.StringType)
