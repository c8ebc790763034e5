import json

import pytest
from pyspark.sql import functions as F

from adlake import schemas
from adlake.sources.tables import read_or_empty
from adlake.sources.topics import read_file_topic, read_kafka_topic
from adlake.streaming import bronze

NOW_ONLY = {"availableNow": True}


def message(number, value):
    return json.dumps(
        {"value": value, "partition": 0, "offset": number, "timestamp": "2024-03-01T12:00:01Z"}
    )


def event(eid, **extra):
    return json.dumps(
        {
            "eid": eid,
            "uid": "u",
            "timestamp": 1709294400,
            "event_time": "2024-03-01T12:00:00+00:00",
            "event_type": "impression",
            "campaign": 4,
            **extra,
        }
    )


@pytest.fixture
def topics(tmp_path):
    def write(event_type, name, *messages):
        folder = tmp_path / "topics" / event_type
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("\n".join(messages) + "\n")

    for event_type in schemas.EVENT_TYPES:
        write(event_type, "first.json", message(0, event(f"{event_type}-0", cost=0.5)))
    write.root = tmp_path
    return write


def stream(spark, root, only=None, checkpoint="cp"):
    queries = bronze.start_streams(
        spark,
        lambda t: read_file_topic(spark, f"{root}/topics/{t}"),
        f"{root}/raw",
        f"{root}/{checkpoint}",
        only,
        NOW_ONLY,
    )
    for query in queries.values():
        query.awaitTermination()
    return queries


def raw(spark, root, event_type):
    return read_or_empty(spark, f"{root}/raw/{event_type}s", schemas.RAW[event_type])


def test_streams_append_and_resume(spark, topics):
    root = topics.root
    assert set(stream(spark, root)) == set(schemas.EVENT_TYPES)
    assert [raw(spark, root, t).count() for t in schemas.EVENT_TYPES] == [1, 1, 1]
    stream(spark, root)
    assert raw(spark, root, "impression").count() == 1
    topics("impression", "second.json", message(1, event("impression-1")))
    stream(spark, root)
    assert {r["eid"] for r in raw(spark, root, "impression").collect()} == {
        "impression-0",
        "impression-1",
    }
    row = raw(spark, root, "impression").where("kafka_offset = 0").first()
    assert (row["cost"], row["campaign"], row["kafka_partition"]) == (0.5, 4, 0)
    assert row["raw_date"] == row["ingest_ts"].date() and row["raw_hour"] == row["ingest_ts"].hour
    assert "raw_date=" in raw(spark, root, "click").inputFiles()[0]


def test_new_checkpoint_replays(spark, topics):
    stream(spark, topics.root, "click")
    stream(spark, topics.root, "click", checkpoint="replay")
    assert raw(spark, topics.root, "click").count() == 2


def test_only_one_topic(spark, topics):
    assert list(stream(spark, topics.root, "click")) == ["click"]
    assert not (topics.root / "raw" / "impressions").exists()
    with pytest.raises(ValueError):
        stream(spark, topics.root, "view")


def test_malformed_messages_are_kept_and_set_aside(spark, topics):
    topics(
        "impression",
        "bad.json",
        message(7, "{not json"),
        message(8, json.dumps({"uid": "u", "timestamp": 5})),
    )
    stream(spark, topics.root, "impression")
    frame = raw(spark, topics.root, "impression")
    assert {r["kafka_offset"] for r in schemas.quarantined(frame).collect()} == {7, 8}
    assert schemas.keyed(frame).count() == 1


def test_binary_values_decode(spark):
    messages = spark.createDataFrame(
        [(event("x").encode(), 1, 2)], "value binary, partition int, offset bigint"
    ).withColumn("timestamp", F.lit("2024-03-01 12:00:01").cast("timestamp"))
    row = bronze.parse_topic(messages, "click").first()
    assert row["eid"] == "x" and "cost" not in row.asDict()


def test_kafka_options(spark):
    with pytest.raises(ValueError):
        read_kafka_topic(spark, "t", "localhost:9092", "middle")
