import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from adlake import schemas  # noqa: E402
from adlake.session import RESULT_SETTINGS  # noqa: E402
from adlake.sources.tables import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in RESULT_SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    """Builds raw events of one type from (eid, unix seconds) pairs or dicts."""

    def build(event_type, *items, ingested=None):
        rows = []
        for number, item in enumerate(items):
            row = item if isinstance(item, dict) else {"eid": item[0], "timestamp": item[1]}
            t = row.get("timestamp")
            at = row.get("at", ingested or (0 if t is None else t + 10))
            rows.append(
                (
                    row.get("eid"),
                    row.get("uid", "u1"),
                    t,
                    row.get("event_time", "same"),
                    row.get("campaign", 1),
                    row.get("cost", 1.0),
                    row.get("offset", number),
                    at,
                )
            )
        frame = spark.createDataFrame(
            rows,
            "eid string, uid string, timestamp bigint, event_time string, campaign int, "
            "cost double, kafka_offset bigint, at bigint",
        )
        text = "CASE WHEN event_time = 'same' THEN "
        text += "date_format(cast(timestamp as timestamp), \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\") "
        text += "ELSE event_time END"
        return frame.selectExpr(
            "eid",
            "uid",
            "timestamp",
            f"{text} AS event_time",
            f"'{event_type}' AS event_type",
            "campaign",
            "cost",
            "0 AS kafka_partition",
            "kafka_offset",
            "cast(timestamp as timestamp) AS kafka_timestamp",
            "cast(at as timestamp) AS ingest_ts",
            "to_date(cast(at as timestamp)) AS raw_date",
            "hour(cast(at as timestamp)) AS raw_hour",
        ).select(*schemas.RAW[event_type].names)

    return build


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))
