"""Compaction of stored partitions.

A layout is noted with the files and bytes it left in a day; while both stay the same, the day is
in that layout still and is left alone.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.operators.maintain import (
    TARGET_FILE_BYTES,
    file_report,
    files_needed,
    inventory,
    place_files,
    place_sorted_files,
    with_zorder,
)
from adlake.plans.silver import as_date
from adlake.session import scratch
from adlake.sources.tables import PARTITION, Lake

# Attribution can change a day for 30 days; five more cover late ingestion.
COMPACTED_DAYS = 35

ROW_KEY = {"silver": "event_id", "gold": "campaign"}
ZORDER = {"silver": ("campaign", "event_id"), "gold": ("campaign", "summary_date")}


def report_files(lake: Lake) -> DataFrame:
    """Files, sizes and rows per day of the row-level table."""
    return file_report(files_of(lake, "silver"), lake.read("silver_days"))


def files_of(lake: Lake, layer: str) -> DataFrame:
    """(day, file_path, file_bytes) of a layer."""
    if not lake.days(layer):
        schema = f"{PARTITION[layer]} date, file_path string, file_bytes bigint"
        return lake.spark.createDataFrame([], schema)
    return inventory(lake.spark, lake.location(layer), PARTITION[layer])


def day_layouts(lake: Lake, layer: str, since: date) -> DataFrame:
    """(event_date, files, bytes) of the recent days."""
    day = F.col(PARTITION[layer])
    return (
        files_of(lake, layer)
        .where(day >= F.lit(since))
        .groupBy(day.alias("event_date"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("file_bytes").alias("bytes"))
    )


def planned(lake: Lake, layer: str, layout: str, as_of, target_bytes: int) -> list[tuple[date, int]]:
    """Recent days to rewrite and the number of files each gets, at most COMPACTED_DAYS entries.

    Packing asks for days with more files than their size needs; another layout for days not
    noted to be in it.
    """
    found = day_layouts(lake, layer, as_date(as_of) - timedelta(days=COMPACTED_DAYS))
    wanted = files_needed(F.col("bytes"), target_bytes).alias("wanted")
    if layout == "packed":
        due = found.where(F.col("files") > wanted)
    else:
        noted = lake.read("layouts").where((F.col("layer") == layer) & (F.col("layout") == layout))
        due = found.join(noted, ["event_date", "files", "bytes"], "left_anti")
    return [tuple(r) for r in due.select("event_date", wanted).orderBy("event_date").collect()]


def note_layout(lake: Lake, layer: str, layout: str, days: list[date]) -> None:
    made = day_layouts(lake, layer, min(days)).where(F.col("event_date").isin(days))
    lake.note("layouts", made.withColumns({"layer": F.lit(layer), "layout": F.lit(layout)}))


def compact_binpack(
    lake: Lake,
    as_of: date | str,
    target_bytes: int = TARGET_FILE_BYTES,
    layer: str = "silver",
    now: datetime | None = None,
) -> int | None:
    """Rewrite the recent days that have more files than their size needs."""
    plan = planned(lake, layer, "packed", as_of, target_bytes)
    if not plan:
        return None
    days = [day for day, _ in plan]
    rows = lake.read_days(layer, days)
    placed = place_files(rows, plan, PARTITION[layer], [ROW_KEY[layer]])
    records = lake.replace_days(layer, placed, days, placed=True)
    lake.record(layer, "compact", 0, now)
    return records


def compact_sorted(
    lake: Lake,
    as_of: date | str,
    sort_by: str = "campaign",
    target_bytes: int = TARGET_FILE_BYTES,
    layer: str = "silver",
    now: datetime | None = None,
) -> int | None:
    """Rewrite the recent days sorted by ``sort_by``, so that filters on it skip files."""
    return _ordered(lake, as_of, f"sort {sort_by}", [sort_by], None, target_bytes, layer, now)


def compact_zorder(
    lake: Lake,
    as_of: date | str,
    columns: tuple[str, ...] | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
    layer: str = "silver",
    now: datetime | None = None,
) -> int | None:
    """Rewrite the recent days along a z-order of ``columns``, so that filters on any of them
    skip files."""
    columns = columns or ZORDER[layer]
    layout = f"zorder {','.join(columns)}"
    return _ordered(lake, as_of, layout, ["_z", *columns], columns, target_bytes, layer, now)


def _ordered(lake, as_of, layout, order, zorder, target_bytes, layer, now) -> int | None:
    """One placement for all days due, whatever their numbers of files."""
    plan = planned(lake, layer, layout, as_of, target_bytes)
    if not plan:
        return None
    days, partition = [day for day, _ in plan], PARTITION[layer]
    rows = lake.read_days(layer, days)
    columns = rows.columns
    if zorder:  # within a day its own column has one value
        rows = with_zorder(rows, partition, tuple(c for c in zorder if c != partition))
    order = [c for c in dict.fromkeys([*order, ROW_KEY[layer]]) if c != partition]
    with scratch(lake.spark, "sorting") as folder:
        placed = place_sorted_files(rows, plan, partition, order, folder).select(*columns)
        records = lake.replace_days(layer, placed, days, placed=True)
    note_layout(lake, layer, layout, days)
    lake.record(layer, layout.split()[0], 0, now)
    return records
