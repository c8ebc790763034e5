"""Partitioned Parquet tables of the lake, and the small tables that tell about them.

Days are replaced by Spark's own dynamic partition overwrite: its committer writes new days aside
and puts them in place when the job commits. Rows may be computed from the table they replace.
Days left without rows are deleted afterwards. A run that dies before the commit changed nothing
and is repeated; one that dies within it may leave a day absent, which :meth:`Lake.lost_days`
finds from the day summaries, and the row-level job then rebuilds such days from raw events.
Readers meanwhile see some days old and some new. One run writes a lake at a time.

What is known about days (:data:`NOTES`) is appended, one file per run. The latest note of a day
counts, and a day that is gone has a note of no rows.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake import schemas
from adlake.functions.columns import as_utc, column
from adlake.operators import id_filter
from adlake.operators.changes import SUMMARY_COLUMNS, day_summaries
from adlake.sources import files

TABLES = {
    "silver": ("event_date", schemas.SILVER),
    "gold": ("summary_date", schemas.GOLD),
    "gold_sketches": ("summary_date", schemas.SKETCHES),
}
PARTITION = {name: partition for name, (partition, _) in TABLES.items()}
NOTES = {
    # What is known about every day of the row-level table, and what the KPI table was made of.
    "silver_days": schemas.DAY_NOTE,
    "gold_days": schemas.DAY_NOTE,
    # Filters of the ids each batch brought to a day.
    "id_filters": schemas.ID_FILTER,
    # Orders that days were rewritten in.
    "layouts": schemas.LAYOUT,
    "run_log": schemas.RUN_LOG,
    "stream_log": schemas.STREAM_LOG,
}
VIEWS = ("silver", "gold", "gold_sketches", "silver_days", "run_log", "stream_log")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet folder under its declared schema; no rows where nothing was written yet."""
    if not files.exists(spark, path):
        return schemas.empty(spark, schemas.nullable(schema))
    return spark.read.schema(schemas.nullable(schema)).parquet(path)


def read_folders(
    spark: SparkSession, root: str, partition: str, values: list[str], schema: T.StructType
) -> DataFrame:
    """The given partition values of a table. Folders of other values are not listed."""
    if not values:
        return schemas.empty(spark, schemas.nullable(schema))
    folders = [f"{root}/{partition}={value}" for value in values]
    reader = spark.read.schema(schemas.nullable(schema)).option("basePath", root)
    return reader.parquet(*folders)


def balanced(df: DataFrame, *partition: str) -> DataFrame:
    """Rows placed for a partitioned write.

    The rebalance hint lets AQE cut large partition values into several tasks and pack small
    ones together. Without it every task would write a file per value, or one task would
    write a whole value however many rows it has.
    """
    return df.hint("rebalance", *partition)


def between_times(df: DataFrame, time: str, partition: str, start, end) -> DataFrame:
    """Rows with ``start <= time < end`` of a table stored by the day of ``time``.

    The days are stated as well, so that folders outside them are not read.
    """
    first, last = (F.lit(str(value)).cast("timestamp") for value in (start, end))
    inside = (column(time) >= first) & (column(time) < last)
    return df.where(inside & F.col(partition).between(F.to_date(first), F.to_date(last)))


def time_function(spark: SparkSession, name: str, view: str, time: str, partition: str) -> None:
    """``name(start, end)`` for SQL: :func:`between_times` of a view, so that a caller who knows
    times only still reads the days concerned only. A row whose day is not that of its time is
    found by its day alone."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(view).schema)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(start_time TIMESTAMP, end_time TIMESTAMP) "
        f"RETURNS TABLE({fields}) RETURN SELECT * FROM {view} "
        f"WHERE `{time}` >= start_time AND `{time}` < end_time "
        f"AND `{partition}` BETWEEN to_date(start_time) AND to_date(end_time)"
    )


class Lake:
    """Row-level and KPI tables below one root, with the small tables about them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def location(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def days(self, layer: str) -> list[date]:
        """The days a layer holds, from its folder names."""
        values = files.partition_values(self.spark, self.location(layer), PARTITION[layer])
        return [date.fromisoformat(value) for value in values]

    def read(self, layer: str) -> DataFrame:
        """A table as it stands; of day notes the latest of each day that has rows."""
        schema = NOTES[layer] if layer in NOTES else TABLES[layer][1]
        stored = read_or_empty(self.spark, self.location(layer), schema)
        if schema is not schemas.DAY_NOTE:
            return stored
        # One row per day and run: few enough for one task, which spares the shuffle.
        latest = stored.coalesce(1).groupBy("event_date").agg(
            *(F.max_by(name, "noted_at").alias(name) for name in SUMMARY_COLUMNS)
        )
        return latest.where(F.col("row_count") > 0)

    def read_days(self, layer: str, days: list[date]) -> DataFrame:
        """The given days only, as far as they exist."""
        partition, schema = TABLES[layer]
        wanted = set(days)
        held = [str(day) for day in self.days(layer) if day in wanted]
        return read_folders(self.spark, self.location(layer), partition, held, schema)

    def register_views(self) -> None:
        """Make the tables known to SQL under their names, and ``silver_between(start, end)``."""
        for layer in VIEWS:
            self.read(layer).createOrReplaceTempView(layer)
        time_function(self.spark, "silver_between", "silver", "event_time", "event_date")

    def append(
        self, layer: str, rows: DataFrame, ids_noted: bool = False, placed: bool = False
    ) -> int:
        """Add rows; existing files stay as they are. Returns how many rows there were.

        New row-level rows have their ids noted first, unless they are ``ids_noted``. ``placed``
        rows keep their arrangement.
        """
        partition, schema = TABLES[layer]
        if layer == "silver" and not ids_noted:
            self.note_ids(rows)
        rows = schemas.conform(rows, schema)
        return self._write(rows if placed else balanced(rows, partition), layer, "append")[0]

    def replace_days(
        self, layer: str, rows: DataFrame, days: list[date] | None, placed: bool = False
    ) -> int:
        """Make ``rows`` the content of the given days; days without rows become empty.

        Without ``days``, all days of the table are replaced. ``rows`` may read the table.
        ``placed`` rows keep their arrangement.
        """
        partition, schema = TABLES[layer]
        wanted = set(self.days(layer)) if days is None else set(days)
        if not placed:
            rows = balanced(schemas.conform(rows, schema), partition)
        if days is not None:
            rows = rows.withColumn(partition, self._expected(layer, wanted))
        count, found = self._write(rows, layer, "overwrite")
        self.drop_days(layer, wanted - found)
        return count

    def _expected(self, layer: str, days: set[date]) -> Column:
        """The day of a row, failing the query if it is none of ``days``. As a value, not as a
        filter: the optimizer would evaluate a filter on the other side of a join too."""
        day = F.col(PARTITION[layer])
        stray = F.raise_error(F.concat(F.lit(f"{layer}: rows of a day not replaced: "), day.cast("string")))
        inside = day.isin(sorted(days)) if days else F.lit(False)
        return F.when(inside, day).otherwise(stray.cast("date"))

    def drop_days(self, layer: str, days: set[date]) -> None:
        for day in days & set(self.days(layer)):
            files.delete(self.spark, f"{self.location(layer)}/{PARTITION[layer]}={day}")

    def lost_days(self) -> list[date]:
        """Days of the row-level table that have rows by their notes and no folder: a dead run's
        commit lost them."""
        noted = self.read("silver_days").select("event_date").collect()  # one row per day
        return sorted({row[0] for row in noted} - set(self.days("silver")))

    def note(self, name: str, rows: DataFrame) -> None:
        """Append rows to a small table, as one file."""
        schemas.conform(rows, NOTES[name]).coalesce(1).write.mode("append").parquet(self.location(name))

    def note_days(self, name: str, summaries: DataFrame, gone: set[date]) -> None:
        """Note day summaries, and days that have no rows any more."""
        noted = summaries
        if gone:
            none = self.spark.createDataFrame([(day, 0) for day in sorted(gone)], "event_date date, row_count bigint")
            noted = summaries.unionByName(none, allowMissingColumns=True)
        self.note(name, noted.withColumn("noted_at", F.unix_micros(F.current_timestamp())))

    def summarize(self, days: list[date]) -> None:
        """Note the summaries of the given days of the row-level table."""
        gone = set(days) - set(self.days("silver"))
        self.note_days("silver_days", day_summaries(self.read_days("silver", days)), gone)

    def note_ids(self, rows: DataFrame) -> None:
        """Note the ids of row-level rows about to be stored."""
        self.note("id_filters", id_filter.build(rows, "event_id", "event_date"))

    def days_holding(self, rows: DataFrame, count: int | None = None) -> list[date]:
        """Days that may hold an id of ``rows``; a day it leaves out holds none of them."""
        filters = self.read("id_filters")
        hits = id_filter.probe(filters, rows.select("event_id"), "event_id", "event_date", count)
        return sorted(row[0] for row in hits.collect())  # one row per day

    def log(self) -> DataFrame:
        return self.read("run_log")

    def last_run(self, layer: str) -> dict | None:
        row = self.log().where(F.col("layer") == layer).orderBy(F.desc("commit_id")).first()
        return row.asDict() if row else None

    def record(self, layer: str, operation: str, records: int, now: datetime | None) -> None:
        """Log a finished run, also one that changed nothing. Its number follows the last one's."""
        at = as_utc(now or datetime.now(timezone.utc))
        # The log of a layer has one row per run; one task reads it, and nothing is shuffled.
        last = self.log().coalesce(1).where(F.col("layer") == layer).agg(F.max("commit_id").alias("parent_id"))
        self.note(
            "run_log",
            last.select(
                F.lit(layer).alias("layer"),
                (F.coalesce("parent_id", F.lit(0)) + 1).alias("commit_id"),
                "parent_id",
                F.lit(at).alias("committed_at"),
                F.lit(operation).alias("operation"),
                F.lit(records).cast("bigint").alias("records"),
            ),
        )

    def _write(self, rows: DataFrame, layer: str, mode: str) -> tuple[int, set[date]]:
        """Rows written and the days they are of."""
        partition, seen = PARTITION[layer], Observation()
        rows = rows.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.collect_set(partition).alias("days")
        )
        writer = rows.write.mode(mode).partitionBy(partition)
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.location(layer))
        return seen.get["rows"], set(seen.get["days"])
