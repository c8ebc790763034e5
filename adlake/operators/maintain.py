"""File layout: inventory and compaction. Row content never changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators.wide import number_rows

TARGET_FILE_BYTES = 128 * 1024 * 1024
#: Ranks of 6 bits: 4,096 cells of two columns in every day.
ZORDER_BITS, ZORDER_SAMPLE = 6, 4_096


def inventory(spark: SparkSession, root: str, partition: str) -> DataFrame:
    """(``partition``, file_path, file_bytes) of a table's data files.

    A scan of the binary-file source that asks for no content opens no file; Spark lists the
    folders, on executors where they are many, and a filter on ``partition`` prunes them.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return reader.load(root).select(
        F.col(partition).cast("date").alias(partition),
        F.col("path").alias("file_path"),
        F.col("length").alias("file_bytes"),
    )


def file_report(files: DataFrame, days: DataFrame, partition: str = "event_date") -> DataFrame:
    """Files, sizes and rows per day, from an :func:`inventory` and the table's day summaries, so
    that no data file is opened."""
    megabyte = 1048576.0
    sized = files.groupBy(partition).agg(
        F.lit("data").alias("file_type"),
        F.count(F.lit(1)).alias("file_count"),
        F.round(F.sum("file_bytes") / megabyte, 2).alias("total_mb"),
        F.round(F.avg("file_bytes") / megabyte, 2).alias("avg_file_mb"),
    )
    counted = days.select(partition, F.col("row_count").alias("total_records"))
    return sized.join(counted, partition, "left")


def files_needed(total_bytes: Column, target_bytes: int = TARGET_FILE_BYTES) -> Column:
    """How many files of about ``target_bytes`` hold the given bytes."""
    return F.greatest(F.lit(1), F.ceil(total_bytes / F.lit(target_bytes))).cast("int")


def place_files(rows: DataFrame, plan: list, partition: str, spread_by: list[str]) -> DataFrame:
    """Rows placed so that each partition value is written as its planned number of files.

    ``plan`` lists (partition value, number of files), one entry per partition to compact.
    Each file has its own task, however uneven the partitions are: a day with a third of all
    rows is planned more files and split over as many tasks.
    """
    starts, total = [], 0
    for value, files in plan:
        starts.append((value, files, total))
        total += files
    kind = rows.schema[partition].dataType.simpleString()
    # One row per partition value under compaction, so its size does not follow the data.
    lookup = rows.sparkSession.createDataFrame(
        starts, f"{partition} {kind}, _files int, _start int"
    )
    own_file = F.pmod(F.xxhash64(*spread_by), F.col("_files")) + F.col("_start")
    return (
        rows.join(F.broadcast(lookup), partition)
        .repartitionById(total, own_file.cast("int"))
        .select(*rows.columns)
    )


def place_sorted_files(
    rows: DataFrame, plan: list, partition: str, order: list[str], path: str
) -> DataFrame:
    """Rows placed and sorted so that each file covers a narrow range of values.

    A reader that filters on the leading sort column then skips files by their min and max.
    One rule for every day: its rows are numbered in ``order`` and cut into the planned number
    of equal runs, so a day gets exactly its files however its values are spread, and a value
    that holds a large share of the rows is cut too. ``path`` keeps the numbered rows.
    """
    numbered = number_rows(rows, [partition, *order], path=path)
    begins = numbered.groupBy(partition).agg(
        F.min("row_index").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    starts, total = [], 0
    for value, files in plan:
        starts.append((value, files, total))
        total += files
    kind = rows.schema[partition].dataType.simpleString()
    # One row per partition value under compaction, so neither follows the data.
    lookup = rows.sparkSession.createDataFrame(
        starts, f"{partition} {kind}, _files int, _start int"
    ).join(F.broadcast(begins), partition)
    run = F.floor((F.col("row_index") - F.col("_first")) * F.col("_files") / F.col("_rows"))
    return (
        numbered.join(F.broadcast(lookup), partition)
        .repartitionById(total, (run + F.col("_start")).cast("int"))
        .sortWithinPartitions("row_index")
        .select(*rows.columns)
    )


def rank_bounds(rows: DataFrame, partition: str, columns: tuple[str, ...], sample: int) -> DataFrame:
    """Per partition value and column, values that cut its rows into about equal shares.

    They come from about ``sample`` rows of each partition, chosen by hash. Only the layout
    depends on them.
    """
    sizes = rows.groupBy(partition).agg(F.count(F.lit(1)).alias("_n"))
    chosen = F.pmod(F.xxhash64(*columns), F.lit(1 << 20)) * F.col("_n") < F.lit(sample << 20)
    few = rows.select(partition, *columns).join(F.broadcast(sizes), partition).where(chosen)
    ordered = few.groupBy(partition).agg(
        *(F.array_sort(F.collect_list(c)).alias(c) for c in columns)
    )

    def cuts(column):
        values, size = F.col(column), F.size(column)
        steps = F.sequence(F.lit(1), F.lit((1 << ZORDER_BITS) - 1))
        at = lambda n: F.get(values, (n * size / (1 << ZORDER_BITS)).cast("int"))
        return F.when(size > 0, F.transform(steps, at)).alias(f"_{column}_cuts")

    return ordered.select(F.col(partition).alias("_of"), *(cuts(c) for c in columns))


def _rank(column: str) -> Column:
    value = F.col(column)
    below = F.filter(f"_{column}_cuts", lambda cut: cut <= value)
    return F.coalesce(F.greatest(F.size(below), F.lit(0)), F.lit(0))


def with_zorder(
    rows: DataFrame, partition: str, columns: tuple[str, ...], sample: int = ZORDER_SAMPLE
) -> DataFrame:
    """Rows with ``_z``: the ranks of ``columns`` within the partition, their bits interleaved.

    Rows near each other in ``_z`` are near in every column, so files cut from that order cover
    narrow ranges of each. A rank counts the bounds at or below a value; null has rank 0.
    """
    # One row per partition value under compaction.
    bounded = rows.join(F.broadcast(rank_bounds(rows, partition, columns, sample)), F.col(partition) == F.col("_of"))
    key = F.lit(0).cast("bigint")
    for place, column in enumerate(reversed(columns)):
        rank = _rank(column).cast("bigint")
        for bit in range(ZORDER_BITS):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + place))
    return bounded.select(*rows.columns, key.alias("_z"))
