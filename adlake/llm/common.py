"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlake.session import scratch_path
from adlake.sources import files

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(
    df: DataFrame, purpose: str, partition: str | None = None, folder: str | None = None
) -> DataFrame:
    """``df`` written once to the shared folder and read from there.

    Later jobs reread files that every executor reaches instead of recomputing; a lost
    executor costs its running tasks only. The files go with :func:`discard`, with the
    :func:`run_folder` they were made in (or ``folder``), or at the end of the session.
    """
    path = staging_path(df.sparkSession, purpose, folder)
    writer = df.write.partitionBy(partition) if partition else df.write
    writer.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.staged_at = path
    return kept


def discard(df: DataFrame) -> None:
    """Deletes the files behind a result of :func:`staged` that nothing reads any more."""
    files.delete(df.sparkSession, df.staged_at)


#: Folder that staged files go to; None: the session's own.
_current: ContextVar[str | None] = ContextVar("llm_run_folder", default=None)
_of_session: dict[str, str] = {}


def current_folder(spark: SparkSession) -> str:
    return _current.get() or _session_folder(spark)


def staging_path(spark: SparkSession, purpose: str, folder: str | None = None) -> str:
    """A fresh path in the current run's folder, or in another one."""
    return f"{folder or current_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """One folder for all that operators stage inside the block, deleted at its end.

    Results are read from staged files, so they must be written or counted inside the block.
    """
    path = scratch_path(spark, "llm-run")
    token = _current.set(path)
    try:
        yield path
    finally:
        _current.reset(token)
        files.delete(spark, path)


def _session_folder(spark: SparkSession) -> str:
    """Where results live that are used after the call that made them; deleted at exit."""
    application = spark.sparkContext.applicationId
    if application not in _of_session:
        path = _of_session[application] = scratch_path(spark, "llm-session")
        atexit.register(_delete_at_exit, spark, path)
    return _of_session[application]


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    with suppress(Py4JError, OSError):  # the JVM may have ended before
        files.delete(spark, path)


def whole_text(column: Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(column.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; other letters keep their case.

    ``lower`` is the fast form where a text is pure ASCII, where both agree.
    """
    pure = F.octet_length(text) == F.char_length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


#: Rows numbered in one part, on average.
NUMBERED = 65_536


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str, rows: int) -> DataFrame:
    """Adds ``name``: a gapless number from 0 within ``keys``, without one task per key.

    ``rows`` is the size of the largest key, or a bound of it. Rows of a key are dealt by a hash
    of ``order`` into parts of about ``NUMBERED`` rows of the largest key, numbered within each
    part, and shifted by the sizes of the parts before, of which there are keys times that number
    at most; they are counted with partial aggregation. Rows equal in ``keys`` and ``order``
    share a part and get neighbouring numbers.
    """
    chunks = max(1, -(-rows // NUMBERED))
    part, within, size = f"_{name}_part", f"_{name}_within", f"_{name}_size"
    dealt = df.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    rows = Window.partitionBy(*keys, part)
    placed = dealt.withColumn(
        within, F.row_number().over(rows.orderBy(*[F.col(c).asc_nulls_first() for c in order]))
    )
    sizes = dealt.groupBy(*keys, part).agg(F.count(F.lit(1)).alias(size))
    before = F.sum(size).over(
        Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = sizes.select(
        *[F.col(k).alias(f"_{k}_of") for k in keys],
        F.col(part).alias(f"{part}_of"),
        F.coalesce(before, F.lit(0)).alias(size),
    )
    same = placed[part] == shifts[f"{part}_of"]
    for k in keys:
        same &= placed[k].eqNullSafe(shifts[f"_{k}_of"])
    joined = placed.join(shifts, same)
    return joined.withColumn(name, (F.col(within) - 1 + F.col(size)).cast("long")).drop(
        part, within, size, f"{part}_of", *[f"_{k}_of" for k in keys]
    )


def slices(batch, rows: int = 256):
    """An Arrow batch in short slices, so that few texts are Python strings at a time."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
