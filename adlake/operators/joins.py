"""How a batch meets what is stored, where both grow with the input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A batch of up to this many rows is sent to every task, which spares the stored side a shuffle.
BATCH_ROWS = 50_000


def batch_side(batch: DataFrame, rows: int | None) -> DataFrame:
    """``batch`` as one side of a join; ``rows`` is how many it has, where they were counted.

    The choice is not left to Spark: its size of a table of files is that of the columns' share of
    the compressed bytes, and the rows it would collect and broadcast on that ground were found to
    take more than ten times as much. Any other batch, also one nobody counted, is shuffled.
    """
    few = rows is not None and rows <= BATCH_ROWS
    return F.broadcast(batch) if few else batch.hint("merge")
