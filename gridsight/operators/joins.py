"""Joins of detail rows with a summary, safe where one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridsight.session import new_folder
from gridsight.sources import tables


def stored(df: DataFrame, purpose: str = "summary") -> DataFrame:
    """The table written to the shared folder and read back.

    Catalyst then knows its true size, where the estimate for an aggregate is that of its input,
    and lost executors cost no recomputation.
    """
    path = tables.write_replace(df, new_folder(df.sparkSession, purpose))
    return tables.read_table(df.sparkSession, path)


#: Rows a task is given where bytes say little about its work or its memory.
TASK_ROWS = 200_000


def tasks_for(rows: int) -> int:
    """How many tasks share this many rows, so that a task's share does not grow with the table."""
    return max(1, -(-rows // TASK_ROWS))


def join_summary(rows: DataFrame, summary: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` beside the one summary row of their keys.

    The summary is stored first. A small one is broadcast on the strength of its file size; for a
    large one both sides are shuffled for the join alone, which is the form in which adaptive
    execution can split the partition of a frequent key. A summary joined straight out of its own
    aggregation would have neither.
    """
    return rows.join(stored(summary), keys, how)
