"""Rows dealt by key over as many tasks as their number asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows that a task gets on average at most, where the session has fewer shuffle partitions than that takes.
ROWS = 1 << 19


def parts(rows: DataFrame, most: int | None = None) -> int:
    """Tasks for the rows of a table, whose files know their number."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // (most or ROWS)))


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """A table's rows by key, so that what a task sorts and groups afterwards doesn't grow with the table."""
    return rows.repartition(parts(rows), *keys)
