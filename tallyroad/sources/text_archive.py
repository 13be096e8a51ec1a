"""Raw message archives and merged text output."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F


def archive_path(root: str, topic: str, time: dt.datetime, batch: str) -> str:
    """``<root>/<topic>/<day>/<batch>``: named after the batch, not the clock,
    so a replayed batch replaces its own folder."""
    return f"{root.rstrip('/')}/{topic}/{time:%Y-%m-%d}/{batch}"


def write_archive(messages: DataFrame, path: str, value_col: str = "value") -> None:
    """Every message as one line, before any filter; also for empty batches.
    Null messages have no text to keep."""
    lines = messages.where(F.col(value_col).isNotNull()).select(F.col(value_col).alias("value"))
    lines.write.mode("overwrite").text(path)


def write_positions(messages: DataFrame, path: str) -> None:
    """Every message with its topic, partition and offset, in their order, so
    that a replay can start at a position and skip what lies before."""
    place = ["topic", "partition", "offset"]
    rows = messages.select(F.col("topic"), F.col("partition").cast("int"), F.col("offset").cast("bigint"), "value")
    rows.sortWithinPartitions(*place).write.mode("overwrite").parquet(path)


def read_archive(spark: SparkSession, root: str, topic: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").text(
        f"{root.rstrip('/')}/{topic}", lineSep="\n"
    )


def write_merged_text(lines: DataFrame, path: str, overwrite: bool = True, files: int = 1) -> None:
    """Write a text column as ``files`` files, in the order of the input: read
    one after another, by name, they are the input's partitions in their order.
    One file is written by one task, so ask for more where that is too much.
    Without ``overwrite`` an existing path is an error."""
    column = F.col(lines.columns[0]).alias("value")
    placed = lines.select(column, F.monotonically_increasing_id().alias("_place"))
    parts = placed.repartitionByRange(files, "_place").sortWithinPartitions("_place")
    parts.select("value").write.mode("overwrite" if overwrite else "error").text(path)
