"""Cells in files from which a point get skips nearly everything.

Files hold ranges of row keys, sorted, in small row groups. Their statistics
(and a Bloom filter, for keys that lie within a group's range but not in it) let
Parquet pass over all groups but those of the row key that is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyroad.operators.cells import CELL

SCHEMA = "row_key STRING, family STRING, qualifier STRING, version BIGINT, value STRING, written BIGINT"
# A row group; a point get reads one, or a few of a very large row.
GROUP_BYTES = 1 << 20
ORDER = [*CELL, "version", "written"]


def write_cells(
    puts: DataFrame, path: str, group_bytes: int = GROUP_BYTES, mode: str = "append"
) -> None:
    """Write puts as files of their own, beside those that are there. Ranges go
    down to the version, so that a row of any size is split."""
    (
        puts.repartitionByRange(*ORDER)
        .sortWithinPartitions(*ORDER)
        .write.mode(mode)
        .option("parquet.block.size", group_bytes)
        .option("parquet.page.size", max(group_bytes // 8, 1 << 10))
        .option("parquet.block.size.row.check.min", 100)
        .option("parquet.page.size.row.check.min", 100)
        .option("parquet.bloom.filter.enabled#row_key", "true")
        .parquet(path)
    )


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """All puts; ``cells.get`` and filters on ``row_key`` reach the files."""
    return spark.read.schema(SCHEMA).parquet(path)


def merge_cells(
    spark: SparkSession, path: str, target: str, group_bytes: int = GROUP_BYTES
) -> None:
    """Cluster what several writes left under a new path."""
    write_cells(read_cells(spark, path), target, group_bytes, "error")
