"""Positions in a global order, and tables that live only as long as needed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyroad.session import scratch_dir


class Scratch:
    """Tables of one operator in the shared folder. A table is deleted once
    whatever is computed from it has been written itself."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_dir(self.spark, name)
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(kept)] = path
        return kept

    def drop(self, *tables: DataFrame) -> None:
        for kept in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(kept)))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def place(df: DataFrame, groups: Sequence[str], by: Sequence[str], scratch: Scratch) -> DataFrame:
    """``df`` with ``place``, a position from 0 without gaps in the order of
    ``by`` within each group, and ``total``, the group's number of rows. Group
    columns hold no nulls.

    A group may hold any share of the rows, as may a value of ``by``: rows are
    dealt by ranges of group, order and input position, sorted, and written.
    What a range holds of a group is then shifted by what earlier ranges hold,
    one number per range and group. Rows equal in group and order come in any
    order, but each has a position of its own."""
    # Written first, since dealing by ranges reads its input twice.
    rows = scratch.keep(df.withColumn("_input", F.monotonically_increasing_id()), "unplaced")
    order = [*groups, *by, "_input"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("_at", F.monotonically_increasing_id())
    placed = scratch.keep(ranged.withColumn("_range", F.shiftright("_at", 33)).drop("_input"), "ranged")
    scratch.drop(rows)
    sizes = placed.groupBy(*groups, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        *groups,
        "_range",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("total"),
    )
    return (
        placed.join(shifts, [*groups, "_range"])
        .withColumn("place", F.col("_at") + F.col("_shift"))
        .drop("_at", "_range", "_shift")
    )
