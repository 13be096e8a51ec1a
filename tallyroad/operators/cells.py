"""Versioned cells: ``row_key, family, qualifier, version, value``.

A table of cells is a log of puts with a ``written`` order. Two puts of the
same version leave the later value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CELL = ("row_key", "family", "qualifier")


def put(
    rows: DataFrame,
    family: Column,
    qualifier: Column,
    value: Column,
    row_key: Column,
    written: Column,
    version: Column | None = None,
) -> DataFrame:
    """Puts as log rows. Without ``version`` the current time in milliseconds
    is the version."""
    now = F.unix_millis(F.current_timestamp())
    return rows.select(
        row_key.cast("string").alias("row_key"),
        family.cast("string").alias("family"),
        qualifier.cast("string").alias("qualifier"),
        (now if version is None else version).cast("bigint").alias("version"),
        value.cast("string").alias("value"),
        written.cast("bigint").alias("written"),
    )


def settle(puts: DataFrame) -> DataFrame:
    """One value per cell and version. Grouping by version as well spreads a
    cell with very many of them."""
    return puts.groupBy(*CELL, "version").agg(F.max_by("value", "written").alias("value"))


def versions(puts: DataFrame, family: str | None = None, limit: int = 1) -> DataFrame:
    """The newest ``limit`` versions of every cell, of one family or of all.

    The rank filter is applied before the shuffle too (a window group limit in
    the plan), so a hot cell sends at most ``limit`` rows per task."""
    rows = puts if family is None else puts.where(F.col("family") == family)
    newest = Window.partitionBy(*CELL).orderBy(F.desc("version"))
    return (
        settle(rows)
        .withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= limit)
        .drop("_rank")
    )


def latest(puts: DataFrame, family: str | None = None) -> DataFrame:
    """The newest version of every cell, by aggregation alone."""
    rows = puts if family is None else puts.where(F.col("family") == family)
    newest = rows.groupBy(*CELL).agg(
        F.max(F.struct("version", "written", "value")).alias("_newest")
    )
    return newest.select(*CELL, "_newest.version", "_newest.value")


def get(puts: DataFrame, row_key: str) -> DataFrame:
    """A point get: the newest version of each cell in one row, any family."""
    return latest(puts.where(F.col("row_key") == row_key))


def delete_latest(puts: DataFrame, named: DataFrame) -> DataFrame:
    """Drop the newest version of the named cells; older ones show again.
    Returns settled cells. The join is on the version too."""
    asked = named.select(*CELL).distinct()
    newest = puts.groupBy(*CELL).agg(F.max("version").alias("version"))
    gone = newest.join(asked, list(CELL), "left_semi")
    return settle(puts).join(gone, [*CELL, "version"], "left_anti")


def delete_marks(puts: DataFrame, named: DataFrame, written: int) -> DataFrame:
    """The same as marks: one row per named cell that exists, with the version
    that goes (see :func:`unmarked`)."""
    asked = named.select(*CELL).distinct()
    newest = puts.groupBy(*CELL).agg(F.max("version").alias("version"))
    return newest.join(asked, list(CELL), "left_semi").withColumn("marked", F.lit(written).cast("bigint"))


def unmarked(puts: DataFrame, marks: DataFrame) -> DataFrame:
    """Puts without those that a later mark names; a version that is put again
    after its mark is back."""
    newest = marks.groupBy(*CELL, "version").agg(F.max("marked").alias("_marked"))
    met = puts.join(newest, [*CELL, "version"], "left")
    return met.where(F.col("_marked").isNull() | (F.col("_marked") < F.col("written"))).select(puts.columns)
