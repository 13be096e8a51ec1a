"""Merge on read: deletes and updates as rows of their own.

Rows carry ``row_seq``, the number of the write that brought them. A delete or
an update writes one mark per key it names, with a number of its own, and no
row is rewritten. Reading resolves the marks: a row goes if a later delete
names its key, and takes the values of the newest later update. A row that is
written again after a delete stays. ``fold`` is what compaction does: the
resolved rows take the place of rows and marks.

Marks of a key are one row before they meet the rows, so a key that is marked
over and over does not grow the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def rows_of(rows: DataFrame, seq: int) -> DataFrame:
    return rows.withColumn("row_seq", F.lit(seq).cast("bigint"))


def delete_marks(named: DataFrame, keys: Sequence[str], seq: int) -> DataFrame:
    """A mark for each key, to be appended to the table of marks."""
    return named.select(*keys).distinct().withColumns(
        {"mark_seq": F.lit(seq).cast("bigint"), "gone": F.lit(True)}
    )


def update_marks(
    changes: DataFrame, keys: Sequence[str], columns: Sequence[str], seq: int
) -> DataFrame:
    """Marks that set ``columns``, from one row per key."""
    return changes.select(
        *keys,
        F.lit(seq).cast("bigint").alias("mark_seq"),
        F.lit(False).alias("gone"),
        F.struct(*columns).alias("set"),
    )


def resolve(
    rows: DataFrame, marks: DataFrame, keys: Sequence[str], columns: Sequence[str] = ()
) -> DataFrame:
    """The rows as they stand after all marks, ``row_seq`` included."""
    names = [f"_{c}" for c in ("deleted", "updated", "new")]
    newest = [
        F.max(F.when(F.col("gone"), F.col("mark_seq"))).alias("_deleted"),
        F.max(F.when(~F.col("gone"), F.col("mark_seq"))).alias("_updated"),
    ]
    if columns:
        newest.append(F.max_by("set", F.when(~F.col("gone"), F.col("mark_seq"))).alias("_new"))
    found = marks.groupBy(*keys).agg(*newest)
    met = rows.join(found, list(keys), "left")
    left = met.where(F.col("_deleted").isNull() | (F.col("_deleted") < F.col("row_seq")))
    late = F.col("_updated") > F.col("row_seq")
    changed = {c: F.when(late, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in columns}
    return left.withColumns(changed).drop(*names).select(rows.columns)


def fold(
    rows: DataFrame, marks: DataFrame, keys: Sequence[str], columns: Sequence[str], path: str
) -> DataFrame:
    """Write the resolved rows to a new place, from which reading needs no
    marks up to now."""
    resolve(rows, marks, keys, columns).write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
