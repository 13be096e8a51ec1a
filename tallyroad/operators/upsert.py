"""Keyed changes to a table, each as one join or aggregation over whole tables.

The size of every side decides at run time between a broadcast (under
``spark.sql.autoBroadcastJoinThreshold``) and a shuffled join. Keys are meant to
be (nearly) unique on both sides: reduce a log to one row per key first, since
Spark cannot split a hot key of a join whose result is grouped by that key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

STAMPS = ("created_at", "updated_at")


def additive_upsert(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Add the measures of ``new`` to rows with the same keys, insert the rest.
    Other columns (the load times) keep the values of the first insert."""
    others = [c for c in existing.columns if c not in (*keys, *measures)]
    sides = existing.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    return (
        sides.groupBy(*keys)
        .agg(
            *[F.sum(m).alias(m) for m in measures],
            *[F.min_by(c, "_side").alias(c) for c in others],
        )
        .select(*existing.columns)
    )


def replace_by_key(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` take the place of existing rows with the same keys."""
    return delete_keys(existing, new, keys).unionByName(new)


def delete_keys(existing: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows whose keys are not among ``gone``."""
    return existing.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def update_keys(
    existing: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Set ``columns`` from ``changes`` (one row per key) where the keys match;
    keys without an existing row change nothing."""
    new = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = existing.join(new, list(keys), "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in existing.columns
        ]
    )


def existing_counts(existing: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many existing rows each wanted key has, zero included: one join for
    all keys."""
    asked = wanted.select(*keys).distinct()
    found = existing.join(asked, list(keys), "left_semi").groupBy(*keys).agg(F.count("*").alias("n"))
    return asked.join(found, list(keys), "left").select(
        *keys, F.coalesce("n", F.lit(0)).alias("n_rows")
    )


def insert_columns(columns: Sequence[str]) -> Column:
    """Comma list of the columns an insert of this row would name."""
    return F.concat_ws(",", *[F.when(F.col(c).isNotNull(), c) for c in columns])


def latest_by_key(log: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row written last for every key of a log; the aggregation keeps one
    row per key and task before it shuffles."""
    rest = [c for c in log.columns if c not in keys]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_row"))
    return newest.select(*keys, "_row.*")
