"""Consumer offsets: a ledger of the next offset per partition and batch.

Ledger rows are ``topic, consumer, partition, offset, batch_id``; ``offset`` is
the first one not read yet.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

LEDGER_SCHEMA = (
    "topic STRING, consumer STRING, `partition` INT, offset BIGINT, batch_id BIGINT"
)


def ranges(messages: DataFrame, *batch: str) -> DataFrame:
    """First and last offset per partition, and the next one to read."""
    return messages.groupBy(*batch, "topic", "partition").agg(
        F.min("offset").alias("from_offset"),
        F.max("offset").alias("last_offset"),
        (F.max("offset") + 1).alias("until_offset"),
    )


def ledger_rows(messages: DataFrame, consumer: str, batch_id: Column) -> DataFrame:
    """What a batch adds to the ledger once its outputs are written."""
    return ranges(messages.withColumn("batch_id", batch_id), "batch_id").select(
        "topic",
        F.lit(consumer).alias("consumer"),
        F.col("partition").cast("int").alias("partition"),
        F.col("until_offset").cast("bigint").alias("offset"),
        F.col("batch_id").cast("bigint").alias("batch_id"),
    )


def resume(ledger: DataFrame, topic: str | None = None, consumer: str | None = None) -> DataFrame:
    """Where to go on: the newest batch's offset of every partition. Rows with
    -1 as partition or offset do not count. ``consumer=None`` reads the rows
    of all consumers, as the relational store does."""
    rows = ledger.where((F.col("partition") != -1) & (F.col("offset") != -1))
    if topic is not None:
        rows = rows.where(F.col("topic") == topic)
    keys = ["topic", "partition"]
    if consumer is not None:
        rows = rows.where(F.col("consumer") == consumer)
    elif topic is None:
        keys.insert(1, "consumer")
    return rows.groupBy(*keys).agg(F.max_by("offset", "batch_id").alias("offset"))


def planned_ends(line: str) -> dict[tuple[str, int], int]:
    """``(topic, partition)`` to offset of a Kafka source's end offsets as a
    checkpoint has them for a batch, silent partitions included; empty for the
    offsets of other sources."""
    try:
        read = json.loads(line)
        return {(t, int(p)): int(o) for t, ends in read.items() for p, o in ends.items() if int(o) >= 0}
    except (AttributeError, TypeError, ValueError):
        return {}


def node_text(positions: DataFrame, *keys: str) -> DataFrame:
    """Positions as ``partition:offset`` text joined by commas, one row per
    topic (and consumer). A group has one entry per topic partition."""
    pairs = F.sort_array(F.collect_list(F.struct("partition", "offset")))
    text = F.transform(pairs, lambda p: F.concat_ws(":", p["partition"], p["offset"]))
    return positions.groupBy(*keys).agg(F.array_join(text, ",").alias("offsets"))


def node_positions(nodes: DataFrame, text_col: str = "offsets") -> DataFrame:
    """The positions in such texts, one row per partition. Texts that do not
    read as ``partition:offset`` pairs count as missing."""
    pair = F.split(F.col("_pair"), ":")
    others = [c for c in nodes.columns if c != text_col]
    good = F.col(text_col).rlike(r"^[0-9]+:[0-9]+(,[0-9]+:[0-9]+)*$")
    return (
        nodes.where(good)
        .select(*others, F.explode(F.split(F.col(text_col), ",")).alias("_pair"))
        .select(
            *others,
            pair[0].try_cast("int").alias("partition"),
            pair[1].try_cast("bigint").alias("offset"),
        )
        .where(F.col("partition").isNotNull() & F.col("offset").isNotNull())
    )


def positions_json(positions: DataFrame) -> DataFrame:
    """Positions as the JSON of the Kafka source's ``startingOffsets``, one row
    per topic. A group has one entry per topic partition."""
    pairs = F.sort_array(F.collect_list(F.struct("partition", "offset")))
    folded = positions.groupBy("topic").agg(F.map_from_entries(pairs).alias("_map"))
    return folded.select("topic", F.to_json(F.create_map("topic", "_map")).alias("offsets"))


# What a Kafka source reads for the ends of a partition.
ENDS = {"latest": -1, "earliest": -2}


def all_partitions(
    positions: DataFrame, topic: str, partitions: int, default: str = "latest"
) -> DataFrame:
    """``positions`` of a topic with a row for each of its ``partitions``; one
    without a stored offset starts at the ``default`` end. A Kafka source wants
    every partition named. Stored ones beyond the number stay."""
    spark = positions.sparkSession
    stored = positions.where(F.col("topic") == topic).select("topic", "partition", "offset")
    every = spark.range(partitions).select(
        F.lit(topic).alias("topic"),
        F.col("id").cast("int").alias("partition"),
        F.lit(ENDS[default]).cast("bigint").alias("offset"),
    )
    return stored.unionByName(every.join(stored, ["topic", "partition"], "left_anti"))


def starting_offsets(
    positions: DataFrame, topic: str, default: str = "latest", partitions: int | None = None
) -> str:
    """The ``startingOffsets`` option for a topic; ``default`` when nothing is
    stored. ``partitions`` is the topic's number of partitions: silent and new
    ones then start at the default end, too."""
    mine = positions.where(F.col("topic") == topic)
    row = positions_json(mine).first()
    if row is not None and partitions is not None:
        row = positions_json(all_partitions(mine, topic, partitions, default)).first()
    return default if row is None else row["offsets"]
