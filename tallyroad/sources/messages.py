"""Message feeds: Kafka, files and text in memory."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

MESSAGE_SCHEMA = "topic STRING, `partition` INT, offset BIGINT, value STRING"


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source. ``starting_offsets`` is ``latest``,
    ``earliest`` or the JSON of ``operators.offsets.starting_offsets``; a
    checkpoint, once there, wins. ``min_partitions`` splits a hot topic
    partition over several tasks."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    """Messages of a topic (needs the spark-sql-kafka package)."""
    reader = spark.readStream.format("kafka").options(**kafka_options(**options))
    return message_columns(reader.load())


def message_columns(raw: DataFrame) -> DataFrame:
    """Position and text of raw Kafka records."""
    return raw.select(
        "topic", "partition", "offset", F.col("value").cast("string").alias("value")
    )


def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: str | StructType = MESSAGE_SCHEMA,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Messages landing as files; ``path`` may hold wildcards."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def archive_stream(
    spark: SparkSession,
    root: str,
    topic: str,
    positions: DataFrame | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Messages of an archive that was kept with positions, as they arrive
    there. ``positions`` (``topic, partition, offset``, one row per topic
    partition) is where to start: partitions without one start at their first
    message. What lies before is skipped by the files' statistics."""
    stream = file_stream(spark, f"{root.rstrip('/')}/{topic}/*/*", max_files_per_trigger=max_files_per_trigger)
    stream = stream.where(F.col("topic") == topic)
    if positions is None:
        return stream
    # As many rows as the topic has partitions.
    known = positions.where(F.col("topic") == topic).select("partition", "offset").collect()
    if not known:
        return stream
    wanted = ~F.col("partition").isin([r["partition"] for r in known])
    for r in known:
        wanted = wanted | ((F.col("partition") == r["partition"]) & (F.col("offset") >= r["offset"]))
    return stream.where(wanted)


def split_texts(texts: DataFrame, text_col: str = "value", separator: str = "@") -> DataFrame:
    """Texts holding several messages: one row per message."""
    others = [c for c in texts.columns if c != text_col]
    parts = F.split(F.col(text_col), separator, -1)
    return texts.select(*others, F.explode(parts).alias(text_col))


def from_memory(spark: SparkSession, messages: Iterable[str | None]) -> DataFrame:
    """A few messages held by the program."""
    return spark.createDataFrame([(m,) for m in messages], "value STRING")
