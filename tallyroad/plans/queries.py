"""The registered queries: ``(spark, sf_dir) -> DataFrame`` by name.

All of them read the ``events`` table in full through ``plans.feed``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyroad.functions import status, text, timebucket as tb
from tallyroad.operators import cells, hourly, marks, metrics, offsets, parse, upsert
from tallyroad.plans import feed
from tallyroad.session import scratch_dir, use_utc
from tallyroad.sources import cell_files, messages as sources, text_archive
from tallyroad.streaming import jobs, tables
from tallyroad.functions.jsonio import row_as_json, write_json

BATCHES = 8
STREAM_BATCHES = 3
CONSUMER = "metrics"

# Writing times of the micro-batches in the expiry query: 13 hours apart, so a
# key that misses one batch is forgotten and one that misses none is kept.
FIRST_WRITE = "2024-02-01 00:00:00"
HOURS_BETWEEN_WRITES = 13
READ_AFTER_HOURS = 97

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(use_utc(spark), sf_dir)

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    _QUERIES[build.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _classified(spark: SparkSession, sf_dir: str, batches: int = BATCHES) -> DataFrame:
    return parse.classify(feed.messages(spark, sf_dir, batches))


def _counted(spark: SparkSession, sf_dir: str, width: int = tb.TEN_MINUTES) -> DataFrame:
    return parse.counted(_classified(spark, sf_dir), width, keep=("batch_id",))


def _writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.batch_writes(_counted(spark, sf_dir), "batch_id")


# --- messages, parsing, filters -------------------------------------------


@query
def json_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change message as JSON text, faults included."""
    return feed.messages(spark, sf_dir).select("event_id", "value")


@query
def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows as JSON objects, and a map column as one."""
    ev = feed.events(spark, sf_dir)
    as_map = F.create_map(F.lit("event_type"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
    return ev.select(
        "event_id",
        row_as_json("event_id", "user_id", "event_type").alias("row_json"),
        write_json(as_map).alias("map_json"),
    )


@query
def split_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of two messages each, split at ``@`` and parsed."""
    pairs = feed.with_texts(feed.events(spark, sf_dir)).select(
        F.concat_ws("@", "clean", "value").alias("value")
    )
    recs = parse.records(parse.classify(sources.split_texts(pairs)))
    return recs.groupBy("event_type", "status").agg(F.count("*").alias("n_records"))


@query
def record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of parsed records."""
    return parse.records(_classified(spark, sf_dir)).agg(F.count("*").alias("n_records"))


@query
def parse_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.records(_classified(spark, sf_dir))


@query
def message_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of the messages, by final outcome."""
    rows = parse.measure_rows(_classified(spark, sf_dir))
    return rows.groupBy("outcome").agg(F.count("*").alias("n_messages"))


@query
def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse.measure_rows(_classified(spark, sf_dir))
    rejected = rows.where(F.col("outcome") == "quarantined")
    return rejected.groupBy("reason").agg(F.count("*").alias("n_messages"))


@query
def quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected texts themselves, also those with a bad number."""
    rows = parse.measure_rows(_classified(spark, sf_dir), keep=("value",))
    return rows.where(F.col("outcome") == "quarantined").select("value", "reason")


@query
def filtered_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates of rows that are not deleted, the time replaced by its label."""
    live = parse.live_updates(parse.records(_classified(spark, sf_dir)))
    return live.withColumn("timestamp", tb.label(F.col("run_ts"))).drop("run_ts")


# --- time buckets and labels ----------------------------------------------


def _event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = tb.parse_timestamp(feed.second_text())
    return feed.events(spark, sf_dir).select("event_id", ts.alias("ts"))


@query
def bucket_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = _event_times(spark, sf_dir)
    return times.select("event_id", tb.label(tb.bucket_start(F.col("ts"))).alias("label"))


@query
def bucket_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = _event_times(spark, sf_dir)
    return times.select("event_id", tb.label(tb.bucket_end(F.col("ts"))).alias("label"))


@query
def bucket_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket bounds as numbers, for a period of seven minutes."""
    millis = F.unix_millis("ts")
    return _event_times(spark, sf_dir).select(
        "event_id",
        millis.alias("millis"),
        tb.floor_millis(millis, 420_000).alias("before_millis"),
        tb.next_millis(millis, 420_000).alias("next_millis"),
    )


@query
def bucket_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day, hour and minute labels, the parts and the time a label reads as."""
    start = tb.bucket_start(F.col("ts"))
    labels = _event_times(spark, sf_dir).select(
        "event_id",
        tb.label(start, "day").alias("day_label"),
        tb.label(tb.hour_of(start), "hour").alias("hour_label"),
        tb.label(start, "minute").alias("minute_label"),
    )
    parts = tb.label_parts(F.col("minute_label"))
    return labels.select(
        "*",
        *[column.alias(f"{name}_part") for name, column in parts.items()],
        F.unix_seconds(tb.label_time(F.col("minute_label"))).alias("minute_seconds"),
        F.unix_seconds(tb.label_time(F.col("hour_label"), "hour")).alias("hour_seconds"),
    )


@query
def status_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric and key label of every live update, and the label's parts."""
    live = parse.live_updates(parse.records(_classified(spark, sf_dir)))
    hour = tb.label(tb.hour_of(F.col("run_ts")), "hour")
    keyed = live.select(
        "msg_id",
        "status",
        status.metric_of(F.col("status")).alias("metric"),
        status.key_label(hour, F.col("adc_id"), status.metric_of(F.col("status"))).alias("key"),
    )
    return keyed.select(
        "*",
        status.key_part(F.col("key"), 0).alias("key_hour"),
        status.key_part(F.col("key"), 1).alias("key_adc"),
        status.key_part(F.col("key"), 2).alias("key_metric"),
    )


# --- ten-minute metrics ----------------------------------------------------


@query
def ten_minute_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: one batch's ten-minute table."""
    return metrics.labelled(metrics.ten_minute(_counted(spark, sf_dir))).drop("run_ts")


@query
def ten_minute_metrics_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from SQL text."""
    return metrics.labelled(metrics.ten_minute_sql(_counted(spark, sf_dir))).drop("run_ts")


@query
def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with buckets of a day."""
    rows = _counted(spark, sf_dir, tb.ONE_DAY)
    return metrics.labelled(metrics.ten_minute(rows)).drop("run_ts")


@query
def next_bucket_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch path: all parsed records, whatever their change type or
    deletion mark, by the end of their bucket."""
    recs = parse.records(_classified(spark, sf_dir)).where(
        parse.number_fault().isNull()
    )
    rows = recs.select(
        tb.bucket_end(tb.parse_timestamp(F.col("timestamp"))).alias("run_ts"),
        "adc_id",
        status.metric_of(F.col("status")).alias("metric"),
        F.when(status.metric_of(F.col("status")).isNotNull(), F.col("driver_id")).alias("driver_id"),
        F.when(
            F.col("status") == status.PRICED_STATUS, text.strict_long(F.col("event_price"))
        ).alias("price"),
    )
    return metrics.labelled(metrics.ten_minute(rows)).drop("run_ts")


@query
def ten_minute_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored ten-minute table after all batches."""
    parts = metrics.partials(_counted(spark, sf_dir), "batch_id")
    return metrics.labelled(metrics.merge_partials(parts)).drop("run_ts")


@query
def daily_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The additive table with buckets of a day, where batches overlap."""
    parts = metrics.partials(_counted(spark, sf_dir, tb.ONE_DAY), "batch_id")
    return metrics.labelled(metrics.merge_partials(parts)).drop("run_ts")


@query
def additive_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half of the batches added to a table of the earlier half.
    ``first_batch`` stands for the load time, which an update leaves alone."""
    parts = metrics.partials(_counted(spark, sf_dir, tb.ONE_DAY), "batch_id")
    half = F.when(F.col("batch_id") < BATCHES // 2, 0).otherwise(1)
    stored = (
        parts.groupBy(half.alias("half"), "run_ts", "adc_id")
        .agg(*[F.sum(m).alias(m) for m in metrics.MEASURES], F.min("batch_id").alias("first_batch"))
        .withColumn("adc_id", text.strict_int(F.col("adc_id")))
    )
    old, new = (stored.where(F.col("half") == h).drop("half") for h in (0, 1))
    merged = upsert.additive_upsert(old, new, ("run_ts", "adc_id"), metrics.MEASURES)
    return metrics.labelled(merged).drop("run_ts")


# --- hourly metrics --------------------------------------------------------


@query
def hourly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.stored_rows(hourly.hourly(_writes(spark, sf_dir)))


@query
def hourly_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same when every other message writes its site as ``09``, not ``9``."""
    site = F.when(F.col("batch_id") % 2 == 1, F.concat(F.lit("0"), F.col("adc_id"))).otherwise(F.col("adc_id"))
    rows = _counted(spark, sf_dir).withColumn("adc_id", site)
    return hourly.stored_rows(hourly.hourly(hourly.batch_writes(rows, "batch_id")))


@query
def hourly_touched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours and sites each batch touches."""
    touched = _writes(spark, sf_dir).select("batch_id", *hourly.KEY).distinct()
    hour = tb.label(F.col("run_hour"), "hour")
    return touched.select("batch_id", status.key_label(hour, F.col("adc_id")).alias("key"))


@query
def hourly_set_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members the last batch adds to the sets all earlier ones left."""
    writes = _writes(spark, sf_dir)
    existing = hourly.members(writes.where(F.col("batch_id") < BATCHES - 1))
    return hourly.new_members(existing, writes.where(F.col("batch_id") == BATCHES - 1))


@query
def hourly_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price totals; hours without a priced message have no row."""
    return hourly.counters(_writes(spark, sf_dir))


@query
def hourly_with_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly table when keys live 24 hours after their last write."""
    first = F.to_timestamp_ltz(F.lit(FIRST_WRITE))
    step = F.col("batch_id") * HOURS_BETWEEN_WRITES * 3600
    writes = _writes(spark, sf_dir).withColumn(
        "written_at", F.timestamp_seconds(F.unix_seconds(first) + step)
    )
    as_of = F.timestamp_seconds(F.unix_seconds(first) + READ_AFTER_HOURS * 3600)
    return hourly.stored_rows(hourly.hourly_with_expiry(writes, as_of))


# --- keyed changes of stored tables ----------------------------------------


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Hourly rows as an early reading and as the last batch's fresh rows, from
    one row per key that holds both."""
    late = F.col("batch_id") == BATCHES - 1
    per_driver = _writes(spark, sf_dir).groupBy(*hourly.KEY, "metric", "driver_id").agg(
        F.sum("price").alias("price"),
        F.sum(F.when(~late, F.col("price"))).alias("early_price"),
        F.bool_or(~late).alias("early"),
        F.bool_or(late).alias("late"),
    )

    def counts(seen: Column) -> list[Column]:
        return [F.count_if(seen & (F.col("metric") == m)).alias(m) for m in status.METRICS]

    keyed = per_driver.groupBy(*hourly.KEY).agg(
        F.struct(*counts(F.col("early")), F.sum("early_price").alias("event_price")).alias("old"),
        F.struct(*counts(F.lit(True)), F.sum("price").alias("event_price")).alias("new"),
        F.bool_or("early").alias("has_old"),
        F.bool_or("late").alias("touched"),
    )
    old = keyed.where("has_old").select(*hourly.KEY, "old.*")
    new = keyed.where("touched").select(*hourly.KEY, "new.*")
    return hourly.stored_rows(old), hourly.stored_rows(new)


KEYS = ("run_time", "adc_id")


@query
def hourly_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fresh rows take the place of the stored ones of their keys."""
    old, new = _halves(spark, sf_dir)
    return upsert.replace_by_key(old, new, KEYS)


@query
def keyed_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows left after deleting the keys of the fresh ones."""
    old, new = _halves(spark, sf_dir)
    return upsert.delete_keys(old, new, KEYS)


def _log(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows of a log, written and read again."""
    path = scratch_dir(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@query
def keyed_delete_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same delete as marks that are resolved on read."""
    old, new = _halves(spark, sf_dir)
    stored = _log(spark, marks.rows_of(old, 0), "rows")
    deleted = _log(spark, marks.delete_marks(new, KEYS, 1), "marks")
    return marks.resolve(stored, deleted, KEYS).drop("row_seq")


@query
def keyed_update_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same update as marks, folded into the rows."""
    old, new = _halves(spark, sf_dir)
    stored = _log(spark, marks.rows_of(old, 0), "rows")
    changed = _log(spark, marks.update_marks(new, KEYS, ["event_price"], 1), "marks")
    return marks.fold(stored, changed, KEYS, ["event_price"], scratch_dir(spark, "folded")).drop("row_seq")


@query
def keyed_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows with the price set from the fresh ones; no inserts."""
    old, new = _halves(spark, sf_dir)
    return upsert.update_keys(old, new, KEYS, ("event_price",))


@query
def keyed_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many stored rows each fresh key has."""
    old, new = _halves(spark, sf_dir)
    return upsert.existing_counts(old, new, KEYS)


@query
def insert_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per list of inserted columns: nulls are left to table defaults."""
    rows = hourly.stored_rows(hourly.hourly(_writes(spark, sf_dir)))
    named = rows.select(upsert.insert_columns(rows.columns).alias("columns"))
    return named.groupBy("columns").agg(F.count("*").alias("n_rows"))


# --- offsets ---------------------------------------------------------------


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.ledger_rows(feed.messages(spark, sf_dir), CONSUMER, F.col("batch_id"))


@query
def offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets each batch went through, by topic partition."""
    return offsets.ranges(feed.messages(spark, sf_dir), "batch_id")


@query
def offset_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ledger(spark, sf_dir)


@query
def offset_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every partition goes on after the newest batch."""
    return offsets.resume(_ledger(spark, sf_dir), feed.TOPIC, CONSUMER)


@query
def offset_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positions as one text per topic, and read back from it."""
    positions = offsets.resume(_ledger(spark, sf_dir), feed.TOPIC, CONSUMER)
    return offsets.node_positions(offsets.node_text(positions, "topic"))


@query
def offset_node_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    positions = offsets.resume(_ledger(spark, sf_dir), feed.TOPIC, CONSUMER)
    return offsets.node_text(positions, "topic")


@query
def offset_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positions as the option a Kafka source starts from, with one
    partition more than ever had a message."""
    positions = offsets.resume(_ledger(spark, sf_dir), feed.TOPIC, CONSUMER)
    every = offsets.all_partitions(positions, feed.TOPIC, feed.TOPIC_PARTITIONS + 1)
    return offsets.positions_json(every)


# --- versioned cells -------------------------------------------------------


def _puts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cell put per event: rows are users, families event kinds, and a
    version is written again by every later event of the same day."""
    return cells.put(
        feed.events(spark, sf_dir),
        family=F.col("event_type"),
        qualifier=F.concat(F.lit("q"), F.col("event_id") % 3),
        value=F.concat(F.lit("v"), F.col("event_id")),
        row_key=F.col("user_id"),
        written=F.col("event_id"),
        version=F.dayofmonth("ts"),
    )


@query
def cells_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value per cell and version: the last one written."""
    return cells.settle(_puts(spark, sf_dir))


@query
def cells_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of every cell, over all families of a row."""
    return cells.latest(_puts(spark, sf_dir))


@query
def cells_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to ten versions of each cell in one family."""
    return cells.versions(_puts(spark, sf_dir), "view", 10)


@query
def cells_delete_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells after deleting the newest version of every view cell."""
    puts = _puts(spark, sf_dir)
    return cells.delete_latest(puts, puts.where(F.col("family") == "view"))


@query
def cells_delete_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same delete as marks that are resolved on read."""
    puts = _log(spark, _puts(spark, sf_dir), "puts")
    gone = _log(spark, cells.delete_marks(puts, puts.where(F.col("family") == "view"), 1 << 62), "marks")
    return cells.settle(cells.unmarked(puts, gone))


@query
def cells_point_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest cells of one row, the newest event's, out of files that hold
    all cells."""
    path = scratch_dir(spark, "cells")
    cell_files.write_cells(_puts(spark, sf_dir), path)
    row_key = feed.events(spark, sf_dir).agg(F.max_by("user_id", "event_id")).first()[0]
    return cells.get(cell_files.read_cells(spark, path), str(row_key))


# --- text output and streams -----------------------------------------------


def _landing(spark: SparkSession, sf_dir: str, batches: int) -> str:
    """Messages written as files, one folder per arriving micro-batch."""
    path = scratch_dir(spark, "landing")
    feed.messages(spark, sf_dir, batches).select(
        "topic", "partition", "offset", "value", "batch_id"
    ).write.partitionBy("batch_id").parquet(path)
    return path


def _run_metrics_job(spark: SparkSession, sf_dir: str, key_life: int | None = None) -> str:
    landing = _landing(spark, sf_dir, STREAM_BATCHES)
    root = scratch_dir(spark, "metrics")
    first = dt.datetime.fromisoformat(FIRST_WRITE).replace(tzinfo=dt.timezone.utc)
    for batch in range(STREAM_BATCHES):
        arrived = sources.file_stream(spark, f"{landing}/batch_id={batch}")
        # Without a checkpoint of its own yet, each run goes on from the ledger.
        checkpoint = scratch_dir(spark, "checkpoint")
        now = first + dt.timedelta(hours=batch * HOURS_BETWEEN_WRITES)
        job = jobs.metrics_job(
            arrived, root, checkpoint, CONSUMER, key_life=key_life, clock=lambda _, now=now: now
        )
        job.awaitTermination()
    return root


@query
def stream_ten_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten-minute table kept by the streaming job."""
    return tables.ten_minute(spark, _run_metrics_job(spark, sf_dir)).drop("run_ts")


@query
def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly table kept by the streaming job."""
    return tables.hourly(spark, _run_metrics_job(spark, sf_dir)).drop("created_at", "updated_at")


@query
def stream_hourly_with_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly table when keys live as long as they do by default."""
    root = _run_metrics_job(spark, sf_dir, hourly.KEY_LIFE)
    return tables.hourly(spark, root).drop("created_at", "updated_at")


@query
def stream_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions the streaming job has stored."""
    return tables.positions(spark, _run_metrics_job(spark, sf_dir), feed.TOPIC, CONSUMER)


@query
def archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the raw archive that the archive job wrote, counted by text."""
    landing = _landing(spark, sf_dir, 1)
    root = scratch_dir(spark, "archive")
    arrived = sources.file_stream(spark, f"{landing}/batch_id=0")
    checkpoint = scratch_dir(spark, "checkpoint")
    jobs.archive_job(arrived, root, feed.TOPIC, checkpoint).awaitTermination()
    lines = text_archive.read_archive(spark, root, feed.TOPIC)
    return lines.groupBy("value").agg(F.count("*").alias("n_lines"))


@query
def archive_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions the archive job has stored."""
    landing = _landing(spark, sf_dir, 1)
    root, ledger = scratch_dir(spark, "archive"), scratch_dir(spark, "ledger")
    arrived = sources.file_stream(spark, f"{landing}/batch_id=0")
    checkpoint = scratch_dir(spark, "checkpoint")
    job = jobs.archive_job(
        arrived, root, feed.TOPIC, checkpoint, consumer=CONSUMER, ledger_root=ledger
    )
    job.awaitTermination()
    return tables.positions(spark, ledger, feed.TOPIC, CONSUMER)


@query
def archive_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly table of a job that replays an archive by position, and goes
    on from its ledger where nothing is left."""
    landing = _landing(spark, sf_dir, 1)
    archive, root = scratch_dir(spark, "archive"), scratch_dir(spark, "metrics")
    arrived = sources.file_stream(spark, f"{landing}/batch_id=0")
    jobs.archive_job(
        arrived, archive, feed.TOPIC, scratch_dir(spark, "checkpoint"), keep_positions=True
    ).awaitTermination()
    for _ in range(2):
        start = tables.positions(spark, root, feed.TOPIC, CONSUMER)
        stream = sources.archive_stream(spark, archive, feed.TOPIC, start)
        job = jobs.metrics_job(stream, root, scratch_dir(spark, "checkpoint"), CONSUMER, key_life=None)
        job.awaitTermination()
    return tables.hourly(spark, root).drop("created_at", "updated_at")


@query
def merged_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows written as merged text and read back."""
    daily = metrics.labelled(metrics.ten_minute(_counted(spark, sf_dir, tb.ONE_DAY)))
    lines = daily.select(F.concat_ws(",", "run_time", "adc_id", *metrics.MEASURES).alias("value"))
    path = scratch_dir(spark, "merged")
    text_archive.write_merged_text(lines, path, files=4)
    return spark.read.text(path, lineSep="\n")
