"""The two jobs: metrics tables and a raw archive, from one message stream.

Progress belongs to the checkpoint; state belongs to the tables. There is no
watermark: late messages join their old bucket.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyroad.functions import timebucket
from tallyroad.operators import hourly as hours, metrics, offsets, parse
from tallyroad.operators.upsert import replace_by_key
from tallyroad.sources.text_archive import archive_path, write_archive, write_positions
from tallyroad.streaming import tables
from tallyroad.streaming.manifest import GRACE, Commit, Folder, Log, Part, State

# The time of a batch comes from the checkpoint, so a replay sees it again.
BATCH_TIME = "batch_time"


def metrics_job(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    consumer: str = "metrics",
    source_table: str = parse.SOURCE_TABLE,
    width: int = timebucket.TEN_MINUTES,
    key_life: int | None = hours.KEY_LIFE,
    archive: tuple[str, str] | None = None,
    publish: Callable[[SparkSession, int], None] | None = None,
    clock: Callable[[int], dt.datetime] | None = None,
    interval: str | None = None,
    fan: int = tables.FAN,
    grace: int = GRACE,
) -> StreamingQuery:
    """Start the metrics job on a stream of ``topic, partition, offset, value``.
    The session has to be in UTC, which labels and day folders are read in.

    ``interval`` is the micro-batch interval (``60 seconds``); without it the
    job takes what is there and stops. ``key_life=None`` keeps hourly state
    for ever. ``archive`` is the root and topic name of a raw archive to write
    as well. ``publish`` is called with the number of a batch when its tables
    are written and before it is committed, so again in a replay (see
    ``tables.changed_by``). ``clock`` replaces the batch times, by batch id.
    ``fan`` and ``grace`` are those of ``tables.upkeep``, which follows every
    batch.

    One job writes to a root at a time: a second one fails with
    ``manifest.ConcurrentWriter``, in the batch in which they meet."""
    require_utc(messages.sparkSession)
    run = _Run(checkpoint, root, consumer, clock)

    def process(batch: DataFrame, batch_id: int) -> None:
        at = run.begin(batch, batch_id)
        if at is None:
            return
        # The source is read and parsed once, for all outputs of the batch.
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            now = run.time(rows, batch_id)
            if archive is not None:
                write_archive(rows, archive_path(*archive, now, run.folder(rows, batch_id)))
            seq = run.sequence(batch_id)
            changes = write_metrics(rows, root, seq, now, key_life, at, run.again)
            if publish is not None:
                publish(batch.sparkSession, seq)
            at = run.end(rows, batch_id, at, now, changes)
        finally:
            rows.unpersist()
        touched = {(p.table, p.slot) for p in at.parts if p.seq == seq}
        tables.upkeep(batch.sparkSession, root, run.log, at, touched, now, key_life, fan, grace)

    rows = measured(_timed(messages), source_table, width, keep_text=archive is not None)
    return _start(rows, process, checkpoint, interval)


def archive_job(
    messages: DataFrame,
    archive_root: str,
    topic: str,
    checkpoint: str,
    clock: Callable[[int], dt.datetime] | None = None,
    interval: str | None = None,
    consumer: str | None = None,
    ledger_root: str | None = None,
    keep_positions: bool = False,
) -> StreamingQuery:
    """Start the job that only keeps raw messages, one folder per batch: their
    lines, or with ``keep_positions`` rows that ``messages.archive_stream``
    replays. With ``ledger_root`` and ``consumer`` it also keeps an offset
    ledger there, so that a job without a checkpoint can go on from it."""
    write = write_positions if keep_positions else write_archive
    run = _Run(checkpoint, ledger_root, consumer, clock)

    def process(batch: DataFrame, batch_id: int) -> None:
        at = run.begin(batch, batch_id)
        if at is None:
            return
        # Read once: for the time, the lines and the offsets.
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            now = run.time(rows, batch_id)
            write(rows, archive_path(archive_root, topic, now, run.folder(rows, batch_id)))
            if ledger_root is not None:
                at = run.end(rows, batch_id, at, now, Changes())
        finally:
            rows.unpersist()
        if ledger_root is not None:
            touched = {(p.table, p.slot) for p in at.parts if p.seq == run.sequence(batch_id)}
            tables.upkeep(batch.sparkSession, ledger_root, run.log, at, touched, now, None)

    return _start(_timed(messages), process, checkpoint, interval)


def offset_ranges(query: StreamingQuery) -> list[dict]:
    """Offsets each recent batch of a query went through, by source, as Spark
    tells them; ``tables.ranges`` has those of all batches."""
    return [
        {
            "batch_id": progress["batchId"],
            "source": source["description"],
            "start": source["startOffset"],
            "end": source["endOffset"],
        }
        for progress in query.recentProgress
        for source in progress["sources"]
    ]


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC, not {zone}")


def stop_after_batch(query: StreamingQuery, poll_seconds: float = 0.1) -> None:
    """Stop a running query between two batches."""
    while query.isActive and query.status["isTriggerActive"]:
        query.awaitTermination(poll_seconds)
    query.stop()


def measured(
    messages: DataFrame,
    source_table: str = parse.SOURCE_TABLE,
    width: int = timebucket.TEN_MINUTES,
    keep_text: bool = False,
) -> DataFrame:
    """Everything the tables need from messages: measures of rows that count,
    text and reason of rejected ones, offsets of all."""
    rows = parse.measure_rows(
        parse.classify(messages, source_table=source_table),
        width,
        keep=("topic", "partition", "offset", BATCH_TIME, "value"),
    )
    if keep_text:
        return rows
    return rows.withColumn("value", F.when(F.col("outcome") == "quarantined", F.col("value")))


@dataclass(frozen=True)
class Changes:
    """Parts that a batch puts in place, and those whose place they take."""

    add: tuple[Part, ...] = ()
    remove: tuple[Part, ...] = ()


def write_metrics(
    rows: DataFrame,
    root: str,
    seq: int,
    now: dt.datetime,
    key_life: int | None,
    at: State,
    again: bool = False,
) -> Changes:
    """Write the parts of one batch: ten-minute partials, hourly writes, what
    they change in the hourly sets and rows, rejected lines. ``at`` is the
    state before the batch, so a second attempt writes the same. Of the
    state, only touched days are read, and members of their hours."""
    spark = rows.sparkSession
    time = F.lit(now).cast("timestamp")
    add: list[Part] = []

    def write(df: DataFrame, table: str, slots: list[str] | None = None) -> None:
        add.extend(tables.write_parts(df, root, table, seq, now, slots or [""], again=again))

    def stored(table: str, slots: list[str]) -> DataFrame:
        return tables.committed(spark, root, table, slots, at)

    counted = rows.where(F.col("outcome") == "counted")
    # At most one row per driver and key of the batch.
    writes = hours.batch_writes(counted).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # Days and buckets of one batch: bounded by the calendar and a number.
        days, buckets, first_hour, last_hour = writes.agg(
            F.sort_array(F.collect_set(F.to_date("run_hour").cast("string"))),
            F.sort_array(F.collect_set(hours.driver_bucket())),
            F.unix_seconds(F.min("run_hour")),
            F.unix_seconds(F.max("run_hour")),
        ).first()
        rejected = rows.where(F.col("outcome") == "quarantined").select("value", "reason")
        write(rejected, "quarantine")
        if not days:
            return Changes(tuple(add))
        keys = ("run_ts", "adc_id")
        summed = metrics.driver_rows(counted, *keys).groupBy(*keys).agg(*metrics.measure_columns(F.lit(0)))
        write(summed.withColumn("run_day", F.to_date("run_ts")), "ten_minute", days)
        day = F.to_date("run_hour")
        write(writes.withColumns({"written_at": time, "run_day": day}), "hour_writes", days)

        before = stored("hour_state", days).drop("batch_seq", "run_day")
        members = stored("members", days).where(
            F.col("run_hour").between(*[F.timestamp_seconds(F.lit(h)) for h in (first_hour, last_hour)])
        )
        if len(buckets) <= hours.BUCKETS // 4:
            members = members.where(F.col("bucket").isin(buckets))
        marked = hours.marked_writes(writes, before, members, time, key_life, seq)
        marked = marked.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write(hours.next_members(marked).withColumn("run_day", day), "members", days)
            after = hours.next_state(marked, before, time, key_life)
            write(after.withColumn("run_day", day), "hour_state", days)
        finally:
            marked.unpersist()
        touched = hours.touched_keys(writes)
        after = tables.read_parts(spark, root, "hour_state", [p for p in add if p.table == "hour_state"])
        fresh = hours.stored_rows(hours.hourly_of_state(after, touched)).withColumns(
            {"created_at": time, "updated_at": time, "changed_seq": F.lit(seq).cast("bigint")}
        )
        others = stored("hourly", days).drop("batch_seq", "run_day")
        replaced = replace_by_key(others, fresh, ("run_time", "adc_id"))
        write(replaced.withColumn("run_day", F.to_date("run_time")), "hourly", days)
    finally:
        writes.unpersist()
    return Changes(tuple(add), tuple(at.of("hour_state", days) + at.of("hourly", days)))


class _Run:
    """What a running job knows about its batches."""

    def __init__(
        self,
        checkpoint: str,
        root: str | None,
        consumer: str | None,
        clock: Callable[[int], dt.datetime] | None,
    ):
        self.checkpoint = checkpoint
        self.root = root
        self.consumer = consumer
        self.clock = clock
        self.log: Log | None = None
        self.again = False
        self._query_id: str | None = None
        self._start: int | None = None

    def query_id(self, batch: DataFrame) -> str:
        if self._query_id is None:
            metadata = batch.sparkSession.read.text(f"{self.checkpoint}/metadata")
            self._query_id = json.loads(metadata.first()[0])["id"]
        return self._query_id

    def folder(self, batch: DataFrame, batch_id: int) -> str:
        return f"{self.query_id(batch)}-{batch_id}"

    def time(self, batch: DataFrame, batch_id: int) -> dt.datetime:
        """When the batch began, as the checkpoint has it: an empty batch has
        its rows' time nowhere, but the plan of the batch does."""
        if self.clock is not None:
            return self.clock(batch_id)
        planned = self._planned(batch, batch_id)
        if planned:
            millis = json.loads(planned[1])["batchTimestampMs"]
            return dt.datetime.fromtimestamp(millis / 1000, dt.timezone.utc)
        millis = batch.select(F.unix_millis(BATCH_TIME)).first()
        if millis is None:
            return dt.datetime.now(dt.timezone.utc)
        return dt.datetime.fromtimestamp(millis[0] / 1000, dt.timezone.utc)

    def _planned(self, batch: DataFrame, batch_id: int) -> list[str]:
        """The checkpoint's lines on a batch: version, times, end offsets."""
        files = Folder(batch.sparkSession, f"{self.checkpoint}/offsets")
        return files.read(str(batch_id)).splitlines() if files.exists(str(batch_id)) else []

    def begin(self, batch: DataFrame, batch_id: int) -> State | None:
        """The state to go on from, with the batch's number claimed; None if
        the batch is committed already, which is a replay with nothing to do."""
        if self.root is None:
            return State()
        spark = batch.sparkSession
        self.log = Log(spark, self.root)
        at = self.log.state()
        query_id = self.query_id(batch)
        known = at.queries.get(query_id)
        if known is not None and batch_id <= known[1]:
            return None
        if known is not None:
            self._start = known[0]
        elif self._start is None:
            self._start = self.log.next_free(query_id) - batch_id
        self.again = self.log.claim(self._start + batch_id, query_id)
        return at

    def sequence(self, batch_id: int) -> int:
        """Batch number in the tables; goes on when a checkpoint starts anew."""
        return self._start + batch_id

    def end(self, rows: DataFrame, batch_id: int, at: State, now: dt.datetime, changes: Changes) -> State:
        """Commit the batch, with the offsets it went through. Partitions that
        brought nothing are known from the plan of the batch."""
        seq, query_id = self.sequence(batch_id), self.query_id(rows)
        known = rows.where(F.col("partition").isNotNull() & F.col("offset").isNotNull())
        # One row per topic partition.
        went = offsets.ranges(known).select(
            "topic", F.col("partition").cast("int"), "from_offset", "until_offset"
        ).collect()
        until = {(r["topic"], r["partition"]): r["until_offset"] for r in went}
        planned = self._planned(rows, batch_id)
        silent = {k: v for line in planned[2:] for k, v in offsets.planned_ends(line).items()}
        ends = {(t, self.consumer, p): o for (t, p), o in (silent | until).items()}
        table = [
            (r["topic"], self.consumer, r["partition"], r["from_offset"], r["until_offset"], batch_id, query_id)
            for r in went
        ]
        add = list(changes.add)
        if table:
            day = str(now.astimezone(dt.timezone.utc).date())
            schema = tables.SCHEMAS["ranges"].split(", batch_seq")[0]
            part = rows.sparkSession.createDataFrame(table, schema).coalesce(1)
            part = part.withColumn("run_day", F.lit(day).cast("date"))
            add += tables.write_parts(part, self.root, "ranges", seq, now, [day], again=self.again)
        return self.log.commit(at, Commit(seq, tuple(add), changes.remove, ends, (query_id, batch_id)))


def _timed(messages: DataFrame) -> DataFrame:
    return messages.withColumn(BATCH_TIME, F.current_timestamp())


def _start(
    rows: DataFrame,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None,
) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
