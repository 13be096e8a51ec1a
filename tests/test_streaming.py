import datetime as dt
import random
import shutil
import threading

import pytest
from pyspark.sql import functions as F

import tallyroad_job
from tallyroad.operators import hourly, metrics, parse
from tallyroad.session import scratch_dir
from tallyroad.sources import messages as sources, text_archive
from tallyroad.streaming import jobs, tables
from test_parse import message

NOON = dt.datetime(2024, 3, 1, 12, tzinfo=dt.timezone.utc)


def some_messages(n=400, seed=5):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        time = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(300))
        status = rng.choice([400, 800, 900, 100, 450, 500])
        texts.append(
            message(
                {"driver_id": rng.randrange(12), "adc_id": rng.choice([1, 1, 1, 2, 3]),
                 "status": status, "customer_price": rng.randrange(50)},
                {"timestamp": f"{time:%Y-%m-%d %H:%M:%S}"},
            )
        )
    texts[7] = "broken"
    texts[8] = " "
    texts[9] = message({"adc_id": "x"})
    return texts


TEXTS = some_messages()


class Feed:
    """Message files of one topic landing in a folder."""

    def __init__(self, spark):
        self.spark = spark
        self.path = scratch_dir(spark, "feed")
        self.root = scratch_dir(spark, "root")
        self.checkpoint = scratch_dir(spark, "checkpoint")
        self.sent = 0

    def land(self, texts):
        rows = [("t", i % 2, self.sent + i, text) for i, text in enumerate(texts)]
        self.sent += len(texts)
        df = self.spark.createDataFrame(rows, sources.MESSAGE_SCHEMA)
        df.coalesce(1).write.mode("append").parquet(self.path)

    def run(self, **options):
        stream = sources.file_stream(self.spark, self.path, max_files_per_trigger=1)
        options = {"key_life": None, "checkpoint": self.checkpoint, **options}
        query = jobs.metrics_job(stream, self.root, consumer="c", **options)
        query.awaitTermination()
        return query

    def ten_minute(self):
        return rows_of(tables.ten_minute(self.spark, self.root))

    def hourly(self):
        return rows_of(tables.hourly(self.spark, self.root).drop("created_at", "updated_at"))


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def batch_rows(spark, texts):
    return parse.counted(parse.classify(sources.from_memory(spark, texts)))


def batch_hourly(spark, texts):
    writes = hourly.batch_writes(batch_rows(spark, texts))
    return rows_of(hourly.stored_rows(hourly.hourly(writes)))


def batch_ten_minute(spark, batches):
    parts = None
    for number, texts in enumerate(batches):
        part = metrics.partials(batch_rows(spark, texts).withColumn("b", F.lit(number)), "b")
        parts = part if parts is None else parts.unionByName(part)
    return rows_of(metrics.labelled(metrics.merge_partials(parts)))


def split(texts, n):
    return [texts[i::n] for i in range(n)]


@pytest.mark.parametrize("n", [1, 5])
def test_stream_equals_batch(spark, n):
    feed = Feed(spark)
    batches = split(TEXTS, n)
    for texts in batches:
        feed.land(texts)
    query = feed.run()
    assert feed.hourly() == batch_hourly(spark, TEXTS)
    assert feed.ten_minute() == batch_ten_minute(spark, batches)
    assert tables.last_committed(spark, feed.root) == n - 1
    assert len(jobs.offset_ranges(query)) == n
    rejected = rows_of(tables.committed(spark, feed.root, "quarantine").drop("batch_seq"))
    assert [r[0] for r in rejected] == ["bad_adc_id", "not_an_object"]


def forget_commit(feed, batch_id):
    """Go on from a copy of the checkpoint as it was before a batch was
    committed, as if the job had died after writing its outputs."""
    copy = scratch_dir(feed.spark, "checkpoint")

    def left_out(folder, names):
        lost = (f"{batch_id}", f".{batch_id}.crc")
        return [n for n in names if n in lost] if folder.endswith("/commits") else []

    shutil.copytree(feed.checkpoint, copy, ignore=left_out)
    feed.checkpoint = copy


def test_replay_changes_nothing(spark):
    feed = Feed(spark)
    for texts in split(TEXTS, 3):
        feed.land(texts)
    feed.run()
    before = feed.ten_minute(), feed.hourly()
    positions = rows_of(tables.positions(spark, feed.root, "t", "c"))
    forget_commit(feed, 2)
    feed.run()
    assert (feed.ten_minute(), feed.hourly()) == before
    assert rows_of(tables.positions(spark, feed.root, "t", "c")) == positions
    assert tables.last_committed(spark, feed.root) == 2


def test_restart_goes_on(spark):
    feed = Feed(spark)
    batches = split(TEXTS, 4)
    for texts in batches:
        feed.land(texts)
        feed.run()
    assert feed.ten_minute() == batch_ten_minute(spark, batches)
    assert feed.hourly() == batch_hourly(spark, TEXTS)


def test_new_checkpoint_keeps_older_batches(spark):
    feed = Feed(spark)
    batches = split(TEXTS, 2)
    feed.land(batches[0])
    feed.run()
    later = Feed(spark)
    later.root = feed.root
    later.land(batches[1])
    later.run()
    later.run()
    assert tables.last_committed(spark, feed.root) == 1
    assert feed.ten_minute() == batch_ten_minute(spark, batches)
    assert feed.hourly() == batch_hourly(spark, TEXTS)


def test_order_of_batches_does_not_matter(spark):
    results = []
    for order in (1, -1):
        feed = Feed(spark)
        for texts in split(TEXTS, 3)[::order]:
            feed.land(texts)
            feed.run()
        results.append((feed.ten_minute(), feed.hourly()))
    assert results[0] == results[1]


def test_same_driver_in_two_batches(spark):
    feed = Feed(spark)
    for _ in range(2):
        feed.land([message()])
        feed.run()
    assert tables.ten_minute(spark, feed.root).first()["sign_driver"] == 2
    assert tables.hourly(spark, feed.root).first()["sign_driver"] == 1


def test_expired_hour_is_replaced_by_a_smaller_count(spark):
    feed = Feed(spark)
    times = [NOON, NOON + dt.timedelta(hours=20), NOON + dt.timedelta(hours=50)]
    counts = []
    for drivers, now in zip(((1, 2), (3,), (4,)), times):
        feed.land([message({"driver_id": d}) for d in drivers])
        feed.run(key_life=hourly.KEY_LIFE, clock=lambda batch_id, now=now: now)
        counts.append(tables.hourly(spark, feed.root).first()["sign_driver"])
    assert counts == [2, 3, 1]
    assert tables.ten_minute(spark, feed.root).first()["sign_driver"] == 4


def test_late_message_joins_its_old_bucket(spark):
    feed = Feed(spark)
    feed.land([message(data={"timestamp": "2024-01-09 00:00:00"})])
    feed.run()
    feed.land([message(data={"timestamp": "2017-06-19 01:00:03"})])
    feed.run()
    hours = [r["run_time"].year for r in tables.hourly(spark, feed.root).collect()]
    assert sorted(hours) == [2017, 2024]


def test_archive_beside_the_metrics(spark):
    feed = Feed(spark)
    archive = scratch_dir(spark, "archive")
    feed.land(TEXTS)
    feed.run(archive=(archive, "t"))
    forget_commit(feed, 0)
    feed.run(archive=(archive, "t"))
    lines = text_archive.read_archive(spark, archive, "t")
    assert sorted(r[0] for r in lines.collect()) == sorted(TEXTS)
    rejected = tables.committed(spark, feed.root, "quarantine")
    assert rejected.count() == 2


def test_archive_job(spark):
    feed = Feed(spark)
    archive = scratch_dir(spark, "archive")
    for texts in split(TEXTS, 2):
        feed.land(texts)
        stream = sources.file_stream(spark, feed.path)
        jobs.archive_job(stream, archive, "t", feed.checkpoint).awaitTermination()
    lines = text_archive.read_archive(spark, archive, "t")
    assert sorted(r[0] for r in lines.collect()) == sorted(TEXTS)


def test_compacted_tables_go_on(spark):
    feed = Feed(spark)
    batches = split(TEXTS, 3)
    for texts in batches[:2]:
        feed.land(texts)
        feed.run()
    target = scratch_dir(spark, "compact")
    tables.compact(spark, feed.root, target)
    before = feed.ten_minute(), feed.hourly(), rows_of(tables.positions(spark, feed.root, "t", "c"))
    feed.root = target
    after = feed.ten_minute(), feed.hourly(), rows_of(tables.positions(spark, target, "t", "c"))
    assert after == before
    feed.land(batches[2])
    feed.run()
    assert tables.last_committed(spark, target) == 2
    assert feed.ten_minute() == batch_ten_minute(spark, batches)
    assert feed.hourly() == batch_hourly(spark, TEXTS)


def test_interval_and_stop(spark):
    feed = Feed(spark)
    feed.land(TEXTS[:5])
    stream = sources.file_stream(spark, feed.path)
    query = jobs.metrics_job(stream, feed.root, feed.checkpoint, interval="1 second")
    query.processAllAvailable()
    jobs.stop_after_batch(query)
    assert not query.isActive
    assert tables.last_committed(spark, feed.root) == 0


def test_published_rows_are_the_stored_ones(spark):
    feed = Feed(spark)
    copies = {"ten_minute": {}, "hourly": {}}

    def publish(session, seq):
        for name, rows in zip(copies, tables.changed_by(session, feed.root, seq)):
            for row in rows.collect():
                copies[name][(row["run_time"], row["adc_id"])] = row

    for texts in split(TEXTS, 2):
        feed.land(texts)
        feed.run(publish=publish)
    stored = tables.ten_minute(spark, feed.root).collect()
    assert sorted(copies["ten_minute"].values(), key=str) == sorted(stored, key=str)
    columns = tables.hourly(spark, feed.root).columns
    published = [tuple(r[c] for c in columns) for r in copies["hourly"].values()]
    stored = [tuple(r) for r in tables.hourly(spark, feed.root).collect()]
    assert sorted(published, key=str) == sorted(stored, key=str)


def test_days_of_a_batch_prune_the_state(spark):
    feed = Feed(spark)
    days = [f"2024-{m:02}-{d:02} 00:00:00" for m in (1, 2, 3) for d in range(1, 29)]
    for some in (days, days[:3]):
        feed.land([message(data={"timestamp": d}) for d in some])
        feed.run()
    counts = [r["sign_driver"] for r in tables.hourly(spark, feed.root).collect()]
    assert counts == [1] * len(days)
    state = tables.read(spark, feed.root, "hour_writes")
    near = tables.same_days(state, state.where(F.col("batch_seq") == 1))
    assert near.count() == 6
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "SortMergeJoin" not in plan


def test_session_has_to_be_in_utc(spark):
    feed = Feed(spark)
    feed.land([message()])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            feed.run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hot_hour_meets_in_no_join(spark):
    """No join on hour and site stands below the grouping by driver."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state = spark.createDataFrame(
            [], tables.SCHEMAS["hour_writes"]
        )
        fresh = hourly.hourly(state).join(hourly.touched_keys(state), list(hourly.KEY), "left_semi")
        plan = fresh._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = {k: min(len(x) - len(x.lstrip(" :+-")) for x in plan.split("\n") if k in x) for k in ("Join", "driver_id")}
    assert depth["Join"] < depth["driver_id"]


def test_archive_goes_on_from_its_ledger(spark):
    feed = Feed(spark)
    archive, ledger = scratch_dir(spark, "archive"), scratch_dir(spark, "ledger")
    for texts in split(TEXTS, 2):
        feed.land(texts)
        stream = sources.file_stream(spark, feed.path)
        job = jobs.archive_job(
            stream, archive, "t", feed.checkpoint, consumer="c", ledger_root=ledger
        )
        job.awaitTermination()
    stored = dict(rows[1:] for rows in map(tuple, tables.positions(spark, ledger, "t", "c").collect()))
    assert max(stored.values()) == len(TEXTS) and set(stored) == {0, 1}


def test_stop_event_ends_the_query_between_batches(spark):
    feed = Feed(spark)
    feed.land(TEXTS[:5])
    stream = sources.file_stream(spark, feed.path)
    query = jobs.metrics_job(stream, feed.root, feed.checkpoint, interval="1 second")
    query.processAllAvailable()
    stop = threading.Event()
    stop.set()
    tallyroad_job.run_until_stopped(query, stop)
    assert not query.isActive


PUBLISHED = []


def remember(session, seq):
    PUBLISHED.append(seq)


def test_command_line_rules(spark):
    given = ["metrics", "--servers", "h:1", "--topic", "t", "--root", "r", "--checkpoint", "c"]
    with pytest.raises(SystemExit):
        tallyroad_job.arguments([*given, "--start", "earliest"])
    assert tallyroad_job.arguments([*given, "--start", "earliest", "--max-offsets", "9"]).max_offsets == 9
    assert tallyroad_job.publisher(None) is None
    assert tallyroad_job.publisher(f"{__name__}:remember") is not None


def test_command_line(spark):
    feed = Feed(spark)
    feed.land(TEXTS)
    given = ["--topic", "t", "--files", feed.path, "--root", feed.root, "--checkpoint", feed.checkpoint]
    args = tallyroad_job.arguments(
        ["metrics", *given, "--key-life", "0", "--publish", f"{__name__}:remember"]
    )
    tallyroad_job.start(spark, args).awaitTermination()
    assert feed.hourly() == batch_hourly(spark, TEXTS)
    given[-3:] = [scratch_dir(spark, "archive"), "--checkpoint", scratch_dir(spark, "checkpoint")]
    args = tallyroad_job.arguments(["archive", *given])
    tallyroad_job.start(spark, args).awaitTermination()
    assert text_archive.read_archive(spark, args.root, "t").count() == len(TEXTS)


def test_empty_tables(spark):
    root = scratch_dir(spark, "none")
    assert tables.last_committed(spark, root) == -1
    assert tables.hourly(spark, root).count() == tables.ten_minute(spark, root).count() == 0
    assert tables.positions(spark, root, "t", "c").count() == 0
