"""State that is kept up while the job runs: reads, merges, expiry, commits."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyroad.operators import hourly, offsets
from tallyroad.session import scratch_dir
from tallyroad.streaming import jobs, manifest, tables
from test_parse import message
from test_streaming import NOON, Feed, batch_hourly, rows_of, some_messages, split

PART = manifest.Part("members", "2024-01-01", 0, 0, 0.0)


def drivers(numbers, at="2024-01-01 00:00:00", status=400):
    return [message({"driver_id": d, "status": status}, {"timestamp": at}) for d in numbers]


def files_of(df):
    return {f.split("/part-")[0] for f in df.inputFiles()}


def test_incremental_state_equals_the_writes(spark):
    """Sets kept by new members only, against all writes of all batches."""
    feed = Feed(spark)
    life = 3 * 3600
    for i, texts in enumerate(split(some_messages(300, 8), 4)):
        feed.land(texts)
        now = NOON + dt.timedelta(hours=[0, 2, 4, 9][i])
        feed.run(key_life=life, clock=lambda _, now=now: now, fan=2)
        writes = tables.read(spark, feed.root, "hour_writes")
        all_rows = hourly.hourly_with_expiry(writes, F.lit(now).cast("timestamp"), life)
        mine = hourly.touched_keys(writes.where(F.col("batch_seq") == i))
        expected = rows_of(hourly.stored_rows(all_rows.join(mine, list(hourly.KEY), "left_semi")))
        stored = tables.committed(spark, feed.root, "hourly").where(F.col("changed_seq") == i)
        columns = ("run_time", "adc_id", *tables.metrics.MEASURES)
        assert rows_of(stored.select(*columns)) == expected


def test_what_a_batch_reads_does_not_grow_with_earlier_batches(spark, monkeypatch):
    """Twenty batches of one hour, by the same drivers: each reads the same
    number of state rows, while the log of writes grows."""
    feed = Feed(spark)
    read = []
    committed = tables.committed

    def counted(spark, root, table, slots=None, at=None):
        df = committed(spark, root, table, slots, at)
        read.append((at.seq + 1, table, df.count()))
        return df

    monkeypatch.setattr(tables, "committed", counted)
    for _ in range(20):
        feed.land(drivers(range(6)))
    feed.run(fan=4)
    for table, most in (("members", 6), ("hour_state", 1), ("hourly", 1)):
        assert {n for seq, t, n in read if t == table and seq > 0} == {most}
    assert {t for _, t, _ in read} == {"members", "hour_state", "hourly"}
    assert tables.read(spark, feed.root, "members").count() == 6
    assert committed(spark, feed.root, "hour_writes").count() == 120


def test_parts_of_a_day_stay_bounded_and_a_reader_sees_one_state(spark):
    """Fifty batches of one day, without the stream around them."""
    root = scratch_dir(spark, "root")
    log = manifest.Log(spark, root)
    row = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), "7", 1, 0, 0, 0, 5, dt.date(2024, 1, 1))],
        tables.SCHEMAS["ten_minute"].replace("batch_seq BIGINT, ", ""),
    ).coalesce(1)
    day, most = "2024-01-01", 0
    for seq in range(50):
        before = log.state()
        add = tables.write_parts(row, root, "ten_minute", seq, NOON, [day])
        at = log.commit(before, manifest.Commit(seq, tuple(add), query=("q", seq)))
        if seq == 9:
            # Opened before a merge, read after many.
            opened = tables.ten_minute(spark, root)
        at = tables.upkeep(spark, root, log, at, [("ten_minute", day)], NOON, None, fan=3, grace=64)
        most = max(most, len(at.of("ten_minute", [day])))
    # Four tiers of at most two parts.
    assert most <= 2 * 4
    assert opened.first()["sign_driver"] == 10
    assert tables.ten_minute(spark, root).first()["event_price"] == 250
    # The log itself does not grow with the batches either.
    assert len(log.files.names()) < 60


def test_expired_writes_are_gone(spark):
    feed = Feed(spark)
    life = 3600
    for i in range(6):
        feed.land(drivers([i], f"2024-01-0{1 + i // 2} 00:00:00"))
        feed.run(key_life=life, clock=lambda _, i=i: NOON + dt.timedelta(hours=2 * i), fan=2, grace=0)
    at = tables.state(spark, feed.root)
    for table in tables.EXPIRING:
        assert {p.slot for p in at.of(table)} == {"2024-01-03"}
        assert tables.read(spark, feed.root, table).where(F.col("batch_seq") < 4).count() == 0
    # What was reported stays, and the newest generation alone is a member.
    assert tables.hourly(spark, feed.root).count() == 3
    assert [r["driver_id"] for r in tables.committed(spark, feed.root, "members").collect()] == ["5"]


def test_readers_list_the_folders_of_their_days(spark):
    feed = Feed(spark)
    days = [f"2024-01-{d:02}" for d in range(1, 6)]
    for _ in range(4):
        feed.land([m for d in days for m in drivers([1], f"{d} 00:00:00")])
    feed.run(fan=100)
    at = tables.state(spark, feed.root)
    wanted = tables.committed(spark, feed.root, "ten_minute", [days[2]])
    assert files_of(wanted) == {f for f in files_of(tables.read(spark, feed.root, "ten_minute")) if days[2] in f}
    assert len(at.of("ten_minute", [days[2]])) == len(files_of(wanted)) == 4
    day = dt.date(2024, 1, 3)
    assert tables.ten_minute(spark, feed.root, (day, day)).first()["sign_driver"] == 4
    assert [r["run_time"].day for r in tables.hourly(spark, feed.root, (day, dt.date(2024, 1, 4))).collect()] == [3, 4]
    # One row per key is stored, so nothing is grouped on the way out.
    plan = tables.hourly(spark, feed.root)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan


def test_a_second_writer_fails(spark):
    first, second = Feed(spark), Feed(spark)
    second.root = first.root
    first.land(drivers([1]))
    second.land(drivers([2]))

    def meanwhile(session, seq):
        second.run()

    # The second job commits while the first one is between its writes.
    with pytest.raises(Exception, match="another job"):
        first.run(publish=meanwhile)
    assert tables.hourly(spark, first.root).first()["sign_driver"] == 1
    # Started again, the first one goes on from what the other one left.
    first.run()
    assert tables.hourly(spark, first.root).first()["sign_driver"] == 2
    assert tables.ten_minute(spark, first.root).first()["sign_driver"] == 2


def test_claims_and_versions_of_the_log(spark):
    log = manifest.Log(spark, scratch_dir(spark, "log"))
    assert log.state() == manifest.State() and log.next_free("a") == 0
    assert not log.claim(0, "a") and log.claim(0, "a")
    with pytest.raises(manifest.ConcurrentWriter):
        log.claim(0, "b")
    assert (log.next_free("a"), log.next_free("b")) == (0, 1)
    at = log.commit(manifest.State(), manifest.Commit(0, (PART,), query=("a", 0), positions={("t", "c", 3): 7}))
    assert log.state() == at and at.of("members") == [PART] and log.next_free("b") == 1
    with pytest.raises(manifest.ConcurrentWriter):
        log.commit(manifest.State(), manifest.Commit(0))
    for n in range(1, 60):
        at = log.commit(at, manifest.Commit(n, remove=(PART,) if n == 5 else (), query=("a", n)))
    assert log.state() == at and at.seq == 59 and at.queries == {"a": (0, 59)}
    assert at.gone == {PART: 5} and not at.parts and at.positions == {("t", "c", 3): 7}
    assert len(log.files.names()) < 40


def test_a_batch_that_died_before_its_commit_is_written_again(spark):
    feed = Feed(spark)
    feed.land(drivers([1, 2]))

    def fail(session, seq):
        raise RuntimeError("lost")

    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            feed.run(publish=fail)
    assert tables.last_committed(spark, feed.root) == -1
    assert tables.hourly(spark, feed.root).count() == tables.ten_minute(spark, feed.root).count() == 0
    feed.run()
    assert tables.hourly(spark, feed.root).first()["sign_driver"] == 2
    assert tables.last_committed(spark, feed.root) == 0


def test_ranges_of_all_batches_are_there_after_a_restart(spark):
    feed = Feed(spark)
    for _ in range(3):
        feed.land(drivers([1, 2, 3]))
        feed.run()
    rows = [tuple(r) for r in tables.ranges(spark, feed.root).orderBy("batch_id", "partition").collect()]
    assert [r[2:6] for r in rows] == [(p, 3 * b + p, 3 * b + 3 - p, b) for b in range(3) for p in range(2)]


def test_silent_partitions_have_positions(spark, monkeypatch):
    line = json.dumps({"t": {"0": 400, "1": 8, "7": 12}})
    assert offsets.planned_ends(line) == {("t", 0): 400, ("t", 1): 8, ("t", 7): 12}
    assert offsets.planned_ends('{"logOffset":3}') == offsets.planned_ends("-") == offsets.planned_ends("[1]") == {}
    planned = jobs._Run._planned
    monkeypatch.setattr(jobs._Run, "_planned", lambda *a: [*planned(*a), line])
    feed = Feed(spark)
    feed.land(drivers([1, 2, 3]))
    feed.run()
    stored = tables.positions(spark, feed.root, "t", "c")
    assert {r["partition"]: r["offset"] for r in stored.collect()} == {0: 3, 1: 2, 7: 12}
    assert json.loads(offsets.starting_offsets(stored, "t")) == {"t": {"0": 3, "1": 2, "7": 12}}


def test_an_empty_batch_has_the_time_of_its_plan(spark):
    feed = Feed(spark)
    feed.land([" "])
    feed.run(clock=None)
    line = jobs.Folder(spark, f"{feed.checkpoint}/offsets").read("0").splitlines()[1]
    ranges = [p for p in tables.state(spark, feed.root).parts if p.table == "quarantine"]
    assert int(ranges[0].time * 1000) == json.loads(line)["batchTimestampMs"]


def test_all_of_it_equals_one_batch(spark):
    feed = Feed(spark)
    texts = some_messages(250, 3)
    for some in split(texts, 6):
        feed.land(some)
    feed.run(fan=2, grace=1)
    assert feed.hourly() == batch_hourly(spark, texts)
