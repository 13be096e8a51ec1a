"""Marks that are resolved on read, clustered cells, replay of an archive."""

import pytest
from pyspark.sql import functions as F

from tallyroad.operators import cells, marks
from tallyroad.session import scratch_dir
from tallyroad.sources import cell_files, messages as sources
from tallyroad.streaming import jobs, tables
from test_streaming import Feed, batch_hourly, some_messages, split

ROWS = "k int, v int, w string"


def resolved(spark, rows, all_marks):
    found = marks.resolve(rows, all_marks, ["k"], ["v"])
    assert found.columns == rows.columns
    return sorted(tuple(r) for r in found.collect())


def test_marks_take_effect_in_their_order(spark):
    rows = marks.rows_of(spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, None, "c"), (None, 5, "d")], ROWS), 0)
    keys = spark.createDataFrame([(2,), (2,), (9,)], "k int")
    gone = marks.delete_marks(keys, ["k"], 1)
    assert gone.count() == 2  # as many as keys are named
    set_ = [marks.update_marks(spark.createDataFrame([(1, seq), (2, seq), (3, None)], "k int, v int"), ["k"], ["v"], seq) for seq in (2, 3)]
    every = gone.withColumn("set", F.lit(None).cast("struct<v:int>")).unionByName(set_[1]).unionByName(set_[0])
    expected = [(1, 3, "a", 0), (3, None, "c", 0)]
    got = resolved(spark, rows.where("k IS NOT NULL"), every)
    assert got == expected
    # Rows written after a mark are not touched by it.
    again = rows.where("k = 2").withColumn("row_seq", F.lit(2).cast("bigint"))
    assert resolved(spark, again, every) == [(2, 3, "b", 2)]
    again = again.withColumn("row_seq", F.lit(3).cast("bigint"))
    assert resolved(spark, again, every) == [(2, 20, "b", 3)]
    # A null key is named by no mark.
    assert resolved(spark, rows.where("k IS NULL"), every) == [(None, 5, "d", 0)]
    folded = marks.fold(rows, every, ["k"], ["v"], scratch_dir(spark, "folded"))
    assert sorted(map(str, (tuple(r) for r in folded.collect()))) == sorted(map(str, [*expected, (None, 5, "d", 0)]))
    assert resolved(spark, folded.where("k IS NOT NULL"), every.limit(0)) == expected


def test_a_cell_that_is_put_again_is_back(spark):
    puts = spark.createDataFrame(
        [("1", "cf2", "name", v, f"spark{v}", v) for v in range(1, 5)], cell_files.SCHEMA
    )
    gone = cells.delete_marks(puts, puts, 4)
    assert [tuple(r) for r in gone.collect()] == [("1", "cf2", "name", 4, 4)]
    assert cells.latest(cells.unmarked(puts, gone)).first()["value"] == "spark3"
    more = puts.union(spark.createDataFrame([("1", "cf2", "name", 4, "back", 5)], cell_files.SCHEMA))
    assert cells.latest(cells.unmarked(more, gone)).first()["value"] == "back"
    assert cells.settle(cells.unmarked(puts, gone)).count() == cells.delete_latest(puts, puts).count() == 3


def scanned(df):
    """Rows that the scan of a query handed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    return sum(leaf.metrics().apply("numOutputRows").value() for leaf in leaves(plan))


def leaves(plan):
    if "QueryStage" in plan.nodeName():
        return leaves(plan.plan())
    children = plan.children()
    found = [x for i in range(children.size()) for x in leaves(children.apply(i))]
    return found or [plan]


def test_a_point_get_reads_one_row_group(spark):
    puts = spark.range(60_000).select(
        (F.col("id") % 3000).cast("string").alias("row_key"),
        F.lit("f").alias("family"),
        (F.col("id") % 5).cast("string").alias("qualifier"),
        F.col("id").alias("version"),
        F.sha2(F.col("id").cast("string"), 256).alias("value"),
        F.col("id").alias("written"),
    )
    path, merged = scratch_dir(spark, "cells"), scratch_dir(spark, "merged")
    for part in (puts.where("id % 2 = 0"), puts.where("id % 2 = 1")):
        cell_files.write_cells(part.repartition(3), path, group_bytes=1 << 16)
    cell_files.merge_cells(spark, path, merged, group_bytes=1 << 16)
    for place in (path, merged):
        stored = cell_files.read_cells(spark, place)
        assert stored.count() == 60_000
        found = cells.get(stored, "1234")
        expected = cells.get(puts, "1234")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
        assert "EqualTo(row_key,1234)" in found._jdf.queryExecution().executedPlan().toString()
    most = scanned(cell_files.read_cells(spark, merged).where("row_key = '1234'").select("value"))
    assert 20 <= most < 3_000  # of 60,000: about a row group, or two
    # Within the range of the keys but not among them: the Bloom filter says so.
    assert scanned(cell_files.read_cells(spark, merged).where("row_key = '1234x'").select("value")) == 0


def test_replay_of_an_archive_by_position(spark):
    feed, archive = Feed(spark), scratch_dir(spark, "archive")
    root = scratch_dir(spark, "root")
    texts = some_messages(200, 4)

    def keep():
        stream = sources.file_stream(spark, feed.path)
        jobs.archive_job(stream, archive, "t", feed.checkpoint, keep_positions=True).awaitTermination()

    def replay():
        start = tables.positions(spark, root, "t", "c")
        stream = sources.archive_stream(spark, archive, "t", start, max_files_per_trigger=1)
        jobs.metrics_job(stream, root, scratch_dir(spark, "checkpoint"), "c", key_life=None).awaitTermination()
        return tables.positions(spark, root, "t", "c").collect()

    some = split(texts, 2)
    feed.land(some[0])
    keep()
    first = {r["partition"]: r["offset"] for r in replay()}
    # Then one partition is silent, and another one is new.
    rows = [("t", 1 + 6 * (i % 2), 1000 + i, text) for i, text in enumerate(some[1])]
    spark.createDataFrame(rows, sources.MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(feed.path)
    keep()
    for _ in range(2):
        last = {r["partition"]: r["offset"] for r in replay()}
    assert last == {0: first[0], 1: 1000 + len(rows) - 1, 7: 1000 + len(rows)}
    stored = tables.hourly(spark, root).drop("created_at", "updated_at")
    assert sorted((tuple(r) for r in stored.select(*sorted(stored.columns)).collect()), key=str) == batch_hourly(spark, texts)
    # Nothing was counted twice.
    once = sum(r["offset"] for r in tables.ranges(spark, root).selectExpr("until_offset - from_offset AS offset").collect())
    assert once >= len(texts)
    total = tables.ten_minute(spark, root).agg(F.sum("sign_driver")).first()[0]
    assert total <= len(texts)
    plan = sources.archive_stream(spark, archive, "t", tables.positions(spark, root, "t", "c"))
    assert plan.isStreaming


@pytest.mark.parametrize("topic", ["t", "other"])
def test_an_archive_without_positions_is_read_from_the_start(spark, topic):
    feed, archive = Feed(spark), scratch_dir(spark, "archive")
    feed.land(["a", "b"])
    stream = sources.file_stream(spark, feed.path)
    jobs.archive_job(stream, archive, "t", feed.checkpoint, keep_positions=True).awaitTermination()
    none = spark.createDataFrame([], "topic STRING, `partition` INT, offset BIGINT")
    arrived = sources.archive_stream(spark, archive, "t", none).where(F.col("topic") == topic)
    rows = []
    query = arrived.writeStream.foreachBatch(lambda df, _: rows.extend(df.collect())).trigger(availableNow=True)
    query.option("checkpointLocation", scratch_dir(spark, "checkpoint")).start().awaitTermination()
    assert len(rows) == (2 if topic == "t" else 0)
