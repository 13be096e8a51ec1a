import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row

from tallyroad.session import scratch_dir
from tallyroad.sources import jdbc, text_archive


def test_archive_keeps_everything_but_nulls(spark):
    root = scratch_dir(spark, "archive")
    path = text_archive.archive_path(root, "t", dt.datetime(2024, 1, 31, 23, 59), "q-0")
    assert path == f"{root}/t/2024-01-31/q-0"
    lines = spark.createDataFrame([("a",), ("",), ("  ",), (None,)], "value string")
    text_archive.write_archive(lines, path)
    text_archive.write_archive(lines, path)
    assert sorted(r[0] for r in text_archive.read_archive(spark, root, "t").collect()) == ["", "  ", "a"]


def test_archive_of_an_empty_batch(spark):
    path = f"{scratch_dir(spark, 'archive')}/t/2024-01-01/0"
    text_archive.write_archive(spark.createDataFrame([], "value string"), path)
    assert os.path.exists(f"{path}/_SUCCESS")


def part_files(path):
    return [f for f in os.listdir(path) if f.startswith("part-")]


def test_merged_text_keeps_the_order(spark):
    path = scratch_dir(spark, "merged")
    lines = spark.range(1000).repartition(7).selectExpr("cast(id as string) as value")
    expected = [r[0] for r in lines.collect()]
    for files in (1, 3):
        text_archive.write_merged_text(lines, path, files=files)
        names = sorted(part_files(path))
        assert len(names) == files
        assert [x for n in names for x in open(f"{path}/{n}").read().split()] == expected
    text_archive.write_merged_text(lines.limit(5), path)
    assert spark.read.text(path).count() == 5
    with pytest.raises(AnalysisException):
        text_archive.write_merged_text(lines, path, overwrite=False)


class Connection:
    """Records what a DB-API connection is asked to do."""

    def __init__(self):
        self.calls = []

    def cursor(self):
        return self

    def execute(self, statement):
        self.calls.append(statement)

    def executemany(self, statement, rows):
        self.calls.append((statement, rows))

    def commit(self):
        self.calls.append("commit")

    def close(self):
        self.calls.append("close")


def test_statements():
    assert jdbc.delete_statement("t", ["a", "b"]) == "DELETE FROM t WHERE a = ? AND b = ?"
    assert jdbc.update_statement("t", ["k"], ["x", "y"]) == "UPDATE t SET x = ?, y = ? WHERE k = ?"


def test_rows_run_in_batches():
    made = []

    def connect():
        made.append(Connection())
        return made[-1]

    rows = [Row(k=i, x=i * 2) for i in range(5)]
    jdbc.execute_rows(rows, connect, "S", ["x", "k"], 2)
    assert len(made) == 1
    assert made[0].calls == [
        ("S", [(0, 0), (2, 1)]), "commit", ("S", [(4, 2), (6, 3)]), "commit", ("S", [(8, 4)]),
        "commit", "close"]
    jdbc.execute_rows([], connect, "S", ["x"], 2)
    assert len(made) == 1


def test_rows_are_computed_once_for_all_null_patterns(spark):
    runs = spark.sparkContext.accumulator(0)

    def counted(rows):
        for row in rows:
            runs.add(1)
            yield row

    mixed = spark.createDataFrame(
        spark.sparkContext.parallelize(
            [(1, "a", 1), (2, None, 2), (3, "c", None), (4, None, None), (5, "e", 5)], 2
        ).mapPartitions(counted),
        "id int, x string, y int",
    )
    seen = {}
    jdbc.write_by_nulls(mixed, ["x", "y"], lambda part: seen.update({tuple(part.columns): part.count()}))
    assert seen == {("id",): 1, ("id", "x"): 1, ("id", "y"): 1, ("id", "x", "y"): 2}
    assert runs.value == 5


def test_swap_is_one_transaction():
    statements = jdbc.swap_statements("t", "s", ["a", "b"], ["a", "b", "n"])
    assert statements == [
        "DELETE FROM t WHERE EXISTS (SELECT 1 FROM s WHERE s.a = t.a AND s.b = t.b)",
        "INSERT INTO t (a, b, n) SELECT a, b, n FROM s",
    ]
