import pytest

from tallyroad.operators import upsert

SCHEMA = "k string, n long, created_at string"


def df(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_additive_upsert(spark):
    old = df(spark, ("a", 1, "t0"), ("b", 2, "t0"))
    new = df(spark, ("b", 5, "t1"), ("c", 7, "t1"))
    merged = upsert.additive_upsert(old, new, ["k"], ["n"])
    assert rows(merged) == [("a", 1, "t0"), ("b", 7, "t0"), ("c", 7, "t1")]


def test_replace_by_key(spark):
    old = df(spark, ("a", 1, "t0"), ("b", 2, "t0"), ("b", 3, "t0"))
    new = df(spark, ("b", 5, "t1"), ("c", 7, "t1"))
    once = upsert.replace_by_key(old, new, ["k"])
    assert rows(once) == [("a", 1, "t0"), ("b", 5, "t1"), ("c", 7, "t1")]
    assert rows(upsert.replace_by_key(once, new, ["k"])) == rows(once)


def test_delete_and_update(spark):
    old = df(spark, ("a", 1, "t0"), ("b", 2, "t0"))
    change = df(spark, ("b", None, "t1"), ("c", 7, "t1"))
    assert rows(upsert.delete_keys(old, change, ["k"])) == [("a", 1, "t0")]
    updated = upsert.update_keys(old, change, ["k"], ["n"]).orderBy("k").collect()
    assert [tuple(r) for r in updated] == [("a", 1, "t0"), ("b", None, "t0")]


def test_existing_counts(spark):
    old = df(spark, ("a", 1, "t0"), ("b", 2, "t0"), ("b", 3, "t0"))
    wanted = df(spark, ("b", 0, ""), ("b", 1, ""), ("c", 0, ""))
    assert rows(upsert.existing_counts(old, wanted, ["k"])) == [("b", 2), ("c", 0)]


def test_insert_columns(spark):
    mixed = spark.createDataFrame([(1, "a", 1), (2, None, 2), (4, None, None)], "id int, x string, y int")
    named = mixed.select(upsert.insert_columns(mixed.columns))
    assert [r[0] for r in named.collect()] == ["id,x,y", "id,y", "id"]


def test_latest_by_key(spark):
    log = df(spark, ("a", 1, "t0"), ("a", 3, "t1"), ("b", 2, "t0"))
    assert rows(upsert.latest_by_key(log, ["k"], "n").select("k", "n", "created_at")) == [
        ("a", 3, "t1"), ("b", 2, "t0")]
