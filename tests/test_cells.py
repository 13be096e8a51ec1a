from pyspark.sql import functions as F

from tallyroad.operators import cells


def puts(spark, *rows):
    """``(row, family, qualifier, version, value)`` in writing order."""
    data = [(*r, i) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        data, "row_key string, family string, qualifier string, version long, value string, written long"
    )


def name_versions(spark, *extra):
    base = [("1", "cf2", "name", v, f"spark{v}") for v in (1, 2, 3, 4)]
    return puts(spark, *base, *extra)


def values(df):
    return [r["value"] for r in df.orderBy("row_key", "family", "qualifier", F.desc("version")).collect()]


def test_latest_and_versions(spark):
    log = name_versions(spark, ("2", "cf1", "name", 1, "other"))
    assert values(cells.versions(log, "cf2", 2)) == ["spark4", "spark3"]
    assert values(cells.versions(log, "cf2", 10)) == ["spark4", "spark3", "spark2", "spark1"]
    assert values(cells.latest(log)) == ["spark4", "other"]
    assert values(cells.latest(log, "cf1")) == ["other"]


def test_point_get_reads_all_families(spark):
    log = name_versions(spark, ("1", "cf1", "age", 9, "7"), ("2", "cf2", "name", 1, "x"))
    assert values(cells.get(log, "1")) == ["7", "spark4"]


def test_last_write_of_a_version_stays(spark):
    log = name_versions(spark, ("1", "cf2", "name", 2, "again"))
    assert values(cells.versions(log, limit=10)) == ["spark4", "spark3", "again", "spark1"]
    same = puts(spark, ("1", "f", "q", 5, "z"), ("1", "f", "q", 5, "a"))
    assert values(cells.latest(same)) == ["a"]


def test_delete_latest_shows_the_older_one(spark):
    log = name_versions(spark, ("2", "cf2", "name", 1, "kept"))
    left = cells.delete_latest(log, log.where("row_key = '1'"))
    assert values(left) == ["spark3", "spark2", "spark1", "kept"]
    assert values(cells.delete_latest(puts(spark, ("1", "f", "q", 1, "a")), log)) == ["a"]


def test_put_with_and_without_version(spark):
    row = spark.range(1)
    args = dict(family=F.lit("f"), qualifier=F.lit("q"), value=F.lit(3), row_key=F.col("id"), written=F.lit(0))
    assert cells.put(row, **args, version=F.lit(4)).first()["version"] == 4
    assert cells.put(row, **args).first()["version"] > 1_600_000_000_000
