import pytest
from pyspark.sql import functions as F

from tallyroad.functions import timebucket as tb


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def labels(spark, text):
    ts = tb.parse_timestamp(F.lit(text))
    return one(spark, floor=tb.label(tb.bucket_start(ts)), next=tb.label(tb.bucket_end(ts)))


@pytest.mark.parametrize(
    "text, floor, after",
    [
        ("2017-06-19 01:00:03", "2017-06-19_01-00", "2017-06-19_01-10"),
        ("2017-04-14 23:59:59", "2017-04-14_23-50", "2017-04-15_00-00"),
        ("2017-06-19 01:10:00", "2017-06-19_01-10", "2017-06-19_01-20"),
        ("1969-12-31 23:59:59", "1969-12-31_23-50", "1970-01-01_00-00"),
        # Unreadable text is kept in the 1970 bucket.
        ("0", "1970-01-01_00-00", "1970-01-01_00-10"),
        ("", "1970-01-01_00-00", "1970-01-01_00-10"),
        ("yesterday", "1970-01-01_00-00", "1970-01-01_00-10"),
        ("2017-06-19T01:00:03", "1970-01-01_00-00", "1970-01-01_00-10"),
        # Short numbers, trailing text and values that roll over are read.
        ("2017-6-9 1:0:3", "2017-06-09_01-00", "2017-06-09_01-10"),
        ("2017-06-19 01:10:03.5 UTC", "2017-06-19_01-10", "2017-06-19_01-20"),
        ("2017-13-01 00:00:00", "2018-01-01_00-00", "2018-01-01_00-10"),
        ("2017-02-30 00:00:00", "2017-03-02_00-00", "2017-03-02_00-10"),
        ("2017-06-19 25:61:61", "2017-06-20_02-00", "2017-06-20_02-10"),
        ("2017-00-00 00:00:00", "2016-11-30_00-00", "2016-11-30_00-10"),
        ("9500-1-1 00:00:00", "9500-01-01_00-00", "9500-01-01_00-10"),
        ("2017-06-19 00:00:0000086400", "2017-06-20_00-00", "2017-06-20_00-10"),
        ("2017-06-19 00:00:99999999", "2020-08-19_09-40", "2020-08-19_09-50"),
    ],
)
def test_ten_minute_labels(spark, text, floor, after):
    assert labels(spark, text) == {"floor": floor, "next": after}


@pytest.mark.parametrize(
    "millis, period, floor, after",
    [(0, 10, 0, 10), (9, 10, 0, 10), (10, 10, 10, 20), (-1, 10, -10, 0), (-10, 10, -10, 0)],
)
def test_millis(spark, millis, period, floor, after):
    m = F.lit(millis).cast("bigint")
    row = one(spark, floor=tb.floor_millis(m, period), next=tb.next_millis(m, period))
    assert row == {"floor": floor, "next": after}


def test_same_buckets_as_window(spark):
    times = spark.range(0, 5000).select(F.timestamp_seconds(F.col("id") * 977 - 900_000).alias("ts"))
    window = F.window("ts", "10 minutes")
    differing = times.select(
        "ts", window["start"].alias("s"), window["end"].alias("e")
    ).where((F.col("s") != tb.bucket_start(F.col("ts"))) | (F.col("e") != tb.bucket_end(F.col("ts"))))
    assert differing.count() == 0


def test_label_parts(spark):
    parts = tb.label_parts(F.lit("2017-02-12_14-20"))
    assert one(spark, **parts) == {
        "year": "2017", "month": "02", "day": "12", "hour": "14", "minute": "20",
    }
    parts = tb.label_parts(F.lit("2017-06-19_01"), "hour")
    assert one(spark, **parts)["hour"] == "01"
    assert one(spark, **parts)["minute"] == "0"


def test_label_times(spark):
    row = one(
        spark,
        hour=tb.label_time(F.lit("2017-06-19_01"), "hour").cast("string"),
        minute=tb.label_time(F.lit("2017-06-19_01-10")).cast("string"),
        wrong=tb.label_time(F.lit("2017-06-19_01_10")).cast("string"),
    )
    assert row == {"hour": "2017-06-19 01:00:00", "minute": "2017-06-19 01:10:00", "wrong": None}


def test_unknown_label_kind():
    with pytest.raises(ValueError):
        tb._format("week")
    with pytest.raises(ValueError):
        tb.label_parts(F.lit("2017"), "day")


def test_pad_two(spark):
    numbers = [0, 7, 10, 123, 2017]
    row = one(spark, **{f"n{n}": tb.pad_two(F.lit(n)) for n in numbers})
    assert list(row.values()) == ["00", "07", "10", "123", "2017"]


def test_current_time(spark):
    row = one(spark, now=tb.current_millis(), day=tb.current_day())
    assert row["now"] > 1_600_000_000_000 and len(row["day"]) == 10


@pytest.mark.parametrize(
    "text, out",
    [
        ("12017-06-19 01:00:03", True),
        ("0-1-1 00:00:00", True),
        ("9999-12-31 23:59:60", True),
        ("99999999999999999999-1-1 0:0:0", True),
        ("9999-12-31 23:59:59", False),
        ("2017-06-19 01:00:03", False),
        ("yesterday", False),
        ("", False),
    ],
)
def test_times_out_of_range(spark, text, out):
    assert one(spark, out=tb.out_of_range(F.lit(text)))["out"] is out
