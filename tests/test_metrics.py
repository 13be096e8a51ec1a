import random

from pyspark.sql import functions as F

from tallyroad.functions import status, timebucket as tb
from tallyroad.operators import metrics, parse
from tallyroad.sources import messages
from test_parse import message

SCHEMA = "run_ts timestamp, adc_id string, metric string, driver_id string, price int"


def rows(spark, texts, width=tb.TEN_MINUTES):
    return parse.counted(parse.classify(messages.from_memory(spark, texts)), width)


def table(df):
    return {(r["run_time"], r["adc_id"]): r for r in metrics.labelled(df).collect()}


def test_four_messages(spark):
    texts = [
        message({"driver_id": 2269128, "adc_id": 9, "status": s, "customer_price": p})
        for s, p in ((400, 1), (800, 2), (900, 3), (400, 4))
    ]
    joined = messages.split_texts(messages.from_memory(spark, ["@".join(texts)]))
    result = table(metrics.ten_minute(parse.counted(parse.classify(joined))))
    row = result.pop(("2017-06-19_01-00", "9"))
    assert not result
    assert [row[m] for m in metrics.MEASURES] == [1, 1, 0, 1, 3]
    assert {f.dataType.simpleString() for f in metrics.ten_minute(rows(spark, texts)).schema[2:]} == {"bigint"}


def test_status_without_metric_gives_zeros(spark):
    row = table(metrics.ten_minute(rows(spark, [message({"status": 100})])))[("2017-06-19_01-00", "9")]
    assert [row[m] for m in metrics.MEASURES] == [0, 0, 0, 0, 0]


def test_empty_driver_counts_once(spark):
    texts = [message({"driver_id": None}), message({"driver_id": ""}), message({"driver_id": 5})]
    row = table(metrics.ten_minute(rows(spark, texts)))[("2017-06-19_01-00", "9")]
    assert row["sign_driver"] == 2


def test_four_statuses_share_a_metric(spark):
    texts = [message({"status": s}) for s in (450, 500, 600, 950)]
    row = table(metrics.ten_minute(rows(spark, texts)))[("2017-06-19_01-00", "9")]
    assert row["exception_driver"] == 1


def test_every_status(spark):
    codes = [*status.STATUS_METRIC, "100", "0", "", "4000"]
    df = spark.createDataFrame([(c,) for c in codes], "s string")
    got = [r[0] for r in df.select(status.metric_of(F.col("s"))).collect()]
    assert got == [status.STATUS_METRIC.get(c) for c in codes]


def random_rows(spark, seed, n=3000):
    """A third of all rows share one bucket and site."""
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        hot = rng.random() < 0.34
        second = 0 if hot else 600 * rng.randrange(20)
        metric = rng.choice([*status.METRICS, None])
        price = rng.randrange(-5, 100) if metric == status.PRICED_METRIC else None
        driver = None if metric is None else str(rng.randrange(40))
        data.append((second, "1" if hot else str(rng.randrange(4)), metric, driver, price, rng.randrange(5)))
    df = spark.createDataFrame(
        data, "s long, adc_id string, metric string, driver_id string, price int, batch_id int"
    )
    return df.withColumn("run_ts", F.timestamp_seconds("s")).drop("s")


def test_equals_count_distinct(spark):
    df = random_rows(spark, 1)
    plain = df.groupBy("run_ts", "adc_id").agg(
        *[F.count_distinct(F.when(F.col("metric") == m, F.col("driver_id"))).cast("int").alias(m)
          for m in status.METRICS],
        F.coalesce(F.sum("price"), F.lit(0)).cast("int").alias("event_price"),
    )
    for ours in (metrics.ten_minute(df), metrics.ten_minute_sql(df)):
        assert ours.exceptAll(plain).count() == plain.exceptAll(ours).count() == 0


def test_additive_counts_a_driver_once_per_batch(spark):
    texts = [message(), message()]
    two = rows(spark, texts).withColumn("batch_id", F.monotonically_increasing_id())
    merged = metrics.merge_partials(metrics.partials(two, "batch_id")).first()
    assert merged["sign_driver"] == 2
    assert metrics.ten_minute(two).first()["sign_driver"] == 1


def test_batch_order_does_not_matter(spark):
    df = random_rows(spark, 2)
    parts = metrics.partials(df, "batch_id")
    turned = metrics.partials(df.withColumn("batch_id", 4 - F.col("batch_id")), "batch_id")
    a, b = metrics.merge_partials(parts), metrics.merge_partials(turned)
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_spellings_of_a_site_meet_in_the_stored_table(spark):
    two = rows(spark, [message({"adc_id": "09"}), message({"adc_id": "9"})])
    assert metrics.ten_minute(two).count() == 2
    stored = metrics.merge_partials(metrics.partials(two.withColumn("b", F.lit(0)), "b")).collect()
    assert [(r["adc_id"], r["sign_driver"]) for r in stored] == [(9, 2)]


def test_totals_are_64_bit(spark):
    big = [message({"status": 900, "driver_id": d, "customer_price": 2**33 - 1}) for d in (1, 2, 3)]
    df = rows(spark, big)
    for total in (metrics.ten_minute(df), metrics.ten_minute_sql(df)):
        assert total.first()["event_price"] == 3 * (2**33 - 1)
        assert dict(total.dtypes)["event_price"] == dict(total.dtypes)["sign_driver"] == "bigint"
    merged = metrics.merge_partials(metrics.partials(df.withColumn("b", F.lit(0)), "b"))
    assert merged.first()["event_price"] == 3 * (2**33 - 1)


def test_load_times(spark):
    row = metrics.stamped(metrics.ten_minute(rows(spark, [message()]))).first()
    assert row["created_at"] == row["updated_at"] is not None
