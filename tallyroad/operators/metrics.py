"""Ten-minute metrics: distinct drivers per metric and a price total.

Input rows are ``run_ts, adc_id, metric, driver_id, price`` (see
``operators.parse.counted``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyroad.functions import timebucket
from tallyroad.functions.status import METRICS
from tallyroad.functions.text import strict_int

MEASURES = (*METRICS, "event_price")


def driver_rows(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per key, metric and driver, with the driver's price total.

    A status belongs to one metric, so every distinct count below is a plain
    count of these rows: no row is copied once per metric, and a hot key is
    spread over its drivers before it meets in one task. A driver repeated in
    a hot key collapses before the shuffle."""
    return rows.groupBy(*keys, "metric", "driver_id").agg(F.sum("price").alias("price"))


def measure_columns(price_if_none: Column) -> list[Column]:
    """Aggregates over ``driver_rows``; sums of long values."""
    counts = [F.count_if(F.col("metric") == metric).alias(metric) for metric in METRICS]
    return [*counts, F.coalesce(F.sum("price"), price_if_none).alias("event_price")]


def ten_minute(rows: DataFrame) -> DataFrame:
    """``run_ts, adc_id`` and the five measures as long. Sites group by their
    text; statuses without a metric give rows of zeros."""
    per_driver = driver_rows(rows, "run_ts", "adc_id")
    return per_driver.groupBy("run_ts", "adc_id").agg(*measure_columns(F.lit(0)))


def labelled(metrics: DataFrame) -> DataFrame:
    """The stored form: a text label of the bucket next to its time."""
    return metrics.select(timebucket.label(F.col("run_ts")).alias("run_time"), "*")


def stamped(metrics: DataFrame) -> DataFrame:
    """Add the load times."""
    now = F.current_timestamp()
    return metrics.withColumns({"created_at": now, "updated_at": now})


# The same query in SQL text over a view of parsed records.
TEN_MINUTE_SQL = """
    WITH per_driver AS (
        SELECT run_ts, adc_id, metric, driver_id, sum(price) AS price
        FROM {rows}
        GROUP BY run_ts, adc_id, metric, driver_id
    )
    SELECT run_ts,
           adc_id,
           count_if(metric = 'sign_driver') AS sign_driver,
           count_if(metric = 'run_driver') AS run_driver,
           count_if(metric = 'exception_driver') AS exception_driver,
           count_if(metric = 'complete_driver') AS complete_driver,
           coalesce(sum(price), 0) AS event_price
    FROM per_driver
    GROUP BY run_ts, adc_id
"""


def ten_minute_sql(rows: DataFrame) -> DataFrame:
    return rows.sparkSession.sql(TEN_MINUTE_SQL, rows=rows)


def partials(rows: DataFrame, batch_col: str) -> DataFrame:
    """Ten-minute metrics of each micro-batch on its own; measures as long."""
    keys = (batch_col, "run_ts", "adc_id")
    return driver_rows(rows, *keys).groupBy(*keys).agg(*measure_columns(F.lit(0)))


def merge_partials(parts: DataFrame) -> DataFrame:
    """Sum partial results over batches. A driver seen in two batches of a
    bucket counts twice: this table is additive, the hourly one is exact.
    Sites become numbers here, so ``09`` and ``9`` meet."""
    return (
        parts.withColumn("adc_id", strict_int(F.col("adc_id").cast("string")))
        .groupBy("run_ts", "adc_id")
        .agg(*[F.sum(m).alias(m) for m in MEASURES])
    )
