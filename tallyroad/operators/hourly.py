"""Hourly metrics: exact distinct drivers and price totals across batches.

The state is a table of *writes*: one row per hour, site, metric and driver of
a micro-batch, with the driver's price total and the time of the write. A set
per key, its size, a counter per key and their common expiry are all
aggregations of it, so replaying a batch replaces its rows and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyroad.functions import timebucket
from tallyroad.functions.status import METRICS
from tallyroad.functions.text import strict_int
from tallyroad.operators.metrics import driver_rows, measure_columns

# Fixed value: the life of a key after its last write, in seconds.
KEY_LIFE = 24 * 3600

KEY = ("run_hour", "adc_id")


def batch_writes(rows: DataFrame, *more_keys: str) -> DataFrame:
    """The hourly writes of measure rows (``more_keys``: batch columns). Sites
    become numbers first, so the drivers of ``09`` and ``9`` are one set."""
    hourly = rows.withColumns(
        {"run_hour": timebucket.hour_of(F.col("run_ts")), "adc_id": strict_int(F.col("adc_id"))}
    )
    return driver_rows(hourly, *KEY, *more_keys)


def touched_keys(writes: DataFrame) -> DataFrame:
    """Hours and sites with any counted message, also those whose statuses
    belong to no metric."""
    return writes.select(*KEY).distinct()


def members(writes: DataFrame) -> DataFrame:
    """The set of each key: distinct drivers by metric."""
    return writes.where(F.col("metric").isNotNull()).select(*KEY, "metric", "driver_id").distinct()


def new_members(existing: DataFrame, writes: DataFrame) -> DataFrame:
    """Members of ``writes`` that are not in ``existing`` yet. The join is on
    the driver too, so a hot hour and site spreads over its drivers."""
    return members(writes).join(existing, [*KEY, "metric", "driver_id"], "left_anti")


def counters(writes: DataFrame) -> DataFrame:
    """Price total per key; keys without a priced message have no row."""
    return (
        writes.where(F.col("price").isNotNull()).groupBy(*KEY).agg(F.sum("price").alias("event_price"))
    )


def hourly(writes: DataFrame) -> DataFrame:
    """Four driver counts (long) and the price total of every key, NULL when
    the hour has no priced message. Keys never expire."""
    per_driver = driver_rows(writes, *KEY)
    return per_driver.groupBy(*KEY).agg(*measure_columns(F.lit(None).cast("bigint")))


def hourly_with_expiry(writes: DataFrame, as_of: Column, life: int = KEY_LIFE) -> DataFrame:
    """As :func:`hourly`, when a key is forgotten ``life`` seconds after its
    last write. Each write renews the whole key. ``as_of`` is the reading time
    and may depend on ``run_hour`` and ``adc_id``.

    1. Per driver, mark the last write. Its window holds one driver's writes
       to one key, at most one per micro-batch.
    2. Per metric and write time, count the drivers last seen then and add up
       the prices: a time line of at most one row per micro-batch.
    3. A gap longer than the life starts a new generation; the key holds its
       newest one, provided that is still alive. A driver belongs to it
       exactly when its last write does.
    """
    per_driver = Window.partitionBy(*KEY, "metric", "driver_id").orderBy("written_at")
    line = (
        writes.withColumn("is_last", F.lead("written_at").over(per_driver).isNull())
        .groupBy(*KEY, "metric", "written_at")
        .agg(F.count_if("is_last").alias("drivers"), F.sum("price").alias("price"))
    )
    newest_first = Window.partitionBy(*KEY, "metric").orderBy(F.desc("written_at"))
    written = F.unix_seconds("written_at")
    alive = (
        line.withColumn("gap", F.lag(written).over(newest_first) - written)
        # Gaps too long between here and the newest write: none within the
        # newest generation.
        .withColumn("ended", F.count_if(F.col("gap") > life).over(newest_first))
        .withColumn("newest", F.first(written).over(newest_first))
        .withColumn("fresh", F.unix_seconds(as_of) - F.col("newest") <= life)
    )
    live = F.col("fresh") & (F.col("ended") == 0)
    counts = [
        F.coalesce(F.sum(F.when(live & (F.col("metric") == m), F.col("drivers"))), F.lit(0)).alias(m)
        for m in METRICS
    ]
    return alive.groupBy(*KEY).agg(*counts, F.sum(F.when(live, F.col("price"))).alias("event_price"))


# State of a set and its price total, one row per hour, site and metric. ``gen``
# is the batch that started it, ``since`` that batch's time.
STATE_KEY = (*KEY, "metric")
STATE_SCHEMA = (
    "run_hour TIMESTAMP, adc_id INT, metric STRING, gen BIGINT, since TIMESTAMP, "
    "last_write TIMESTAMP, drivers BIGINT, price BIGINT"
)
MEMBER_SCHEMA = "run_hour TIMESTAMP, adc_id INT, metric STRING, driver_id STRING, gen BIGINT, bucket INT"
BUCKETS = 256


def driver_bucket(driver: str = "driver_id") -> Column:
    return F.pmod(F.xxhash64(driver), F.lit(BUCKETS)).cast("int")


def alive(state: DataFrame, now: Column, life: int | None) -> DataFrame:
    """State whose key has not expired at ``now``."""
    if life is None:
        return state
    return state.where(F.unix_seconds(now) - F.unix_seconds("last_write") <= life)


def marked_writes(
    writes: DataFrame, state: DataFrame, members: DataFrame, now: Column, life: int | None, seq: int
) -> DataFrame:
    """The writes that belong to a set, with the generation they fall into and
    whether the driver is ``new`` there. An expired set starts over: its
    members have an older generation and are not met."""
    current = alive(state, now, life).select(*STATE_KEY, "gen")
    placed = writes.where(F.col("metric").isNotNull()).join(current, list(STATE_KEY), "left")
    placed = placed.withColumn("gen", F.coalesce("gen", F.lit(seq).cast("bigint")))
    member = [*STATE_KEY, "driver_id", "gen"]
    known = members.select(*member, F.lit(True).alias("_known"))
    return placed.join(known, member, "left").select(
        *member, "price", F.col("_known").isNull().alias("new")
    )


def next_members(marked: DataFrame) -> DataFrame:
    return marked.where("new").select(*STATE_KEY, "driver_id", "gen", driver_bucket().alias("bucket"))


def next_state(marked: DataFrame, state: DataFrame, now: Column, life: int | None) -> DataFrame:
    """The state after a batch: counts and totals grow by what the batch adds,
    every key it wrote lives on from ``now``, expired ones are left out."""
    added = marked.groupBy(*STATE_KEY).agg(
        F.max("gen").alias("_gen"), F.count_if("new").alias("_drivers"), F.sum("price").alias("_price")
    )
    both = alive(state, now, life).join(added, list(STATE_KEY), "full")
    hit = F.col("_gen").isNotNull()
    price = F.when(F.col("price").isNull() | F.col("_price").isNull(), F.coalesce("price", "_price"))
    return both.select(
        *STATE_KEY,
        F.coalesce("gen", "_gen").alias("gen"),
        F.coalesce("since", now).alias("since"),
        F.when(hit, F.greatest("last_write", now)).otherwise(F.col("last_write")).alias("last_write"),
        (F.coalesce("drivers", F.lit(0)) + F.coalesce("_drivers", F.lit(0))).cast("bigint").alias("drivers"),
        price.otherwise(F.col("price") + F.col("_price")).alias("price"),
    )


def hourly_of_state(state: DataFrame, keys: DataFrame) -> DataFrame:
    """Hourly rows of the given hours and sites, as :func:`hourly` has them."""
    counts = [
        F.coalesce(F.sum(F.when(F.col("metric") == m, F.col("drivers"))), F.lit(0)).cast("bigint").alias(m)
        for m in METRICS
    ]
    return keys.join(state, list(KEY), "left").groupBy(*KEY).agg(*counts, F.sum("price").alias("event_price"))


def stored_rows(metrics: DataFrame) -> DataFrame:
    """The stored form: the hour is called ``run_time``."""
    return metrics.withColumnRenamed("run_hour", "run_time")
