"""Change messages made from the ``events`` table.

Every event becomes one message. Number rules over ``event_id`` only vary what
a message says (its table, type, faults, micro-batch); no event is left out.

=================  =========================================================
message part       rule
=================  =========================================================
msgid              event_id
timestamp          ts to the second
table              ``other`` when event_id % 17 = 0
type               ``INSERT`` when event_id % 13 = 0, else ``UPDATE``
driver_id          user_id
adc_id             event_id % 7
status             signup 400, view 800, purchase 900, click 100, error one
                   of 450, 500, 600, 950 by event_id % 4
customer_price     floor(value)
is_del             1 when event_id % 11 = 0, else 0
complete_time      null
=================  =========================================================

The first fault rule that fits an event changes its text (``FAULTS``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyroad.functions.jsonio import write_json
from tallyroad.operators.parse import SOURCE_TABLE

# Divisor of event_id -> what is wrong with the message.
FAULTS = {
    97: "broken_text",
    101: "null_msgid",
    103: "no_values",
    107: "null_values",
    109: "null_driver",
    113: "no_driver",
    127: "empty_is_del",
    131: "no_timestamp",
    137: "null_timestamp",
    139: "text_price",
    149: "empty_adc",
    151: "blank_line",
    157: "padded",
    163: "text_data",
    167: "no_is_del",
    173: "null_type",
}

# Fault -> the pattern it replaces in the text, and by what.
EDITS = {
    "broken_text": (r"^", "["),
    "null_msgid": (r'"msgid":\d+', '"msgid":null'),
    "no_values": (r',"values":\{[^}]*\}', ""),
    "null_values": (r'"values":\{[^}]*\}', '"values":null'),
    "null_driver": (r'"driver_id":\d+', '"driver_id":null'),
    "no_driver": (r'"driver_id":\d+,', ""),
    "empty_is_del": (r'"is_del":\d+', '"is_del":""'),
    "no_timestamp": (r'"timestamp":"[^"]*",', ""),
    "null_timestamp": (r'"timestamp":"[^"]*"', '"timestamp":null'),
    "text_price": (r'"customer_price":\d+', '"customer_price":"x"'),
    "empty_adc": (r'"adc_id":\d+', '"adc_id":""'),
    "blank_line": (r"^.*$", " \t "),
    "padded": (r"^(.*)$", " \t$1\n "),
    "no_is_del": (r'"is_del":\d+,', ""),
    "null_type": (r'"type":"[A-Z]*"', '"type":null'),
}
TOPIC = "trans_event"
TOPIC_PARTITIONS = 16


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "ts", "user_id", "event_type", "value"
    )


def batch_of(batches: int) -> Column:
    """The micro-batch an event arrives in."""
    return F.col("event_id") % batches


def messages(spark: SparkSession, sf_dir: str, batches: int = 8) -> DataFrame:
    """``event_id, batch_id, topic, partition, offset, value``."""
    placed = with_texts(events(spark, sf_dir))
    return placed.select(
        "event_id",
        batch_of(batches).alias("batch_id"),
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        F.expr(f"event_id div {TOPIC_PARTITIONS}").alias("offset"),
        "value",
    )


def with_texts(ev: DataFrame) -> DataFrame:
    """Events with ``clean``, the message before any fault, and ``value``."""
    id_ = F.col("event_id")
    fault = None
    for divisor, name in FAULTS.items():
        hit = id_ % divisor == 0
        fault = F.when(hit, name) if fault is None else fault.when(hit, name)
    data = F.struct(
        F.when(id_ % 17 == 0, "other").otherwise(SOURCE_TABLE).alias("table"),
        F.when(id_ % 13 == 0, "INSERT").otherwise("UPDATE").alias("type"),
        second_text().alias("timestamp"),
        _values().alias("values"),
    )
    written = ev.withColumn("_data", write_json(data)).select(
        *[c for c in ev.columns if c != "value"],
        fault.alias("_fault"),
        "_data",
        F.concat(
            F.lit('{"msgid":'), id_.cast("string"), F.lit(',"data":'), "_data", F.lit("}")
        ).alias("clean"),
    )
    patterns = F.create_map(*[F.lit(x) for f, (find, _) in EDITS.items() for x in (f, find)])
    changes = F.create_map(*[F.lit(x) for f, (_, by) in EDITS.items() for x in (f, by)])
    quoted = F.concat(
        F.lit('{"msgid":'),
        id_.cast("string"),
        F.lit(',"data":"'),
        F.replace("_data", F.lit('"'), F.lit('\\"')),
        F.lit('"}'),
    )
    value = (
        F.when(F.col("_fault").isNull(), F.col("clean"))
        .when(F.col("_fault") == "text_data", quoted)
        .otherwise(F.regexp_replace("clean", patterns[F.col("_fault")], changes[F.col("_fault")]))
    )
    return written.withColumn("value", value).drop("_fault", "_data")


def second_text() -> Column:
    return F.substring(F.col("ts").cast("string"), 1, 19)


def _values() -> Column:
    id_ = F.col("event_id")
    kind = F.col("event_type")
    errors = F.array(*[F.lit(s) for s in (450, 500, 600, 950)])
    code = (
        F.when(kind == "signup", 400)
        .when(kind == "view", 800)
        .when(kind == "purchase", 900)
        .when(kind == "click", 100)
        .otherwise(F.get(errors, (id_ % 4).cast("int")))
    )
    return F.struct(
        F.col("user_id").alias("driver_id"),
        (id_ % 7).alias("adc_id"),
        code.alias("status"),
        F.floor("value").alias("customer_price"),
        F.when(id_ % 11 == 0, 1).otherwise(0).alias("is_del"),
        F.lit(None).cast("string").alias("complete_time"),
    )
