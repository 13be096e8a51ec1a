import json

from pyspark.sql import functions as F

from tallyroad.operators import offsets
from tallyroad.sources import messages


def ledger(spark, *rows):
    return spark.createDataFrame(list(rows), offsets.LEDGER_SCHEMA)


def test_resume_takes_the_newest_batch(spark):
    log = ledger(spark, ("t", "c", 0, 10, 1), ("t", "c", 0, 7, 2), ("t", "c", 1, 2**40, 1),
                 ("t", "d", 0, 99, 9), ("u", "c", 0, 1, 1), ("t", "c", -1, 5, 3), ("t", "c", 2, -1, 3))
    got = offsets.resume(log, "t", "c").orderBy("partition").collect()
    assert [tuple(r) for r in got] == [("t", 0, 7), ("t", 1, 2**40)]
    assert offsets.resume(log, "t").where("partition = 0").first()["offset"] == 99


def test_starting_offsets(spark):
    log = ledger(spark, ("t", "c", 0, 11, 1), ("t", "c", 1, 20, 1))
    positions = offsets.resume(log, "t", "c")
    assert json.loads(offsets.starting_offsets(positions, "t")) == {"t": {"0": 11, "1": 20}}
    assert offsets.starting_offsets(positions, "u", "earliest") == "earliest"


def test_node_text(spark):
    log = ledger(spark, ("t", "c", 10, 1, 1), ("t", "c", 0, 11, 1), ("t", "c", 1, 20, 1))
    node = offsets.node_text(offsets.resume(log, "t", "c"), "topic")
    assert node.first()["offsets"] == "0:11,1:20,10:1"
    back = offsets.node_positions(node).orderBy("partition").collect()
    assert [tuple(r) for r in back] == [("t", 0, 11), ("t", 1, 20), ("t", 10, 1)]


def test_unreadable_node_counts_as_missing(spark):
    nodes = spark.createDataFrame([("t", "0:1,x"), ("u", ""), ("v", None)], "topic string, offsets string")
    assert offsets.node_positions(nodes).count() == 0


def test_ranges(spark):
    rows = spark.createDataFrame([("t", 0, o) for o in (3, 4, 9)], "topic string, partition int, offset long")
    assert tuple(offsets.ranges(rows).first()) == ("t", 0, 3, 9, 10)
    assert tuple(offsets.ledger_rows(rows, "c", F.lit(7)).first()) == ("t", "c", 0, 10, 7)


def test_kafka_options():
    assert messages.kafka_options("h:1", "t", '{"t":{"0":5}}', 100, 8) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": '{"t":{"0":5}}',
        "maxOffsetsPerTrigger": "100",
        "minPartitions": "8",
    }


def test_message_columns(spark):
    raw = spark.createDataFrame(
        [("t", 0, 1, bytearray(b"{}"), None)],
        "topic string, partition int, offset long, value binary, key binary",
    )
    assert tuple(messages.message_columns(raw).first()) == ("t", 0, 1, "{}")
