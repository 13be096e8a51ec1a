"""What the physical plans must and must not contain."""

import re

import pytest

from tallyroad.operators import parse
from tallyroad.plans import feed, queries

SF_DIR = "/root/testdata/sf0.001"
WRITING = {"archive_roundtrip", "archive_positions", "merged_text"} | {n for n in queries.all_queries() if n.startswith("stream_")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {
        name: plan(build(spark, SF_DIR))
        for name, build in queries.all_queries().items()
        if name not in WRITING
    }


def test_no_pair_products_or_python(plans):
    for name, text in plans.items():
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "Python", "Pandas"):
            assert bad not in text, (name, bad)


def test_no_single_partition(plans):
    # A count of everything ends in one task, on one partial row per task.
    for name, text in plans.items():
        assert ("SinglePartition" in text) == (name == "record_count"), name


def test_scans_read_only_used_columns(plans):
    assert "props" not in "".join(re.findall(r"ReadSchema: .*", "".join(plans.values())))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plans["offset_resume"]).group(1)
    assert schema == "event_id:bigint"


def test_text_is_parsed_once(plans):
    text = plans["ten_minute_metrics"]
    assert len(re.findall(r"from_json\(StructField\(msgid", text)) == 1
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("FileScan") == 1


def test_aggregations_combine_before_the_shuffle(plans):
    for name in ("ten_minute_metrics", "hourly_metrics", "cells_latest", "offset_resume"):
        for exchange in re.findall(r"Exchange hashpartitioning.*\n(.*)", plans[name]):
            assert re.search(r"Aggregate\(.*partial_|Aggregate\(keys=.*functions=\[\]", exchange), exchange


def test_rank_is_cut_before_the_shuffle(plans):
    assert plans["cells_versions"].count("WindowGroupLimit") == 2


def test_generated_code_stays_small(spark):
    """Methods over 8,000 bytes are not compiled by the JVM."""
    counted = parse.counted(parse.classify(feed.messages(spark, SF_DIR)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code = counted.groupBy("adc_id").count()
        text = code._sc._jvm.PythonSQLUtils.explainString(code._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(s) for s in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000
