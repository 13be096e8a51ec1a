"""Command line of the streaming jobs, for spark-submit."""

from __future__ import annotations

import argparse
import importlib
import signal
import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyroad.operators import hourly, offsets, parse
from tallyroad.session import build_session
from tallyroad.sources import messages
from tallyroad.streaming import jobs, tables


def arguments(args: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=("metrics", "archive"))
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka servers")
    source.add_argument("--files", help="folder of message files (Parquet)")
    parser.add_argument("--topic", required=True)
    parser.add_argument("--root", required=True, help="folder of the tables or the archive")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--consumer", default="metrics")
    parser.add_argument("--start", choices=("latest", "earliest"), default="latest")
    parser.add_argument("--no-stored-offsets", action="store_true")
    parser.add_argument("--source-table", default=parse.SOURCE_TABLE)
    parser.add_argument("--archive", help="also archive raw messages here (metrics job)")
    parser.add_argument("--key-life", type=int, default=hourly.KEY_LIFE, help="seconds, 0 for ever")
    parser.add_argument("--interval", help="micro-batch interval; without it, run once")
    parser.add_argument("--max-offsets", type=int, help="most messages per batch")
    parser.add_argument("--min-partitions", type=int)
    parser.add_argument("--partitions", type=int, help="partitions of the topic, silent ones too")
    parser.add_argument(
        "--publish", help="module:function called with the session and the number of a batch"
    )
    parsed = parser.parse_args(args)
    if parsed.start == "earliest" and parsed.servers and parsed.max_offsets is None:
        parser.error("--start earliest needs --max-offsets: the first batch would be the whole topic")
    return parsed


def publisher(name: str | None) -> Callable[[SparkSession, int], None] | None:
    if name is None:
        return None
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def ledger_root(args: argparse.Namespace) -> str:
    """Where the offsets are: with the tables, or beside an archive's topics."""
    return args.root if args.job == "metrics" else f"{args.root.rstrip('/')}/_positions"


def stream(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return messages.file_stream(spark, args.files)
    start = args.start
    if not args.no_stored_offsets:
        stored = tables.positions(spark, ledger_root(args), args.topic, args.consumer)
        start = offsets.starting_offsets(stored, args.topic, start, args.partitions)
    return messages.kafka_stream(
        spark,
        servers=args.servers,
        topic=args.topic,
        starting_offsets=start,
        max_offsets_per_trigger=args.max_offsets,
        min_partitions=args.min_partitions,
    )


def start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    if args.job == "archive":
        return jobs.archive_job(
            stream(spark, args),
            args.root,
            args.topic,
            args.checkpoint,
            interval=args.interval,
            consumer=args.consumer,
            ledger_root=ledger_root(args),
        )
    return jobs.metrics_job(
        stream(spark, args),
        args.root,
        args.checkpoint,
        consumer=args.consumer,
        source_table=args.source_table,
        key_life=args.key_life or None,
        archive=(args.archive, args.topic) if args.archive else None,
        publish=publisher(args.publish),
        interval=args.interval,
    )


def run_until_stopped(query: StreamingQuery, stop: threading.Event) -> None:
    """Wait for the end of the query; once ``stop`` is set, end it between two
    batches."""
    while not query.awaitTermination(1):
        if stop.is_set():
            jobs.stop_after_batch(query)


if __name__ == "__main__":
    parsed = arguments()
    stop = threading.Event()
    query = start(build_session("tallyroad"), parsed)
    signal.signal(signal.SIGTERM, lambda *_: stop.set())
    run_until_stopped(query, stop)
