"""Balanced shards by longest-processing-time scheduling.

Rows with equal texts form a group that stays together. Groups go, largest
first, to the shard with the least bytes, taken from a heap. Only a histogram
of group sizes passes through the driver: sizes up to 4096 bytes are classes of
their own, larger ones keep 12 bits after the leading one, so there are at most
about 200,000 classes for any input. Groups of one class are dealt in one go.
Which group of a class goes where is decided on the executors, by ranks that
have no gaps.

The law that holds is ``bytes``: shard totals are near equal. A null text
counts as 0 bytes, and all null texts form one group. Repeated ids are separate
rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyroad.llm.common import RANK_ROWS, stored

ROW_BYTES = 8
CLASS_BITS = 12


def size_class(weight: Column) -> Column:
    """``weight`` without the bits after the 13th from its leading one."""
    drop = F.greatest(F.length(F.bin(weight)) - (CLASS_BITS + 1), F.lit(0))
    power = F.pow(F.lit(2.0), drop).cast("bigint")
    return (F.floor(weight / power) * power).cast("bigint")


def deal(classes: Iterable[tuple[int, int, int]], shards: int) -> list[tuple[int, list[int], list[int]]]:
    """Greedy scheduling of ``(class, groups, bytes)``, largest class first.

    Gives ``(class, ends, shards)``: groups ranked below ``ends[0]`` go to
    ``shards[0]``, those below ``ends[1]`` to ``shards[1]``, and so on.
    """
    heap = [(0.0, s) for s in range(shards)]
    out = []
    for size, n, total in sorted(classes, reverse=True):
        each = total / n
        taken: dict[int, int] = {}
        if n > 4 * shards:
            heap, taken = fill(heap, n, each)
        for _ in range(n - sum(taken.values())):
            load, s = heap[0]
            heapq.heapreplace(heap, (load + each, s))
            taken[s] = taken.get(s, 0) + 1
        ends, at = [], 0
        for s in sorted(taken):
            at += taken[s]
            ends.append(at)
        out.append((size, ends, sorted(taken)))
    return out


def fill(heap: list[tuple[float, int]], n: int, each: float) -> tuple[list[tuple[float, int]], dict[int, int]]:
    """What the heap would surely give out of ``n`` equal groups, at once: up
    to one group under the level at which all would be even."""
    loads = sorted(heap)
    below, rest = 0.0, n * each
    level = 0.0
    for i, (load, _) in enumerate(loads):
        below += load
        level = (below + rest) / (i + 1)
        if i + 1 == len(loads) or level <= loads[i + 1][0]:
            break
    taken = {s: max(0, int((level - load) / each) - 1) for load, s in loads if level > load}
    taken = {s: q for s, q in taken.items() if q}
    filled = [(load + taken.get(s, 0) * each, s) for load, s in loads]
    heapq.heapify(filled)
    return filled, taken


def ranked(df: DataFrame, group: str, by: str, total: int, name: str) -> DataFrame:
    """``df`` with ``name``, a rank from 0 without gaps in each ``group``.

    A group may hold any share of the rows: it is dealt into buckets by a hash
    of the unique column ``by``, ranked there, and shifted by the sizes of the
    buckets before."""
    buckets = 1 + total // RANK_ROWS
    spread = df.withColumn("_bucket", F.pmod(F.xxhash64(by), F.lit(buckets)))
    sizes = spread.groupBy(group, "_bucket").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(group, "_bucket", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(by))
    return (
        spread.withColumn("_inside", inside)
        .join(shifts, [group, "_bucket"])
        .withColumn(name, F.col("_inside") - 1 + F.col("_shift"))
        .drop("_bucket", "_inside", "_shift")
    )


def assign(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, size, text_crc32, shard, slot`` of every row."""
    text = F.col(text_col)
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
            # Texts that share a digest are kept together too, which is allowed.
            F.coalesce(F.md5(text.cast("binary")), F.lit("null")).alias("same"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("same").agg(F.sum("size").alias("weight"), F.count("*").alias("rows"))
    groups = stored(groups.withColumn("class", size_class(F.col("weight"))), "shard-groups")
    histogram = groups.groupBy("class").agg(F.count("*").alias("n"), F.sum("weight"), F.sum("rows")).collect()
    total_groups = sum(r[1] for r in histogram)
    total_rows = sum(r[3] for r in histogram)
    dealt = deal([(r[0], r[1], r[2]) for r in histogram], shards)
    plan = docs.sparkSession.createDataFrame(
        pd.DataFrame(dealt, columns=["class", "ends", "to"]), "class bigint, ends array<bigint>, to array<int>"
    )
    placed = (
        ranked(groups.select("same", "class"), "class", "same", total_groups, "rank")
        .join(plan, "class")
        .withColumn("step", F.size(F.filter("ends", lambda end: end <= F.col("rank"))))
        .select("same", F.get("to", F.col("step")).alias("shard"))
    )
    sharded = rows.join(placed, "same").select("id", "size", "crc", "row", "shard")
    return ranked(stored(sharded, "sharded"), "shard", "row", total_rows, "slot").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", "slot"
    )
