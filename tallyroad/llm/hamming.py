"""Exact nearest binary codes by multi-index hashing with growing radius.

A code of ``SEGMENTS`` * ``SEGMENT_BITS`` bits is cut into segments. If two
codes differ in fewer than SEGMENTS * (s + 1) bits, some segment of theirs
differs in at most s. So round s probes, for every segment of a query, the
values at distance s, and verifies the codes it meets. After the round all
codes up to distance SEGMENTS * (s + 1) - 1 are known; a query is finished once
its k-th verified distance is not above that, or once all rows are found.

The index holds distinct codes; of each, the k smallest ids are enough for any
answer, however many rows share it. A pair is verified in one round and segment
only (its nearest segment, the first of equals), so no candidate comes twice
and none needs to be remembered. Ties in distance go to the smaller id. A query
row is itself among the rows that are searched.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyroad.llm.common import stored

SEGMENTS = 4
SEGMENT_BITS = 16


def sign_code(vector: Column) -> Column:
    """Segments of the sign code of a vector: bit b of segment s is set where
    component s * SEGMENT_BITS + b is above 0. Missing components count as not
    above 0, further ones are left out; a null vector has no code."""

    def bit(i: int) -> Column:
        return F.when(F.get(vector, F.lit(i)) > 0, 1 << (i % SEGMENT_BITS)).otherwise(0)

    segments = []
    for s in range(SEGMENTS):
        bits = [bit(s * SEGMENT_BITS + b) for b in range(SEGMENT_BITS)]
        segments.append(sum(bits[1:], bits[0]))
    return F.when(vector.isNotNull(), F.array(*segments))


def shell(distance: int) -> list[int]:
    """Masks of ``distance`` bits."""
    return [sum(1 << b for b in c) for c in itertools.combinations(range(SEGMENT_BITS), distance)]


def gaps(a: Column, b: Column) -> list[Column]:
    """Distance of two codes in each segment."""
    return [F.bit_count(F.get(a, F.lit(s)).bitwiseXOR(F.get(b, F.lit(s)))) for s in range(SEGMENTS)]


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, id, distance, rank`` of each query's k nearest rows. Both
    inputs have ``id, code`` (segments); rows without a code are left out."""
    coded = rows.where(F.col("code").isNotNull() & F.col("id").isNotNull()).select("id", "code")
    # One code may hold any share of the rows: the rank is cut to k in each
    # task before the shuffle.
    place = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    members = stored(coded.withColumn("_place", place).where(F.col("_place") <= k).drop("_place"), "members")
    total = coded.count()
    codes = stored(members.select("code").distinct(), "codes")
    index = stored(
        codes.select(F.posexplode("code").alias("segment", "value"), "code"), "index"
    )
    asked = queries.where(F.col("code").isNotNull()).select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    # Equal queries share their search.
    asked = stored(asked, "asked")
    farthest = SEGMENTS * SEGMENT_BITS
    open_ = stored(asked.select("query", F.lit(farthest).alias("bound")).distinct(), "open")
    found = None
    for distance in range(SEGMENT_BITS + 1):
        masks = F.array(*[F.lit(m) for m in shell(distance)])
        probes = open_.select("query", "bound", F.posexplode("query").alias("segment", "own")).select(
            "query", "bound", "segment", F.explode(masks).alias("mask"), "own"
        ).select("query", "bound", "segment", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
        # Their number is not seen in the size of the queries they come from.
        met = probes.hint("merge").join(index, ["segment", "value"])
        apart = gaps(F.col("query"), F.col("code"))
        least = F.least(*apart)
        first = F.array_position(F.array(*apart), least) - 1
        whole = sum(apart[1:], apart[0])
        # Ties at the bound may have smaller ids.
        own = (least == distance) & (first == F.col("segment")) & (whole <= F.col("bound"))
        hits = met.where(own).select("query", "code", whole.alias("distance"))
        new = hits.join(members, "code").select("query", "id", "distance")
        best = Window.partitionBy("query").orderBy("distance", "id")
        both = new if found is None else found.unionByName(new)
        found = stored(
            both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank"), "found"
        )
        covered = SEGMENTS * (distance + 1) - 1
        state = found.groupBy("query").agg(F.count("*").alias("n"), F.max("distance").alias("far"))
        done = state.where(((F.col("n") == k) & (F.col("far") <= covered)) | (F.col("n") >= min(k, total)) & (F.lit(total) <= k))
        bounds = state.where(F.col("n") == k).select("query", F.col("far").alias("near"))
        left = open_.join(done, "query", "left_anti").join(bounds, "query", "left")
        open_ = stored(left.select("query", F.coalesce("near", "bound").cast("int").alias("bound")), "open")
        if open_.isEmpty():
            break
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))
    return asked.join(found.withColumn("rank", rank), "query").select("query_id", "id", "distance", "rank")
