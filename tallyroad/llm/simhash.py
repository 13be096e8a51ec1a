"""SimHash near-duplicates by meeting in the middle.

Two 64-bit fingerprints that differ in at most 2 bits both lie within 1 bit of
a third value. So every distinct fingerprint emits the 65 values of its ball of
half the radius, and a shuffle by value brings linked fingerprints together. A
value's own ball has 65 points, which bounds every group however many documents
there are: copies collapse to one fingerprint before the shuffle. Groups are
never expanded into all pairs: neighbours in a sorted group are linked, and a
chain is enough for the components.

Null and empty texts have fingerprint zero and link like any other. Ids may be
null or repeated; a component's id is its smallest id that is not null.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyroad.llm import graph
from tallyroad.llm.common import fresh, stored, word_blocks
from tallyroad.llm.places import Scratch

BITS = 64
SEED = 42


def hash_blocks(text: str | None, words: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles, in blocks. Shingles are runs of ``words`` words
    of the text in ASCII lower case, repeats included; a shorter text is one
    shingle, a text without words has none."""
    digest = xxhash.xxh64_intdigest
    carry: list[bytes] = []
    any_run = False
    for block in word_blocks((text or "").encode().lower()):
        block = carry + block
        runs = zip(*(itertools.islice(block, i, None) for i in range(words)))
        hashes = np.array([digest(b" ".join(r), SEED) for r in runs], dtype=np.uint64)
        if len(hashes):
            any_run = True
            yield hashes
        carry = block[-(words - 1) :] if words > 1 else []
    if not any_run and carry:
        yield np.array([digest(b" ".join(carry), SEED)], dtype=np.uint64)


def text_fingerprint(text: str | None, words: int) -> int:
    bits = np.zeros(BITS, dtype=np.int64)
    total = 0
    for hashes in hash_blocks(text, words):
        total += len(hashes)
        for part in np.array_split(hashes, 1 + len(hashes) // 4096):
            raw = part.astype(">u8").view(np.uint8).reshape(-1, 8)
            bits += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    # A bit is 1 if it is set in over half of the hashes.
    return int.from_bytes(np.packbits(bits * 2 > total).tobytes(), "big")


def fingerprint(text: Column, words: int = 3) -> Column:
    """The fingerprint as a signed 64-bit column."""

    @F.pandas_udf("bigint")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            values = np.array([text_fingerprint(t, words) for t in texts], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))

    return of(text)


def ball(bits: int) -> list[int]:
    """Masks of all values within ``bits`` flips, as signed numbers."""
    masks = [
        sum(1 << b for b in chosen) for n in range(bits + 1) for chosen in itertools.combinations(range(BITS), n)
    ]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]


def links(fingerprints: DataFrame, radius: int = 2) -> DataFrame:
    """``a, b``: distinct pairs a > b of the values in the only column of
    ``fingerprints`` that chain up every pair within ``radius``, which has to
    be even. Every link is itself within it.

    All points of a value's ball of half the radius are within ``radius`` of
    each other, so consecutive ones are; the distance is still checked."""
    if radius % 2:
        raise ValueError("radius has to be even")
    masks = F.array(*[F.lit(m) for m in ball(radius // 2)])
    fp = F.col(fingerprints.columns[0])
    emitted = (
        fingerprints.where(fp.isNotNull())
        .select(fp.alias("fp"))
        .distinct()
        .select("fp", F.explode(masks).alias("mask"))
        .select(F.col("fp").bitwiseXOR(F.col("mask")).alias("value"), "fp")
    )
    before = F.lag("fp").over(Window.partitionBy("value").orderBy("fp"))
    met = emitted.select(F.col("fp").alias("a"), before.alias("b")).where(F.col("b").isNotNull())
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    return met.where(near).distinct()


def roots(fingerprints: DataFrame, radius: int = 2) -> DataFrame:
    """``fp, root`` for every fingerprint that has a link: one root for each
    connected component."""
    return graph.components(links(fingerprints, radius), "a", "b").select(
        F.col("node").alias("fp"), F.col("component").alias("root")
    )


def components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """``id_col, fingerprint`` (signed 64 bits) and ``component_id`` of every
    input row."""
    rows = stored(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), words).alias("fp")), "simhash")
    lowest = rows.groupBy("fp").agg(F.min("id").alias("id"))
    linked = roots(lowest.select("fp"), radius)
    rooted = lowest.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    members = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return rows.join(members, "fp").select(
        F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component_id"
    )


def hex_text(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """The input's rows and columns, one row of each component: the one with
    the smallest id (nulls last; of rows with equal ids, the one whose text has
    the smallest hash). Which rows go is decided on ids and fingerprints alone,
    so that whole rows are shuffled once at most."""
    scratch = Scratch(docs.sparkSession)
    fp, row = (fresh(docs, name) for name in ("fp", "row"))
    # A copy of the rows: only in a table do they have numbers that stay.
    marked = scratch.keep(
        docs.select("*", fingerprint(F.col(text_col), words).alias(fp), F.monotonically_increasing_id().alias(row)), "marked"
    )
    linked = roots(marked.select(fp), radius)
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.xxhash64(text_col), F.col(row).alias("row"))
    # Copies meet in one row per fingerprint before anything is joined.
    first = marked.groupBy(F.col(fp).alias("fp")).agg(F.min(order).alias("order"))
    rooted = first.join(linked, "fp", "left").select("order", F.coalesce("root", "fp").alias("root"))
    kept = rooted.groupBy("root").agg(F.min("order").alias("order")).select(F.col("order.row").alias(row))
    # As a table, its size is known before the rows are joined with it.
    gone = scratch.keep(marked.select(row).join(kept, row, "left_anti"), "gone")
    return marked.join(gone, row, "left_anti").select([F.col(f"`{c}`") for c in docs.columns])
