"""Helpers shared by the operators of this package.

Rules that hold for all of them: a null text counts as an empty one unless an
operator says otherwise; only the columns an operator needs are read from its
input, so further columns, whatever they are called, neither matter nor come
back; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from tallyroad.session import scratch_dir

# Rows in an Arrow batch. A batch of whole texts has to fit into a Python
# worker, also where very long documents stand together.
BATCH_ROWS = 256
# Bytes of a text whose words are held as Python objects at once.
BLOCK_BYTES = 1 << 20
# Rows that one group of a ranking window should hold.
RANK_ROWS = 50_000


def small_batches(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, lineage cut,
    and still there when executors are lost."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def byte_blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes, cut before white space
    (a word longer than ``size`` stays whole)."""
    start, n = 0, len(data)
    while n - start > size:
        cut = start + size
        ends = [p for p in (data.find(c, cut) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f")) if p >= 0]
        if not ends:
            break
        cut = min(ends)
        yield data[start:cut]
        start = cut
    yield data[start:]


def word_blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """Words (``[^\\x20\\x09-\\x0D]+``) of a UTF-8 text, block by block."""
    for block in byte_blocks(data, size):
        # bytes.split() knows exactly the six white-space bytes of the rule.
        yield block.split()
