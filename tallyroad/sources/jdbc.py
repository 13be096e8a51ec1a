"""Relational tables through Spark's JDBC source and sink.

Credentials come in as options. Queries of a batch run as joins over whole
tables (``operators.upsert``) and are written back in bulk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import islice

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tallyroad.operators.upsert import insert_columns

BATCH_ROWS = 1000


def read_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Rows of a query; no rows give an empty DataFrame."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int | None = None,
    **options: str,
) -> DataFrame:
    """A table, read in ``parts`` ranges of ``split_column`` when given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split_column is not None:
        low, high = bounds
        reader = reader.options(
            partitionColumn=split_column, lowerBound=low, upperBound=high, numPartitions=parts
        )
    return reader.load()


def read_offsets(spark: SparkSession, url: str, table: str, topic: str, **options: str) -> DataFrame:
    """Stored offsets of a topic; the consumer is not looked at and rows with
    -1 are skipped. The filters run in the database."""
    rows = read_table(spark, url, table, **options)
    return rows.where(
        (F.col("topic") == topic) & (F.col("partition") != -1) & (F.col("offset") != -1)
    ).select(
        "topic",
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
    )


def append(df: DataFrame, url: str, table: str, nullable: Sequence[str] = (), **options: str) -> None:
    """Insert rows. A row's null ``nullable`` columns are left out of its
    insert, so that the table's defaults apply."""

    def write(part: DataFrame) -> None:
        part.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()

    write_by_nulls(df, nullable, write)


def write_by_nulls(
    df: DataFrame, nullable: Sequence[str], write: Callable[[DataFrame], None]
) -> None:
    """Hand the rows to ``write`` once per set of missing ``nullable`` columns
    that occurs, without those columns. The rows are computed once."""
    if not nullable:
        write(df)
        return
    rows = df.withColumn("_named", insert_columns(nullable)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # At most as many as the columns have subsets.
        patterns = sorted(r[0] for r in rows.select("_named").distinct().collect())
        for pattern in patterns:
            missing = [c for c in nullable if c not in pattern.split(",")]
            write(rows.where(F.col("_named") == pattern).drop("_named", *missing))
    finally:
        rows.unpersist()


def replace_rows(
    df: DataFrame,
    connect: Callable[[], object],
    url: str,
    table: str,
    staging: str,
    keys: Sequence[str],
    **options: str,
) -> None:
    """Put ``df`` in the place of the rows with its keys. The rows are loaded
    into the table ``staging`` first; the swap is one transaction, so readers
    see the old rows or the new ones, and a failure before it changes nothing."""
    loader = df.write.format("jdbc").options(url=url, dbtable=staging, **options)
    loader.mode("overwrite").save()
    connection = connect()
    try:
        cursor = connection.cursor()
        for statement in swap_statements(table, staging, keys, df.columns):
            cursor.execute(statement)
        connection.commit()
    finally:
        connection.close()


def swap_statements(
    table: str, staging: str, keys: Sequence[str], columns: Sequence[str]
) -> list[str]:
    same = " AND ".join(f"{staging}.{k} = {table}.{k}" for k in keys)
    names = ", ".join(columns)
    return [
        f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} WHERE {same})",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}",
    ]


def delete_statement(table: str, keys: Sequence[str]) -> str:
    return f"DELETE FROM {table} WHERE " + " AND ".join(f"{k} = ?" for k in keys)


def update_statement(table: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """Sets whole values. Additive results are summed in Spark from per-batch
    partials and sent as totals, so a repeated task changes nothing."""
    sets = ", ".join(f"{c} = ?" for c in columns)
    return f"UPDATE {table} SET {sets} WHERE " + " AND ".join(f"{k} = ?" for k in keys)


def run_statement(
    df: DataFrame,
    connect: Callable[[], object],
    statement: str,
    parameters: Sequence[str],
    batch_rows: int = BATCH_ROWS,
) -> None:
    """Run a parameterised update or delete for every row, in batches: one
    DB-API connection per partition, made there by ``connect``."""
    names = list(parameters)
    df.select(*names).foreachPartition(
        lambda rows: execute_rows(rows, connect, statement, names, batch_rows)
    )


def execute_rows(
    rows: Iterable[Row],
    connect: Callable[[], object],
    statement: str,
    names: Sequence[str],
    batch_rows: int = BATCH_ROWS,
) -> None:
    rows = iter(rows)
    batch = list(islice(rows, batch_rows))
    if not batch:
        return
    connection = connect()
    try:
        cursor = connection.cursor()
        while batch:
            cursor.executemany(statement, [tuple(r[n] for n in names) for r in batch])
            connection.commit()
            batch = list(islice(rows, batch_rows))
    finally:
        connection.close()
