"""The tables of the metrics job: Parquet parts that a log of commits names.

A batch writes a part per table and slot (a day, where rows have one), and
commits all of them at once (see ``manifest``). Readers build their paths from
the log, so they list the folders of the slots they want and see whole batches.

=============  ====  =========================================================
ten_minute     day   partial sums, added on read and when parts are merged
hourly         day   the current rows, one per hour and site: a batch rewrites
                     the days it touches
hour_state     day   sets and totals that are alive, rewritten likewise
members        day   drivers of the sets; a batch adds new ones only
hour_writes    day   the writes themselves, to check and rebuild the state by
ranges         day   offsets each batch went through, by day of the batch
quarantine     -     rejected lines
=============  ====  =========================================================
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyroad.operators import hourly as hours, metrics
from tallyroad.streaming.manifest import GRACE, Commit, Folder, Log, Part, State

_COUNTS = ", ".join(f"{m} BIGINT" for m in metrics.MEASURES)

# Columns in the files, and the folder columns.
SCHEMAS = {
    "ten_minute": f"run_ts TIMESTAMP, adc_id STRING, {_COUNTS}, batch_seq BIGINT, run_day DATE",
    "hour_writes": (
        "run_hour TIMESTAMP, adc_id INT, metric STRING, driver_id STRING, price BIGINT, "
        "written_at TIMESTAMP, batch_seq BIGINT, run_day DATE"
    ),
    "hourly": (
        f"run_time TIMESTAMP, adc_id INT, {_COUNTS}, created_at TIMESTAMP, "
        "updated_at TIMESTAMP, changed_seq BIGINT, batch_seq BIGINT, run_day DATE"
    ),
    "hour_state": f"{hours.STATE_SCHEMA}, batch_seq BIGINT, run_day DATE",
    "members": f"{hours.MEMBER_SCHEMA}, batch_seq BIGINT, run_day DATE",
    "ranges": (
        "topic STRING, consumer STRING, `partition` INT, from_offset BIGINT, until_offset BIGINT, "
        "batch_id BIGINT, query_id STRING, batch_seq BIGINT, run_day DATE"
    ),
    "quarantine": "value STRING, reason STRING, batch_seq BIGINT",
}
# The folder column of a table's slots.
SLOTS = {t: "run_day" if "run_day" in s else None for t, s in SCHEMAS.items()}
# Parts of a slot and tier that are merged into one of the next tier.
FAN = 8
MERGED = ("ten_minute", "hour_writes", "members", "ranges", "quarantine")
# Expired as one, when the last write to a day's hours is older than the life.
EXPIRING = ("hour_state", "hour_writes", "members")


def _base(root: str, table: str, tier: int) -> str:
    return f"{root.rstrip('/')}/{table}" + (f"-tier{tier}" if tier else "")


def _folder(part: Part) -> str:
    slot = f"{SLOTS[part.table]}={part.slot}/" if SLOTS[part.table] else ""
    return f"{slot}batch_seq={part.seq}"


def write_parts(
    df: DataFrame,
    root: str,
    table: str,
    seq: int,
    now: dt.datetime,
    slots: Sequence[str] = ("",),
    tier: int = 0,
    again: bool = False,
) -> list[Part]:
    """Write a batch's rows, which lie in no other than ``slots``; the parts
    that came about. AQE merges the rows of small slots into few files and
    splits a hot one. ``again`` is set when an earlier attempt may have left
    parts under the same number."""
    base = _base(root, table, tier)
    parts = [Part(table, slot, tier, seq, now.timestamp()) for slot in slots]
    files = Folder(df.sparkSession, base)
    if again:
        for part in parts:
            files.delete(_folder(part))
    slot_column = SLOTS[table]
    if slot_column is None:
        df.write.mode("overwrite").parquet(f"{base}/{_folder(parts[0])}")
        return parts
    placed = df.hint("rebalance", slot_column).withColumn("batch_seq", F.lit(seq).cast("bigint"))
    if table == "members":
        # Row groups then hold ranges of hours and buckets, which a batch asks for.
        placed = placed.sortWithinPartitions(slot_column, "run_hour", "bucket")
    writer = placed.write.partitionBy(slot_column, "batch_seq").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(base)
    return [part for part in parts if files.exists(_folder(part))]


def read_parts(spark: SparkSession, root: str, table: str, parts: Iterable[Part]) -> DataFrame:
    found = None
    parts = list(parts)
    for tier in sorted({p.tier for p in parts}):
        base = _base(root, table, tier)
        paths = [f"{base}/{_folder(p)}" for p in parts if p.tier == tier]
        rows = spark.read.schema(SCHEMAS[table]).option("basePath", base).parquet(*paths)
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], SCHEMAS[table]) if found is None else found


def _found(spark: SparkSession, root: str, table: str, pattern: str = "") -> DataFrame:
    """What lies in a table's folder, committed or not."""
    base = _base(root, table, 0)
    try:
        return spark.read.schema(SCHEMAS[table]).option("basePath", base).parquet(base + pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMAS[table])


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All parts of a table that batches wrote and upkeep has not deleted yet,
    committed or not; an empty DataFrame when there is none."""
    return _found(spark, root, table)


def state(spark: SparkSession, root: str) -> State:
    return Log(spark, root).state()


def last_committed(spark: SparkSession, root: str) -> int:
    """Number of the newest complete batch, -1 before the first."""
    return state(spark, root).seq


def committed(
    spark: SparkSession, root: str, table: str, slots: Iterable[str] | None = None, at: State | None = None
) -> DataFrame:
    """The rows that count, of some slots or of all."""
    at = at or state(spark, root)
    return read_parts(spark, root, table, at.of(table, slots))


def days_between(first: dt.date, last: dt.date) -> list[str]:
    return [str(first + dt.timedelta(days=n)) for n in range((last - first).days + 1)]


def _slots(between: tuple[dt.date, dt.date] | None) -> list[str] | None:
    return None if between is None else days_between(*between)


def same_days(state: DataFrame, touched: DataFrame) -> DataFrame:
    """The state rows of the days in ``touched``. The days of the calendar
    bound the broadcast (four million at most); joined on the folder column it
    prunes the folders that are read, when the query runs."""
    days = touched.select("run_day").distinct()
    return state.join(F.broadcast(days), "run_day", "left_semi")


def changed_by(spark: SparkSession, root: str, seq: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the ten-minute and the hourly table whose keys a batch touched,
    with the values they have after it. A relational copy replaces them by
    ``run_time`` and ``adc_id``, which may be repeated. For the batch that is
    being published, or one whose own parts upkeep has not deleted yet."""
    at = state(spark, root)
    own = f"/run_day=*/batch_seq={seq}"
    mine = _found(spark, root, "ten_minute", own)
    days = [str(r[0]) for r in mine.select("run_day").distinct().collect()]
    others = [p for p in at.of("ten_minute", days) if (p.tier, p.seq) != (0, seq)]
    merged = any(p.tier and p.seq >= seq for p in others)
    parts = read_parts(spark, root, "ten_minute", others)
    if not merged:
        parts = parts.unionByName(mine)
    touched = metrics.merge_partials(mine).select("run_ts", "adc_id")
    totals = metrics.merge_partials(parts).join(touched, ["run_ts", "adc_id"], "left_semi")
    rows = _found(spark, root, "hourly", own).where(F.col("changed_seq") == seq)
    return metrics.labelled(totals), rows.drop("changed_seq", "batch_seq", "run_day")


def ten_minute(
    spark: SparkSession, root: str, between: tuple[dt.date, dt.date] | None = None
) -> DataFrame:
    """The additive ten-minute table: ``run_time`` label, ``run_ts``, site and
    measures; of some days (first and last) or of all."""
    return metrics.labelled(metrics.merge_partials(committed(spark, root, "ten_minute", _slots(between))))


def hourly(spark: SparkSession, root: str, between: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """The hourly table, as it is stored: one row per hour and site."""
    return committed(spark, root, "hourly", _slots(between)).drop("changed_seq", "batch_seq", "run_day")


def positions(spark: SparkSession, root: str, topic: str, consumer: str) -> DataFrame:
    """Where a new run of the job starts when it has no checkpoint: for every
    partition that a batch has known, also a silent one."""
    at = state(spark, root).positions
    rows = [(t, p, o) for (t, c, p), o in sorted(at.items()) if (t, c) == (topic, consumer)]
    return spark.createDataFrame(rows, "topic STRING, `partition` INT, offset BIGINT")


def ranges(spark: SparkSession, root: str) -> DataFrame:
    """Offsets that every batch went through, since the first run."""
    return committed(spark, root, "ranges").drop("run_day")


def compact(spark: SparkSession, root: str, target: str) -> None:
    """Copy what counts to a new root, one part per table and slot, which a
    stopped job then goes on with (same checkpoint)."""
    at = state(spark, root)
    if at.seq < 0:
        return
    parts: list[Part] = []
    for table in SCHEMAS:
        for slot in sorted({p.slot for p in at.of(table)}):
            live = at.of(table, [slot])
            newest = dt.datetime.fromtimestamp(max(p.time for p in live), dt.timezone.utc)
            rows = _merged(read_parts(spark, root, table, live), table)
            parts += write_parts(rows, target, table, at.seq, newest, [slot])
    Log(spark, target).start(State(0, at.seq, frozenset(parts), at.positions, at.queries))


def _merged(rows: DataFrame, table: str) -> DataFrame:
    rows = rows.drop("batch_seq")
    if table != "ten_minute":
        return rows
    return rows.groupBy("run_ts", "adc_id", "run_day").agg(*[F.sum(m).alias(m) for m in metrics.MEASURES])


def _living(spark: SparkSession, root: str, rows: DataFrame, table: str, day: str, at: State, now: dt.datetime, life: int) -> DataFrame:
    """Rows of sets that have not expired: what is left to a merged part."""
    sets = read_parts(spark, root, "hour_state", at.of("hour_state", [day]))
    sets = hours.alive(sets, F.lit(now).cast("timestamp"), life)
    if table == "members":
        return rows.join(sets, [*hours.STATE_KEY, "gen"], "left_semi").select(rows.columns)
    since = sets.select(*hours.STATE_KEY, "since")
    return rows.join(since, list(hours.STATE_KEY)).where(F.col("written_at") >= F.col("since")).select(rows.columns)


def upkeep(
    spark: SparkSession,
    root: str,
    log: Log,
    at: State,
    touched: Iterable[tuple[str, str]],
    now: dt.datetime,
    life: int | None,
    fan: int = FAN,
    grace: int = GRACE,
) -> State:
    """Merge the parts of touched slots tier by tier, so that a slot has fewer
    than ``fan`` parts per tier; drop what has expired; delete from disk what
    has not counted for ``grace`` commits. A reader that began before goes on
    with the parts it knows."""
    old = [p for p, version in at.gone.items() if at.version - version >= grace]
    gone: set[Part] = set()
    if life is not None:
        # Every write to a day's hours leaves a newer part.
        newest: dict[str, float] = {}
        for p in at.parts:
            if p.table in EXPIRING:
                newest[p.slot] = max(p.time, newest.get(p.slot, p.time))
        ended = {slot for slot, time in newest.items() if now.timestamp() - time > life}
        gone = {p for p in at.parts if p.table in EXPIRING and p.slot in ended}
    live = set(at.parts) - gone
    added: list[Part] = []
    for table, slot in sorted(set(touched)):
        tier = 0
        while table in MERGED:
            same = [p for p in live if (p.table, p.slot, p.tier) == (table, slot, tier)]
            if len(same) < fan:
                break
            rows = read_parts(spark, root, table, same)
            if life is not None and table in EXPIRING:
                rows = _living(spark, root, rows, table, slot, at, now, life)
            seq = max(p.seq for p in same)
            new = write_parts(_merged(rows, table), root, table, seq, now, [slot], tier + 1, again=True)
            live = live - set(same) | set(new)
            gone |= set(same)
            added += new
            tier += 1
    # A part that was made and merged again here was never committed.
    add = tuple(p for p in added if p in live)
    remove = tuple(p for p in gone if p in at.parts)
    if add or remove or old:
        at = log.commit(at, Commit(at.seq, add, remove, deleted=tuple(old)))
    for part in [*old, *(p for p in added if p not in live)]:
        Folder(spark, _base(root, part.table, part.tier)).delete(_folder(part))
    return at
