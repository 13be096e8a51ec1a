"""Change messages: one JSON text per row in, typed records out.

``classify`` gives every input row an ``outcome``:

* ``record``      a message of the wanted table, its nine text fields in ``rec``
* ``blank``       null, empty or white-space line
* ``ignored``     valid, but of another table or without ``data`` or ``values``
* ``quarantined`` cannot be read; ``reason`` says why

The usual message carries all fields, so one narrow ``from_json`` decides it.
Only rows where a field is missing, null or of the wrong kind need the wider
parses that tell those cases apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallyroad.functions.jsonio import read_json
from tallyroad.functions.text import is_blank, strict_int, strict_long, trim_controls
from tallyroad.functions import status, timebucket

# The table whose changes are counted, the change type kept, and
# the "not deleted" mark.
SOURCE_TABLE = "yn_trans_event"
KEPT_TYPE = "UPDATE"
NOT_DELETED = "0"

# Record field -> field of ``values`` in the message.
VALUE_FIELDS = {
    "driver_id": "driver_id",
    "adc_id": "adc_id",
    "status": "status",
    "event_price": "customer_price",
    "is_del": "is_del",
    "complete_time": "complete_time",
}
RECORD_FIELDS = ("msg_id", "timestamp", "event_type", *VALUE_FIELDS)

_NARROW = (
    "msgid STRING, data STRUCT<`table` STRING, type STRING, timestamp STRING, "
    "values STRUCT<" + ", ".join(f"{f} STRING" for f in VALUE_FIELDS.values()) + ">>"
)
_TOP = "MAP<STRING, STRING>"
_DATA = "data MAP<STRING, STRING>"
_VALUES = "data STRUCT<values MAP<STRING, STRING>>"


def _struct_sql(outcome: str, reason: str | None = None, rec: str | None = None) -> str:
    if rec is None:
        rec = "CAST(NULL AS STRUCT<" + ", ".join(f"`{f}`: STRING" for f in RECORD_FIELDS) + ">)"
    reason = "CAST(NULL AS STRING)" if reason is None else f"'{reason}'"
    return f"named_struct('outcome', '{outcome}', 'reason', {reason}, 'rec', {rec})"


def _record_sql(msg_id: str, timestamp: str, event_type: str, field: Callable[[str], str]) -> str:
    """A record from the SQL of its parts; ``field`` gives that of a field of
    ``values``. Null and empty completion times read as ``0``."""
    parts = {"msg_id": msg_id, "timestamp": timestamp, "event_type": event_type}
    for name, source in VALUE_FIELDS.items():
        parts[name] = field(source)
    parts["complete_time"] = f"coalesce(nullif({parts['complete_time']}, ''), '0')"
    pairs = ", ".join(f"'{name}', {sql}" for name, sql in parts.items())
    return _struct_sql("record", rec=f"named_struct({pairs})")


# The text again when the narrow parse cannot decide a message.
_NEEDS_WIDE = (
    "CASE WHEN _text IS NOT NULL AND NOT coalesce(startswith(_text, '{')"
    " AND _m.msgid IS NOT NULL AND _m.data.`table` IS NOT NULL AND (_m.data.`table` <> _table OR ("
    "_m.data.`timestamp` IS NOT NULL AND _m.data.type IS NOT NULL AND "
    + " AND ".join(
        f"_m.data.`values`.{source} IS NOT NULL"
        for name, source in VALUE_FIELDS.items()
        if name != "complete_time"
    )
    + ")), false) THEN _text END"
)

_USUAL_RECORD = _record_sql(
    "_m.msgid", "_m.data.`timestamp`", "_m.data.type", lambda f: f"_m.data.`values`.{f}"
)

# A missing field reads as a default, a null one as empty text.
_WIDE_RECORD = _record_sql(
    "IF(map_contains_key(w._top, 'msgid'), w._top['msgid'], '0')",
    "IF(map_contains_key(w._data, 'timestamp'), w._data['timestamp'], '0')",
    "IF(map_contains_key(w._data, 'type'), w._data['type'], '-')",
    lambda f: f"coalesce(IF(map_contains_key(w._values, '{f}'), w._values['{f}'], '0'), '')",
)

# The checks come in the order that decides which of several faults counts.
# They run inside a lambda, which is interpreted: that costs little for the few
# messages that need it and keeps the compiled code of all others small (the
# JVM does not compile methods over 8,000 bytes).
_RESULT = f"""
    CASE
        WHEN _text IS NULL THEN {_struct_sql("blank")}
        WHEN _wide IS NULL AND _m.data.`table` = _table THEN {_USUAL_RECORD}
        WHEN _wide IS NULL THEN {_struct_sql("ignored")}
        ELSE transform(array(named_struct(
            '_top', _top, '_data', _data, '_values', _values, '_table', _table)), w ->
            CASE
                WHEN w._top IS NULL THEN {_struct_sql("quarantined", "not_an_object")}
                WHEN map_contains_key(w._top, 'msgid') AND w._top['msgid'] IS NULL
                    THEN {_struct_sql("quarantined", "null_msgid")}
                WHEN NOT map_contains_key(w._top, 'data') THEN {_struct_sql("ignored")}
                WHEN w._data IS NULL THEN {_struct_sql("quarantined", "data_not_an_object")}
                WHEN NOT (w._data['table'] <=> w._table) THEN {_struct_sql("ignored")}
                WHEN map_contains_key(w._data, 'timestamp') AND w._data['timestamp'] IS NULL
                    THEN {_struct_sql("quarantined", "null_timestamp")}
                WHEN map_contains_key(w._data, 'type') AND w._data['type'] IS NULL
                    THEN {_struct_sql("quarantined", "null_type")}
                WHEN NOT map_contains_key(w._data, 'values') THEN {_struct_sql("ignored")}
                WHEN w._values IS NULL THEN {_struct_sql("quarantined", "values_not_an_object")}
                ELSE {_WIDE_RECORD}
            END)[0]
    END
"""


def classify(
    messages: DataFrame, value_col: str = "value", source_table: str = SOURCE_TABLE
) -> DataFrame:
    """Add ``outcome``, ``reason`` and ``rec`` to the input columns."""
    kept = messages.columns
    value = F.col(value_col)
    # Text from brace to brace needs no trimming, which looks at every character.
    tight = value.startswith("{") & value.endswith("}")
    parsed = messages.withColumn(
        "_text", F.when(tight, value).when(~is_blank(value), trim_controls(value))
    )
    parsed = parsed.withColumn("_m", read_json(F.col("_text"), _NARROW))
    table = F.lit(source_table)
    parsed = parsed.withColumns({"_table": table, "_wide": F.expr(_NEEDS_WIDE)})
    wide = F.col("_wide")
    parsed = parsed.withColumns(
        {
            "_top": read_json(wide, _TOP),
            "_data": read_json(wide, _DATA)["data"],
            "_values": read_json(wide, _VALUES)["data"]["values"],
        }
    )
    # A generated column stops filters on the result from being pushed below
    # it, which would parse every text a second time.
    return (
        parsed.select(*kept, F.expr(_RESULT).alias("_result"))
        .select(*kept, F.explode(F.array("_result")).alias("_r"))
        .select(*kept, "_r.outcome", "_r.reason", "_r.rec")
    )


def records(classified: DataFrame) -> DataFrame:
    """The parsed records alone, as nine text columns."""
    return classified.where(F.col("outcome") == "record").select("rec.*")


def quarantine(classified: DataFrame, value_col: str = "value") -> DataFrame:
    """Rejected lines with their reason."""
    return classified.where(F.col("outcome") == "quarantined").select(value_col, "reason")


def is_live_update(prefix: str = "") -> Column:
    """An UPDATE of a row that is not deleted (exact, case-sensitive text)."""
    return (F.col(prefix + "event_type") == KEPT_TYPE) & (F.col(prefix + "is_del") == NOT_DELETED)


def live_updates(
    recs: DataFrame, width: int = timebucket.TEN_MINUTES, partitions: int | None = None
) -> DataFrame:
    """Updates of rows that are not deleted, with ``run_ts``, the start of
    their time bucket. ``partitions`` merges tasks without a shuffle, for small
    batches; large ones leave it out."""
    ts = timebucket.parse_timestamp(F.col("timestamp"))
    live = recs.where(is_live_update()).withColumn("run_ts", timebucket.bucket_start(ts, width))
    return live if partitions is None else live.coalesce(partitions)


def number_fault(prefix: str = "") -> Column:
    """Why a record cannot be stored: its site or a counted price is no
    integer, or its time is one that no timestamp can hold. NULL for a good
    record."""
    bad_site = strict_int(F.col(prefix + "adc_id")).isNull()
    bad_price = (F.col(prefix + "status") == status.PRICED_STATUS) & strict_long(
        F.col(prefix + "event_price")
    ).isNull()
    bad_time = timebucket.out_of_range(F.col(prefix + "timestamp"))
    return (
        F.when(bad_site, "bad_adc_id")
        .when(bad_price, "bad_price")
        .when(bad_time, "time_out_of_range")
    )


def counted(
    classified: DataFrame, width: int = timebucket.TEN_MINUTES, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The records that enter the metrics: ``run_ts, adc_id, metric, driver_id,
    price``, after the columns to ``keep``."""
    good = (
        (F.col("outcome") == "record") & is_live_update("rec.") & number_fault("rec.").isNull()
    )
    measures = _measures(width)
    return classified.where(good).select(*keep, *[c.alias(n) for n, c in measures.items()])


def measure_rows(
    classified: DataFrame, width: int = timebucket.TEN_MINUTES, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One slim row per input row: the columns of :func:`counted`, NULL for
    rows that do not count, and the final ``outcome`` and ``reason``. A batch
    that feeds several tables caches these instead of the messages."""
    is_record = F.col("outcome") == "record"
    live = is_record & is_live_update("rec.")
    rows = classified.withColumn("_fault", F.when(live, number_fault("rec."))).select(
        *keep,
        F.when(F.col("_fault").isNotNull(), "quarantined")
        .when(live, "counted")
        .when(is_record, "filtered")
        .otherwise(F.col("outcome"))
        .alias("outcome"),
        F.coalesce("_fault", "reason").alias("reason"),
        "rec",
    )
    measures = _measures(width)
    return rows.select(
        *keep,
        "outcome",
        "reason",
        *[F.when(F.col("outcome") == "counted", c).alias(n) for n, c in measures.items()],
    )


def _measures(width: int) -> dict[str, Column]:
    ts = timebucket.parse_timestamp(F.col("rec.timestamp"))
    metric = status.metric_of(F.col("rec.status"))
    priced = F.col("rec.status") == status.PRICED_STATUS
    return {
        "run_ts": timebucket.bucket_start(ts, width),
        "adc_id": F.col("rec.adc_id"),
        "metric": metric,
        # Without a metric the group still shows, with zeros, but its drivers
        # do not matter: dropping them lets such rows collapse early.
        "driver_id": F.when(metric.isNotNull(), F.col("rec.driver_id")),
        "price": F.when(priced, strict_long(F.col("rec.event_price"))),
    }
