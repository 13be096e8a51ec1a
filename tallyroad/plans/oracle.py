"""What every registered query must return, as SQL over the given tables.

The statements derive the answers from ``events`` directly: they build or parse
no JSON to know what a message says.
"""

from __future__ import annotations

from tallyroad.plans import feed, queries

_FAULT = "CASE " + " ".join(
    f"WHEN event_id % {n} = 0 THEN '{name}'" for n, name in feed.FAULTS.items()
) + " ELSE 'none' END"

_FEED = f"""
feed AS (
    SELECT event_id, ts, user_id, event_type, value,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS second_text,
           {_FAULT} AS fault,
           CASE WHEN event_id % 17 = 0 THEN 'other' ELSE 'yn_trans_event' END AS source_table,
           CASE WHEN event_id % 13 = 0 THEN 'INSERT' ELSE 'UPDATE' END AS change_type,
           event_id % 7 AS site,
           CASE event_type
               WHEN 'signup' THEN 400 WHEN 'view' THEN 800 WHEN 'purchase' THEN 900
               WHEN 'click' THEN 100
               ELSE CASE event_id % 4 WHEN 0 THEN 450 WHEN 1 THEN 500 WHEN 2 THEN 600 ELSE 950 END
           END AS code,
           CAST(floor(value) AS BIGINT) AS whole_price,
           CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS deleted
    FROM events
)"""

_OUTCOMES = """
outcomes AS (
    SELECT *,
           CASE WHEN fault = 'broken_text' THEN 'not_an_object'
                WHEN fault = 'null_msgid' THEN 'null_msgid'
                WHEN fault = 'text_data' THEN 'data_not_an_object'
                WHEN source_table = 'other' THEN NULL
                WHEN fault = 'null_timestamp' THEN 'null_timestamp'
                WHEN fault = 'null_type' THEN 'null_type'
                WHEN fault = 'null_values' THEN 'values_not_an_object'
           END AS parse_reason,
           source_table = 'yn_trans_event' AND fault NOT IN (
               'blank_line', 'broken_text', 'null_msgid', 'text_data', 'null_timestamp',
               'null_type', 'no_values', 'null_values'
           ) AS is_record
    FROM feed
)"""

_RECORDS = """
recs AS (
    SELECT event_id, ts,
           CAST(event_id AS VARCHAR) AS msg_id,
           CASE WHEN fault = 'no_timestamp' THEN '0' ELSE second_text END AS timestamp,
           change_type AS event_type,
           CASE fault WHEN 'null_driver' THEN '' WHEN 'no_driver' THEN '0'
                ELSE CAST(user_id AS VARCHAR) END AS driver_id,
           CASE WHEN fault = 'empty_adc' THEN '' ELSE CAST(site AS VARCHAR) END AS adc_id,
           CAST(code AS VARCHAR) AS status,
           CASE WHEN fault = 'text_price' THEN 'x' ELSE CAST(whole_price AS VARCHAR) END
               AS event_price,
           CASE fault WHEN 'empty_is_del' THEN '' WHEN 'no_is_del' THEN '0'
                ELSE CAST(deleted AS VARCHAR) END AS is_del,
           '0' AS complete_time,
           CASE WHEN fault = 'no_timestamp' THEN TIMESTAMP '1970-01-01 00:00:00'
                ELSE date_trunc('second', ts) END AS event_time,
           CASE WHEN code = 400 THEN 'sign_driver' WHEN code = 800 THEN 'run_driver'
                WHEN code = 900 THEN 'complete_driver'
                WHEN code IN (450, 500, 600, 950) THEN 'exception_driver' END AS metric,
           CASE WHEN code = 900 AND fault <> 'text_price' THEN whole_price END AS price,
           fault = 'empty_adc' OR (fault = 'text_price' AND code = 900) AS is_faulty
    FROM outcomes
    WHERE is_record
),
live AS (
    SELECT *, time_bucket(INTERVAL '10 minutes', event_time) AS run_ts
    FROM recs
    WHERE event_type = 'UPDATE' AND is_del = '0'
),
counted AS (
    SELECT * FROM live WHERE NOT is_faulty
)"""

_BASE = f"WITH {_FEED.strip()}, {_OUTCOMES.strip()}, {_RECORDS.strip()}"

_MINUTE = "%Y-%m-%d_%H-%M"
_HOUR = "%Y-%m-%d_%H"


def _distinct_counts(cast: str) -> str:
    return ",\n".join(
        f"CAST(count(DISTINCT driver_id) FILTER (metric = '{m}') AS {cast}) AS {m}"
        for m in ("sign_driver", "run_driver", "exception_driver", "complete_driver")
    )


def _metrics(source: str, bucket: str, label: str = _MINUTE) -> str:
    return f"""{_BASE}
    SELECT strftime({bucket}, '{label}') AS run_time, adc_id,
           {_distinct_counts('BIGINT')},
           CAST(coalesce(sum(price), 0) AS BIGINT) AS event_price
    FROM {source} GROUP BY 1, 2"""


_SUMS = ", ".join(
    f"CAST(sum({m}) AS BIGINT) AS {m}"
    for m in ("sign_driver", "run_driver", "exception_driver", "complete_driver", "event_price")
)


def _partials(bucket: str, batches: int) -> str:
    return f"""
    partials AS (
        SELECT event_id % {batches} AS batch_id, {bucket} AS run_ts, CAST(adc_id AS INTEGER) AS adc_id,
               {_distinct_counts('BIGINT')}, coalesce(sum(price), 0) AS event_price
        FROM counted GROUP BY 1, 2, 3
    )"""


def _additive(bucket: str, batches: int) -> str:
    return f"""{_BASE}, {_partials(bucket, batches)}
    SELECT strftime(run_ts, '{_MINUTE}') AS run_time, adc_id, {_SUMS}
    FROM partials GROUP BY run_ts, adc_id"""


_TEN = "run_ts"
_DAY = "time_bucket(INTERVAL '1 day', event_time)"
_HOUR_START = "date_trunc('hour', run_ts)"
_LAST = queries.BATCHES - 1

_WRITES = f"""
writes AS (
    SELECT DISTINCT {_HOUR_START} AS run_hour, CAST(adc_id AS INTEGER) AS adc_id, metric,
           driver_id, event_id % {queries.BATCHES} AS batch_id
    FROM counted
)"""


def _hourly(where: str) -> str:
    return f"""
    SELECT {_HOUR_START} AS run_time, CAST(adc_id AS INTEGER) AS adc_id,
           {_distinct_counts('BIGINT')}, CAST(sum(price) AS BIGINT) AS event_price
    FROM counted WHERE {where} GROUP BY 1, 2"""


_BATCH = f"event_id % {queries.BATCHES}"
_HALVES = f"""{_BASE},
    touched AS (
        SELECT DISTINCT {_HOUR_START} AS run_time, CAST(adc_id AS INTEGER) AS adc_id
        FROM counted WHERE {_BATCH} = {_LAST}
    ),
    old AS ({_hourly(f"{_BATCH} < {_LAST}")}),
    every AS ({_hourly("TRUE")}),
    new AS (SELECT every.* FROM every JOIN touched USING (run_time, adc_id))"""

def _expiry(batches: int, read_at: str) -> str:
    return f"""{_BASE},
    timed AS (
        SELECT c.run_hour, c.adc_id, c.metric, c.driver_id, c.price,
               TIMESTAMP '{queries.FIRST_WRITE}'
                   + to_hours(CAST(c.batch_id * {queries.HOURS_BETWEEN_WRITES} AS INTEGER)) AS written_at
        FROM (
            SELECT {_HOUR_START} AS run_hour, CAST(adc_id AS INTEGER) AS adc_id, metric,
                   driver_id, price, event_id % {batches} AS batch_id
            FROM counted
        ) c
    ),
    touches AS (
        SELECT DISTINCT run_hour, adc_id, metric, written_at FROM timed WHERE metric IS NOT NULL
    ),
    gaps AS (
        SELECT *, CASE WHEN written_at - lag(written_at) OVER (
                   PARTITION BY run_hour, adc_id, metric ORDER BY written_at) > INTERVAL '24 hours'
               THEN 1 ELSE 0 END AS starts
        FROM touches
    ),
    numbered AS (
        SELECT *, sum(starts) OVER (
            PARTITION BY run_hour, adc_id, metric ORDER BY written_at) AS generation
        FROM gaps
    ),
    lives AS (
        SELECT run_hour, adc_id, metric, min(written_at) AS born, max(written_at) AS renewed
        FROM numbered GROUP BY run_hour, adc_id, metric, generation
    ),
    keys AS (
        SELECT run_hour, adc_id, max(written_at) AS last_touch FROM timed GROUP BY 1, 2
    ),
    alive AS (
        SELECT l.* FROM lives l JOIN keys k ON l.run_hour = k.run_hour AND l.adc_id = k.adc_id
        WHERE {read_at} - renewed <= INTERVAL '24 hours'
    ),
    kept AS (
        SELECT t.* FROM timed t JOIN alive a
        ON t.run_hour = a.run_hour AND t.adc_id = a.adc_id AND t.metric = a.metric
           AND t.written_at BETWEEN a.born AND a.renewed
    ),
    counts AS (
        SELECT run_hour, adc_id, {_distinct_counts('BIGINT')}, CAST(sum(price) AS BIGINT) AS event_price
        FROM kept GROUP BY 1, 2
    )
    SELECT k.run_hour AS run_time, k.adc_id,
           coalesce(sign_driver, 0) AS sign_driver, coalesce(run_driver, 0) AS run_driver,
           coalesce(exception_driver, 0) AS exception_driver,
           coalesce(complete_driver, 0) AS complete_driver, event_price
    FROM keys k LEFT JOIN counts c ON k.run_hour = c.run_hour AND k.adc_id = c.adc_id"""


# The text of every message, part by part; a missing part is NULL.
_TEXTS = f"""
parts AS (
    SELECT event_id, fault,
           CASE fault WHEN 'no_driver' THEN NULL WHEN 'null_driver' THEN '"driver_id":null'
                ELSE '"driver_id":' || user_id END AS driver_part,
           CASE fault WHEN 'empty_adc' THEN '"adc_id":""' ELSE '"adc_id":' || site END AS adc_part,
           '"status":' || code AS status_part,
           CASE fault WHEN 'text_price' THEN '"customer_price":"x"'
                ELSE '"customer_price":' || whole_price END AS price_part,
           CASE fault WHEN 'no_is_del' THEN NULL WHEN 'empty_is_del' THEN '"is_del":""'
                ELSE '"is_del":' || deleted END AS del_part,
           '"table":"' || source_table || '"' AS table_part,
           CASE fault WHEN 'null_type' THEN '"type":null'
                ELSE '"type":"' || change_type || '"' END AS type_part,
           CASE fault WHEN 'no_timestamp' THEN NULL WHEN 'null_timestamp' THEN '"timestamp":null'
                ELSE '"timestamp":"' || second_text || '"' END AS time_part
    FROM feed
),
datas AS (
    SELECT event_id, fault,
           '{{' || concat_ws(',', table_part, type_part, time_part,
               CASE fault WHEN 'no_values' THEN NULL WHEN 'null_values' THEN '"values":null'
               ELSE '"values":{{' || concat_ws(',', driver_part, adc_part, status_part, price_part,
                    del_part, '"complete_time":null') || '}}' END) || '}}' AS data_text
    FROM parts
),
texts AS (
    SELECT event_id,
           CASE WHEN fault = 'blank_line' THEN ' ' || chr(9) || ' '
                WHEN fault = 'null_msgid' THEN '{{"msgid":null,"data":' || data_text || '}}'
                WHEN fault = 'text_data' THEN '{{"msgid":' || event_id || ',"data":"'
                    || replace(data_text, '"', chr(92) || '"') || '"}}'
                WHEN fault = 'broken_text' THEN '[{{"msgid":' || event_id || ',"data":' || data_text || '}}'
                WHEN fault = 'padded' THEN ' ' || chr(9) || '{{"msgid":' || event_id || ',"data":'
                    || data_text || '}}' || chr(10) || ' '
                ELSE '{{"msgid":' || event_id || ',"data":' || data_text || '}}' END AS value
    FROM datas
)"""

_REC_COLUMNS = (
    "msg_id, timestamp, event_type, driver_id, adc_id, status, event_price, is_del, complete_time"
)

_LEDGER = f"""
ledger AS (
    SELECT '{feed.TOPIC}' AS topic, '{queries.CONSUMER}' AS consumer,
           CAST(event_id % {feed.TOPIC_PARTITIONS} AS INTEGER) AS partition,
           max(event_id // {feed.TOPIC_PARTITIONS}) + 1 AS "offset", event_id % {queries.BATCHES} AS batch_id
    FROM events GROUP BY 1, 2, 3, 5
),
positions AS (
    SELECT topic, partition, arg_max("offset", batch_id) AS "offset"
    FROM ledger GROUP BY 1, 2
)"""

_PUTS = """
puts AS (
    SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS family,
           'q' || (event_id % 3) AS qualifier, CAST(day(ts) AS BIGINT) AS version,
           'v' || event_id AS value, event_id AS written
    FROM events
),
settled AS (
    SELECT row_key, family, qualifier, version, arg_max(value, written) AS value
    FROM puts GROUP BY 1, 2, 3, 4
),
ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY row_key, family, qualifier ORDER BY version DESC) AS place
    FROM settled
)"""

_CELL_COLUMNS = "row_key, family, qualifier, version, value"


def oracle_sql() -> dict[str, str]:
    stream_batches = queries.STREAM_BATCHES
    ten_minute = _metrics("counted", _TEN)
    found = {
        "json_write": f"WITH {_FEED.strip()}, {_TEXTS.strip()} SELECT event_id, value FROM texts",
        "json_rows": """
            SELECT event_id,
                   '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"'
                       || event_type || '"}' AS row_json,
                   '{"event_type":"' || event_type || '","user":"' || user_id || '"}' AS map_json
            FROM events""",
        "split_messages": f"""{_BASE},
            both_texts AS (
                SELECT change_type AS event_type, CAST(code AS VARCHAR) AS status
                FROM feed WHERE source_table = 'yn_trans_event'
                UNION ALL
                SELECT event_type, status FROM recs
            )
            SELECT event_type, status, count(*) AS n_records FROM both_texts GROUP BY 1, 2""",
        "record_count": f"{_BASE} SELECT count(*) AS n_records FROM recs",
        "parse_messages": f"{_BASE} SELECT {_REC_COLUMNS} FROM recs",
        "message_outcomes": f"""{_BASE},
            ends AS (
                SELECT CASE WHEN o.fault = 'blank_line' THEN 'blank'
                            WHEN o.parse_reason IS NOT NULL THEN 'quarantined'
                            WHEN NOT o.is_record THEN 'ignored'
                            WHEN l.event_id IS NULL THEN 'filtered'
                            WHEN l.is_faulty THEN 'quarantined'
                            ELSE 'counted' END AS outcome
                FROM outcomes o LEFT JOIN live l ON o.event_id = l.event_id
            )
            SELECT outcome, count(*) AS n_messages FROM ends GROUP BY 1""",
        "quarantine_reasons": f"""{_BASE},
            rejected AS (
                SELECT parse_reason AS reason FROM outcomes WHERE parse_reason IS NOT NULL
                UNION ALL
                SELECT CASE WHEN adc_id = '' THEN 'bad_adc_id' ELSE 'bad_price' END
                FROM live WHERE is_faulty
            )
            SELECT reason, count(*) AS n_messages FROM rejected GROUP BY 1""",
        "quarantined_lines": f"""{_BASE}, {_TEXTS.strip()}
            SELECT t.value, o.parse_reason AS reason
            FROM outcomes o JOIN texts t ON o.event_id = t.event_id
            WHERE o.parse_reason IS NOT NULL
            UNION ALL
            SELECT t.value, CASE WHEN l.adc_id = '' THEN 'bad_adc_id' ELSE 'bad_price' END
            FROM live l JOIN texts t ON l.event_id = t.event_id
            WHERE l.is_faulty""",
        "filtered_updates": f"""{_BASE}
            SELECT {_REC_COLUMNS.replace("timestamp", f"strftime(run_ts, '{_MINUTE}') AS timestamp")}
            FROM live""",
        "bucket_before": f"""
            SELECT event_id, strftime(time_bucket(INTERVAL '10 minutes', ts), '{_MINUTE}') AS label
            FROM events""",
        "bucket_next": f"""
            SELECT event_id, strftime(time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes',
                                      '{_MINUTE}') AS label
            FROM events""",
        "bucket_millis": """
            SELECT event_id, epoch_ms(date_trunc('second', ts)) AS millis,
                   epoch_ms(date_trunc('second', ts)) // 420000 * 420000 AS before_millis,
                   (epoch_ms(date_trunc('second', ts)) // 420000 + 1) * 420000 AS next_millis
            FROM events""",
        "bucket_labels": f"""
            WITH starts AS (
                SELECT event_id, time_bucket(INTERVAL '10 minutes', ts) AS s FROM events
            )
            SELECT event_id, strftime(s, '%Y-%m-%d') AS day_label,
                   strftime(s, '{_HOUR}') AS hour_label, strftime(s, '{_MINUTE}') AS minute_label,
                   strftime(s, '%Y') AS year_part, strftime(s, '%m') AS month_part,
                   strftime(s, '%d') AS day_part, strftime(s, '%H') AS hour_part,
                   strftime(s, '%M') AS minute_part,
                   CAST(epoch(s) AS BIGINT) AS minute_seconds,
                   CAST(epoch(date_trunc('hour', s)) AS BIGINT) AS hour_seconds
            FROM starts""",
        "status_metric": f"""{_BASE}
            SELECT msg_id, status, metric,
                   concat_ws('@', strftime(run_ts, '{_HOUR}'), adc_id, metric) AS key,
                   strftime(run_ts, '{_HOUR}') AS key_hour, adc_id AS key_adc, metric AS key_metric
            FROM live""",
        "ten_minute_metrics": ten_minute,
        "ten_minute_metrics_sql": ten_minute,
        "daily_metrics": _metrics("counted", _DAY),
        "next_bucket_metrics": _metrics(
            "(SELECT * FROM recs WHERE NOT is_faulty)",
            "time_bucket(INTERVAL '10 minutes', event_time) + INTERVAL '10 minutes'",
        ),
        "ten_minute_additive": _additive(_TEN, queries.BATCHES),
        "daily_additive": _additive(_DAY, queries.BATCHES),
        "additive_upsert": f"""{_BASE}, {_partials(_DAY, queries.BATCHES)}
            SELECT strftime(run_ts, '{_MINUTE}') AS run_time, adc_id, {_SUMS},
                   coalesce(min(batch_id) FILTER (batch_id < {queries.BATCHES // 2}), min(batch_id))
                       AS first_batch
            FROM partials GROUP BY run_ts, adc_id""",
        "hourly_metrics": f"{_BASE} {_hourly('TRUE')}",
        "hourly_spellings": f"{_BASE} {_hourly('TRUE')}",
        "hourly_touched_keys": f"""{_BASE}
            SELECT DISTINCT {_BATCH} AS batch_id,
                   strftime(run_ts, '{_HOUR}') || '@' || adc_id AS key
            FROM counted""",
        "hourly_set_add": f"""{_BASE}, {_WRITES}
            SELECT run_hour, adc_id, metric, driver_id
            FROM writes WHERE metric IS NOT NULL
            GROUP BY 1, 2, 3, 4 HAVING min(batch_id) = {_LAST}""",
        "hourly_counters": f"""{_BASE}
            SELECT {_HOUR_START} AS run_hour, CAST(adc_id AS INTEGER) AS adc_id, CAST(sum(price) AS BIGINT) AS event_price
            FROM counted WHERE price IS NOT NULL GROUP BY 1, 2""",
        "hourly_with_expiry": _expiry(
            queries.BATCHES,
            f"TIMESTAMP '{queries.FIRST_WRITE}' + INTERVAL '{queries.READ_AFTER_HOURS} hours'",
        ),
        "hourly_replace": f"""{_HALVES}
            SELECT * FROM new UNION ALL
            SELECT * FROM old WHERE (run_time, adc_id) NOT IN (SELECT (run_time, adc_id) FROM new)""",
        "keyed_delete": f"""{_HALVES}
            SELECT * FROM old WHERE (run_time, adc_id) NOT IN (SELECT (run_time, adc_id) FROM new)""",
        "keyed_update": f"""{_HALVES}
            SELECT o.run_time, o.adc_id, o.sign_driver, o.run_driver, o.exception_driver,
                   o.complete_driver,
                   CASE WHEN n.run_time IS NULL THEN o.event_price ELSE n.event_price END AS event_price
            FROM old o LEFT JOIN new n ON o.run_time = n.run_time AND o.adc_id = n.adc_id""",
        "keyed_exists": f"""{_HALVES}
            SELECT n.run_time, n.adc_id, count(o.run_time) AS n_rows
            FROM new n LEFT JOIN old o ON o.run_time = n.run_time AND o.adc_id = n.adc_id
            GROUP BY 1, 2""",
        "insert_columns": f"""{_BASE}, hourly AS ({_hourly('TRUE')})
            SELECT 'run_time,adc_id,sign_driver,run_driver,exception_driver,complete_driver'
                       || CASE WHEN event_price IS NULL THEN '' ELSE ',event_price' END AS columns,
                   count(*) AS n_rows
            FROM hourly GROUP BY 1""",
        "offset_ranges": f"""
            SELECT event_id % {queries.BATCHES} AS batch_id, '{feed.TOPIC}' AS topic,
                   CAST(event_id % {feed.TOPIC_PARTITIONS} AS INTEGER) AS partition,
                   min(event_id // {feed.TOPIC_PARTITIONS}) AS from_offset,
                   max(event_id // {feed.TOPIC_PARTITIONS}) AS last_offset,
                   max(event_id // {feed.TOPIC_PARTITIONS}) + 1 AS until_offset
            FROM events GROUP BY 1, 2, 3""",
        "offset_ledger": f"WITH {_LEDGER.strip()} SELECT * FROM ledger",
        "offset_resume": f"WITH {_LEDGER.strip()} SELECT * FROM positions",
        "offset_node": f"WITH {_LEDGER.strip()} SELECT * FROM positions",
        "offset_node_text": f"""WITH {_LEDGER.strip()}
            SELECT topic, string_agg(partition || ':' || "offset", ',' ORDER BY partition) AS offsets
            FROM positions GROUP BY 1""",
        "offset_json": f"""WITH {_LEDGER.strip()}
            SELECT topic, '{{"' || topic || '":{{'
                   || string_agg('"' || partition || '":' || "offset", ',' ORDER BY partition)
                   || ',"{feed.TOPIC_PARTITIONS}":-1}}}}' AS offsets
            FROM positions GROUP BY 1""",
        "cells_settled": f"WITH {_PUTS.strip()} SELECT {_CELL_COLUMNS} FROM settled",
        "cells_latest": f"WITH {_PUTS.strip()} SELECT {_CELL_COLUMNS} FROM ranked WHERE place = 1",
        "cells_versions": f"""WITH {_PUTS.strip()}
            SELECT {_CELL_COLUMNS} FROM ranked WHERE family = 'view' AND place <= 10""",
        "cells_delete_latest": f"""WITH {_PUTS.strip()}
            SELECT {_CELL_COLUMNS} FROM ranked WHERE family <> 'view' OR place > 1""",
        "cells_point_get": f"""WITH {_PUTS.strip()}
            SELECT {_CELL_COLUMNS} FROM ranked
            WHERE place = 1 AND row_key = (SELECT CAST(arg_max(user_id, event_id) AS VARCHAR) FROM events)""",
        "stream_ten_minute": _additive(_TEN, stream_batches),
        "stream_hourly": f"{_BASE} {_hourly('TRUE')}",
        # A row is as fresh as the last batch that touched its key.
        "stream_hourly_with_expiry": _expiry(stream_batches, "last_touch"),
        "archive_positions": f"""
            SELECT '{feed.TOPIC}' AS topic,
                   CAST(event_id % {feed.TOPIC_PARTITIONS} AS INTEGER) AS partition,
                   max(event_id // {feed.TOPIC_PARTITIONS}) + 1 AS "offset"
            FROM events GROUP BY 1, 2""",
        "stream_positions": f"""
            SELECT '{feed.TOPIC}' AS topic,
                   CAST(event_id % {feed.TOPIC_PARTITIONS} AS INTEGER) AS partition,
                   arg_max(event_id // {feed.TOPIC_PARTITIONS}, (event_id % {stream_batches}, event_id)) + 1
                       AS "offset"
            FROM events GROUP BY 1, 2""",
        "archive_roundtrip": f"""WITH {_FEED.strip()}, {_TEXTS.strip()},
            lines AS (SELECT unnest(string_split(value, chr(10))) AS value FROM texts)
            SELECT value, count(*) AS n_lines FROM lines GROUP BY 1""",
        "merged_text": f"""WITH daily AS ({_metrics("counted", _DAY)})
            SELECT concat_ws(',', run_time, adc_id, sign_driver, run_driver, exception_driver,
                             complete_driver, event_price) AS value
            FROM daily""",
    }
    # Other ways to the same rows.
    same = {
        "keyed_delete_marks": "keyed_delete",
        "keyed_update_marks": "keyed_update",
        "cells_delete_marks": "cells_delete_latest",
        "archive_replay": "stream_hourly",
    }
    return found | {name: found[other] for name, other in same.items()}
