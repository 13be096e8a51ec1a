"""Time buckets, their text labels and the parts of a label."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyroad.functions.text import rarely

# Label and message time formats.
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
MINUTE_LABEL = "yyyy-MM-dd_HH-mm"
HOUR_LABEL = "yyyy-MM-dd_HH"
DAY_LABEL = "yyyy-MM-dd"
LABEL_FORMATS = {"day": DAY_LABEL, "hour": HOUR_LABEL, "minute": MINUTE_LABEL}

TEN_MINUTES = 600
ONE_HOUR = 3600
ONE_DAY = 86400

# Numbers between fixed separators, each with optional leading blanks; what
# follows the seconds is ignored.
_LENIENT = (
    r"^[ \t]*(\d+)-[ \t]*(\d+)-[ \t]*(\d+) "
    r"[ \t]*(\d+):[ \t]*(\d+):[ \t]*(\d+)"
)
# Years a timestamp can hold, in seconds before and after the epoch, and a bound
# for single numbers that keeps the sums below within 64 bits.
_FIRST_SECOND = -62_135_596_800
_LAST_SECOND = 253_402_300_799
_LARGEST = 10**12


def floor_millis(millis: Column, period_ms: int) -> Column:
    """Largest multiple of the period that is not after ``millis``."""
    return millis - F.pmod(millis, F.lit(period_ms))


def next_millis(millis: Column, period_ms: int) -> Column:
    """Smallest multiple of the period after ``millis``; a multiple itself
    moves on to the next one."""
    return floor_millis(millis, period_ms) + F.lit(period_ms)


def _lenient_timestamp(text: Column) -> Column:
    """NULL for text that does not read, and for times out of range."""

    def part(i: int) -> Column:
        return F.regexp_extract(text, _LENIENT, i).try_cast("bigint")

    numbers = [part(i) for i in range(1, 7)]
    small = F.coalesce(F.greatest(*numbers) < _LARGEST, F.lit(False))
    for number in numbers:
        small = small & number.isNotNull()
    # Months, days, hours, ... out of range roll over into the next unit.
    months = numbers[0] * 12 + numbers[1] - 1
    year = F.floor(months / 12)
    date = F.make_date(year.cast("int"), (months % 12 + 1).cast("int"), F.lit(1))
    days = F.unix_date(date).cast("bigint") + numbers[2] - 1
    seconds = days * ONE_DAY + numbers[3] * 3600 + numbers[4] * 60 + numbers[5]
    held = F.when(small & year.between(1, 9999), seconds)
    return F.when(held.between(_FIRST_SECOND, _LAST_SECOND), F.timestamp_seconds(held))


def out_of_range(text: Column) -> Column:
    """Whether a time reads, but lies outside the years 1 to 9999."""
    strict = F.try_to_timestamp(text, F.lit(SECOND_FORMAT))
    return strict.isNull() & rarely(
        text, lambda t: t.rlike(_LENIENT) & _lenient_timestamp(t).isNull()
    )


def parse_timestamp(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text as a timestamp. Short numbers, values that
    roll over and trailing text are accepted; text that cannot be read at all
    becomes the epoch, so its row is kept and lands in the 1970 bucket."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(SECOND_FORMAT)),
        rarely(text, _lenient_timestamp),
        F.timestamp_seconds(F.lit(0)),
    )


def parse_millis(text: Column) -> Column:
    return F.unix_millis(parse_timestamp(text))


def bucket_start(ts: Column, seconds: int = TEN_MINUTES) -> Column:
    """Start of the tumbling bucket holding ``ts`` (epoch-aligned)."""
    return F.timestamp_millis(floor_millis(F.unix_millis(ts), seconds * 1000))


def bucket_end(ts: Column, seconds: int = TEN_MINUTES) -> Column:
    """End of that bucket, which is the start of the next one."""
    return F.timestamp_millis(next_millis(F.unix_millis(ts), seconds * 1000))


def label(ts: Column, kind: str = "minute") -> Column:
    """Text label of a time; ``kind`` is day, hour or minute."""
    return F.date_format(ts, _format(kind))


def label_time(text: Column, kind: str = "minute") -> Column:
    """Time of a label, NULL when the text does not match its kind."""
    return F.try_to_timestamp(text, F.lit(_format(kind)))


def label_parts(text: Column, kind: str = "minute") -> dict[str, Column]:
    """Zero-padded year, month, day, hour and minute text of a label. An hour
    label has minute ``0``."""
    if kind not in ("hour", "minute"):
        raise ValueError(f"label kind must be hour or minute, not {kind!r}")
    ts = label_time(text, kind)
    parts = {
        "year": pad_two(F.year(ts)),
        "month": pad_two(F.month(ts)),
        "day": pad_two(F.dayofmonth(ts)),
        "hour": pad_two(F.hour(ts)),
        "minute": pad_two(F.minute(ts)),
    }
    if kind == "hour":
        parts["minute"] = F.when(ts.isNotNull(), "0")
    return parts


def pad_two(number: Column) -> Column:
    """A number as text of two digits or more."""
    text = number.cast("string")
    return F.when(number < 10, F.concat(F.lit("0"), text)).otherwise(text)


def hour_of(ts: Column) -> Column:
    """The hour a time belongs to."""
    return F.date_trunc("hour", ts)


def current_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def current_day() -> Column:
    return F.date_format(F.current_timestamp(), DAY_LABEL)


def _format(kind: str) -> str:
    if kind not in LABEL_FORMATS:
        raise ValueError(f"unknown label kind {kind!r}, use one of {sorted(LABEL_FORMATS)}")
    return LABEL_FORMATS[kind]
