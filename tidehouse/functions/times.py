"""Event-time helpers; text is read and written in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidehouse.schemas import DAY_FORMAT, SECOND_FORMAT


def date_id(text: Column) -> Column:
    """Day of a date-time text; null when it cannot be read."""
    return F.date_format(F.try_to_timestamp(text), DAY_FORMAT)


def day_of(ts: Column) -> Column:
    return F.date_format(ts, DAY_FORMAT)


def second_text(ts: Column) -> Column:
    return F.date_format(ts, SECOND_FORMAT)


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def from_epoch_ms_whole_seconds(ms: Column) -> Column:
    """Timestamp of epoch milliseconds cut to the second."""
    return F.timestamp_seconds(F.call_function("div", ms, F.lit(1000)))


def epoch_ms(text: Column, full: bool = True) -> Column:
    """Epoch milliseconds of a date-time text, or of midnight of a date text."""
    whole = text if full else F.concat(text, F.lit(" 00:00:00"))
    return F.unix_millis(F.try_to_timestamp(whole, F.lit(SECOND_FORMAT)))


def epoch_day(ms: Column) -> Column:
    return day_of(from_epoch_ms(ms))


def epoch_second_text(ms: Column) -> Column:
    return second_text(from_epoch_ms(ms))


def fractional_epoch_ms(text: Column) -> Column:
    """Epoch milliseconds of ``yyyy-MM-dd HH:mm:ss[.f]Z`` with one to three fraction digits.

    A fraction is a decimal fraction, so ``.04Z`` is 40 ms; a missing one is 0.
    """
    bare = F.rtrim(text, F.lit("Z"))
    fraction = F.rpad(F.split_part(bare, F.lit("."), F.lit(2)), 3, "0").cast("int")
    return epoch_ms(F.split_part(bare, F.lit("."), F.lit(1))) + fraction


def compare_fractional(left: Column, right: Column) -> Column:
    """-1, 0 or 1 as ``left`` is before, equal to or after ``right``."""
    gap = fractional_epoch_ms(left) - fractional_epoch_ms(right)
    return F.signum(gap).cast("int")


def proc_time_columns() -> list[Column]:
    """Processing-time columns; one value for a whole batch or micro-batch."""
    return [
        F.unix_timestamp().alias("unix_s"),
        F.current_timestamp().alias("row_op_ts"),
        F.unix_millis(F.current_timestamp()).alias("now_ms"),
    ]
