"""Scalar functions of the warehouse, as Column expressions.

Every function here is a composition of Spark built-ins so that it stays in
whole-stage codegen; none needs Python on the executors.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from fraudmart import schemas


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: _dt.datetime | str | None) -> Column:
    """A wall-clock timestamp literal (timestamp_ntz), independent of the
    session and Python time zones. ``None`` means the current instant."""
    if value is None:
        return F.localtimestamp().cast(schemas.TS)
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(value).cast(schemas.TS)


def date_lit(value: _dt.date | str | None) -> Column:
    """A date literal; ``None`` means today's UTC day (the report date)."""
    if value is None:
        value = _dt.datetime.now(_dt.timezone.utc).date()
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(value).cast("date")


def iso_date(value: _dt.date | str | None) -> str:
    """A report date as ``YYYY-MM-DD``; ``None`` means today's UTC day."""
    if value is None:
        value = _dt.datetime.now(_dt.timezone.utc).date()
    if isinstance(value, _dt.datetime):
        value = value.date()
    return value.isoformat() if isinstance(value, _dt.date) else _dt.date.fromisoformat(value[:10]).isoformat()


def full_name(last: Column | str = "last_name", first: Column | str = "first_name",
              patronymic: Column | str = "patronymic") -> Column:
    """``last || ' ' || first || ' ' || patronymic``: null when any part is null
    (concat propagates nulls, concat_ws would not)."""
    return F.concat(_c(last), F.lit(" "), _c(first), F.lit(" "), _c(patronymic))


def epoch_seconds(ts: Column | str) -> Column:
    """Whole epoch seconds of a wall-clock timestamp (fractions dropped)."""
    return F.unix_timestamp(_c(ts))


def abs_gap_seconds(a: Column | str, b: Column | str) -> Column:
    """Absolute difference in whole seconds, each side floored to the second."""
    return F.abs(epoch_seconds(a) - epoch_seconds(b))


def amount_from_text(text: Column | str) -> Column:
    """Feed amount with a decimal comma -> decimal(18,2); null when unparsable
    (``try_cast`` keeps one bad row from stopping the job)."""
    cleaned = F.regexp_replace(F.trim(_c(text)), ",", ".")
    return cleaned.try_cast(schemas.AMOUNT)


def epoch_ms_to_date(ms: Column | str) -> Column:
    """Epoch milliseconds (as a workbook date cell arrives through JSON) ->
    the UTC calendar day. Pure arithmetic, so no session zone is involved."""
    days = F.floor(_c(ms) / F.lit(86_400_000)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def excel_serial_to_date(serial: Column | str) -> Column:
    """Spreadsheet day serial (1900 date system) -> date."""
    return F.date_add(F.lit("1899-12-30").cast("date"), F.floor(_c(serial)).cast("int"))


def business_date(file_name: Column | str) -> Column:
    """Business date of a feed file, from the DDMMYYYY part of its name
    (``transactions_01032021.txt`` -> 2021-03-01); null when the name does
    not carry one."""
    digits = F.regexp_extract(_c(file_name), r"_([0-9]{8})\.[A-Za-z]+$", 1)
    return F.try_to_timestamp(F.nullif(digits, F.lit("")),
                              F.lit(schemas.FEED_DATE_FORMAT)).cast(schemas.TS)


def date_tag(d: Column | str) -> Column:
    """Date formatted as DDMMYYYY, as used in feed and report file names."""
    return F.date_format(_c(d), schemas.FEED_DATE_FORMAT)
