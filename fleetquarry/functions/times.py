"""Zone-less times: shifts, windows, and text in several layouts.

All times are TIMESTAMP_NTZ, so no result depends on the session's time zone. "Now" is an
argument everywhere; a job passes its own start time and a rerun gives the same rows.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetquarry.functions.text import ColumnOrName, as_column, plain

NTZ = "timestamp_ntz"
Moment = datetime | date | str | Column

# three numbers, perhaps a clock time and a half of the day; the groups are reordered to ISO
_WRITTEN = (
    r"^\s*(\d{1,2})[-./](\d{1,2})[-./](\d{1,4})"
    r"(?:\s+(\d{1,2}:\d{1,2}(?::\d{1,2}(?:[.]\d{1,6})?)?)\s*([AaPp][Mm])?)?\s*$"
)


def moment(value: Moment) -> Column:
    """A point in time as a TIMESTAMP_NTZ column; texts and datetimes fold to a literal."""
    if isinstance(value, Column):
        return value.cast(NTZ)
    return F.lit(str(value)).cast(NTZ)


def shift_hours(value: ColumnOrName, hours: int = 3) -> Column:
    """A fixed offset from UTC, without daylight rules."""
    return as_column(value).cast(NTZ) + F.make_dt_interval(F.lit(0), F.lit(hours))


def day_of(value: ColumnOrName) -> Column:
    return as_column(value).cast("date").cast(NTZ)


def hour_of(value: ColumnOrName) -> Column:
    return day_of(value) + F.make_dt_interval(F.lit(0), F.hour(as_column(value).cast(NTZ)))


def days_before(as_of: Moment, days: int) -> Column:
    return moment(as_of) - F.make_dt_interval(F.lit(days))


def days_after(as_of: Moment, days: int) -> Column:
    return moment(as_of) + F.make_dt_interval(F.lit(days))


def on_day(value: ColumnOrName, day: Moment) -> Column:
    """Within the 24 hours after ``day``, open at both ends."""
    value = as_column(value)
    return (value > moment(day)) & (value < days_after(day, 1))


def parse_mixed(value: ColumnOrName, short_years: bool = True) -> Column:
    """A time from text whose layout its punctuation tells.

    ``yy.MM.dd`` when a two-digit last part precedes a blank (only with ``short_years``),
    day-month-year without a slash, month/day/year with one. Anything else is NULL. Each row
    costs one replacement into ISO text and one cast.
    """
    text = plain(value)
    order = F.when(text.contains("/"), F.lit("$3-$1-$2 $4 $5")).otherwise(F.lit("$3-$2-$1 $4 $5"))
    if short_years:
        # two digits: 00-49 are this century, 50-99 the last one
        century = F.when(F.ltrim(text) < "5", F.lit("20")).otherwise(F.lit("19"))
        short = F.concat(century, F.lit("$1-$2-$3 $4 $5"))
        order = F.when(text.contains(".") & text.rlike("[.].. "), short).otherwise(order)
    iso = F.regexp_replace(text, F.lit(_WRITTEN), order)
    hour = F.regexp_extract(text, r"\s(\d{1,2}):", 1).try_cast("int")
    lettered = text.contains("m") | text.contains("M")  # spares most texts the patterns
    afternoon = text.rlike(r"(?i)pm\s*$")
    shift = F.when(afternoon & (hour < 12), F.lit(12)).when(~afternoon & (hour == 12), F.lit(-12))
    halved = F.regexp_replace(iso, "(?i)[ap]m$", "").try_cast(NTZ) + F.make_dt_interval(
        F.lit(0), F.coalesce(shift, F.lit(0))
    )
    time = F.when(lettered & text.rlike(r"(?i)[ap]m\s*$"), halved).otherwise(iso.try_cast(NTZ))
    # text of another shape comes through the replacement as it was; a cast could read some
    return F.when(text.rlike(r"^\s*\d{1,2}[-./]"), time)


def parse_compact_day(value: ColumnOrName) -> Column:
    """The day of ``yyyyMMdd...``; NULL for anything else."""
    text = plain(value)
    iso = F.concat(F.left(text, F.lit(4)), F.lit("-"), F.substring(text, 5, 2), F.lit("-"), F.substring(text, 7, 2))
    return F.when(text.rlike(r"^\d{8}"), iso).try_cast("date").cast(NTZ)


def parse_iso_day(value: ColumnOrName) -> Column:
    """The day of ``yyyy-MM-dd...``; NULL for anything else."""
    return F.left(plain(value), F.lit(10)).try_cast("date").cast(NTZ)


def minute_text(value: ColumnOrName) -> Column:
    return _rearranged(value, r"\d\d:\d\d")


def second_text(value: ColumnOrName) -> Column:
    return _rearranged(value, r"\d\d:\d\d:\d\d")


def _rearranged(value: ColumnOrName, clock: str) -> Column:
    """``dd.MM.yyyy`` and a clock time from the text form, which no time zone touches."""
    iso = as_column(value).cast(NTZ).cast("string")
    return F.regexp_replace(iso, rf"^(\d+)-(\d\d)-(\d\d) ({clock}).*$", "$3.$2.$1 $4")
