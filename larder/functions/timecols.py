"""Timestamp parsing and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The timestamp text layout, and the time-of-day slots as [start, end) hours;
# every other hour (14-16, 21-5) and a missing hour is "Night".
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_SLOTS = (("Morning", 6, 11), ("Noon", 11, 14), ("Evening", 17, 21))
OTHER_SLOT = "Night"

# The lenient parser's layouts (own choice): a date as year-month-day (``-`` or ``/``, one or two
# digits), as eight digits or as month/day/year, then optionally a time of day with seconds, a
# fraction of 1 to 9 digits and a zone.  Wall-clock time is kept, the zone is not applied.
# Groups 1-3, 4-6 (eight digits) and 7-9 (month first) are the date, 10-13 hour, minute, second, fraction.
_LAYOUT = (r"^\s*(?:(\d{4})[-/](\d{1,2})[-/](\d{1,2})|(\d{4})(\d{2})(\d{2})(?=\D|$)|(\d{1,2})/(\d{1,2})/(\d{4})(?=\D|$))"
           r"(?:(?:T|\s+)(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,9}))?)?\s*(?:Z|[+-]\d{2}:?\d{2})?)?\s*$")
_CUT = "\u0001"
_CUT_PARTS = _CUT + _CUT.join(("$1$4$9", "$2$5$7", "$3$6$8", "$10", "$11", "$12", "$13"))


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _parse_ntz(c: Column, fmt: str) -> Column:
    """``to_timestamp_ntz`` reads the wall-clock time directly (no session time zone, so no
    shift inside a daylight-saving gap) but raises on bad text under ANSI mode; the
    ``try_to_timestamp`` test in front makes bad text NULL instead."""
    return F.when(F.try_to_timestamp(c, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(c, F.lit(fmt)))


def parse_timestamp(col: Column | str, fmt: str = TIMESTAMP_FORMAT, text: bool = True) -> Column:
    """Text in ``fmt`` -> TIMESTAMP_NTZ (wall-clock time, no zone); anything else -> NULL.
    ``text=False`` is for a DATE or timestamp input, whose wall-clock time is kept as it is."""
    return _parse_ntz(_col(col), fmt) if text else _col(col).cast("timestamp_ntz")


def lenient_timestamp(col: Column | str) -> Column:
    """Text in any of the layouts above -> TIMESTAMP_NTZ; unknown layout or invalid value -> NULL."""
    c = _col(col)
    # one pass of the pattern cuts a text into its parts; a text of no known layout stays as it is
    cut = F.regexp_replace(c, F.lit(_LAYOUT), F.lit(_CUT_PARTS))
    part = F.split(cut, _CUT)
    year, month, day, hour, minute, second = (F.coalesce(F.get(part, F.lit(i)).try_cast("int"), F.lit(0)) for i in range(1, 7))
    fraction = F.substring(F.rpad(F.get(part, F.lit(7)), 6, "0"), 1, 6)
    seconds = F.concat(second.cast("string"), F.lit("."), fraction).try_cast("decimal(16,6)")
    # year 0 and second 60 are no wall-clock time
    good = (cut != c) & (year > 0) & (second < 60)
    return F.when(good, F.try_make_timestamp_ntz(year, month, day, hour, minute, seconds))


def time_slot(hour: Column | str) -> Column:
    """Hour of day -> slot name (``TIME_SLOTS``); all other hours and NULL -> Night."""
    h = _col(hour)
    out = None
    for name, start, end in TIME_SLOTS:
        cond = (h >= start) & (h < end)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(OTHER_SLOT))


def month_key(col: Column | str) -> Column:
    """Date -> ``yyyyMM`` text, the month partition key of forecast tables."""
    return F.date_format(_col(col), "yyyyMM")


def calendar_columns(col: Column | str, weekday: bool = False) -> dict[str, Column]:
    """Model calendar features: month (1-12), day of year (1-366) and, optionally,
    weekday with Monday = 0."""
    c = _col(col)
    out = {"month": F.month(c), "day_of_year": F.dayofyear(c)}
    if weekday:
        out["weekday"] = F.weekday(c)
    return out
