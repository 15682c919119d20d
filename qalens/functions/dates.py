"""Date parsing and calendar labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from qalens._columns import as_col

# Calendar grains accepted by the period operators (Spark datetime patterns).
GRAINS = {
    "year": "yyyy",
    "month": "yyyy-MM",
    "day": "yyyy-MM-dd",
}

# Timestamp text layouts accepted from exports. A date, alone or followed by
# 'T' or a space and hours and minutes, with optional seconds, 1 to 9 fraction digits
# (microseconds are kept) and a trailing 'Z'.
SOURCE_TIMESTAMP_REGEX = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-5][0-9](\.[0-9]{1,9})?)?Z?)?$"
)


def parse_timestamp(
    c: str | Column, formats: tuple[str, ...] | list[str] | None = None
) -> Column:
    """Text to ``timestamp_ntz``; anything else becomes NULL, never an error.

    Default: the layouts of :data:`SOURCE_TIMESTAMP_REGEX`, as wall-clock time: text of such a
    layout, less a trailing 'Z', is cast to a time without zone, so the answer does not depend
    on the session time zone (a time in a daylight-saving gap is kept as written). Impossible
    dates (2019-02-29, month 13) and partial text such as '2011' are NULL (the cast alone
    would read '2011' as 2011-01-01).

    ``formats``: Spark datetime patterns tried in order; these parse in the
    session time zone and are then taken as wall-clock time.
    """
    text = as_col(c)
    if formats:
        attempts = [F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats]
        return (attempts[0] if len(attempts) == 1 else F.coalesce(*attempts)).cast("timestamp_ntz")
    bare = F.rtrim(text, F.lit("Z"))
    return F.when(text.rlike(SOURCE_TIMESTAMP_REGEX), bare.try_cast("timestamp_ntz"))


# Units by which a grain's groups are formed before they are labelled.
_TRUNC = {"yyyy": "year", "yyyy-MM": "month", "yyyy-MM-dd": "day"}


def period_start(c: str | Column, grain: str = "yyyy") -> Column | None:
    """The first day of a time's period, as a date; None for a grain that is not one of
    :data:`GRAINS`. Grouping on it and labelling the few groups afterwards
    (``period_label`` of the date is that of the time) spares a text per row."""
    unit = _TRUNC.get(GRAINS.get(grain, grain))
    if unit is None:
        return None
    day = as_col(c).cast("date")
    return day if unit == "day" else F.trunc(day, unit)


def in_years(c: str | Column, years: Sequence[str | int]) -> Column:
    """Whether a time lies in one of the calendar years, as ranges of the time itself
    (consecutive years are one range), so that nothing is formatted per row. NULL: false."""
    wanted = sorted({int(y) for y in years})
    first = [y for y in wanted if y - 1 not in wanted]
    last = [y for y in wanted if y + 1 not in wanted]
    ts, out = as_col(c), F.lit(False)
    for lo, hi in zip(first, last):
        begin, end = (F.lit(f"{y:04d}-01-01 00:00:00").cast("timestamp_ntz") for y in (lo, hi + 1))
        out = out | ((ts >= begin) & (ts < end))
    return F.coalesce(out, F.lit(False))


def period_label(c: str | Column, grain: str = "yyyy") -> Column:
    """Calendar label as text ('2019', '2019-03', '2019-03-01'); NULL stays NULL."""
    pattern = GRAINS.get(grain, grain)
    return F.date_format(as_col(c), pattern)
