"""Lenient parsing, relabelling and calendar expressions.

All of these are built-in expressions, so a whole cleaning pass stays inside
one code-generated projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first and last day that a nanosecond timestamp can hold.
FIRST_DATE, LAST_DATE = "1677-09-21", "2262-04-11"

MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
SEASONS = ("Spring", "Summer", "Fall", "Winter")


def any_date(col: Column, formats: Sequence[str] = ()) -> Column:
    """Text as a date of any year: ISO, then `formats`, then a spreadsheet serial.

    Five or six digits are a serial and not a year; eight are a date without
    dashes, if a format says so.
    """
    serial = col.rlike("^[0-9]{5,6}$")
    parsed = F.when(~serial, col.try_cast("date"))
    for fmt in formats:
        parsed = F.coalesce(parsed, F.try_to_timestamp(col, F.lit(fmt)).cast("date"))
    return F.coalesce(parsed, F.when(serial, serial_date(col.try_cast("double"))))


def lenient_date(
    col: Column, formats: Sequence[str] = (), first: str = FIRST_DATE, last: str = LAST_DATE
) -> Column:
    """`any_date` between `first` and `last`, null when it does not parse or lies outside."""
    parsed = any_date(col, formats)
    return F.when(parsed.between(F.lit(first).cast("date"), F.lit(last).cast("date")), parsed)


def serial_date(col: Column) -> Column:
    """A bare number in a date column, read as nanoseconds since the epoch.

    Spreadsheet serials therefore land in 1970, which the sentinel rule nulls.
    """
    return F.timestamp_micros(F.floor(col / 1000).cast("bigint")).cast("date")


def null_sentinel_year(date: Column, year: int | None) -> Column:
    """Null the dates of the year that marks a corrupt value."""
    return date if year is None else F.when(F.year(date) != F.lit(year), date)


def lenient_long(col: Column) -> Column:
    """Parse to bigint; whole numbers written as decimals count, other text is null."""
    number = col.try_cast("double")
    return F.coalesce(
        col.try_cast("bigint"), F.when(number == F.rint(number), number.try_cast("bigint"))
    )


def relabel(col: Column, labels: Mapping, keep_unmapped: bool) -> Column:
    """Dictionary lookup; unmapped values stay as they are or turn null."""
    if not labels:
        return col if keep_unmapped else F.lit(None).cast("string")
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), col)
    return F.coalesce(found, col) if keep_unmapped else found


def clock_text(col: Column, fmt: str = "H:m:s") -> Column:
    """A time of day as `HH:mm`, null when it does not parse."""
    return F.date_format(F.try_to_timestamp(col, F.lit(fmt)), "HH:mm")


def clock_hour(hhmm: Column) -> Column:
    return F.split_part(hhmm, F.lit(":"), F.lit(1)).try_cast("int")


def day_half(hhmm: Column) -> Column:
    """AM before noon, PM otherwise; an unknown time counts as PM."""
    return F.when(clock_hour(hhmm) < 12, F.lit("AM")).otherwise(F.lit("PM"))


def month_name(date: Column) -> Column:
    """English month name; a lookup is several times cheaper per row than a date formatter.

    The `try_` form matters: in ANSI mode the plain one is planned as never
    null, whatever the index, and an unknown date would get a month.
    """
    return F.try_element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(date))


def season_of(month: Column) -> Column:
    """Northern meteorological season; null month gives null."""
    return (
        F.when(month.isin(12, 1, 2), F.lit("Winter"))
        .when(month.isin(3, 4, 5), F.lit("Spring"))
        .when(month.isin(6, 7, 8), F.lit("Summer"))
        .when(month.isNotNull(), F.lit("Fall"))
    )


def shift_years(date: Column, years: int) -> Column:
    """Move a date by whole years; 29 February becomes the 28th in a common year."""
    return F.add_months(date, 12 * years)


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Whether the lower-cased text holds any of the words as a substring."""
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w)) for w in words])
