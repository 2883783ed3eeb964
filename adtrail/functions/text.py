"""Text predicates and normalisers: blanks, ids, hour windows, timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adtrail.functions.measures import as_column

SPACES = " \t\n\r\x0b\x0c"
IST_FORMAT = "yyyy-MM-dd HH:mm:ssXX"
DAY_FIRST_FORMAT = "dd/MM/yyyy HH:mm:ss"


def trimmed(value) -> Column:
    return F.btrim(as_column(value), F.lit(SPACES))


def is_blank(value, array: bool = False) -> Column:
    """Null, empty, whitespace, 'null' or 'None' (and '[]' for arrays)."""
    words = ["", "null", "None"] + (["[]"] if array else [])
    return as_column(value).isNull() | trimmed(value).isin(words)


def valid_id(value) -> Column:
    """True for ids that are present, not 'null' and not an unfilled {{placeholder}}."""
    value = as_column(value)
    return F.coalesce(~value.isin("", "null") & ~value.startswith("{{"), F.lit(False))


def is_digits(value) -> Column:
    return F.coalesce(as_column(value).rlike("^[0-9]+$"), F.lit(False))


def digits_or_null(value) -> Column:
    value = as_column(value)
    return F.when(is_digits(value), value)


def non_empty(value) -> Column:
    """The value, or null where it is the empty string."""
    return F.nullif(as_column(value), F.lit(""))


def normal_id(value) -> Column:
    """Blank becomes 'Unknown', scientific notation becomes plain digits.

    Plain digits stay text: a trip through a float would change 18-digit ids.
    """
    value = as_column(value)
    number = F.floor(value.try_cast("decimal(38,4)")).cast("string")
    return (
        F.when(value.isNull() | value.isin("", "Unknown"), "Unknown")
        .when(value.rlike(r"^\s*[+-]?\d+(\.\d*)?([eE][+-]?\d+)?\s*$") & ~is_digits(value), F.coalesce(number, value))
        .otherwise(value)
    )


def hour_label(hour) -> Column:
    """'HH:00:00 - HH:59:59' for an hour number."""
    two = F.lpad(as_column(hour).cast("string"), 2, "0")
    return F.concat(two, F.lit(":00:00 - "), two, F.lit(":59:59"))


def window_hour(text) -> Column:
    """Hour number of an hour window in any spelling; null where none is found."""
    found = F.regexp_extract(as_column(text), r"(\d{1,2})", 1)
    return F.nullif(found, F.lit("")).cast("int") % 24


def normal_hour_window(text) -> Column:
    return hour_label(window_hour(text))


_CLOCK = r"^\s*(\d{4}-\d{1,2}-\d{1,2})(?:[ T](\d{1,2}:\d{2})(:\d{2})?(\.\d{1,9})?\s*(?:Z|[+-]\d{2}:?\d{2}|[+-]\d{2})?)?\s*$"


def wall_clock(text) -> Column:
    """Timestamp text to a zone-less timestamp that keeps the wall clock it shows; null where it cannot be read.

    Seconds, fractions and the offset may be missing, ``T`` may stand for the space; a bare date is its midnight.
    """
    text = as_column(text)
    part = lambda n: F.regexp_extract(text, _CLOCK, n)
    clock = F.concat(part(1), F.lit(" "), F.coalesce(F.nullif(part(2), F.lit("")), F.lit("00:00")), F.coalesce(F.nullif(part(3), F.lit("")), F.lit(":00")), part(4))
    return F.when(part(1) != "", clock).try_cast("timestamp_ntz")


def parse_timestamp(text) -> Column:
    """Day-first or ISO text, with or without offset, to wall clock; null if neither."""
    whole = trimmed(text)
    day_first = r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})(.*)$"
    turned = F.regexp_replace(whole, day_first, "$3-$2-$1$4")
    return wall_clock(turned)
