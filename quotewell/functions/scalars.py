"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters counted as white space when labels are stripped.
WHITESPACE = "".join(char for char in map(chr, range(0x3001)) if char.isspace())
# A time of day behind a date: cut off, since prices are kept per day.
TIME_OF_DAY = r"[T ]\s*\d{1,2}:\d{2}(:\d{2}([.,]\d+)?)?\s*([AaPp][Mm]|Z|[+-]\d{2}:?\d{2})?$"
# A day's name before a date and the ending of an ordinal: dropped. "Sept" is brought to "Sep".
WEEKDAY_NAME = r"(?i)^(mon|tues?|wed(nes)?|thu(rs?)?|fri|sat(ur)?|sun)(day)?[,.]?\s+"
ORDINAL = r"(?i)\b(\d{1,2})(st|nd|rd|th)\b"
SEPT = r"(?i)\bsept\b"
SEPARATORS = r"[\s,./-]+"
# Two-digit years: from this one on in the 20th century, below it in the 21st.
CENTURY_PIVOT = 69
# The notations accepted for a number; anything else is missing.
_NUMBER = r"\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*"
NUMBER_PATTERN = f"^{_NUMBER}$"

MICROS_PER_DAY = 86_400_000_000


def normalise_name(name: str) -> str:
    """Header text as a column name: stripped, lower case, blanks to underscores, no dots."""
    return name.strip().lower().translate({ord(" "): "_", ord("."): None})


def strip(column: Column) -> Column:
    return F.btrim(column, F.lit(WHITESPACE))


def to_number(column: Column) -> Column:
    """Text to double; text that is not a plain number becomes NULL, never NaN."""
    return F.when(column.rlike(NUMBER_PATTERN), column.try_cast("double"))


def all_numbers(*columns: str) -> Column:
    """Every column holds a plain number; one match per row instead of one per column."""
    pattern = "^" + r"\|".join([_NUMBER] * len(columns)) + "$"
    return F.concat_ws("|", *columns).rlike(pattern)


def to_date(column: Column, formats: Iterable[str]) -> Column:
    """Text to date by the first format that fits, without a time of day; NULL when none does.

    Formats with a month name are tried on texts with letters only, the others on texts without:
    a text that fits no format costs few attempts. Month names are English, in either case.
    """
    day = strip(column)
    day = F.when(day.contains(":"), F.regexp_replace(day, TIME_OF_DAY, "")).otherwise(day)
    words = F.regexp_replace(F.regexp_replace(day, WEEKDAY_NAME, ""), ORDINAL, "$1")
    words = F.btrim(F.regexp_replace(F.regexp_replace(words, SEPT, "Sep"), SEPARATORS, " "))

    def first_fit(text: Column, chosen: list[str]) -> Column:
        return F.coalesce(*[parse_day(text, fmt) for fmt in chosen], F.lit(None).cast("date"))

    formats = list(formats)
    named = [fmt for fmt in formats if "MMM" in fmt]
    plain = [fmt for fmt in formats if "MMM" not in fmt]
    return F.when(day.rlike("[A-Za-z]"), first_fit(words, named)).otherwise(first_fit(day, plain))


def parse_day(text: Column, fmt: str) -> Column:
    """Text to date by one format; two-digit years are those from 1969 to 2068."""
    day = F.try_to_date(text, fmt)
    if re.search("y+", fmt).group() != "yy":
        return day
    # The parser puts two-digit years into 2000 to 2099.
    late = F.year(day) >= 2000 + CENTURY_PIVOT
    return F.when(late, F.add_months(day, -1200)).otherwise(day)


def equals_ignoring_case(column: Column, text: str) -> Column:
    """True or false, never NULL, so that it can be negated without losing NULL labels."""
    return F.lower(column).eqNullSafe(F.lit(text.lower()))


def round_half_up(column: Column, digits: int) -> Column:
    """Round to ``digits`` after removing float noise beyond the 8th decimal.

    Two engines that sum in different orders differ in the last bits, so an exact tie such as
    0.125 may arrive as 0.12499999999999997. Rounding to 8 decimals first restores the tie.
    """
    fine = F.rint(column * 1e8) / 10.0 ** (8 - digits)
    return F.floor(fine + 0.5) / 10.0**digits


def round_shortest(column: Column, digits: int, half: str = "even") -> Column:
    """Round on the shortest decimal text of a double: ties to the even digit, or away from zero.

    2.675 is a tie here, as it is written, though the double lies just below it. The text is an
    exact decimal of up to 38 digits; doubles that do not fit one keep their value, since they are
    far above 10^15 and have no decimals, and missing, NaN and infinite values stay as they are.
    """
    if half not in ("even", "up"):
        raise ValueError(f"half is 'even' or 'up', not {half!r}")
    number = column.cast("double")
    exact = F.when(F.abs(number) < 1e15, number.cast("string").try_cast("decimal(38,22)"))
    turn = F.bround if half == "even" else F.round
    return F.coalesce(turn(exact, digits).cast("double"), number)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({name: round_half_up(F.col(name), digits) for name in columns})


def month_sin(date: Column) -> Column:
    return F.sin(F.month(date) * (2 * math.pi) / 12)


def month_cos(date: Column) -> Column:
    return F.cos(F.month(date) * (2 * math.pi) / 12)


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM").cast("date")


def date_micros(date: Column) -> Column:
    """Midnight of the date in microseconds since 1970, independent of the session time zone."""
    return F.unix_date(date).cast("bigint") * MICROS_PER_DAY


def micros_to_date(micros: Column) -> Column:
    return F.date_from_unix_date(F.floor(micros / MICROS_PER_DAY).cast("int"))


def close_to(left: Column, right: Column, tolerance: float) -> Column:
    return F.abs(left - right) < tolerance


def percent_change(new: Column, old: Column) -> Column:
    return F.try_divide(new - old, old) * 100
