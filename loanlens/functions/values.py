"""Turning raw text into typed values; anything unreadable becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanlens.schemas import NULL_TOKENS


# Every character that counts as white space.
WHITE_SPACE = [chr(code) for code in (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)]


def stripped(text: Column) -> Column:
    """Without leading or trailing white space of any kind, no-break spaces included.

    Most values are not padded, which a look at the two ends tells for less than a trim.  White
    space lies below the printable ASCII characters or above them, so comparing whole texts tells
    about the first; the last is taken once.
    """
    padded = (text < "!") | (text >= "\x7f") | F.substring(text, -1, 1).isin(WHITE_SPACE)
    return F.when(padded, F.btrim(text, F.lit("".join(WHITE_SPACE)))).otherwise(text)


def same_word(text: Column, word: str) -> Column:
    """Equal but for case and outer white space; an unknown is not equal.

    Only a text as long as the word, in which no character changes its length with its case, is
    worth lowering.
    """
    bare = stripped(text)
    return F.coalesce((F.length(bare) == len(word)) & (F.lower(bare) == word), F.lit(False))


def null_if_token(text: Column, tokens: list[str] | None = None, then: Column | None = None) -> Column:
    """Null for the texts that stand for a missing value (compared untrimmed), else ``then``, by default the text.

    Most values are longer than any token, which costs less to see than a look-up.
    """
    missing = tokens if tokens is not None else NULL_TOKENS
    short = F.octet_length(text) <= max((len(token.encode()) for token in missing), default=0)
    return F.when(~(short & text.isin(missing)), text if then is None else then)


def us_date(text: Column) -> Column:
    """Month/day/year text as a date."""
    return F.try_to_date(text, "M/d/yyyy")


def instant(text: Column) -> Column:
    """ISO text, with offset or without, as an instant; no offset means UTC.

    The guard keeps out bare clock times, which the cast would place on today's date.
    """
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp"))


def number(text: Column) -> Column:
    """Measure as a double; the cast passes over blanks, and not-a-number is no value."""
    return F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))


def whole_number(text: Column) -> Column:
    """Integer measure; goes through double because drifted files hold text like ``4.0``.

    A fraction is no whole number, so it gives null and is not cut off.
    """
    value = number(text)
    return F.when(value == F.floor(value), value.try_cast("bigint"))


def full_days(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded down on the instants (not on calendar days)."""
    day = F.lit(86_400_000_000)
    gap = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return ((gap - F.pmod(gap, day)) / day).cast("bigint")
