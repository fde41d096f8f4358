"""Column-to-column helpers. All of them stay inside JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters after which the warehouse's one-argument INITCAP
# starts a new word (white space counts as well). The apostrophe is not one.
WORD_DELIMITERS = r"""!?@"^#$&~_,.:;+-*%/|\[](){}<>"""

_DELIMITER_CLASS = r"[\s!?@\"^#$&~_,.:;+\-*%/|\\\[\](){}<>]"
_DECIMAL_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_INSTANT_TEXT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|z|[+-][0-9]{2}:[0-9]{2})$"
)


def capitalise_words(text: Column) -> Column:
    """Upper-case the first letter after every delimiter, lower-case the rest.

    Spark's ``initcap`` only starts words at spaces, so the text is cut behind
    each delimiter and every piece is capitalised by itself.
    """
    pieces = F.split(F.lower(text), f"(?<={_DELIMITER_CLASS})")
    capital = F.transform(
        pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))
    )
    return F.array_join(capital, "")


def first_group(text: Column, pattern: str) -> Column:
    """First capture group, null (not the empty string) when nothing matches."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))


def exists(predicate: Column) -> Column:
    """Three-valued predicate to a plain boolean: unknown counts as false."""
    return F.coalesce(predicate, F.lit(False))


def try_double(text: Column) -> Column:
    """Text to double; null unless it is a plain decimal number.

    The guard keeps out spellings Spark alone would accept, such as ``1f``.
    """
    return F.when(text.rlike(_DECIMAL_TEXT), F.trim(text).try_cast("double"))


def try_decimal(text: Column, precision: int = 6, scale: int = 1) -> Column:
    """Text to ``decimal(precision, scale)``, rounded; null when it does not fit."""
    return F.trim(text).try_cast(f"decimal({precision},{scale})")


def number_or_null(text: Column) -> Column:
    """Text to a whole number, rounded half away from zero; null when not numeric."""
    return F.trim(text).try_cast("decimal(38,0)")


def rounded_long(value: Column) -> Column:
    """Float to integer the warehouse way: half away from zero, null on overflow."""
    return F.round(value).try_cast("bigint")


def parse_instant(text: Column) -> Column:
    """ISO text with seconds and a zone to an instant; anything else is null."""
    return F.when(text.rlike(_INSTANT_TEXT), text.try_cast("timestamp"))


def local_datetime(instant: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` as a zone-less timestamp."""
    return F.convert_timezone(F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz"))


def local_date(instant: Column, zone: str) -> Column:
    """Calendar day in ``zone`` on which the instant falls."""
    return F.to_date(local_datetime(instant, zone))


def local_noon(day: Column, zone: str) -> Column:
    """Instant of twelve o'clock in ``zone`` on the given day."""
    noon = F.to_date(day).cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")
    return F.convert_timezone(F.lit(zone), F.current_timezone(), noon).cast("timestamp")
