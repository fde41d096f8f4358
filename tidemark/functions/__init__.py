"""Column functions that Spark has no single built-in for."""

from tidemark.functions.columns import (  # noqa: F401
    capitalise_words,
    exists,
    first_group,
    local_date,
    local_datetime,
    local_noon,
    number_or_null,
    parse_instant,
    rounded_long,
    try_decimal,
    try_double,
)
