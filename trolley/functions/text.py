"""Text to number and text to time, with the reading rules of the event producers.

The common spellings take the engine's native casts; patterns only guard what a cast would accept
too much of.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters stripped from the ends of a number, and of any other text.
NUMBER_WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE = NUMBER_WHITESPACE + "\x1c\x1d\x1e\x1f"

# The number and time spellings accepted.
DIGITS = r"\d+(?:_\d+)*"
NUMBER = rf"[+-]?(?:{DIGITS}\.?(?:{DIGITS})?|\.{DIGITS})(?:[eE][+-]?{DIGITS})?"
NOT_FINITE = r"[+-]?(?i:nan|inf|infinity)"
YEAR = r"(?!0000)\d{4}"
CLOCK_TEXT = rf"^{YEAR}-\d\d-\d\d \d\d:\d\d:\d\d$"
LOOSE_CLOCK_TEXT = rf"^{YEAR}-\d{{1,2}}-\d{{1,2}}[{WHITESPACE}]+\d{{1,2}}:\d{{1,2}}:\d{{1,2}}$"
TWO_PARTS = rf"^[^{WHITESPACE}]+[{WHITESPACE}]+[^{WHITESPACE}]+$"

#: The first DOUBLE beyond BIGINT; a cast alone would cut it to the largest BIGINT.
BIGINT_END = float(1 << 63)


def trim_all(text: Column) -> Column:
    """Strip every kind of whitespace, not only spaces."""
    return F.btrim(text, F.lit(WHITESPACE))


def to_double(text: Column) -> Column:
    """Text to DOUBLE; NaN and infinities are values, anything else malformed is NULL."""
    bare = F.btrim(text, F.lit(NUMBER_WHITESPACE))
    spelled = bare.rlike(rf"^(?:{NUMBER}|{NOT_FINITE})$")
    # The cast knows nan without a sign only.
    unsigned = F.regexp_replace(F.translate(bare, "_", ""), r"^[+-](?i:(nan))$", "$1")
    return F.when(spelled, unsigned.try_cast("double"))


def double_to_bigint(number: Column) -> Column:
    """Cut the fraction; NULL for NaN, infinities and what does not fit."""
    return F.when(number < BIGINT_END, number.try_cast("bigint"))


def id_to_bigint(text: Column) -> Column:
    """JSON id text to BIGINT: exact for integers, through DOUBLE for spellings like 5.0."""
    return F.coalesce(text.try_cast("bigint"), double_to_bigint(text.try_cast("double")))


def bare_time(event_time: Column) -> Column:
    """The time text without zone suffix and padding."""
    return trim_all(F.replace(event_time, F.lit(" UTC"), F.lit("")))


def has_time_shape(event_time: Column) -> Column:
    """True if the text is exactly two whitespace-separated parts; missing text is not."""
    return F.coalesce(bare_time(event_time).rlike(TWO_PARTS), F.lit(False))


def to_event_ts(event_time: Column) -> Column:
    """``YYYY-M-D H:M:S`` (optional `` UTC``) to a timestamp; NULL if it is no real time."""
    bare = bare_time(event_time)
    one_space = F.regexp_replace(bare, rf"[{WHITESPACE}]+", " ")
    return F.when(bare.rlike(CLOCK_TEXT), bare.try_cast("timestamp")).when(
        bare.rlike(LOOSE_CLOCK_TEXT), F.try_to_timestamp(one_space, F.lit("y-M-d H:m:s"))
    )


def epoch_ms(ts: Column) -> Column:
    """Timestamp (with or without zone) to epoch milliseconds."""
    return F.unix_millis(ts.cast("timestamp"))


def ms_to_ntz(ms: Column) -> Column:
    """Epoch milliseconds to a zone-free timestamp."""
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def once(columns: list[Column]) -> Column:
    """Columns worked out once per row, however many filters and projections use them later.

    Plain projections are copied into every later filter by the optimizer; the output of a
    generator is not.
    """
    return F.inline(F.array(F.struct(*columns)))
