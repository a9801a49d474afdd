"""Text to typed values, with bad text turning into NULL instead of failing the job.

The casts follow Spark's non-ANSI rules and give the same result whether or not the session runs
in ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters removed at both ends where the contract trims all whitespace (fixed values:
# the Unicode whitespace set).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# What a cast from text ignores at both ends: ASCII control characters and the space.
_CAST_PADDING = "".join(chr(code) for code in range(33)) + "\x7f"

_WHOLE_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]*)$"
_DECIMAL_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_INFINITE = r"^[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?$"

# Largest millisecond count whose microseconds still fit a timestamp.
_MAX_MILLIS = 9_223_372_036_854_775


def strip(text: Column) -> Column:
    """Remove all whitespace, not only spaces, at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def stripped_double(text: Column) -> Column:
    """Keep digits and dots only, then read a double; signs and group marks vanish."""
    return F.regexp_replace(text.cast("string"), "[^0-9.]", "").try_cast("double")


def whole_number(text: Column, kind: str = "int") -> Column:
    """Integer part of plain decimal text; exponents, overflow and other text give NULL."""
    trimmed = F.btrim(text.cast("string"), F.lit(_CAST_PADDING))
    digits = F.regexp_extract(trimmed, r"^([+-]?[0-9]+)", 1)
    return (
        F.when(~trimmed.rlike(_WHOLE_NUMBER), None)
        .when(digits == "", F.lit(0).cast(kind))
        .otherwise(digits.try_cast(kind))
    )


def lenient_date(text: Column) -> Column:
    return text.try_cast("date")


def lenient_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp")


def blank_to_null(text: Column) -> Column:
    """Trim spaces; nothing left gives NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def epoch_millis(text: Column) -> Column:
    """Milliseconds since the epoch as bigint, held inside the timestamp range."""
    millis = whole_number(text, "bigint")
    return F.when(
        millis.isNotNull(),
        F.greatest(F.least(millis, F.lit(_MAX_MILLIS)), F.lit(-_MAX_MILLIS)),
    )


def market_segment(business: Column, usage: Column) -> Column:
    """``{BUSINESS}_RESIDENTIAL``, ``{BUSINESS}_COMMERCIAL`` or ``OTHER``."""
    business = F.upper(strip(F.coalesce(business.cast("string"), F.lit("None"))))
    usage = F.upper(strip(F.coalesce(usage.cast("string"), F.lit("None"))))
    business = F.when(business == "SELL", F.lit("SALE")).otherwise(business)
    return F.when(
        usage.isin("RESIDENTIAL", "COMMERCIAL"), F.concat(business, F.lit("_"), usage)
    ).otherwise(F.lit("OTHER"))


def _decimal_text(text: Column) -> Column:
    trimmed = strip(text.cast("string"))
    return F.when(trimmed.rlike(_DECIMAL_NUMBER), trimmed.try_cast("double"))


def finite_double(value: Column) -> Column:
    """A finite double, or NULL for text that is no number, NaN and the infinities."""
    number = _decimal_text(value)
    return F.when(F.abs(number) < float("inf"), number)


def coordinate_or_zero(value: Column) -> Column:
    """A double where the text is a number (infinities included), otherwise 0.0."""
    trimmed = strip(value.cast("string"))
    signed = F.when(trimmed.startswith("-"), float("-inf")).otherwise(float("inf"))
    infinite = F.when(trimmed.rlike(_INFINITE), signed)
    return F.coalesce(_decimal_text(value), infinite, F.lit(0.0))
