"""Categorical encodings: list literals, hash buckets, indicators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from seqprep.functions.cleaning import strip

# One element of a list literal. Possessive quantifiers keep matching iterative, so long texts
# cannot exhaust the regex stack.
_SINGLE = r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
_DOUBLE = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:[.][0-9]++)?+"
_TEXT = rf"(?:{_SINGLE}|{_DOUBLE})"
_ATOM = rf"(?:{_TEXT}(?:\s*+{_TEXT})*+|{_NUMBER}|None|True|False)"
_MORE = rf"(?:\s*+,\s*+{_ATOM})"
_LIST = rf"(?s)^\[\s*+(?:{_ATOM}{_MORE}*+\s*+,?+\s*+)?+\]$"
_TUPLE = rf"(?s)^\(\s*+(?:{_ATOM}(?:{_MORE}++\s*+,?+|\s*+,)\s*+)?+\)$"
# An escape of a text literal, or what lies between two.
_PIECE = r"(?s)(\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|[0-7]{1,3}|.)|[^\\]++)"
# Single-letter escapes; any other escaped character keeps its backslash.
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "b": "\b", "f": "\f", "v": "\v", "\n": "", "\\": "\\", "'": "'", '"': '"'}


def _unescaped(piece: Column) -> Column:
    """The text that one escape stands for; other pieces stay as they are."""
    rest = piece.substr(2, 9)
    number = F.when(rest.rlike("^[0-7]+$"), F.conv(rest, 8, 16)).otherwise(F.substring(rest, 2, 8))
    named = F.try_element_at(F.create_map(*[F.lit(part) for pair in _ESCAPES.items() for part in pair]), rest)
    character = F.decode(F.unhex(F.lpad(number, 4, "0")), "UTF-16BE")
    return (
        F.when(~piece.startswith("\\"), piece)
        .when(rest.rlike("^(?:[0-7]+|x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4})$"), character)
        .otherwise(F.coalesce(named, piece))
    )


def _quoted_text(token: Column) -> Column:
    """One text, or adjacent ones joined, without quotes and escapes."""
    parts = F.regexp_extract_all(token, F.lit(f"(?s)({_TEXT})"), F.lit(1))
    inner = F.transform(parts, lambda part: part.substr(F.lit(2), F.length(part) - 2))
    pieces = F.regexp_extract_all(F.array_join(inner, ""), F.lit(_PIECE), F.lit(1))
    return F.array_join(F.transform(pieces, _unescaped), "")


def _element_text(token: Column) -> Column:
    quoted = token.startswith("'") | token.startswith('"')
    fraction = token.rlike(r"^-?[0-9]+[.][0-9]+$")
    return (
        F.when(quoted, _quoted_text(token))
        .when(fraction, token.try_cast("double").cast("string"))
        .otherwise(token)
    )


def literal_list(text: Column) -> Column:
    """Trimmed upper-case elements of a list or tuple literal; anything else gives ``[]``."""
    trimmed = strip(text.cast("string"))
    tokens = F.regexp_extract_all(trimmed, F.lit(f"(?s)({_ATOM})"), F.lit(1))
    elements = F.transform(tokens, lambda token: F.upper(strip(_element_text(token))))
    is_literal = trimmed.rlike(_LIST) | trimmed.rlike(_TUPLE)
    return F.when(is_literal, F.filter(elements, lambda element: element != "")).otherwise(
        F.array().cast("array<string>")
    )


def hash_bucket(value: Column, buckets: int) -> Column:
    """First eight SHA-256 bytes of the trimmed text, unsigned, modulo ``buckets``."""
    text = F.nullif(strip(value.cast("string")), F.lit(""))
    head = F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10)
    return (head.cast("decimal(20,0)") % F.lit(buckets).cast("decimal(20,0)")).cast("int")


def indicator(condition: Column) -> Column:
    """1.0 where the condition holds, otherwise 0.0 (also when it is NULL)."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)).cast("float")


def one_of(position: Column, width: int) -> list[Column]:
    """``width`` zeros with a 1 at the zero-based position (none if NULL), as one array column.

    ``position`` should be a plain column: it is used several times.
    """
    if width == 0:
        return []

    def zeros(count) -> Column:
        return F.array_repeat(F.lit(0.0).cast("float"), count)

    position = position.cast("int")
    one = F.array(F.lit(1.0).cast("float"))
    found = F.concat(zeros(position), one, zeros(F.lit(width - 1) - position))
    return [F.when(position.isNull(), zeros(F.lit(width))).otherwise(found)]


def code_of(value: Column, codes: dict[str, int]) -> Column:
    """Fixed code of a text value, NULL when it has none."""
    pairs = [F.lit(part) for pair in codes.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), value)
