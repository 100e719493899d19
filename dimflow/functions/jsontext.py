"""Checks on JSON text that stay inside Spark's own JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: every character that counts as white space at the ends of a line.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def stripped(line: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.trim(line, F.lit(WHITE_SPACE))


# A JSON string; possessive, so that long strings need no deep recursion.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def _is_strict(line: Column) -> Column:
    """No single quote outside of strings and no control character inside, both of which
    Spark's JSON functions let pass."""
    outside = F.regexp_replace(line, _STRING, "")
    controls = r"[^\x00-\x1f]"
    inside = F.length(F.regexp_replace(line, controls, "")) > F.length(
        F.regexp_replace(outside, controls, "")
    )
    suspect = line.rlike(r"['\x00-\x1f]")
    return F.when(suspect, ~F.contains(outside, F.lit("'")) & ~inside).otherwise(True)


def is_one_json_value(line: Column) -> Column:
    """True when the text is exactly one JSON value, with nothing after it.

    Spark's JSON functions stop reading once a value is complete, so trailing text would go
    unnoticed. Read once as the only element of an array and once as the only member of an
    object, trailing text breaks at least one of the two.
    """
    in_array = F.json_array_length(F.concat(F.lit("["), line, F.lit("]")))
    in_object = F.json_object_keys(F.concat(F.lit('{"v":'), line, F.lit("}")))
    return F.coalesce(
        (in_array == 1) & (F.size(in_object) == 1) & _is_strict(line), F.lit(False)
    )


def is_parsed(line: Column) -> Column:
    """True for an object, an array or a string; bare numbers and words count as broken."""
    return F.substring(line, 1, 1).isin("{", "[", '"') & is_one_json_value(line)


def mentions(line: Column, key: str) -> Column:
    """Is ``key`` a member name (object), an element (array) or a part (string) of the line?"""
    first = F.substring(line, 1, 1)
    text = F.get_json_object(F.concat(F.lit("["), line, F.lit("]")), "$[0]")
    return F.coalesce(
        F.when(first == "{", F.array_contains(F.json_object_keys(line), key))
        .when(first == "[", F.array_contains(F.from_json(line, "array<string>"), key))
        .when(first == '"', F.contains(text, F.lit(key))),
        F.lit(False),
    )


def payload_field(payload: Column, name: str, kind: str) -> Column:
    """One field of a JSON sub-document; NULL when absent, malformed or of another type."""
    return F.get_json_object(payload, f"$.{name}").try_cast(kind)
