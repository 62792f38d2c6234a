"""Field extraction from message and dimension lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_fields(value: Column, *fields: str) -> Column:
    """Named fields of a JSON object as text, in one pass over the text.

    Numbers come back as their text, an absent field or JSON null as NULL, and a
    text that is no JSON object as NULL in every field. It is a generator, so
    filters on the fields are not copied below it and the text is parsed once.
    """
    return F.json_tuple(value, *fields)


def is_one_object(value: Column) -> Column:
    """Whether a text that begins with a JSON object holds nothing behind it.

    Spark's JSON readers take the first object of a text and leave the rest. As the only element of a list, and as the only
    field of an object, a text has to be read whole: what could end one of them early can't end the other.
    A text with one pair of braces can't hold more, and only others are parsed again. A text with
    braces inside that has a key twice isn't one object either.
    """
    flat = value.rlike(r"^\s*\{[^{}]*+\}\s*$")
    listed = F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))
    held = F.try_parse_json(F.concat(F.lit('{"x":'), value, F.lit("}")))
    alone = listed.isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull() & held.isNotNull()
    return F.when(flat, True).otherwise(alone)


def word(line: Column, position: int) -> Column:
    """Word at a position (from 0) of a line split on single spaces, or NULL."""
    return F.get(F.split(line, " "), F.lit(position))


def display_key(*parts: Column) -> Column:
    """Parts joined with a dash, for showing; group by the parts themselves."""
    return F.concat_ws("-", *[part.cast("string") for part in parts])
