"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fields(text: Column, sep: str) -> Column:
    """Split on one separator character.

    Empty fields at the end are dropped, those at the start or inside are kept, and
    the empty text is one empty field. ``split`` alone would keep the trailing ones.
    """
    body = F.rtrim(text, F.lit(sep))
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, sep))
    )


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units: a character beyond the basic plane counts twice."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("bigint")
