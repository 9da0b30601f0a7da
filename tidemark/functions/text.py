"""Delimited fields and words."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_GAP = "[ \\t\\r\\n]+"


def field(line: Column, position: int, delimiter: str = ",") -> Column:
    """Field of a delimited line, counted from 0; null if the line is too short."""
    return F.get(F.split(line, re.escape(delimiter)), F.lit(position))


def joined_key(*parts: Column, separator: str = ":") -> Column:
    return F.concat_ws(separator, *parts)


def words(text: Column) -> Column:
    """All words of a text, in order, as an array."""
    return F.array_remove(F.split(text, WORD_GAP), "")
