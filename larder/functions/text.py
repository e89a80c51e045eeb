"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def words(text: Column) -> Column:
    """The words of a text: split into lines, then on each single space.

    Empty words are kept, as are case and punctuation. A line end separates words exactly
    like a space does, so both splits are one: line ends become spaces by plain replacement,
    and a one-character separator spares the regular expression that would otherwise be
    compiled for every row.
    """
    space = F.lit(" ")
    for line_end in ("\r\n", "\r", "\n"):
        text = F.replace(text, F.lit(line_end), space)
    return F.split(text, " ")
