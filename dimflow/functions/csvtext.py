"""Quoted cells of CSV text. Patterns are possessive, so that long lines need no deep recursion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'


def header_names(header: Column) -> Column:
    """Column names of a CSV header row, quotes removed."""
    cells = F.regexp_extract_all(header, F.lit(r'(?:^|,)("(?:[^"]|"")*+"|[^,]*)'), F.lit(1))
    return F.transform(
        cells,
        lambda cell: F.when(
            cell.rlike('(?s)^".*"$'),
            F.replace(F.regexp_replace(cell, '^"|"$', ""), F.lit('""'), F.lit('"')),
        ).otherwise(cell),
    )


def opens_outside(line: Column) -> Column:
    """Does a line that begins a row end within quotes? A quote counts at the start of a cell only."""
    # Whole cells with their commas, then a cell whose quote is not closed.
    return line.rlike(rf'^(?:(?:{_QUOTED})?+[^,"][^,]*+,|(?:{_QUOTED})?+,)*+"[^"]*+(?:""[^"]*+)*+$')


def opens_inside(line: Column) -> Column:
    """Does a line that begins within quotes end within quotes?"""
    rest = F.regexp_replace(line, r'^[^"]*+(?:""[^"]*+)*+"(?!")[^,]*+', "")
    closed = line.rlike(r'^[^"]*+(?:""[^"]*+)*+"(?!")')
    # After the cell that is closed here, the line goes on like one that begins a row.
    return F.when(closed, rest.startswith(",") & opens_outside(F.substring(rest, F.lit(2), F.length(rest)))).otherwise(True)
