"""CSV texts held in a column, read and written by built-in functions.

Cells are separated by commas and may be quoted; in a quoted cell a quote is doubled, and line breaks belong to the cell.
A quote inside a cell that does not begin with one is an ordinary character, as is what follows the closing quote, and
a quoted cell that is never closed reaches to the end. Blank lines are no rows. All loops of the patterns are
possessive, so that neither long cells nor many quotes take the regular expressions' stack.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_CELL = rf'(?:"{_INSIDE}(?:"[^,\r\n]*+|\z)|[^,\r\n]*+)'
_RECORD = rf"({_CELL}(?:,{_CELL})*+)(?:\r\n|\n|\r|\z)"
_QUOTED = rf'^"({_INSIDE})"?+([^,\r\n]*+)'


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a value several times and work it out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _value(cell: Column) -> Column:
    inside = F.replace(F.regexp_extract(cell, _QUOTED, 1), F.lit('""'), F.lit('"'))
    return F.when(cell.startswith('"'), F.concat(inside, F.regexp_extract(cell, _QUOTED, 2))).otherwise(cell)


def cells(record: Column) -> Column:
    """The values of one row, as an array of texts."""
    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({_CELL})"), F.lit(1)), _value)


def rows(body: Column) -> Column:
    """All rows of a text as arrays of texts; the first is the header. Null for null."""
    return F.transform(F.filter(F.regexp_extract_all(body, F.lit(_RECORD), F.lit(1)), lambda r: r != ""), cells)


def last_places(header: Column) -> Column:
    """Places (from 0) of the header's names; of a name that occurs more than once only its last place."""
    n = F.size(header)
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: ~F.array_contains(F.slice(header, i + 2, F.greatest(n, F.lit(1))), F.get(header, i)))


def line(values: Column) -> Column:
    """A row as text; cells with commas, quotes or line breaks are quoted, and a row of one empty cell is, too."""
    quoted = F.transform(values, lambda v: F.when(
        v.rlike(r'[,"\r\n]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v))
    return let(F.array_join(quoted, ","), lambda text: F.when(text == "", F.lit('""')).otherwise(text))
