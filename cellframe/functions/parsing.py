"""Parsing of text lines into fields and numbers, as Column expressions.

Fixed values. The text formats: control characters and spaces at both ends are trimmed; ``#`` starts
a comment; matrix and vector fields are separated by a comma or tab, tensor fields by commas and
white space, dense rows by commas; trailing empty fields do not count; an integer field has no
padding; the special words of a number are exactly ``NaN`` and ``Infinity``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTROL_AND_SPACE = "".join(chr(c) for c in range(0x21))
COMMENT = "#"
CELL_DELIMITERS = ",\t"
ROW_DELIMITERS = ","
TENSOR_DELIMITERS = ", \t\n\x0b\f\r"
INTEGER = r"^[+-]?[0-9]+$"
ANY_SPECIAL = r"(?i)^[\x00-\x20]*[+-]?(inf|infinity|nan)[\x00-\x20]*$"
VALID_SPECIAL = r"^[\x00-\x20]*[+-]?(NaN|Infinity)[\x00-\x20]*$"
SHAPE_HEADER = r"(?i)^#\s*shape\s*:(.*)$"


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(CONTROL_AND_SPACE))


def is_data(line: Column) -> Column:
    """Neither blank nor a comment (``line`` is trimmed)."""
    return (line != "") & ~F.startswith(line, F.lit(COMMENT))


def fields(line: Column, delimiters: str) -> Column:
    """Split, without trailing empty fields."""
    body = F.rtrim(line, F.lit(delimiters))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(_split(body, delimiters))


def words(line: Column, delimiters: str) -> Column:
    """Split, without empty fields."""
    return F.array_remove(_split(line, delimiters), "")


def _split(line: Column, delimiters: str) -> Column:
    """Split on any of the characters; splitting on a single one needs no regular expression."""
    if len(delimiters) > 1:
        line = F.translate(line, delimiters, delimiters[0] * len(delimiters))
    return F.split(line, delimiters[0])


def once(value: Column) -> Column:
    """The value as a generated column, so that later filters do not evaluate it again."""
    return F.explode(F.array(value))


def as_integer(field: Column) -> Column:
    """The integer, or null."""
    return F.when(field.rlike(INTEGER), field.try_cast("bigint"))


def as_number(field: Column) -> Column:
    """The number, or null."""
    number = field.try_cast("double")
    finite = F.abs(number) < float("inf")
    misspelt = field.rlike(ANY_SPECIAL) & ~field.rlike(VALID_SPECIAL)
    return F.when(finite | ~misspelt, number)
