"""Number reading and writing that agrees with the data's text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A finite decimal number, single underscores allowed between digits.
_DIGITS = "[0-9]+(_[0-9]+)*"
# Plain numbers, nearly all there are, are tried first, without groups that repeat.
_FINITE = rf"^[+-]?[0-9]+(?:\.[0-9]+)?$|^\s*[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?\s*$"
_INFINITE = r"^\s*[+-]?(?i)inf(inity)?\s*$"


def quantise(x: Column) -> Column:
    """Degrees (DOUBLE) to integer 1e-7 degree, rounding like 7-decimal text. The text itself, which is slow, is
    made only near a tie and beyond 10,000 degrees: elsewhere the product is off by less than 1e-4, so both agree."""
    steps = x * F.lit(1e7)
    text = F.replace(F.call_function("format_number", x, F.lit("0.0000000")), F.lit("."), F.lit("")).cast("bigint")
    clear = (F.abs(x) < 10_000) & (F.abs(steps - F.rint(steps)) < 0.49)
    return F.when(clear, F.rint(steps).cast("bigint")).otherwise(text)


def degrees_text(value_i: Column) -> Column:
    """Integer 1e-7 degree as text with exactly seven decimals."""
    size, unit = F.abs(value_i).cast("bigint"), F.lit(10_000_000).cast("bigint")
    text = F.concat(F.call_function("div", size, unit).cast("string"), F.lit("."),
                    F.lpad((size % unit).cast("string"), 7, "0"))
    return F.when(value_i < 0, F.concat(F.lit("-"), text)).otherwise(text)


def to_degrees(value_i: Column) -> Column:
    return value_i.cast("double") / F.lit(1e7)


def read_float(text: Column) -> Column:
    """Text to a finite DOUBLE; NULL where the text is not a plain number."""
    cleaned = F.replace(F.trim(text), F.lit("_"), F.lit(""))
    return F.when(text.rlike(_FINITE), cleaned.try_cast("double"))


def is_infinite_text(text: Column) -> Column:
    """True where the text denotes an infinity (also by overflow, as 1e999)."""
    spelled = text.rlike(_INFINITE)
    value = read_float(text)
    return F.coalesce(spelled | (F.abs(value) == F.lit(float("inf"))), F.lit(False))


def within(x: Column, low, high) -> Column:
    """x where low <= x <= high, else NULL."""
    return F.when((x >= F.lit(low)) & (x <= F.lit(high)), x)
