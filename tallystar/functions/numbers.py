"""Float coercion over text columns.

Spark's own cast is wider than the contract in one way (``1d``, ``1f`` and
``0x1p3`` parse) and narrower in another (``1_000`` does not), so the text is
checked for shape first and then handed to ``try_cast``, which never throws
under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: shapes that count as a number; try_cast has the last word.
NUMBER_SHAPE = (
    r"(?i)^\s*[+-]?(?:nan|inf(?:inity)?|(?:[0-9][0-9_]*\.?|\.?[0-9])[0-9_]*(?:e[+-]?[0-9_]+)?)\s*$"
)


def _rare_spelling(text: Column) -> Column:
    """Numbers that try_cast does not know: digit groups with ``_`` and a signed NaN."""
    grouped = F.regexp_replace(text, "(?<=[0-9])_(?=[0-9])", "").try_cast("double")
    signed_nan = F.lower(F.trim(text)).isin("+nan", "-nan")
    return F.when(text.contains("_"), grouped).when(signed_nan, F.lit(float("nan")))


def parse_float(text: Column) -> Column:
    """Text -> double, NULL when the text is not a number."""
    return F.when(
        text.rlike(NUMBER_SHAPE), F.coalesce(text.try_cast("double"), _rare_spelling(text))
    )


def safe_float(text: Column, default: float = 0.0) -> Column:
    """Text -> double; NULL and anything unparseable become ``default``."""
    return F.coalesce(parse_float(text), F.lit(default))


def null_to_zero(text: Column) -> Column:
    """NULL and empty text -> 0.0; other bad text -> NULL, for the caller to reject."""
    return F.when(text.isNull() | (text == ""), F.lit(0.0)).otherwise(parse_float(text))
