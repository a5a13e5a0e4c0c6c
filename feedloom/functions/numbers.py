"""Number expressions.

A cast alone would accept ``5d`` and ``NaN``.  Brazilian texts have lost their letters
by the time they are cast; other texts are matched first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions._column import ColumnLike, as_column
from feedloom.functions.text import null_tokens, strip

NUMERALS = "0123456789,.-"
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def number_text(c: ColumnLike) -> Column:
    """Brazilian number text to a dot-decimal text; empty when there is no digit or mark.

    Dots count as thousands marks only next to a comma, so ``1.234`` stays 1.234.
    """
    kept = F.regexp_replace(as_column(c), r"[^0-9,.\-]+", "")
    if isinstance(c, str):
        # Texts of nothing else are taken as they are.
        text = F.col(c).cast("string")
        kept = F.when(F.ltrim(text, F.lit(NUMERALS)) == "", text).otherwise(kept)
    no_marks = F.when(
        F.contains(kept, F.lit(",")), F.replace(kept, F.lit("."), F.lit(""))
    ).otherwise(kept)
    return comma_to_dot(no_marks)


def comma_to_dot(c: ColumnLike) -> Column:
    return F.replace(as_column(c), F.lit(","), F.lit("."))


def _double(text: Column) -> Column:
    return null_tokens(F.regexp_extract(text, PLAIN_NUMBER, 0), [""]).try_cast("double")


def to_float(c: ColumnLike, ptbr: bool = True) -> Column:
    if ptbr:
        return number_text(c).try_cast("double")
    return _double(strip(as_column(c).cast("string")))


def to_int(c: ColumnLike, ptbr: bool = True) -> Column:
    """Whole number.  ``ptbr`` keeps the digits before the decimal mark; otherwise a
    text with a fraction is not a whole number and gives null."""
    if ptbr:
        return F.substring_index(number_text(c), ".", 1).try_cast("bigint")
    text = strip(as_column(c).cast("string"))
    number = _double(text)
    # Through a decimal, so that long identifiers keep all their digits.
    exact = F.when(number == F.floor(number), text.try_cast("decimal(38,10)"))
    return exact.try_cast("bigint")


def to_number_or_null(c: ColumnLike, missing: Sequence[str] = ("", "NONE", "NAN")) -> Column:
    return _double(strip(null_tokens(c, missing)))
