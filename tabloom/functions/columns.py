"""Column expressions that fix how missing values behave.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation. Missing is always NULL, never NaN.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text that stands for a missing category.
MISSING_TEXT = "nan"

# Fixed value: what counts as a number in text. Rejects 'nan', '12f', '1.5d',
# which Spark's cast alone would accept.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_integer(dtype: T.DataType) -> bool:
    return isinstance(dtype, INTEGER_TYPES)


def numeric(column: Column, dtype: T.DataType) -> Column:
    """Whole numbers as BIGINT, everything else as DOUBLE with NaN as NULL."""
    if is_integer(dtype) or isinstance(dtype, T.BooleanType):
        return column.cast("bigint")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.nullif(column.cast("double"), F.lit(float("nan")))
    return column.cast("double")


def parse_number(column: Column) -> Column:
    """Text to DOUBLE; blanks and anything that is not a number become NULL."""
    text = F.trim(column.cast("string"))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def missing_as_text(column: Column) -> Column:
    """The category as text, with missing as a category of its own."""
    return F.coalesce(column.cast("string"), F.lit(MISSING_TEXT))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def equals(
    column: Column, value, negate: bool = False, dtype: T.DataType | None = None
) -> Column:
    """Equality flag; a missing value differs from every value.

    A column whose ``dtype`` is a number is compared as one, so that 1.0 equals
    '1' and 0.0 equals 0; a value that is no number differs from all of them.
    Any other column is compared as text.
    """
    if isinstance(dtype, T.NumericType):
        try:
            number = float(value)
        except ValueError:
            same = F.lit(False)
        else:
            same = column.cast("double").eqNullSafe(F.lit(number))
    else:
        same = column.cast("string").eqNullSafe(F.lit(str(value)))
    return flag(~same if negate else same)


def text_matches(column: Column, pattern: str) -> Column:
    """Case-insensitive regular expression flag; missing does not match."""
    return flag(column.cast("string").rlike("(?i)" + pattern))


def below(column: Column, bound: float) -> Column:
    return flag(column < F.lit(bound))


def above(column: Column, bound: float) -> Column:
    return flag(column > F.lit(bound))


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Division with NULL for a zero divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def right_closed_bin(column: Column, edges: Sequence[float]) -> Column:
    """Index of the interval ``(edge, next edge]`` as DOUBLE, NULL outside."""
    pairs = list(zip(edges, edges[1:]))
    first, *rest = [
        ((column > F.lit(low)) & (column <= F.lit(high)), F.lit(float(index)))
        for index, (low, high) in enumerate(pairs)
    ]
    chain = F.when(*first)
    for condition, result in rest:
        chain = chain.when(condition, result)
    return chain
