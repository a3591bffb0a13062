"""Casting, mapping, dropping, filling, tagging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions import parse_number

# Fixed values.
MISSING_NUMBER = -999.0
POSITIVE_LABELS = ("Yes", "1", "1.0")


def _is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text columns to DOUBLE; unreadable values become NULL. Numbers stay."""
    text = {
        name: parse_number(F.col(f"`{name}`"))
        for name in cols
        if isinstance(df.schema[name].dataType, T.StringType)
    }
    return df.withColumns(text) if text else df


def map_values(df: DataFrame, col: str, mapping: Mapping[Any, Any]) -> DataFrame:
    """Replace values by a small literal mapping; unlisted values become NULL."""
    chain = None
    for key, value in mapping.items():
        condition = F.col(col) == F.lit(key)
        chain = (
            F.when(condition, F.lit(value))
            if chain is None
            else chain.when(condition, F.lit(value))
        )
    return df.withColumn(col, F.lit(None) if chain is None else chain)


def normalise_target(
    df: DataFrame, col: str, positives: Sequence[str] = POSITIVE_LABELS, out: str | None = None
) -> DataFrame:
    """1 for a listed positive spelling, 0 for anything else or missing."""
    hit = F.col(col).cast("string").isin(list(positives))
    return df.withColumn(out or col, F.coalesce(hit, F.lit(False)).cast("int"))


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; absent ones are ignored."""
    return df.drop(*cols)


def columns_of(df: DataFrame, kind: str, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the 'string' or 'numeric' columns, in schema order."""
    wanted = {
        "string": lambda dtype: isinstance(dtype, T.StringType),
        "numeric": _is_numeric,
    }[kind]
    return [f.name for f in df.schema.fields if wanted(f.dataType) and f.name not in exclude]


def fill_missing(
    df: DataFrame, cols: Sequence[str] | None = None, value: float = MISSING_NUMBER
) -> DataFrame:
    """Fill NULL and NaN in numeric columns, by default in all of them."""
    names = columns_of(df, "numeric") if cols is None else cols
    return df.na.fill(value, subset=list(names)) if names else df


def fill_with_mean(df: DataFrame, cols: Sequence[str], train: DataFrame) -> DataFrame:
    """Fill NULL with the column's mean over the training rows."""
    means = train.agg(*[F.avg(c).alias(c) for c in cols]).first()
    fills = {c: means[c] for c in cols if means[c] is not None}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in fills.items()}
    return df.withColumns(filled) if filled else df


def tag(df: DataFrame, split: str | None = None, source: str | None = None) -> DataFrame:
    """Mark rows with the split and / or the source they came from."""
    marks = {"split": split, "source": source}
    return df.withColumns({k: F.lit(v) for k, v in marks.items() if v is not None})


def take_split(df: DataFrame, split: str) -> DataFrame:
    return df.filter(F.col("split") == split)


def row_weight(
    df: DataFrame, weights: Mapping[str, float], source_col: str = "source", out: str = "weight"
) -> DataFrame:
    """A weight per source, 1 for sources that are not listed."""
    column = F.lit(1.0)
    for source, weight in weights.items():
        column = F.when(F.col(source_col) == source, F.lit(float(weight))).otherwise(column)
    return df.withColumn(out, column)
