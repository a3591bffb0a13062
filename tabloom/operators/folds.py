"""Deterministic folds from the row key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions import missing_as_text
from tabloom.operators.ranks import range_offsets

# Hash ranges used to order rows in exact mode: 2^16.
RANGE_BITS = 16


def assign_folds(
    df: DataFrame,
    key: str = "id",
    label: str | None = None,
    k: int = 5,
    seed: int = 42,
    mode: str = "hash",
    out: str = "fold",
) -> DataFrame:
    """Add a fold number from 0 to k-1 that depends on key and seed only.

    'hash' needs no shuffle and is balanced in expectation, per label too.
    'exact' deals the rows of each label out in hash order, so the folds of a
    label differ by at most one row.
    """
    hashed = F.xxhash64(F.col(key), F.lit(seed).cast("bigint"))
    if mode == "hash":
        return df.withColumn(out, F.pmod(hashed, F.lit(k)).cast("int"))
    if mode != "exact":
        raise ValueError(f"unknown fold mode: {mode}")
    # The top bits of the hash cut the hash order into even ranges.
    ordered = df.withColumns(
        {
            "__label": missing_as_text(F.col(f"`{label}`")) if label else F.lit(""),
            "__hash": hashed,
            "range_id": F.shiftright(hashed, 64 - RANGE_BITS).cast("int"),
        }
    )
    by = ["__label"]
    inside = Window.partitionBy(*by, "range_id").orderBy("__hash", key)
    offsets = range_offsets(ordered, by, {"n_range": F.count(F.lit(1))})
    placed = ordered.withColumn("__inside", F.row_number().over(inside) - F.lit(1)).join(
        offsets, [*by, "range_id"]
    )
    position = F.col("n_range_before") + F.col("__inside")
    return placed.select(
        *[F.col(f"`{c}`") for c in df.columns], F.pmod(position, F.lit(k)).cast("int").alias(out)
    )
