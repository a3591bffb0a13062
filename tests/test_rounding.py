"""Rounding of results equals Spark's, without a decimal number per value."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.catalog.base import round_double


@pytest.mark.parametrize("digits", [4, 6, 8, 9])
def test_rounding_is_sparks_bit_for_bit(spark, digits):
    rng = np.random.default_rng(digits)
    ties = (rng.integers(-(10**7), 10**7, 3000) + 0.5) / 10.0**digits
    near = [np.nextafter(ties, np.inf), np.nextafter(ties, -np.inf), ties + 0.0011 / 10.0**digits]
    wide = rng.normal(size=3000) * 10.0 ** rng.integers(-12, 20, 3000)
    odd = [0.0, -0.0, -1e-12, 1e300, -1e300, float("nan"), float("inf"), -float("inf"), 2.0**40 / 10.0**digits]
    values = np.concatenate([ties, *near, wide, odd]).tolist() + [None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", round_double(F.col("x"), digits).alias("a"), F.round("x", digits).alias("b")).collect()

    def bits(x):
        return None if x is None else struct.pack("d", x)

    assert len(rows) == len(values)
    assert [r for r in rows if bits(r["a"]) != bits(r["b"])] == []
