"""Exact grouped ROC AUC, score summaries and correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.ranks import (
    _before,
    quantile_edges,
    range_count,
    with_range,
)

# Scores are compared after rounding to this many decimals, so that the noise
# of summing in another order cannot break or make ties.
SCORE_DECIMALS = 12


def score_key(score: Column) -> Column:
    """A score as a whole number of 10^-12 steps."""
    return F.rint(score * F.lit(10.0**SCORE_DECIMALS)).cast("bigint")


def auc_from_counts(counted: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """AUC from one row per (by, value) with ``pos``, ``neg`` and ``range_id``.

    Pairs inside a range come from running counts, pairs across ranges from
    the totals of the ranges, so nothing is joined back to the values.
    """
    running = F.coalesce(F.sum("neg").over(_before([value], [*by, "range_id"])), F.lit(0))
    won = F.col("pos").cast("double") * (running + F.col("neg") / 2.0)
    per_range = (
        counted.withColumn("won", won)
        .groupBy(*by, "range_id")
        .agg(F.sum("won").alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    below = F.coalesce(F.sum("neg").over(_before(["range_id"], by)), F.lit(0))
    totals = per_range.withColumn("won", F.col("won") + F.col("pos").cast("double") * below)
    summed = totals.groupBy(*by).agg(
        F.sum("won").alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    pairs = F.col("pos").cast("double") * F.col("neg")
    return summed.select(
        *by, F.try_divide(F.col("won"), pairs).alias("auc"), F.col("pos").alias("n_pos"),
        F.col("neg").alias("n_neg"),
    )


def auc(
    scores: DataFrame,
    score: str = "score",
    label: str = "label",
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Exact ROC AUC per group, ties counting one half.

    Rows without score or label are left out; a group without positives or
    without negatives gets NULL. ``weight`` says how many rows a row stands for.
    """
    by = [by] if isinstance(by, str) else list(by)
    rows = F.col(weight) if weight else F.lit(1)
    narrow = scores.select(
        *by, score_key(F.col(score)).alias("__score"), F.col(label).alias("__label"), rows.alias("__rows")
    ).filter(F.col("__score").isNotNull() & F.col("__label").isNotNull())
    edges = quantile_edges(narrow, ["__score"], range_count(scores.sparkSession))["__score"]
    counted = narrow.groupBy(*by, "__score").agg(
        F.sum(F.when(F.col("__label") == 1, F.col("__rows")).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("__label") != 1, F.col("__rows")).otherwise(0)).alias("neg"),
    )
    return auc_from_counts(with_range(counted, "__score", edges), by, "__score")


def fold_auc(scores: DataFrame, label: str = "label") -> DataFrame:
    """AUC per model, seed and fold of a score table."""
    by = [c for c in ("feature_set", "model", "seed", "fold") if c in scores.columns]
    return auc(scores, "score", label, by)


def score_summary(scores: DataFrame, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Smallest, largest and mean score, and the number of rows."""
    return scores.groupBy(*by).agg(
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        F.avg(score).alias("mean_score"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def correlation_matrix(wide: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, as (a, b, corr) rows.

    All pairs come from one pass; the matrix is symmetric with 1 on the
    diagonal. Each pair uses the rows where both columns are present.
    """
    pairs = list(combinations(range(len(cols)), 2))
    one = wide.agg(
        *[F.corr(F.col(cols[i]), F.col(cols[j])).alias(f"c{i}_{j}") for i, j in pairs],
        *[F.stddev_pop(F.col(c)).alias(f"d{i}") for i, c in enumerate(cols)],
    )
    cells = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            corr = F.col(f"c{min(i, j)}_{max(i, j)}") if i != j else F.when(F.col(f"d{i}") > 0, 1.0)
            cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), corr.alias("corr")))
    return one.select(F.inline(F.array(*cells)))
