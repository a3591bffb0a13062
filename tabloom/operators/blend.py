"""Blend model scores: means, weights, grids, greedy selection.

Scores come as a long table (id, model, score and optionally seed, split,
label) or, one column per model, as a wide table made by ``pivot_scores``.
Searching weights means computing the exact AUC of many weighted sums. All
candidates of a step share one pass, and candidates that cannot be the best
are ruled out first by bounds from counts per cell, see ``best_blend``.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add, or_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.metrics import auc
from tabloom.operators.ranks import pct_rank
from tabloom.operators.weighted_auc import Cells, compared, finer_cells, first_cells, scored_rows
from tabloom.session import discard, materialise, shuffle_width

# Cells per candidate, at most, in each pass that rules candidates out.
BOUND_BINS = (1024, 4096, 16384, 16384)
# With this few candidates left the exact job costs less than finer bounds.
FEW_CANDIDATES = 8
# Candidates per exact job, at most.
EXACT_CHUNK = 64
# Scores that one exact job shuffles: so many tables' worth, but at least as many as given.
EXACT_TABLES, LEAST_EXACT = 4, 1 << 24


def pivot_scores(
    scores: DataFrame, models: Sequence[str], by: Sequence[str] = ("id",), keep: Sequence[str] = ()
) -> DataFrame:
    """One row per key with one column per model, and ``keep`` columns once."""
    return (
        scores.filter(F.col("model").isin(list(models)))
        .groupBy(*by)
        .agg(
            *[F.first(c, ignorenulls=True).alias(c) for c in keep],
            *[F.max(F.when(F.col("model") == m, F.col("score"))).alias(m) for m in models],
        )
    )


def mean_blend(
    scores: DataFrame,
    models: Sequence[str] | None = None,
    by: Sequence[str] = ("id",),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Equal-weight mean over all or the named models."""
    chosen = scores if models is None else scores.filter(F.col("model").isin(list(models)))
    return chosen.groupBy(*by).agg(
        F.avg("score").alias("score"),
        *[F.first(c, ignorenulls=True).alias(c) for c in keep],
    )


def weighted_blend(
    scores: DataFrame,
    weights: Mapping[str, float],
    by: Sequence[str] = ("id",),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Sum of weight times score; models without a weight are left out.

    Terms are added in the order of ``weights``, so the result does not depend
    on how rows are distributed.
    """
    models = list(weights)
    wide = pivot_scores(scores, models, by, keep)
    return wide.select(*by, *keep, weighted_sum(models, list(weights.values())).alias("score"))


def seed_mean_blend(scores: DataFrame, by: Sequence[str] = ("id",)) -> DataFrame:
    """Mean over seeds of per-seed blended scores."""
    return scores.groupBy(*by).agg(F.avg("score").alias("score"))


def rank_normalise(scores: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Replace each score by its average rank over the number of rows, per model."""
    return pct_rank(scores, "score", by, "rank_score")


def rank_mean_blend(
    scores: DataFrame,
    models: Sequence[str] | None = None,
    by: Sequence[str] = ("id",),
    keep: Sequence[str] = (),
    within: Sequence[str] = ("model",),
) -> DataFrame:
    """Equal-weight mean of rank-normalised scores."""
    chosen = scores if models is None else scores.filter(F.col("model").isin(list(models)))
    ranked = rank_normalise(chosen, within)
    return mean_blend(ranked.drop("score").withColumnRenamed("rank_score", "score"), None, by, keep)


def blend_score_tables(
    first: DataFrame, second: DataFrame, first_weight: float, second_weight: float,
    id_col: str = "id",
) -> DataFrame:
    """Weighted sum of two score tables on the keys both have."""
    left = first.select(id_col, F.col("score").alias("__a"))
    right = second.select(id_col, F.col("score").alias("__b"))
    mixed = F.col("__a") * F.lit(first_weight) + F.col("__b") * F.lit(second_weight)
    return left.join(right, id_col).select(id_col, mixed.alias("score"))


# -- weight grids -----------------------------------------------------------


def _steps(stop: float, step: float, start: float = 0.0) -> list[float]:
    return [float(x) for x in np.arange(start, stop, step)]


def grid3_coarse() -> list[tuple[float, float, float]]:
    """Three weights, the first two from .1 below .8, the third at least .05."""
    pairs = [(a, b) for a in _steps(0.8, 0.05, 0.1) for b in _steps(0.8 - a, 0.05, 0.1)]
    return [(a, b, 1 - a - b) for a, b in pairs if 1 - a - b >= 0.05]


def grid3_full(step: float = 0.05) -> list[tuple[float, float, float]]:
    """Three weights on the simplex, as far as floating point keeps the last
    one non-negative."""
    pairs = [(a, b) for a in _steps(1.01, step) for b in _steps(1.01 - a, step)]
    return [(a, b, 1 - a - b) for a, b in pairs if 1 - a - b >= 0]


def grid2(step: float = 0.05) -> list[tuple[float, float]]:
    """``w`` for the first column and the rest for the second."""
    return [(w, 1 - w) for w in _steps(1.01, step)]


def grid4(step: float = 0.05, most: float = 0.5) -> list[tuple[float, float, float, float]]:
    """Three weights up to ``most`` and a remainder between 0 and ``most``."""
    axis = _steps(most + 0.01, step)
    triples = [(a, b, c) for a in axis for b in axis for c in axis]
    return [(a, b, c, 1.0 - a - b - c) for a, b, c in triples if 0 <= 1.0 - a - b - c <= most]


# -- exact search -----------------------------------------------------------


def weighted_sum(cols: Sequence[str], weights: Sequence[float]) -> Column:
    """Sum of weight times score; a column of weight 0 is left out, so a score
    that is missing there does no harm."""
    terms = [F.lit(float(w)) * F.col(f"`{c}`") for c, w in zip(cols, weights) if w]
    return reduce(add, terms) if terms else F.lit(0.0)


def search_table(
    wide: DataFrame, cols: Sequence[str], label: str, missing: str = "error"
) -> DataFrame:
    """The columns a search needs, written out evenly split.

    A search reads its table several times and multiplies every row by the
    number of candidates, so it wants more partitions than the table's size
    alone would give. A row that lacks its label or a score is an error;
    ``missing='drop'`` leaves such rows out of the whole search, with a warning
    that says how many.
    """
    if missing not in ("error", "drop"):
        raise ValueError(f"missing must be 'error' or 'drop', not {missing!r}")
    narrow = wide.select(label, *cols)
    stored = materialise(narrow.repartition(shuffle_width(wide.sparkSession)))
    lacking = stored.filter(reduce(or_, [F.col(f"`{c}`").isNull() for c in (label, *cols)])).count()
    if not lacking:
        return stored
    if missing == "error":
        raise ValueError(f"{lacking} rows lack a score or the label; pass missing='drop' to leave them out")
    warnings.warn(f"{lacking} rows lack a score or the label and are left out", stacklevel=2)
    return stored.na.drop()


def blend_aucs(
    wide: DataFrame, cols: Sequence[str], label: str, weights: Sequence[Sequence[float]]
) -> DataFrame:
    """The exact AUC of every weight vector: (w_id, auc, n_pos, n_neg).

    Rows without a score or label are left out. Computed at once, up to
    ``EXACT_CHUNK`` candidates per job.
    """
    rows = scored_rows(wide, cols, label)
    found = []
    for start in range(0, len(weights), EXACT_CHUNK):
        part = dict(list(enumerate(weights))[start : start + EXACT_CHUNK])
        cells = first_cells(rows, part, len(cols))
        won = {}
        for some in chunks(cells, EXACT_CHUNK):
            won |= compared(rows, part, some)
        found += [
            (i, won[i] / 2 / c.pairs if c.pairs else None, int(c.pos.sum()), int(c.neg.sum()))
            for i, c in sorted(cells.items())
        ]
    discard(rows)
    return wide.sparkSession.createDataFrame(found, "w_id int, auc double, n_pos bigint, n_neg bigint")


def chunks(cells: Mapping[int, Cells], most: int) -> Iterator[dict[int, Cells]]:
    """The candidates in order, ``most`` at once, as far as the rows of their open cells stay within bounds."""
    part: dict[int, Cells] = {}
    held = 0
    for i, c in sorted(cells.items()):
        rows, mass = int(c.pos.sum() + c.neg.sum()), int(c.mass.sum())
        if part and (len(part) == most or held + mass > max(LEAST_EXACT, EXACT_TABLES * rows)):
            yield part
            part, held = {}, 0
        part[i] = c
        held += mass
    if part:
        yield part


@dataclass(frozen=True)
class Best:
    """The best weight vector of a search, and how many were computed exactly."""

    w_id: int
    weights: tuple[float, ...]
    auc: float | None
    exact_candidates: int


def best_blend(
    wide: DataFrame,
    cols: Sequence[str],
    label: str,
    weights: Sequence[Sequence[float]],
    chunk: int = EXACT_CHUNK,
    stored: bool = False,
) -> Best:
    """The weight vector with the greatest exact AUC, the first one on a tie.

    A candidate whose upper bound lies below the greatest lower bound cannot
    win. Bounds are made finer, up to a limit, while more than a few candidates
    are open. All others are computed exactly, up to ``chunk`` candidates per job.
    ``stored`` says that ``wide`` comes from ``search_table``.
    """
    rows = scored_rows(wide, cols, label, stored)
    try:
        return _best_of(rows, len(cols), weights, chunk)
    finally:
        if not stored:
            discard(rows)


def _best_of(rows: DataFrame, n_cols: int, weights: Sequence[Sequence[float]], chunk: int) -> Best:
    every = dict(enumerate(weights))
    cells = first_cells(rows, every, n_cols, BOUND_BINS[0])
    if not cells or not cells[0].pairs:
        return Best(0, tuple(weights[0]), None, 0)
    pairs = cells[0].pairs
    for bins in (*BOUND_BINS[1:], None):
        bounds = {i: c.won() for i, c in cells.items()}
        floor = max(low for low, _ in bounds.values()) / 2 / pairs
        cells = {i: cells[i] for i, (_, high) in bounds.items() if high / 2 / pairs >= floor}
        if bins is None or len(cells) <= FEW_CANDIDATES:
            break
        cells = finer_cells(rows, every, cells, bins)
    results: list[tuple[float, int]] = []
    for part in chunks(cells, chunk):
        results += [(won / 2 / pairs, i) for i, won in compared(rows, every, part).items()]
    top, w_id = max(results, key=lambda r: (r[0], -r[1]))
    return Best(w_id, tuple(weights[w_id]), top, len(cells))


def grid_blend(
    wide: DataFrame,
    cols: Sequence[str],
    label: str,
    grid: Sequence[Sequence[float]],
    missing: str = "error",
) -> Best:
    """Best weights of a grid over the named score columns."""
    table = search_table(wide, cols, label, missing)
    best = best_blend(table, cols, label, grid, stored=True)
    discard(table)
    return best


@dataclass(frozen=True)
class Climb:
    """Models picked by hill climbing, in order, with the AUC after each."""

    selected: list[str]
    aucs: list[float]
    counts: dict[str, int] = field(default_factory=dict)

    @property
    def weights(self) -> dict[str, float]:
        return {m: n / len(self.selected) for m, n in self.counts.items()}


def hill_climb(
    wide: DataFrame,
    cols: Sequence[str],
    label: str,
    max_add: int = 11,
    min_gain: float = 1e-5,
    missing: str = "error",
) -> Climb:
    """Greedy selection with replacement on the AUC of the mean of the picks.

    Starts at the best single model and adds, while it gains more than
    ``min_gain``, the model that helps most. Each step is one search over all
    models.
    """
    wide = search_table(wide, cols, label, missing)
    counts = np.zeros(len(cols))
    selected: list[str] = []
    aucs: list[float] = []
    for _ in range(max_add + 1):
        options = []
        for i in range(len(cols)):
            picked = counts.copy()
            picked[i] += 1
            options.append(tuple(picked / picked.sum()))
        best = best_blend(wide, cols, label, options, stored=True)
        if best.auc is None:
            break
        if aucs and best.auc - aucs[-1] <= min_gain:
            break
        counts[best.w_id] += 1
        selected.append(cols[best.w_id])
        aucs.append(best.auc)
    discard(wide)
    picks = {c: int(n) for c, n in zip(cols, counts) if n}
    return Climb(selected, aucs, picks)


def pick_best(
    variants: DataFrame, label: str = "label", by: str = "variant"
) -> DataFrame:
    """The variant with the greatest AUC as one row (variant, auc)."""
    return (
        auc(variants, "score", label, [by])
        .select(by, "auc")
        .orderBy(F.desc_nulls_last("auc"), by)
        .limit(1)
    )
