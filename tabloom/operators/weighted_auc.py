"""Exact AUCs of many weighted sums of a few score columns.

Every row stands once in the table; the sums are made per block of rows inside
the tasks. A first pass counts both classes per candidate in cells of its
scores, which orders all pairs but those within a cell. Finer cells narrow
that down for the candidates still of interest; the scores of the cells that
stay open are then shuffled by candidate and range and compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.metrics import SCORE_DECIMALS
from tabloom.session import materialise, shuffle_width, shuffles_removed

#: Rows whose sums a task makes at once.
BLOCK = 1 << 16
#: Cells of all candidates together, and the least and most of one: bounds what a task sends and the driver gets.
CELLS, LEAST_CELLS, MOST_CELLS = 1 << 20, 64, 1 << 15
#: About how many scores of a candidate are compared in one group.
GROUP = 1 << 19
#: A cell that can be split holds at most this share of the rows when its scores are compared.
CELL_SHARE = 1 / 64

_FIRST, _LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


@dataclass(frozen=True)
class Cells:
    """Rows of both classes per cell of a candidate's scores; ``edges`` part the cells."""

    edges: np.ndarray
    pos: np.ndarray
    neg: np.ndarray

    @property
    def bounds(self) -> np.ndarray:
        return np.concatenate([[_FIRST], self.edges, [_LAST]])

    @property
    def open(self) -> np.ndarray:
        """Cells whose pairs are not ordered: both classes, and more than one possible score."""
        single = self.bounds[1:] == self.bounds[:-1] + 1
        return (self.pos > 0) & (self.neg > 0) & ~single

    @property
    def mass(self) -> np.ndarray:
        """Rows of the open cells, 0 for others."""
        return np.where(self.open, self.pos + self.neg, 0)

    @property
    def pairs(self) -> int:
        return int(self.pos.sum()) * int(self.neg.sum())

    def won(self) -> tuple[int, int]:
        """Twice the least and the most pairs that a positive wins, ties being half."""
        below = np.cumsum(self.neg) - self.neg
        ties = np.where(self.open, 0, self.neg)
        least = int((self.pos * (2 * below + ties)).sum())
        return least, least + 2 * int((self.pos * self.neg)[self.open].sum())

    def finer(self, cells: int) -> np.ndarray:
        """Edges that split the open cells by about ``cells`` more, by their rows."""
        where, mass = np.flatnonzero(self.open), self.mass[self.open]
        if not len(where):
            return self.edges
        parts = 2 + (cells * (mass / mass.sum())).astype(np.int64)
        low, high = self.bounds[:-1][where].astype(float), self.bounds[1:][where].astype(float)
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        inner = np.floor(np.repeat(low, parts) + step * np.repeat((high - low) / parts, parts))
        inner = inner[(inner > float(_FIRST)) & (inner < float(_LAST))].astype(np.int64)
        return np.unique(np.concatenate([self.edges, inner]))


def scored_rows(wide: DataFrame, cols: Sequence[str], label: str, stored: bool = False) -> DataFrame:
    """``pos`` and the scores as s0, s1, ..., evenly split and written; rows that lack any are left out.

    ``stored`` says that ``wide`` is such a table already, which is not written again.
    """
    rows = wide.select(
        (F.col(label) == 1).alias("pos"), *[F.col(f"`{c}`").cast("double").alias(f"s{j}") for j, c in enumerate(cols)]
    ).na.drop("any", subset=["pos"])
    for j in range(len(cols)):
        rows = rows.filter(F.col(f"s{j}").isNotNull())
    return rows if stored else materialise(rows.repartition(shuffle_width(wide.sparkSession)))


def keys_of(scores: np.ndarray, weights: Sequence[float]) -> np.ndarray:
    """Weighted sums as whole numbers of 10^-12 steps, ascending."""
    total = weights[0] * scores[0]
    for w, s in zip(weights[1:], scores[1:]):
        total = total + w * s
    steps = np.rint(total * 10.0**SCORE_DECIMALS)
    if not (np.abs(steps) < 2.0**63).all():
        raise ArithmeticError("a weighted score is no number, or too large to be compared")
    return np.sort(steps.astype(np.int64))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The scores of positive and of negative rows, one line per column, of some batches each."""

    def split(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        rows = pa.Table.from_batches(held)
        is_pos = rows.column(0).to_numpy().astype(bool)
        scores = np.stack([rows.column(j).to_numpy() for j in range(1, rows.num_columns)])
        return scores[:, is_pos], scores[:, ~is_pos]

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BLOCK:
            yield split(held)
            held, n = [], 0
    if n:
        yield split(held)


def count_cells(
    rows: DataFrame, weights: Mapping[int, Sequence[float]], edges: Mapping[int, np.ndarray]
) -> dict[int, Cells]:
    """The cells of every candidate. Tasks send counts per cell, not rows."""
    schema = "w_id int, pos array<bigint>, neg array<bigint>"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {i: np.zeros((2, len(e) + 1), np.int64) for i, e in edges.items()}
        seen = False
        for block in blocks(batches):
            seen = True
            for i, total in totals.items():
                for counted, scores in zip(total, block):
                    keys = keys_of(scores, weights[i])
                    counted += np.diff(np.searchsorted(keys, edges[i], "left"), prepend=0, append=len(keys))
        for i, total in totals.items() if seen else ():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), *[pa.array([x], pa.list_(pa.int64())) for x in total]],
                names=["w_id", "pos", "neg"],
            )

    def add_up(parts: pa.Table) -> pa.Table:
        summed = [
            pa.array([parts.column(name).combine_chunks().flatten().to_numpy().reshape(parts.num_rows, -1).sum(0)],
                     pa.list_(pa.int64()))
            for name in ("pos", "neg")
        ]
        return pa.table([parts.column("w_id").slice(0, 1), *summed], names=["w_id", "pos", "neg"])

    with shuffles_removed(rows.sparkSession):
        found = rows.mapInArrow(count, schema).groupBy("w_id").applyInArrow(add_up, schema).toArrow()
    return {
        i: Cells(edges[i], np.array(pos, np.int64), np.array(neg, np.int64))
        for i, pos, neg in zip(*(found.column(j).to_pylist() for j in range(3)))
    }


def first_cells(
    rows: DataFrame, weights: Mapping[int, Sequence[float]], n_cols: int, most: int = MOST_CELLS
) -> dict[int, Cells]:
    """At most ``most`` cells of one width from the least to the greatest possible score; none without rows."""
    row = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(f"s{j}").alias(f"lo{j}") for j in range(n_cols)],
        *[F.max(f"s{j}").alias(f"hi{j}") for j in range(n_cols)],
    ).first()
    if not row["n"]:
        return {}
    ends = [(row[f"lo{j}"], row[f"hi{j}"]) for j in range(n_cols)]
    cells = cells_each(len(weights), row["n"], most)
    edges = {}
    for i, w in weights.items():
        low, high = (sum(f(x * a, x * b) for x, (a, b) in zip(w, ends)) * 10.0**SCORE_DECIMALS for f in (min, max))
        spread = np.floor(np.append(np.linspace(low, high, cells), high + 1))
        edges[i] = np.unique(spread[np.abs(spread) < 2.0**63].astype(np.int64))
    return count_cells(rows, weights, edges)


def cells_each(candidates: int, n_rows: int, most: int) -> int:
    """Cells per candidate; no more than rows, and few for many candidates."""
    return min(most, max(LEAST_CELLS, min(CELLS, n_rows) // candidates))


def finer_cells(
    rows: DataFrame, weights: Mapping[int, Sequence[float]], cells: Mapping[int, Cells], most: int = MOST_CELLS
) -> dict[int, Cells]:
    """The cells counted anew, with open ones split."""
    n_rows = max(int(c.pos.sum() + c.neg.sum()) for c in cells.values())
    more = cells_each(len(cells), n_rows, most)
    return count_cells(rows, {i: weights[i] for i in cells}, {i: c.finer(more) for i, c in cells.items()})


def compared(rows: DataFrame, weights: Mapping[int, Sequence[float]], cells: Mapping[int, Cells]) -> dict[int, int]:
    """Twice the pairs that a positive wins, exactly, per candidate.

    A cell of too many rows is split first; one value that many rows share
    ends as a cell of its own, whose pairs are ties.
    """
    cells = dict(cells)
    while True:
        heavy = {
            i: c
            for i, c in cells.items()
            if c.mass.max(initial=0) > max(GROUP, CELL_SHARE * int(c.pos.sum() + c.neg.sum()))
        }
        if not heavy:
            break
        cells |= finer_cells(rows, weights, heavy)
    won = {i: c.won()[0] for i, c in cells.items()}
    group_of = {}
    for i, c in cells.items():
        mass = c.mass
        if not mass.any():
            continue
        group_of[i] = np.where(c.open, (np.cumsum(mass) - mass) // GROUP, -1)
        # What open cells of one group win against each other is compared again.
        for g in np.unique(group_of[i][c.open]):
            pos, neg = c.pos[group_of[i] == g], c.neg[group_of[i] == g]
            won[i] -= 2 * int((pos * (np.cumsum(neg) - neg)).sum())
    if not group_of:
        return won
    edges = {i: cells[i].edges for i in group_of}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            for i, groups in group_of.items():
                count = int(groups.max()) + 1
                lists = []
                for scores in block:
                    keys = keys_of(scores, weights[i])
                    own = groups[np.searchsorted(edges[i], keys, "right")]
                    keys, own = keys[own >= 0], own[own >= 0]
                    starts = np.searchsorted(own, np.arange(count + 1)).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(starts), pa.array(keys)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(count, i, np.int32)), pa.array(np.arange(count, dtype=np.int32)), *lists],
                    names=["w_id", "part", "pos", "neg"],
                )

    def compare(parts: pa.Table) -> pa.Table:
        pos, neg = (parts.column(name).combine_chunks().flatten().to_numpy() for name in ("pos", "neg"))
        pos, neg = np.sort(pos), np.sort(neg)
        twice = int(np.searchsorted(neg, pos, "left").sum()) + int(np.searchsorted(neg, pos, "right").sum())
        return pa.table([parts.column("w_id").slice(0, 1), pa.array([twice], pa.int64())], names=["w_id", "won"])

    dealt = rows.mapInArrow(deal, "w_id int, part int, pos array<bigint>, neg array<bigint>")
    of_groups = dealt.groupBy("w_id", "part").applyInArrow(compare, "w_id int, won bigint")
    with shuffles_removed(rows.sparkSession):
        for r in of_groups.groupBy("w_id").agg(F.sum("won").alias("won")).collect():
            won[r["w_id"]] += r["won"]
    return won
