"""Standardisation and k-means features."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.train import run_parallel
from tabloom.session import discard, materialise

#: Bytes of points that are stored in one row, and points that are looked at together.
BLOCK, LOOK = 1 << 13, 1 << 10


class Standardise:
    """(x - mean) / population deviation, fitted on training rows.

    A constant column is only centred. ``fill`` replaces missing values first.
    """

    def __init__(self, cols: Sequence[str], suffix: str = "_z", fill: float | None = None):
        self.cols, self.suffix, self.fill = list(cols), suffix, fill

    def value(self, col: str) -> Column:
        column = F.col(f"`{col}`").cast("double")
        return column if self.fill is None else F.coalesce(column, F.lit(float(self.fill)))

    def fit(self, train: DataFrame) -> StandardiseModel:
        row = train.agg(
            *[F.avg(self.value(c)).alias(f"m{i}") for i, c in enumerate(self.cols)],
            *[F.stddev_pop(self.value(c)).alias(f"d{i}") for i, c in enumerate(self.cols)],
        ).first()
        means = [row[f"m{i}"] for i in range(len(self.cols))]
        deviations = [row[f"d{i}"] for i in range(len(self.cols))]
        return StandardiseModel(self, means, deviations)


@dataclass(frozen=True)
class StandardiseModel:
    spec: Standardise
    means: list[float | None]
    deviations: list[float | None]

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = []
        for c, mean, deviation in zip(self.spec.cols, self.means, self.deviations):
            centred = self.spec.value(c) - F.lit(mean).cast("double")
            scaled.append((centred / F.lit(deviation or 1.0)).alias(f"{c}{self.spec.suffix}"))
        return df.select("*", *scaled)


class ClusterFeatures:
    """Cluster number and distance to the nearest centre, per k.

    Missing values count as 0, columns are standardised, and of several
    restarts the one with the least cost is kept. Centres are fitted on the
    training rows. First centres are Spark's (k-means||), ``workers`` restarts at
    a time, which share one copy of the points in memory, or on disk where they
    do not fit; then all go on together.
    """

    def __init__(
        self,
        cols: Sequence[str],
        ks: Sequence[int] = (5, 10),
        restarts: int = 10,
        seed: int = 42,
        max_iter: int = 300,
        tol: float = 1e-4,
        prefix: str = "cluster",
        workers: int = 4,
    ):
        self.cols, self.ks, self.restarts = list(cols), list(ks), restarts
        self.seed, self.max_iter, self.tol = seed, max_iter, tol
        self.prefix, self.workers = prefix, workers

    def fit(self, train: DataFrame) -> ClusterModel:
        scaler = Standardise(self.cols, suffix="__z", fill=0.0).fit(train.select(*self.cols))
        assembler = VectorAssembler(
            inputCols=[f"{c}__z" for c in self.cols], outputCol="__point"
        )
        points = assembler.transform(scaler.transform(train.select(*self.cols)))
        # Every restart and round reads the points again.
        points = materialise(points.select("__point"))

        def first_centres(k: int, restart: int) -> np.ndarray:
            start = KMeans(featuresCol="__point", k=k, seed=self.seed + restart, maxIter=0)
            return np.array(start.fit(points).clusterCenters())

        runs = [(k, r) for k in self.ks for r in range(self.restarts)]
        # Spark would keep a copy of its own for every restart.
        points.persist()
        try:
            starts = run_parallel([lambda k=k, r=r: first_centres(k, r) for k, r in runs], self.workers)
        finally:
            points.unpersist()
        blocks = materialise(points.select(vector_to_array("__point").alias("x")).mapInArrow(pack_points, "block binary"))
        fits = lloyd(blocks, starts, self.max_iter, self.tol)
        for (k, _), (_, _, rounds) in zip(runs, fits):
            if rounds >= self.max_iter:
                warnings.warn(f"k-means with k={k} stopped at {self.max_iter} iterations", stacklevel=2)
        discard(points, blocks)
        found = [(cost, r, k, centres) for (k, r), (centres, cost, _) in zip(runs, fits)]
        centres = {k: min((f for f in found if f[2] == k), key=lambda f: f[:2])[3] for k in self.ks}
        return ClusterModel(self, scaler, centres)


def pack_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: points (lists of doubles, all of one length) as binary blocks."""
    for batch in batches:
        values = batch.column(0).flatten().to_numpy()
        size = len(values) // max(len(batch.column(0)), 1) * 8
        ends = np.append(np.arange(0, values.nbytes, max(BLOCK // max(size, 1), 1) * max(size, 1)), values.nbytes)
        buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
        blocks = pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)
        yield pa.RecordBatch.from_arrays([blocks], names=["block"])


def gather(starts: Sequence[np.ndarray]):
    """For mapInArrow: what a round of k-means needs of the points, for each set of centres.

    One row per task: ``sums`` with the cost of each set, then for each centre
    of each set the sum and number of the points nearest to it. Of equally near
    centres the first counts.
    """
    width = starts[0].shape[1]
    bounds = np.cumsum([0, *map(len, starts)]).tolist()
    centres = np.concatenate(starts)
    # A point's (x, 1) times these: its squared distance but for x * x, which is the same for all.
    factors = np.concatenate([-2.0 * centres, (centres * centres).sum(axis=1)[:, None]], axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, costs = np.zeros((len(centres), width + 1)), np.zeros(len(starts))
        for batch in batches:
            # The blocks of a batch lie one after the other.
            blocks = batch.column(0)
            offsets = np.frombuffer(blocks.buffers()[1], np.int32)[blocks.offset : blocks.offset + len(blocks) + 1]
            points = np.frombuffer(blocks.buffers()[2][offsets[0] : offsets[-1]]) if len(blocks) else np.zeros(0)
            points = points.reshape(-1, width)
            for first in range(0, len(points), LOOK):
                some = points[first : first + LOOK].T
                x = np.concatenate([some, np.ones((1, some.shape[1]))])
                own = (x[:-1] * x[:-1]).sum(axis=0)
                apart = factors @ x
                nearest = np.empty(apart.shape)
                for s, (low, high) in enumerate(zip(bounds, bounds[1:])):
                    least, chosen = apart[low:high].min(axis=0), nearest[low:high]
                    np.equal(apart[low:high], least, out=chosen)
                    if chosen.sum() > len(least):
                        chosen *= np.cumsum(chosen, axis=0) == 1
                    costs[s] += np.maximum(least + own, 0.0).sum()
                sums += nearest @ x.T
        row = pa.array([np.concatenate([costs, sums.ravel()])], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([row], names=["sums"])

    return run


def lloyd(
    blocks: DataFrame, starts: Sequence[np.ndarray], max_iter: int, tol: float
) -> list[tuple[np.ndarray, float, int]]:
    """Centres, cost and rounds of k-means from each set of first centres.

    All sets go on together, so a round reads the points once for all that have
    not ended. A set ends when no centre moved by more than ``tol``, or after
    ``max_iter`` rounds; its cost is that of the last round's nearest centres.
    A centre that no point is nearest to stays. The driver gets sums per task.
    """
    found = [(centres, 0.0, 0) for centres in starts]
    going = list(range(len(starts)))
    for rounds in range(1, max_iter + 1):
        tasks = blocks.mapInArrow(gather([found[i][0] for i in going]), "sums array<double>").toArrow()
        sums = tasks.column(0).combine_chunks().flatten().to_numpy().reshape(tasks.num_rows, -1).sum(axis=0)
        costs, sums = sums[: len(going)], sums[len(going) :].reshape(-1, starts[0].shape[1] + 1)
        first, ended = 0, []
        for i, cost in zip(going, costs.tolist()):
            centres = found[i][0]
            own = sums[first : first + len(centres)]
            first += len(centres)
            with_points = own[:, -1] > 0
            moved = centres.copy()
            moved[with_points] = own[with_points, :-1] / own[with_points, -1:]
            found[i] = moved, cost, rounds
            if (((moved - centres) ** 2).sum(axis=1) <= tol * tol).all():
                ended.append(i)
        going = [i for i in going if i not in ended]
        if not going:
            break
    return found


@dataclass(frozen=True)
class ClusterModel:
    spec: ClusterFeatures
    scaler: StandardiseModel
    centres: dict[int, np.ndarray]

    def transform(self, df: DataFrame) -> DataFrame:
        """Distances as column expressions over the k centres."""
        scaled = self.scaler.transform(df)
        point = [F.col(f"`{c}__z`") for c in self.spec.cols]
        added = []
        for k, centres in self.centres.items():
            squares = [
                sum(((x - F.lit(float(v))) * (x - F.lit(float(v))) for x, v in zip(point, centre)), F.lit(0.0))
                for centre in centres
            ]
            nearest = F.array_min(
                F.array(*[F.struct(d.alias("d"), F.lit(j).alias("j")) for j, d in enumerate(squares)])
            )
            scaled = scaled.withColumn(f"__near{k}", nearest)
            added += [
                F.col(f"__near{k}.j").alias(f"{self.spec.prefix}_{k}"),
                F.sqrt(F.col(f"__near{k}.d")).alias(f"{self.spec.prefix}_{k}_dist"),
            ]
        return scaled.select(*[F.col(f"`{c}`") for c in df.columns], *added)

