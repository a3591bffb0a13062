"""Exact top-k search by inner product over an impact-ordered index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabloom.llm.common import pick
from tabloom.session import materialise

#: Rows of one block of the index, and queries of one block, on average.
BLOCK_ROWS = 8192
QUERY_ROWS = 256
#: Impacts (sizes of components) are quantised to so many levels.
LEVELS = 16
#: A query stops once at most this share of a block's rows can be among its best.
RESCORE_SHARE = 0.25
#: Shares of the postings after which the bounds are looked at.
STEPS = (0.5, 0.65, 0.8, 1.0)


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id, v: each component x as floor(scale * x); unusable vectors left out."""
    rows = pick(vectors, vec_id=id_col, raw=vector_col)
    x = F.col("raw").cast("array<double>")
    usable = ~F.exists(
        x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    )
    return (
        rows.filter(F.col("vec_id").isNotNull() & F.col("raw").isNotNull())
        .filter(usable)
        .select("vec_id", F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v"))
    )


class Index:
    """Postings of one block of vectors: segments of a dimension, sign and level.

    A component's impact is its size, quantised to a level by its integer
    division; a segment holds the rows whose component in a dimension has a
    sign and level, and the bounds of its components.
    """

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix
        n, dims = matrix.shape
        largest = int(np.abs(matrix).max(initial=0))
        self.largest = largest
        self.floats = matrix.astype(np.float64)
        step = max(1, -(-largest // LEVELS))
        # Signed level: truncation towards zero, so a level has one sign, and
        # level 0 holds small components of either sign.
        signed = np.sign(matrix) * (np.abs(matrix) // step)
        key = (signed + LEVELS + 1) + np.arange(dims) * (2 * LEVELS + 3)
        flat = key.T.ravel()
        order = np.argsort(flat, kind="stable")
        bounds = np.flatnonzero(np.r_[True, np.diff(flat[order]) != 0]) if n else np.zeros(0, int)
        self.start = np.r_[bounds, len(flat)]
        self.rows = order % max(n, 1)
        values = matrix.T.ravel()[order]
        self.dim = (order // max(n, 1))[bounds] if n else bounds
        self.low = np.minimum.reduceat(values, bounds) if n else bounds
        self.high = np.maximum.reduceat(values, bounds) if n else bounds
        # Per dimension, the least and greatest component of the block.
        self.least, self.most = (matrix.min(0), matrix.max(0)) if n else (np.zeros(dims, int),) * 2

    def best(self, query: np.ndarray, own: int, k: int, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the rows that can be among the k best.

        Segments come by falling impact, the most that a component can add over
        the least it could. A row's partial score counts its processed
        segments; what it has not met yet adds at most the highest impact that
        is left, dimension by dimension. The k-th best proven lower bound (or
        ``floor``, proven before) rules out rows whose upper bound is below it.
        Processing ends when few rows are left, or at the end of the segments;
        the rows left are scored exactly. Components so large that bounds would
        be rounded are scored exactly at once, in whole numbers.
        """
        n, dims = self.matrix.shape
        # Floating point is exact for whole numbers below 2^53. What is added up
        # below is at most twice the largest score, with the dimensions' count.
        bits = int(dims).bit_length()
        peak = self.largest * int(np.abs(query).max(initial=0)) * dims
        if 4 * peak << bits >= 2**53:
            return self.closest(self.matrix, np.arange(n), query, own, k)
        weight = query[self.dim]
        a, b = weight * self.low, weight * self.high
        most, least = np.maximum(a, b), np.minimum(a, b)
        base = np.minimum(query * self.least, query * self.most)
        impact = most - base[self.dim]
        # What quantisation can add in all, the widest segment of each dimension.
        width = np.zeros(dims)
        np.maximum.at(width, self.dim, most - least)
        slack = width.sum()
        order = np.argsort(-impact, kind="stable")
        # Impact and number of the segments met are added up as one number.
        both, carried = np.zeros(n), (impact * (1 << bits) + 1).astype(np.float64)
        sizes = np.diff(self.start)[order]
        ends = np.cumsum(sizes)
        alive, begin = np.arange(n), 0
        for share in STEPS:
            end = int(np.searchsorted(ends, share * ends[-1], "left")) + 1
            if end <= begin:
                continue  # a large segment has taken this step's share already
            part = order[begin:end]
            rows = np.concatenate([self.rows[self.start[s] : self.start[s + 1]] for s in part])
            both += np.bincount(rows, np.repeat(carried[part], sizes[begin:end]), n)
            begin = end
            whole = both.astype(np.int64)
            upper, met = base.sum() + (whole >> bits), whole & ((1 << bits) - 1)
            left = float(impact[order[end]]) if end < len(order) else 0.0
            bound = -np.inf if floor is None else floor
            if n > k:
                # One row at most is the query itself, which takes no part.
                bound = max(bound, np.partition(upper, n - k - 1)[n - k - 1] - slack)
            alive = np.flatnonzero(upper + (dims - met) * left >= bound)
            if len(alive) <= RESCORE_SHARE * n or end >= len(order):
                break
        return self.closest(self.floats, alive, query, own, k)

    def closest(
        self, matrix: np.ndarray, alive: np.ndarray, query: np.ndarray, own: int, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k best of some rows by their exact scores, without one row that is the query's own."""
        same = alive[self.ids[alive] == own]
        same = same[(self.matrix[same] == query).all(axis=1)]
        if len(same):
            alive = alive[alive != same[0]]
        # Sums of whole numbers below 2**53 are exact in floating point.
        scores = (matrix[alive] @ query.astype(matrix.dtype)).astype(np.int64)
        if len(alive) > k:
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            alive, scores = alive[scores >= kth], scores[scores >= kth]
        order = np.lexsort((self.ids[alive], -scores))[:k]
        return self.ids[alive][order], scores[order]


def unpack(ids: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, "<i8")
    return ids, np.frombuffer(values, "<i8").reshape(len(ids), -1) if len(ids) else np.zeros((0, 1), int)


def search_blocks(k: int):
    """For mapInArrow: each row joins a block of vectors with a block of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, index = None, None
        # The k-th best exact score of a query so far is a proven lower bound.
        floors: dict[tuple[int, int], int] = {}
        for batch in batches:
            for block, ids, values, asked, query_ids, query_values, copies in zip(*batch.columns):
                if known != block.as_py():
                    index = Index(*unpack(ids.as_py(), values.as_py()))
                    known = block.as_py()
                found = []
                own, queries = unpack(query_ids.as_py(), query_values.as_py())
                if not len(own):
                    continue
                times = np.frombuffer(copies.as_py(), "<i8")
                for place, (i, query) in enumerate(zip(own, queries)):
                    row = asked.as_py(), place
                    best, scores = index.best(query, int(i), k, floors.get(row))
                    if len(scores) == k:
                        floors[row] = max(int(scores[-1]), floors.get(row, int(scores[-1])))
                    same = (np.full(len(best), x, np.int64) for x in (i, *row, times[place]))
                    found.append((*same, best, scores))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in zip(*found)],
                    names=["query_id", "asked", "place", "copies", "vec_id", "score"],
                )

    return run


def blocks_of(rows: DataFrame, size: int, dims: int, total: int, most: int) -> DataFrame:
    """Rows as records of about ``size``: block, ids, values and copies, as packed numbers.

    A row that is there several times is in a block up to ``most`` times.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: dict[int, list] = {}
        for batch in batches:
            for block, vec_id, v, copies in zip(*(c.to_pylist() for c in batch.columns)):
                filled = (vec_id, v + [0] * (dims - len(v)), copies)
                rest.setdefault(block, []).extend([filled] * min(copies, most))
        for block, found in sorted(rest.items()):
            found.sort()
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([block], pa.int32()),
                    "ids": [np.array([x[0] for x in found], "<i8").tobytes()],
                    "vals": [np.array([x[1] for x in found], "<i8").tobytes()],
                    "copies": [np.array([x[2] for x in found], "<i8").tobytes()],
                }
            )

    n = max(1, -(-total // size))
    block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int").alias("block")
    keyed = rows.select(block, "vec_id", "v", "copies")
    return keyed.repartition(n, "block").mapInArrow(packed, "block int, ids binary, vals binary, copies binary")


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per query and rank (from 1): query_id, rank, vec_id, score.

    Components x become floor(scale * x). Queries are the rows that meet
    ``is_query``, a condition on ``vec_id``; candidates are all rows but the
    query's own. The k best inner products are returned, all if there are
    fewer; ties go to the smaller vec_id. Rows count by themselves, also where
    they repeat an id: each is a candidate, for another row of its id too, and
    each that is a query gives its own ranks. Equal rows are searched once, as
    k + 1 of them are all that k ranks can hold.

    Rows are indexed in blocks and the queries sent past each block in blocks,
    so no task holds more than one of each; each pair yields at most k rows a
    query, of which the best k remain.

    Vectors that are NULL or hold a NULL or non-finite component take no part,
    nor do rows without an id. Of unequal lengths, the shorter counts as filled
    with zeros. An empty table gives an empty one; further columns are left out.
    """
    rows = materialise(
        whole_numbers(vectors, id_col, vector_col, scale)
        .groupBy("vec_id", "v")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    queries = rows.filter(is_query)
    total, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    n_queries = queries.count()
    dims = max(dims, 1)
    blocks = blocks_of(rows, BLOCK_ROWS, dims, total, k + 1).drop("copies")
    asked = materialise(blocks_of(queries, QUERY_ROWS, dims, n_queries, 1)).toDF(
        "asked", "query_ids", "query_vals", "copies"
    )
    n_asked = max(1, -(-n_queries // QUERY_ROWS))
    pairs = blocks.withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1)))).join(
        asked, "asked"
    )
    found = pairs.select("block", "ids", "vals", "asked", "query_ids", "query_vals", "copies").mapInArrow(
        search_blocks(k), "query_id long, asked long, place long, copies long, vec_id long, score long"
    )
    order = W.partitionBy("asked", "place").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
        .select("query_id", "rank", "vec_id", "score")
    )
