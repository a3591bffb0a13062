"""Queries that do their whole job, and what they leave on disk while they do."""

import os
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from tabloom.catalog import encodings, training
from tabloom.operators import blend, scale
from tabloom.session import shared_folder


class Seen(Exception):
    pass


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with small tables of the star schema."""
    folder = str(tmp_path_factory.mktemp("tables"))

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")

    write("nation", [(i, f"N{i}") for i in range(5)], "n_nationkey int, n_name string")
    segments = ["BUILDING", "AUTOMOBILE", "FURNITURE"]
    write(
        "customer",
        [(i, f"C{i}", i % 5, i * 131.5 % 900 - 90, segments[i % 3]) for i in range(1, 41)],
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    )
    priorities = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    write(
        "orders",
        [(i, i * 7 % 40 + 1, "FOP"[i * i % 3], i * 977.25 % 5000, priorities[i % 5]) for i in range(1, 401)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string",
    )
    lines = [(i, float(i * j % 9 + 1)) for i in range(1, 401) for j in range(i % 6)]
    write("lineitem", lines, "l_orderkey long, l_quantity double")
    return folder


def test_cluster_features_takes_all_restarts_from_one_copy_of_the_points(spark, tables, monkeypatch):
    cached = []

    class Start(scale.KMeans):
        def fit(self, points):
            cached.append(points.is_cached)
            return super().fit(points)

    def look(blocks, starts, *_):
        assert [len(s) for s in starts] == [5] * 10 + [10] * 10
        raise Seen

    monkeypatch.setattr(scale, "KMeans", Start)
    monkeypatch.setattr(scale, "lloyd", look)
    with pytest.raises(Seen):
        encodings.cluster_features(spark, tables)
    assert cached == [True] * 20


def kept_tables(spark):
    folder = f"{shared_folder(spark)}/tabloom"
    return {f"{folder}/{name}" for name in (os.listdir(folder) if os.path.isdir(folder) else [])}


def test_a_search_compares_in_bounded_steps_and_leaves_no_table(spark, monkeypatch):
    rng = np.random.default_rng(5)
    df = pd.DataFrame({"a": rng.random(600), "b": rng.random(600), "y": (rng.random(600) < 0.4).astype(int)})
    grid, table = blend.grid2(), spark.createDataFrame(df)
    whole = blend.grid_blend(table, ["a", "b"], "y", grid)
    monkeypatch.setattr(blend, "BOUND_BINS", (8,))
    monkeypatch.setattr(blend, "LEAST_EXACT", 0)
    sizes, compared = [], blend.compared

    def counted(rows, weights, cells):
        sizes.append((len(cells), sum(int(c.mass.sum()) for c in cells.values())))
        return compared(rows, weights, cells)

    monkeypatch.setattr(blend, "compared", counted)
    before = kept_tables(spark)
    best = blend.grid_blend(table, ["a", "b"], "y", grid)
    assert (best.w_id, best.auc) == (whole.w_id, whole.auc)
    assert len(sizes) > 1 and all(mass <= 4 * len(df) or n == 1 for n, mass in sizes)
    assert sum(n for n, _ in sizes) == best.exact_candidates
    assert blend.blend_aucs(table, ["a", "b"], "y", grid).count() == len(grid)
    blend.hill_climb(table, ["a", "b"], "y", max_add=1)
    assert kept_tables(spark) == before


def test_a_run_deletes_features_and_vectors_once_they_are_scored(spark, tables):
    before = kept_tables(spark)
    row = training.kept_run(spark, tables).first()
    assert (row.n_rows, row.n_differ, row.same_features, row.n_bare) == (80, 0, True, 80)
    wide = []
    for path in kept_tables(spark) - before:
        if list(Path(path).rglob("*.parquet")) and not os.path.isdir(f"{path}/manifest"):
            left = spark.read.parquet(path)
            wide += [left.columns] * ("__features" in left.columns or "MonthlyCharges" in left.columns and left.count() > 80)
    assert wide == []
