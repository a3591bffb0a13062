"""AUCs of many weighted sums: cells, their refinement and the comparison in groups."""

import numpy as np
import pandas as pd
import pytest

from tabloom.operators import blend, weighted_auc


def brute(y, score):
    score = np.rint(np.asarray(score) * 1e12)
    pos, neg = score[y == 1], score[y == 0]
    return ((pos[:, None] > neg).mean() + (pos[:, None] >= neg).mean()) / 2


@pytest.fixture
def skewed():
    """Scores with one far outlier, one value that a third of the rows share, and equal rows."""
    rng = np.random.default_rng(3)
    a = rng.normal(size=1500) * 1e-6
    a[::3] = 2.5e-7
    a[7] = 4e3
    b = np.round(rng.random(1500), 2)
    return pd.DataFrame({"a": a, "b": b, "y": (rng.random(1500) < 0.3).astype(int)})


@pytest.mark.parametrize("group", [16, 1 << 19])
def test_all_aucs_of_skewed_scores(spark, skewed, group, monkeypatch):
    monkeypatch.setattr(weighted_auc, "GROUP", group)
    grid = [(1.0, 0.0), (0.5, 0.5), (0.0, 1.0), (-1.0, 1e-6), (0.0, 0.0)]
    found = {r.w_id: r for r in blend.blend_aucs(spark.createDataFrame(skewed), ["a", "b"], "y", grid).collect()}
    for i, (v, w) in enumerate(grid):
        assert found[i].auc == pytest.approx(brute(skewed.y, v * skewed.a + w * skewed.b), abs=1e-14)
        assert (found[i].n_pos, found[i].n_neg) == (skewed.y.sum(), (1 - skewed.y).sum())


def test_search_does_not_multiply_rows_by_candidates(spark, skewed, monkeypatch):
    """Candidates meet the rows inside the tasks; no table has one row for each of both."""
    def refuse(*args, **more):
        raise AssertionError("one row per row and candidate")
    monkeypatch.setattr(blend, "auc", refuse)
    best = blend.grid_blend(spark.createDataFrame(skewed), ["a", "b"], "y", blend.grid2())
    values = [brute(skewed.y, v * skewed.a + w * skewed.b) for v, w in blend.grid2()]
    assert best.auc == pytest.approx(max(values), abs=1e-14)


def test_rows_that_lack_a_score_and_tables_without_a_class(spark):
    df = spark.createDataFrame(
        [(0.1, 0.2, 1), (0.3, None, 0), (0.2, 0.1, 0), (0.5, 0.4, None)], "a double, b double, y int"
    )
    row = blend.blend_aucs(df, ["a", "b"], "y", [(1.0, 0.0)]).first()
    assert (row.auc, row.n_pos, row.n_neg) == (0.0, 1, 1)
    assert blend.blend_aucs(df.filter("y = 1"), ["a", "b"], "y", [(1.0, 0.0)]).first().auc is None
    assert blend.blend_aucs(df.filter("a > 1"), ["a", "b"], "y", [(1.0, 0.0)]).count() == 0


def test_refused_scores(spark):
    df = spark.createDataFrame([(float("nan"), 1), (0.1, 0)], "a double, y int")
    with pytest.raises(Exception, match="no number"):
        blend.blend_aucs(df, ["a"], "y", [(1.0,)]).collect()
