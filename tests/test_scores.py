"""Metrics, blends and folds."""

import numpy as np
import pandas as pd
import pytest
from fixture_tables import LABELS, SCORES, column, long_scores
from pyspark.sql import functions as F

from tabloom.operators import blend
from tabloom.operators.folds import assign_folds
from tabloom.operators.metrics import auc, correlation_matrix, score_summary
from tabloom.operators.train import leaderboard


def brute_auc(labels, scores):
    labels, scores = np.asarray(labels), np.round(np.asarray(scores), 12)
    pos, neg = scores[labels == 1], scores[labels == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def random_scores(rows=600, seed=1):
    rng = np.random.default_rng(seed)
    y = (rng.random(rows) < 0.3).astype(int)
    return pd.DataFrame(
        {
            "id": np.arange(rows),
            "y": y,
            "a": np.round(rng.random(rows) + 0.30 * y, 2),
            "b": rng.random(rows) + 0.25 * y,
            "c": np.where(rng.random(rows) < 0.4, 0.5, rng.random(rows) + 0.2 * y),
        }
    )


@pytest.fixture(scope="module")
def wide(spark):
    return blend.pivot_scores(long_scores(spark), list(SCORES), keep=["label"]).cache()


def test_auc_per_model(spark):
    got = column(auc(long_scores(spark), by=["model"]), "auc", "model")
    assert got == {"a": 0.866667, "b": 0.733333, "c": 0.5}


def test_auc_of_one_class_is_missing(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")
    assert auc(df).first()["auc"] is None


def test_auc_properties(spark):
    pdf = random_scores()
    df = spark.createDataFrame(pdf).select(F.col("y").alias("label"), F.col("c").alias("score"))
    value = auc(df).first()["auc"]
    assert value == pytest.approx(brute_auc(pdf.y, pdf.c), abs=1e-12)
    assert auc(df.union(df)).first()["auc"] == pytest.approx(value, abs=1e-12)
    turned = auc(df.withColumn("score", -F.col("score"))).first()["auc"]
    assert turned == pytest.approx(1 - value, abs=1e-12)
    spread = auc(df.repartition(7, "score")).first()["auc"]
    assert spread == pytest.approx(value, abs=1e-12)


def test_mean_and_rank_blends(spark):
    scores = long_scores(spark)
    mean = blend.mean_blend(scores, keep=["label"])
    want = [0.6, 0.533333, 0.6, 0.266667, 0.4, 0.4, 0.333333, 0.166667]
    assert column(mean, "score") == dict(zip(range(1, 9), want))
    assert auc(mean).first()["auc"] == pytest.approx(0.9)
    ranked = blend.rank_mean_blend(scores, keep=["label"])
    assert auc(ranked).first()["auc"] == pytest.approx(0.8)
    fixed = blend.weighted_blend(scores, {"a": 0.2, "b": 0.3, "c": 0.5})
    assert column(fixed, "score")[1] == pytest.approx(0.2 * 0.9 + 0.3 * 0.5 + 0.5 * 0.4)


def test_grid_sizes():
    sizes = [len(g) for g in (blend.grid3_coarse(), blend.grid3_full(), blend.grid3_full(0.1), blend.grid2())]
    assert sizes == [79, 218, 60, 21]


def test_full_grid_and_hill_climb_on_the_small_table(wide):
    assert blend.grid_blend(wide, list(SCORES), "label", blend.grid3_full()).auc == 1.0
    climb = blend.hill_climb(wide, list(SCORES), "label")
    assert climb.selected == ["a", "b"]
    assert climb.aucs == pytest.approx([0.866667, 0.966667], abs=1e-6)
    assert climb.weights == {"a": 0.5, "b": 0.5}


@pytest.mark.parametrize("bins", [(4,), (8, 64), (256, 2048)])
def test_search_equals_brute_force(spark, bins, monkeypatch):
    """Ruling candidates out never loses the winner, nor the first of a tie."""
    monkeypatch.setattr(blend, "BOUND_BINS", bins)
    monkeypatch.setattr(blend, "FEW_CANDIDATES", 0)
    pdf = random_scores()
    grid = blend.grid3_full(0.1)
    values = [brute_auc(pdf.y, w[0] * pdf.a + w[1] * pdf.b + w[2] * pdf.c) for w in grid]
    best = blend.grid_blend(spark.createDataFrame(pdf), ["a", "b", "c"], "y", grid)
    assert best.w_id == int(np.argmax(np.round(values, 12)))
    assert best.auc == pytest.approx(max(values), abs=1e-12)
    assert 1 <= best.exact_candidates <= len(grid)


def test_search_in_chunks_and_on_ties(spark):
    pdf = random_scores(200)
    df = spark.createDataFrame(pdf)
    same = [(1.0, 0.0, 0.0), (2.0, 0.0, 0.0), (3.0, 0.0, 0.0)]
    best = blend.best_blend(blend.search_table(df, ["a", "b", "c"], "y"), ["a", "b", "c"], "y", same, chunk=2)
    assert best.w_id == 0 and best.auc == pytest.approx(brute_auc(pdf.y, pdf.a))


def test_hill_climb_equals_brute_force(spark):
    pdf = random_scores(400, seed=5)
    cols = ["a", "b", "c"]
    picks, last = [], 0.0
    for step in range(12):
        options = [brute_auc(pdf.y, pdf[picks + [c]].mean(axis=1)) for c in cols]
        i = int(np.argmax(np.round(options, 12)))
        if step and options[i] - last <= 1e-5:
            break
        picks.append(cols[i])
        last = options[i]
    climb = blend.hill_climb(spark.createDataFrame(pdf), cols, "y")
    assert climb.selected == picks
    assert climb.aucs[-1] == pytest.approx(last, abs=1e-12)


def test_summary_and_correlation(spark, wide):
    row = score_summary(long_scores(spark).filter("model = 'a'")).first()
    assert (row.min_score, row.max_score, row.n_rows) == (0.1, 0.9, 8)
    cells = {(r.a, r.b): r["corr"] for r in correlation_matrix(wide, list(SCORES)).collect()}
    assert len(cells) == 9 and cells["a", "a"] == 1.0
    assert cells["a", "b"] == cells["b", "a"] == pytest.approx(0.149786, abs=1e-6)
    assert cells["a", "c"] == pytest.approx(-0.293101, abs=1e-6)
    assert cells["b", "c"] == pytest.approx(0.372723, abs=1e-6)


def test_best_variant_and_leaderboard(spark):
    scores = long_scores(spark)
    variants = scores.withColumnRenamed("model", "variant")
    assert blend.pick_best(variants).first()["variant"] == "a"
    assert [r.model for r in leaderboard(scores).collect()] == ["a", "b", "c"]


def test_blend_of_two_score_tables(spark):
    one = spark.createDataFrame([(1, 0.2), (2, 0.4)], "id BIGINT, score DOUBLE")
    two = spark.createDataFrame([(2, 0.8), (3, 0.1)], "id BIGINT, score DOUBLE")
    got = column(blend.blend_score_tables(one, two, 0.75, 0.25), "score")
    assert got == {2: 0.5}


@pytest.mark.parametrize("mode", ["hash", "exact"])
def test_folds_depend_on_key_and_seed_only(spark, mode):
    df = spark.range(997).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    first = column(assign_folds(df, "id", "y", 5, 42, mode), "fold")
    moved = df.repartition(6, "y").orderBy(F.desc("id"))
    assert column(assign_folds(moved, "id", "y", 5, 42, mode), "fold") == first
    assert column(assign_folds(df, "id", "y", 5, 43, mode), "fold") != first
    assert set(first.values()) == set(range(5))


def test_exact_folds_are_stratified(spark):
    df = spark.range(1003).withColumn("y", F.when(F.col("id") % 10 == 3, None).otherwise(F.col("id") % 3))
    sizes = assign_folds(df, "id", "y", 10, 7, "exact").groupBy("y", "fold").count().collect()
    by_label = {}
    for r in sizes:
        by_label.setdefault(r.y, []).append(r["count"])
    assert len(by_label) == 4
    assert all(max(c) - min(c) <= 1 and len(c) == 10 for c in by_label.values())
