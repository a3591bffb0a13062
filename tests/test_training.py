"""Cross-fitted models and whole runs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import train as tr
from tabloom.operators.metrics import auc
from tabloom.plans import PLANS, build_features, prepare, run_plan
from tabloom.plans.subscription import CATEGORIES, NUMBERS

COUNTS = {
    "fast": 27, "baseline": 26, "quick": 31, "wide": 57, "ensemble": 56, "ensemble_target": 71,
    "wide_target": 70, "exhaustive": 134, "plain": 29, "stacked": 62, "exhaustive_risk": 134,
    "lite": 79, "slim": 122, "evidence": 154, "solo": 45, "set_a": 24, "set_b": 111,
    "set_c": 47, "set_d": 91,
}


def signal(rows=900, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=rows) > 0.3).astype(int)
    return pd.DataFrame(
        {
            "id": np.arange(rows),
            "split": np.where(np.arange(rows) % 5 == 0, "test", "train"),
            "y": y,
            **{f"x{i}": x[:, i] for i in range(3)},
        }
    )


@pytest.fixture(scope="module")
def assembled(spark):
    df = tr.with_training_folds(spark.createDataFrame(signal()), "y", 3, 42, mode="exact")
    return tr.assemble(df, ["x0", "x1", "x2"])


@pytest.fixture(scope="module")
def fitted(assembled):
    models = {
        "boosted": tr.boosted(0.2, rounds=6, depth=3, row_share=0.8, column_share=0.7, min_rows=5),
        "logistic": tr.logistic(max_iter=30),
    }
    return tr.cross_fit(assembled, models, folds=3)


def test_every_row_is_scored_once(fitted):
    scores = fitted.scores
    assert scores.columns == tr.SCORE_COLUMNS
    sizes = {(r.model, r.split): (r.n, r.d) for r in scores.groupBy("model", "split").agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("d")).collect()}
    assert sizes == {(m, s): (n, n) for m in ("boosted", "logistic") for s, n in (("train", 720), ("test", 180))}
    assert scores.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_signal_is_found(spark, fitted):
    for row in auc(fitted.out_of_fold(), by=["model"]).collect():
        assert row["auc"] > 0.75
    board = tr.leaderboard(fitted.scores).collect()
    assert board[0]["auc"] >= board[1]["auc"]
    top = tr.importance_topk(fitted.models["boosted", 42, 0], ["x0", "x1", "x2"], 2, spark).collect()
    assert len(top) == 2 and top[0].feature == "x0"
    assert top[0].importance >= top[1].importance


def test_held_out_rows_are_not_fitted_on(spark):
    """A key-like feature predicts nothing for rows outside the fit."""
    pdf = signal()
    rng = np.random.default_rng(0)
    pdf["y"] = (rng.random(len(pdf)) < 0.5).astype(int)
    df = tr.with_training_folds(spark.createDataFrame(pdf), "y", 3, 42)
    data = tr.assemble(df, ["x0", "x1", "x2"])
    scores = tr.cross_fit(data, {"m": tr.forest(10, 10, 1)}, folds=3).out_of_fold()
    assert abs(auc(scores).first()["auc"] - 0.5) < 0.1


def test_logistic_strength_matches_the_summed_loss(spark):
    """C=1 on the summed loss: the optimum's gradient is zero."""
    pdf = signal(400)
    pdf["split"], pdf["fold"] = "train", pdf.id % 2
    data = tr.assemble(spark.createDataFrame(pdf), ["x0", "x1", "x2"])
    model = tr.cross_fit(data, {"m": tr.logistic(C=1.0, max_iter=200)}, folds=2).models["m", 42, 0]
    rows = pdf[pdf.fold == 1]
    x, y = rows[["x0", "x1", "x2"]].to_numpy(), rows.y.to_numpy()
    w, b = np.array(model.coefficients), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    np.testing.assert_allclose(x.T @ (p - y) + w, 0, atol=0.05)


def test_weights_and_early_stopping(spark):
    pdf = signal(600)
    pdf["w"] = np.where(pdf.id % 2 == 0, 10.0, 1.0)
    pdf["y"] = np.where((pdf.id % 2 == 0), (pdf.x2 > 0).astype(int), (pdf.x2 < 0).astype(int))
    df = tr.with_training_folds(spark.createDataFrame(pdf), "y", 2, 42)
    heavy = tr.cross_fit(tr.assemble(df, ["x2"], weight="w"), {"m": tr.logistic(max_iter=30)}, 2)
    assert heavy.models["m", 42, 0].coefficients[0] > 0
    spec = tr.boosted(0.3, rounds=15, depth=2, early_stop=True)
    stopped = tr.cross_fit(tr.assemble(df, ["x0"]), {"m": spec}, 2)
    assert all(m.getNumTrees <= 15 for m in stopped.models.values())
    assert min(m.getNumTrees for m in stopped.models.values()) < 15


def test_stacking_seeds_and_search(spark, assembled, fitted):
    meta = tr.stack_meta(fitted.scores, ["boosted", "logistic"], folds=3)
    assert auc(meta.out_of_fold()).first()["auc"] > 0.75
    assert meta.test().count() == 180
    assert tr.seed_list(3) == [42, 1042, 2042]
    space = {"depth": tr.Range(1, 3), "learning_rate": tr.Range(0.05, 0.5, log=True)}
    draws = tr.draw_params(space, 20)
    assert draws == tr.draw_params(space, 20)
    assert all(1 <= d["depth"] <= 3 and 0.05 <= d["learning_rate"] <= 0.5 for d in draws)
    trials = tr.search_params(assembled, lambda **p: tr.boosted(rounds=2, **p), space, 2, 3)
    assert trials[0]["mean_auc"] >= trials[1]["mean_auc"] > 0.6


def subscribers(rows=300, seed=4):
    rng = np.random.default_rng(seed)
    pick = lambda *values: rng.choice(np.array(values, dtype=object), rows)
    pdf = pd.DataFrame({"id": np.arange(rows)})
    for c in CATEGORIES:
        pdf[c] = pick("Yes", "No")
    pdf["gender"] = pick("Male", "Female")
    pdf["InternetService"] = pick("DSL", "Fiber optic", "No")
    pdf["Contract"] = pick("Month-to-month", "One year", "Two year")
    pdf["PaymentMethod"] = pick("Electronic check", "Mailed check", "Credit card (automatic)", None)
    pdf["SeniorCitizen"] = rng.integers(0, 2, rows)
    pdf["tenure"] = rng.integers(0, 73, rows)
    pdf["MonthlyCharges"] = np.round(rng.random(rows) * 100 + 18, 2)
    pdf["TotalCharges"] = pdf.tenure * pdf.MonthlyCharges
    churned = (pdf.Contract == "Month-to-month") & (pdf.tenure < 40) | (rng.random(rows) < 0.1)
    pdf["Churn"] = np.where(churned, "Yes", "No")
    return pdf


@pytest.fixture(scope="module")
def ready(spark):
    pdf = subscribers()
    train = spark.createDataFrame(pdf[pdf.id % 4 != 0])
    test = spark.createDataFrame(pdf[pdf.id % 4 == 0].drop(columns="Churn"))
    external = subscribers(40, 9).drop(columns="id")
    external["customerID"] = [f"c{i}" for i in range(40)]
    external["TotalCharges"] = external.TotalCharges.astype(str)
    external.loc[0, "TotalCharges"] = " "
    return prepare(train, test, spark.createDataFrame(external), folds=3).cache()


def test_prepare(ready):
    sizes = {(r.split, r.source): r["count"] for r in ready.groupBy("split", "source").count().collect()}
    assert sizes == {("train", "main"): 225, ("train", "external"): 40, ("test", "main"): 75}
    assert ready.select("id").distinct().count() == 340
    assert ready.filter("split = 'test' AND (y IS NOT NULL OR fold <> -1)").count() == 0
    assert ready.filter("split = 'train' AND fold NOT IN (0, 1, 2)").count() == 0
    assert ready.filter("source = 'external' AND TotalCharges IS NULL").count() == 1


@pytest.mark.parametrize("name", PLANS)
def test_feature_counts(ready, name):
    """Each plan gives the recorded number of features, all of them numbers
    without gaps unless the plan leaves categories as text."""
    plan = PLANS[name]
    base = ready.drop("source")
    table = build_features(plan, base)
    assert len(table.features) == len(set(table.features)) == COUNTS[name]
    assert table.df.count() == base.count()
    numeric = [c for c, t in table.df.dtypes if t != "string" and c in table.features]
    assert len(numeric) == COUNTS[name] - (0 if plan.label_codes else len(CATEGORIES))
    gaps = table.df.select([F.count_if(F.col(c).isNull()).alias(c) for c in numeric]).first()
    assert not any(gaps)


def test_training_features_ignore_test_rows(ready):
    """Other test rows leave everything fitted on training rows unchanged."""
    names = ["Contract_MonthlyCharges_mean", "Contract_freq", "InternetService_tenure_std"]
    moved = ready.withColumn(
        "Contract", F.when(F.col("split") == "test", "Two year").otherwise(F.col("Contract"))
    ).withColumn("MonthlyCharges", F.when(F.col("split") == "test", 1.0).otherwise(F.col("MonthlyCharges")))
    tables = [
        build_features(PLANS["slim"], f.drop("source")).df.filter("split = 'train'").select("id", *names)
        for f in (ready, moved)
    ]
    assert tables[0].exceptAll(tables[1]).count() == 0


@pytest.mark.parametrize("method", ["grid", "climb", "stack"])
def test_run(ready, method):
    models = {"boosted": tr.boosted(0.3, rounds=3, depth=3), "forest": tr.forest(5, 5, 5)}
    result = run_plan(ready, models, "fast", folds=3, method=method)
    assert result.test_scores.count() == 75
    assert result.metrics["blend_42"] > 0.6
    row = result.record.first()
    assert row.features == COUNTS["fast"] and row.details["method"] == method


def test_run_over_seeds(ready):
    models = {"forest": tr.forest(5, 4, 5)}
    result = run_plan(ready, models, "set_a", folds=2, seeds=2, method="mean")
    assert {"blend_42", "blend_1042"} <= set(result.metrics)
    assert result.test_scores.count() == 75
    assert result.base_scores.select("seed").distinct().count() == 2
    assert set(NUMBERS) <= set(ready.columns)
