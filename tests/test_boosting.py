"""Boosting stopped by held-out AUC: against models of each length and plain AUCs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.operators import boosting
from tabloom.operators import train as tr


def plain_auc(score, label):
    pos, neg = score[label == 1], score[label != 1]
    return float(np.mean([(p > neg).sum() + (p == neg).sum() / 2 for p in pos]) / len(neg))


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 900
    x = rng.normal(size=(n, 3))
    pdf = pd.DataFrame({"id": np.arange(n), "a": x[:, 0], "b": x[:, 1].round(1), "c": x[:, 2].round()})
    pdf[tr.LABEL] = (x[:, 0] + x[:, 1] ** 2 + rng.normal(size=n) * 1.5 > 0.8).astype(float)
    pdf[tr.WEIGHT] = 1.0
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol=tr.FEATURES).transform(spark.createDataFrame(pdf))
    return rows.filter("id < 600").cache(), rows.filter("id >= 600").cache()


SPEC = tr.boosted(learning_rate=0.4, depth=3, row_share=0.7, rounds=40)


@pytest.fixture(scope="module")
def fitted(data):
    return SPEC.with_rounds(12).estimator(7).fit(data[0])


def scores_of(model, rows):
    out = model.transform(rows).select("id", tr.LABEL, vector_to_array("probability")[1].alias("p"))
    return out.toPandas().sort_values("id")


def test_staged_aucs_are_those_of_the_cut_models(fitted, data, monkeypatch):
    monkeypatch.setattr(boosting, "ROUNDS_AT_ONCE", 5)
    aucs, best, over = boosting.best_round(fitted, data[1], tr.LABEL, patience=100)
    assert len(aucs) == 12 and not over
    for rounds in (1, 2, 5, 6, 12):
        own = scores_of(boosting.cut(fitted, rounds), data[1])
        assert aucs[rounds - 1] == pytest.approx(plain_auc(own.p.to_numpy(), own[tr.LABEL].to_numpy()), abs=1e-12)
    assert best == 1 + int(np.argmax(aucs))


def test_a_cut_model_is_the_model_of_fewer_rounds(fitted, data):
    short = SPEC.with_rounds(4).estimator(7).fit(data[0])
    np.testing.assert_allclose(
        scores_of(boosting.cut(fitted, 4), data[1]).p, scores_of(short, data[1]).p, atol=1e-12
    )


def test_patience():
    assert boosting.first_stop([], 3) == 0
    assert boosting.first_stop([0.6, 0.7, 0.7, 0.65], 3) == 1
    # A later, higher round does not count once patience is over.
    assert boosting.first_stop([0.6, 0.7, 0.6, 0.6, 0.9], 2) == 1
    assert boosting.first_stop([0.6, 0.7, 0.6, 0.6, 0.9], 3) == 4


def test_fits_double_until_patience_is_over(data, monkeypatch):
    asked = []
    monkeypatch.setattr(boosting, "FIRST_FIT", 1)

    def fit(rounds):
        asked.append(rounds)
        return SPEC.with_rounds(rounds).estimator(7).fit(data[0])

    found = boosting.fit_until(fit, data[1], tr.LABEL, 40, 4)
    assert asked[0] == 4 and all(b == min(40, 2 * a) for a, b in zip(asked, asked[1:]))
    whole, best, _ = boosting.best_round(fit(asked[-1]), data[1], tr.LABEL, 4)
    assert found.best_round == best and found.aucs[: len(whole)] == pytest.approx(whole)
    assert len(found.model.treeWeights) == best and found.best_auc == max(found.aucs[:best])
    assert found.early or found.fitted_rounds == 40


def test_held_out_rows_of_one_label(fitted, data):
    aucs, best, over = boosting.best_round(fitted, data[1].filter(F.col(tr.LABEL) == 1), tr.LABEL, 3)
    assert set(aucs) == {0.5} and best == 1 and over


def test_cross_fit_keeps_what_was_stopped(spark, data):
    rows = data[0].withColumn("split", F.lit("train")).withColumn("fold", (F.col("id") % 2).cast("int"))
    spec = tr.boosted(learning_rate=0.4, depth=2, rounds=16, patience=3)
    fit = tr.cross_fit(rows, {"p": spec}, folds=2, seed=7)
    assert {k: len(m.treeWeights) for k, m in fit.models.items()} == {
        k: s.best_round for k, s in fit.stopped.items()
    }
    assert fit.out_of_fold().count() == 600
