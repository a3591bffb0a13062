"""Kept runs: saved, read again, applied to later rows."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_training import ready  # noqa: F401 - a fixture

from tabloom.operators import train as tr
from tabloom.plans import PLANS, load_run, run_plan
from tabloom.plans import kept as kept_module

#: Statistics, clusters and all encoders; ranks are defined within one table.
PLAN = replace(PLANS["evidence"], ranks=(), target_encoding=True, frequency=True, woe=True)
RAW_TEST = ("split", "source", "fold", "y")


@pytest.fixture(scope="module")
def run(spark, ready):  # noqa: F811
    models = {"boosted": tr.boosted(0.3, rounds=3, depth=3), "logistic": tr.logistic(max_iter=10)}
    return run_plan(ready, models, PLAN, folds=2, seeds=2, method="fixed", weights={"boosted": 0.75, "logistic": 0.25})


@pytest.fixture(scope="module")
def stored(spark, run, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("kept") / "run")
    run.kept.save(path)
    return path


def scores(df):
    return {r["id"]: r["score"] for r in df.collect()}


@pytest.mark.parametrize("large", [False, True])
def test_later_rows_score_as_in_the_run(spark, ready, run, stored, large, request):  # noqa: F811
    if large:
        request.getfixturevalue("tiny_bounds")
    later = ready.filter("split = 'test'").drop(*RAW_TEST)
    again = load_run(spark, stored)
    assert again.fitted.features == run.features and again.weights == run.kept.weights
    assert scores(again.score(later)) == pytest.approx(scores(run.test_scores), abs=1e-12)
    assert scores(run.kept.score(later)) == pytest.approx(scores(run.test_scores), abs=1e-12)


def test_unseen_and_missing_values_of_later_rows(spark, ready, stored):  # noqa: F811
    later = ready.filter("split = 'test'").drop(*RAW_TEST).limit(6)
    odd = later.withColumn("Contract", F.lit("never seen")).withColumn("MonthlyCharges", F.lit(None).cast("double"))
    again = load_run(spark, stored)
    found = again.fitted.transform(odd).first()
    assert found["Contract"] == -999 and found["Contract_freq"] == 0.0 and found["Contract_woe"] == 0.0
    got = scores(again.score(odd))
    assert len(got) == 6 and all(0 <= s <= 1 for s in got.values())
    assert again.score(later.limit(0)).count() == 0
    with pytest.raises(ValueError, match="Contract"):
        again.score(later.drop("Contract"))


def test_a_run_is_not_written_over(run, stored):
    with pytest.raises(Exception, match="(?i)exists"):
        run.kept.save(stored)


def test_another_version_is_refused(spark, run, tmp_path, monkeypatch):
    monkeypatch.setattr(kept_module, "VERSION", 2)
    run.kept.save(str(tmp_path / "next"))
    monkeypatch.setattr(kept_module, "VERSION", 1)
    with pytest.raises(ValueError, match="version 2"):
        load_run(spark, str(tmp_path / "next"))


def test_what_cannot_be_kept(ready):  # noqa: F811
    models = {"boosted": tr.boosted(0.3, rounds=2, depth=2), "forest": tr.forest(3, 3, 5)}
    assert run_plan(ready, models, "set_a", folds=2, method="rank").kept is None
    assert run_plan(ready, models, "set_a", folds=2, method="mean").kept is not None
