"""Run presets: every one end to end, shared steps once, nothing left behind."""

import os

import pytest
from pyspark.sql import functions as F
from test_training import subscribers

from tabloom.operators import train as tr
from tabloom.plans import PLANS, PRESETS, Preset, run_presets
from tabloom.plans.presets import GRIDS, Workshop, make_variants


@pytest.fixture(scope="module")
def tables(spark):
    pdf = subscribers()
    external = subscribers(40, 9).drop(columns="id")
    external["customerID"] = [f"c{i}" for i in range(40)]
    external["TotalCharges"] = external.TotalCharges.astype(str)
    train = spark.createDataFrame(pdf[pdf.id % 4 != 0])
    test = spark.createDataFrame(pdf[pdf.id % 4 == 0].drop(columns="Churn"))
    return train, test, spark.createDataFrame(external)


def small(name, **changes):
    return PRESETS[name].smaller(**{"rounds": 1, "depth": 2, "folds": 2, **changes})


def scores_of(spark, path, name):
    return {r["id"]: r["score"] for r in spark.read.parquet(f"{path}/scores/preset={name}").collect()}


def stored_tables(spark):
    root = os.path.join(spark.conf.get("spark.checkpoint.dir"), "tabloom")
    return {d for d, _, files in os.walk(root) if any(f.endswith(".parquet") for f in files)}


def test_presets_cover_all_plans_and_runs():
    assert len(PRESETS) == 19
    assert {plan for p in PRESETS.values() for plan in p.plans} == set(PLANS)
    for p in PRESETS.values():
        assert set(p.leads) <= set(p.models) and set(p.weights) in (set(), set(p.models))
    sizes = {name: len(make()) for name, make in GRIDS.items() if name != "four"}
    assert sizes == {"coarse": 79, "full": 218, "tenths": 60, "pair": 21}
    assert all(sum(w) == pytest.approx(1) and max(w) <= 0.5 + 1e-9 for w in GRIDS["four"]())


def test_every_preset_runs_and_shares_its_steps(spark, tables, tmp_path):
    path, shop = str(tmp_path / "runs"), Workshop()
    before = stored_tables(spark)
    wanted = [small(name) for name in PRESETS]
    board = run_presets(*tables, wanted, path, shop=shop).collect()
    assert {(r.preset, r.variant) for r in board} == {(p.name, v) for p in wanted for v in p.blends}
    assert all(sum(r.taken for r in board if r.preset == p.name) == 1 for p in wanted)
    for p in wanted:
        found = scores_of(spark, path, p.name)
        assert len(found) == 75 and all(0 <= s <= 1 for s in found.values()), p.name
        variants = spark.read.option("header", True).csv(f"{path}/variants/preset={p.name}")
        assert {r.variant: r["count"] for r in variants.groupBy("variant").count().collect()} == dict.fromkeys(p.blends, 75)
        if p.best:
            aucs = {r.variant: r.auc for r in board if r.preset == p.name}
            assert [r.auc for r in board if r.preset == p.name and r.taken] == [max(aucs.values())]
    records = {r.version: r for r in spark.read.json(f"{path}/records").collect()}
    assert set(records) == set(PRESETS)
    metrics = records["baseline"].metrics.asDict()
    assert metrics["n_rows"] == 75 and metrics["corr_a_b_42"] is not None and metrics["mean_score"] is not None
    # Three presets take the rows of 5 folds with the external table, two the plan of the ensemble, and so on.
    assert shop.computed["features"] == len({(p.plans, p.external, p.external_weight) for p in wanted}) + 3
    assert shop.computed["rows"] == len({(p.external and PLANS[q].uses_external, p.external_weight) for p in wanted for q in p.plans})
    assert not shop.made and not +shop.users
    assert stored_tables(spark) == before


def test_a_shared_step_gives_what_it_gives_alone(spark, tables, tmp_path):
    pair = [small("main_only"), small("main_only_seeds")]
    shop = Workshop()
    run_presets(*tables, pair, str(tmp_path / "both"), shop=shop)
    # Both take the main rows alone; with one seed their features and models are the same.
    assert shop.computed["features"] == 1 and shop.computed["scores"] == 3
    for p in pair:
        run_presets(*tables, [p], str(tmp_path / p.name))
        alone, shared = (scores_of(spark, str(tmp_path / x), p.name) for x in (p.name, "both"))
        assert alone == pytest.approx(shared, abs=1e-12)


def test_without_an_external_table(spark, tables, tmp_path):
    train, test, _ = tables
    runs = [small("fast"), small("weighted_stack")]
    assert run_presets(train, test, None, runs[:1], str(tmp_path / "x")).count() == 1
    with pytest.raises(ValueError, match="names"):
        run_presets(train, test, None, runs[:1] * 2, str(tmp_path / "y"))


def test_variants_are_the_blends_they_name(spark):
    rows = [
        (i, split, f, m, int(i % 3 == 0) if split == "train" else None, ((i * k) % 17) / 17 + 0.1 * (i % 3 == 0))
        for split, ids in (("train", range(60)), ("test", range(100, 120)))
        for i in ids
        for f in [i % 3 if split == "train" else None]
        for m, k in (("a", 5), ("b", 7), ("c", 11))
    ]
    base = spark.createDataFrame(rows, "id long, split string, fold int, model string, label int, score double")
    kinds = ("mean", "mean:a,b", "rank", "stack", "stack_rank", "stack_mean", "climb", "coarse", "tenths", "four", "fixed")
    preset = Preset("x", ("fast",), {}, kinds, folds=3, weights={"a": 0.75, "c": 0.25}, leads=("a", "b", "c"))
    found, used = make_variants(base, ["a", "b", "c"], preset, 42)
    by = {(r.variant, r.id): r.score for r in found.collect()}
    assert len(by) == 80 * len(kinds)
    score = {(r[0], r[3]): r[5] for r in rows}
    for i in (0, 7, 101):
        a, b, c = (score[i, m] for m in "abc")
        assert by["mean", i] == pytest.approx((a + b + c) / 3) and by["mean:a,b", i] == pytest.approx((a + b) / 2)
        assert by["fixed", i] == pytest.approx(0.75 * a + 0.25 * c)
        for kind, partner in (("stack_rank", "rank"), ("stack_mean", "mean")):
            w = used[kind]
            assert by[kind, i] == pytest.approx(w["stack"] * by["stack", i] + w[partner] * by[partner, i])
        w = used["four"]
        assert by["four", i] == pytest.approx(w["a"] * a + w["b"] * b + w["c"] * c + w["mean"] * (a + b + c) / 3)
    assert set(used) == {"stack_rank", "stack_mean", "climb", "coarse", "tenths", "four", "fixed"}
    with pytest.raises(ValueError, match="unknown blend"):
        make_variants(base, ["a"], Preset("x", (), {}, ("nothing",)), 42)


def test_searched_models_keep_their_draws_when_made_smaller(spark, tables, tmp_path):
    run = small("searched", trials=2)
    shop = Workshop()
    run_presets(*tables, [run], str(tmp_path / "s"), shop=shop)
    assert shop.computed["search"] == 3 and shop.computed["scores"] == 3
    spec = run.models["a"].make(learning_rate=0.05, depth=9, min_rows=7, row_share=0.9, column_share=0.5)
    assert isinstance(spec, tr.ModelSpec)
    assert spec.params["maxIter"] == 1 and spec.params["maxDepth"] == 2 and spec.params["stepSize"] == 0.05
