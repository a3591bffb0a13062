"""Faults that were mended: numeric flags, rules on NULL, weights, missing scores, sizes."""

import math
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import blend, lookup
from tabloom.operators import train as tr
from tabloom.operators.encode import FrequencyEncoder, LabelEncoder, TargetEncoder, WoeEncoder
from tabloom.operators.features import (
    FeatureSet,
    additive_score,
    count_equal,
    flag_equal,
    flag_not_equal,
    is_set,
    is_zero,
    rule_flag,
    under,
)
from tabloom.operators.groupstats import GroupStats, StatBlock
from tabloom.plans import prepare, run_plan
from tabloom.plans.subscription import PLANS
from tabloom.session import SHUFFLE_CLEANUP, materialise, run_tables, shuffles_removed


def test_flags_on_numbers_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 1, "Yes"), (2, 1.0, 0, None), (3, None, None, "1")], "id int, d double, i int, s string"
    )
    features = FeatureSet(
        [
            flag_equal("d_is_1", "d", "1"),
            flag_not_equal("d_not_0", "d", "0"),
            flag_equal("d_is_text", "d", "Yes"),
            flag_equal("s_is_1", "s", "1"),
            count_equal("ones", ["d", "i", "s"], "1"),
            rule_flag("zero", is_zero("d")),
            rule_flag("set", is_set("i"), under("d", 5)),
            additive_score("sum", is_set("i"), is_zero("d"), under("d", 0.5)),
        ]
    )
    rows = [tuple(r)[4:] for r in features.apply(df).orderBy("id").collect()]
    assert rows == [
        (0, 0, 0, 0, 1, 1, 1, 3),
        (1, 1, 0, 0, 1, 0, 0, 0),
        (0, 1, 0, 1, 1, 0, 0, 0),
    ]


def test_weight_equals_repetition(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"id": np.arange(80), "x": rng.normal(size=80)})
    pdf["y"] = (pdf.x + rng.normal(size=80) > 0).astype(int)
    pdf["w"], pdf["split"] = 5.0, "train"
    pdf["fold"] = pdf.id % 2
    repeated = pd.concat([pdf.assign(id=pdf.id + 1000 * k) for k in range(5)])
    once = tr.assemble(spark.createDataFrame(pdf), ["x"], weight="w")
    often = tr.assemble(spark.createDataFrame(repeated), ["x"])
    fits = [tr.cross_fit(t, {"m": tr.logistic(max_iter=200)}, 2).models["m", 42, 0] for t in (once, often)]
    assert fits[0].coefficients[0] == pytest.approx(fits[1].coefficients[0], rel=1e-4)
    plain = tr.assemble(spark.createDataFrame(pdf), ["x"])
    alone = tr.cross_fit(plain, {"m": tr.logistic(max_iter=200)}, 2).models["m", 42, 0]
    assert abs(alone.coefficients[0]) < abs(fits[0].coefficients[0])


def test_missing_scores_are_told(spark):
    df = spark.createDataFrame(
        [(1, 0.9, 0.8), (0, 0.2, None), (0, 0.3, 0.1), (1, 0.7, 0.6)], "label int, a double, b double"
    )
    with pytest.raises(ValueError, match="1 rows lack"):
        blend.grid_blend(df, ["a", "b"], "label", blend.grid2())
    with pytest.raises(ValueError, match="1 rows lack"):
        blend.hill_climb(df, ["a", "b"], "label")
    with pytest.warns(UserWarning, match="1 rows lack"):
        best = blend.grid_blend(df, ["a", "b"], "label", blend.grid2(), missing="drop")
    assert best.auc == 1.0
    sums = df.select(blend.weighted_sum(["a", "b"], [1.0, 0.0]).alias("s")).collect()
    assert [r.s for r in sums] == [0.9, 0.2, 0.3, 0.7]


def mixed(spark, rows=400):
    return spark.createDataFrame(
        [(i, f"k{i}", "ab"[i % 2], "xyz"[i % 3], float(i), i % 2, i % 4, "train") for i in range(rows)],
        "id int, long_one string, two string, three string, v double, y int, fold int, split string",
    )


@pytest.mark.parametrize("kind", ["frequency", "label", "target", "woe", "stats"])
def test_a_long_column_leaves_short_ones_small(spark, monkeypatch, kind):
    """Short columns add no shuffle, and values are those of the small way."""
    cols = ["long_one", "two", "three"]
    make = {
        "frequency": lambda c: FrequencyEncoder(c, suffix="_out"),
        "label": lambda c: LabelEncoder(c, suffix="_out"),
        "target": lambda c: TargetEncoder(c, "y", suffix="_out"),
        "woe": lambda c: WoeEncoder(c, "y", suffix="_out"),
        "stats": lambda c: GroupStats([StatBlock((x,), ("v",)) for x in c]),
    }[kind]
    df = mixed(spark)
    want = sorted(map(str, make(cols).fit(df).transform(df).collect()))
    monkeypatch.setattr(lookup, "MAX_ROWS", 50)
    limit = {"max_rows": 50} if kind == "label" else {}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        model = make(cols).fit(df, **limit)
        assert sorted(map(str, model.transform(df).collect())) == want
        joins = lambda m: m.transform(df)._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin")
        # One by key, one that takes what was found back to the rows.
        assert joins(model) == 2
        assert joins(make(["two", "three"]).fit(df, **limit)) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_long_keys_are_measured_before_they_are_collected(spark):
    table = spark.range(30).select(F.repeat(F.col("id").cast("string"), 5000).alias("k"), F.lit(1).alias("n_rows"))
    assert lookup.settle(table, ["k"]).small
    assert not lookup.settle(table, ["k"], max_bytes=50_000).small


def test_shuffle_cleanup_is_put_back(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    with shuffles_removed(spark):
        grouped = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
        kept = materialise(grouped)
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    assert kept.count() == 7 and grouped.count() == 7 and grouped.collect()


def test_run_tables_are_deleted(spark):
    with run_tables(spark):
        kept = materialise(spark.range(10))
        assert kept.count() == 10
        paths = kept.inputFiles()
    assert paths
    from pathlib import Path
    from urllib.parse import urlparse

    assert not any(Path(urlparse(p).path).exists() for p in paths)


def test_a_cluster_without_a_shared_folder_is_an_error():
    from tabloom.session import shared_folder

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def people(spark, rows=300, start=0):
    rng = np.random.default_rng(start + 2)
    pdf = pd.DataFrame({"id": np.arange(start, start + rows), "tenure": rng.integers(0, 70, rows)})
    pdf["MonthlyCharges"] = rng.uniform(20, 110, rows).round(2)
    pdf["TotalCharges"] = (pdf.tenure * pdf.MonthlyCharges).round(2)
    pdf["Contract"] = rng.choice(["Month-to-month", "One year", "Two year"], rows)
    risk = pdf.MonthlyCharges / 110 - pdf.tenure / 70 + rng.normal(0, 0.4, rows)
    pdf["Churn"] = np.where(risk > 0, "Yes", "No")
    return spark.createDataFrame(pdf)


def test_run_with_several_blends_and_without_the_external_table(spark):
    train, test = people(spark), people(spark, 60, 1000).drop("Churn")
    external = people(spark, 50, 5000).withColumnRenamed("id", "customerID")
    external = external.withColumn("customerID", F.col("customerID").cast("string"))
    ready = prepare(train, test, external, folds=2, fold_mode="exact")
    models = {"shallow": tr.boosted(rounds=3, depth=2), "deep": tr.boosted(rounds=3, depth=3)}
    methods = ["mean", "grid", "rank"]
    result = run_plan(ready, models, "fast", folds=2, seeds=2, method=methods, fold_mode="exact")
    assert result.method in methods
    assert result.variants.groupBy("variant").count().count() == 3
    assert result.test_scores.count() == 60 and result.base_scores.filter("split = 'train'").count() == 2 * 2 * 350
    assert set(result.models) == {(m, s, f) for m in models for s in (42, 1042) for f in (0, 1)}
    assert all(math.isfinite(v) for v in result.metrics.values())
    best = result.metrics[f"{result.method}_blend_42"] + result.metrics[f"{result.method}_blend_1042"]
    assert all(best >= result.metrics[f"{m}_blend_42"] + result.metrics[f"{m}_blend_1042"] for m in methods)
    without = replace(PLANS["fast"], name="alone", uses_external=False)
    alone = run_plan(ready, models, without, folds=2, method="mean", fold_mode="exact")
    assert alone.base_scores.filter("split = 'train'").count() == 2 * 300


def test_refit_of_the_best_trial(spark):
    df = people(spark, 200).withColumn("y", (F.col("Churn") == "Yes").cast("int")).withColumn("split", F.lit("train"))
    placed = tr.with_training_folds(df, "y", 4, 42)
    data = tr.assemble(placed, ["tenure", "MonthlyCharges"])
    make = lambda **p: tr.boosted(rounds=2, **p)
    ranked = [{"trial": 1, "mean_auc": 0.7, "params": {"depth": 2}}, {"trial": 0, "mean_auc": 0.6, "params": {"depth": 4}}]
    again = tr.refit_best(data, make, ranked, folds=4)
    assert len(again.models) == 4 and again.out_of_fold().count() == 200
    assert {m.getMaxDepth() for m in again.models.values()} == {2}
