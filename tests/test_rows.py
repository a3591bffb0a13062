"""Row-wise features and cleaning on the small tables."""

import math

import pytest
from fixture_tables import both, column
from pyspark.sql import functions as F

from tabloom.operators import clean
from tabloom.operators import features as fx

EDGES7 = [-1, 3, 6, 12, 24, 48, 72, 999]
FEATURES = fx.FeatureSet(
    [
        fx.ratio("avg_spend", "total", "tenure", 1),
        fx.flag_equal("fiber", "internet", "Fiber"),
        fx.flag_not_equal("has_inet", "internet", "No"),
        fx.flag_contains("autopay", "payment", "automatic"),
        fx.flag_equal("mtm", "contract", "M"),
        fx.rule_flag("new_m", fx.under("tenure", 12), fx.is_set("mtm")),
        fx.cut("ten_bin", "tenure", EDGES7),
        fx.cut("ten_bin0", "tenure", [0, 12, 24, 48, 72, 999]),
        fx.cut("tot_bin", "total", [-1, 500, 1000, 2000, 4000, 6000, 999999]),
    ]
)
IDS = [1, 2, 3, 4, 5, 6, 7, 8, 101, 102, 103]
EXPECTED = {
    "avg_spend": [None, 23.875, 83.076923, 19.2, 93.150685, None, 68.571429, 0.01998, 28.333333,
                  18.461538, None],
    "fiber": [1, 0, 1, 0, 0, 0, 1, 0, 0, 0, 0],
    "has_inet": [1, 1, 1, 0, 1, 1, 1, 0, 1, 0, 1],
    "autopay": [0, 0, 1, 0, 1, 0, 0, 0, 0, 0, 0],
    "new_m": [1, 1, 0, 0, 0, 0, 0, 0, 1, 0, 0],
    "ten_bin": [0, 0, 2, 3, 5, 6, 1, None, 1, 2, 0],
    "ten_bin0": [None, 0, 0, 1, 3, 4, 0, None, 0, 0, None],
    "tot_bin": [None, 0, 2, 0, 5, None, 0, 0, 0, 0, None],
}


@pytest.fixture(scope="module")
def featured(spark):
    return FEATURES.apply(both(spark)).cache()


@pytest.mark.parametrize("name", EXPECTED)
def test_row_features(featured, name):
    assert column(featured, name) == dict(zip(IDS, EXPECTED[name]))


def test_target_spellings(spark):
    y = column(both(spark), "y")
    assert [y[i] for i in range(1, 9)] == [1, 0, 1, 0, 1, 0, 0, 0]


def test_unreadable_numbers_become_missing(spark):
    texts = ["1.5", " 2 ", "", " ", "abc", "nan", "12f", "1.5d", "1e3", "-.5", None, "Infinity"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, x string")
    got = column(clean.coerce_numeric(df, ["x"]), "x")
    want = [1.5, 2.0, None, None, None, None, None, None, 1000.0, -0.5, None, None]
    assert [got[i] for i in range(len(texts))] == want


def test_unlisted_values_become_missing(spark):
    df = spark.createDataFrame([(1, "Yes"), (2, "No"), (3, "?"), (4, None)], "id int, x string")
    assert column(clean.map_values(df, "x", {"Yes": 1, "No": 0}), "x") == {1: 1, 2: 0, 3: None, 4: None}


def test_logs_and_divisions_never_throw(spark):
    df = spark.createDataFrame(
        [(1, -1.0, 0.0), (2, -2.0, 0.0), (3, 0.0, 0.0), (4, math.nan, 1.0), (5, 1.0, 2.0)],
        "id int, x double, z double",
    )
    out = fx.FeatureSet([fx.log1p("log_x", "x"), fx.ratio("share", "x", "z")]).apply(df)
    assert column(out, "log_x") == {1: None, 2: None, 3: 0.0, 4: None, 5: 0.693147}
    assert column(out, "share") == {1: None, 2: None, 3: None, 4: None, 5: 0.5}


def test_counts_take_present_columns_only(spark):
    df = spark.createDataFrame([(1, "Yes", 2), (2, None, 0), (3, "No", None)], "id int, a string, b int")
    out = fx.FeatureSet(
        [fx.count_equal("n", ["a", "absent"], "Yes"), fx.count_active("m", ["a", "b"], "Yes"),
         fx.count_positive("p", ["b"])]
    ).apply(df)
    assert column(out, "n") == {1: 1, 2: 0, 3: 0}
    assert column(out, "m") == {1: 2, 2: 0, 3: 0}
    assert column(out, "p") == {1: 1, 2: 0, 3: 0}


def test_features_without_their_inputs(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, x double")
    chosen = fx.FeatureSet([fx.product("xx", "x", "x"), fx.product("xy", "x", "y"), fx.log1p("l", "xy")])
    assert chosen.apply(df).columns == ["id", "x", "xx"]
    with pytest.raises(ValueError, match="y"):
        chosen.apply(df, skip_missing=False)


def test_names_must_differ_beyond_case():
    with pytest.raises(ValueError, match="case"):
        fx.FeatureSet([fx.product("E", "a"), fx.product("e", "b")])


def test_features_are_few_projections(spark):
    """A wide set stays one projection per dependency level, without Python."""
    df = FEATURES.apply(both(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_fill_weight_and_split(spark):
    df = both(spark)
    assert column(clean.fill_missing(df, ["total"]), "total")[1] == -999.0
    assert clean.take_split(df, "test").count() == 3
    mean = clean.fill_with_mean(df, ["total"], df.filter("id < 100"))
    assert column(mean, "total")[1] == round((95.5 + 1080 + 480 + 6800 + 480 + 20) / 6, 6)
    tagged = clean.tag(df, source="ext").unionByName(clean.tag(df, source="main"))
    weights = clean.row_weight(tagged, {"ext": 10.0}).groupBy("source").agg(F.max("weight").alias("w"))
    assert column(weights, "w", "source") == {"ext": 10.0, "main": 1.0}
