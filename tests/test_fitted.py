"""Group statistics, encodings and ranks: small tables, both ways of joining."""

import numpy as np
import pandas as pd
import pytest
from fixture_tables import both, column
from pyspark.sql import functions as F

from tabloom.operators import lookup
from tabloom.operators.encode import (
    CategoryEncoders,
    FrequencyEncoder,
    LabelEncoder,
    TargetEncoder,
    WoeEncoder,
)
from tabloom.operators.groupstats import GroupStats, StatBlock, stat_blocks, value_shares
from tabloom.operators.ranks import RankSpec, exact_medians, pct_rank, pct_ranks
from tabloom.operators.scale import ClusterFeatures, Standardise

IDS = [1, 2, 3, 4, 5, 6, 7, 8, 101, 102, 103]
EXPECTED = {
    "contract_monthly_mean": [52.5, 52.5, 52.5, 57.5, 57.5, 50, 80, 52.5, 52.5, 56.875, 80],
    "contract_monthly_std": [33.040379, 33.040379, 33.040379, 53.033009, 53.033009, 0, 0,
                             33.040379, 33.040379, 0, 0],
    "contract_monthly_diff": [17.5, -22.5, 37.5, -37.5, 37.5, 0, 0, -32.5, -17.5, -36.875, -10],
    "contract_freq": [0.571429, 0.571429, 0.571429, 0.285714, 0.285714, 0.142857, 0, 0.571429,
                      0.571429, 0, 0],
    "contract_code": [3, 3, 3, 0, 0, 1, 4, 3, 3, 2, 4],
    "contract_te": [0.3125, 0.479167, 0.3125, 0.431818, 0.340909, 0.375, 0.375, 0.479167,
                    0.410714, 0.375, 0.340909],
    "contract_woe": [-0.045462, -0.045462, -0.045462, -0.045462, -0.045462, 0.049848, 0.049848,
                     -0.045462, -0.045462, 0, 0.049848],
    "contract_monthly_rank": [0.8, 0.4, 1, 0.5, 1, 1, None, 0.2, 0.6, 1, None],
    "total_pctrank": [None, 0.25, 0.875, 0.6875, 1, None, 0.6875, 0.125, 0.375, 0.5, None],
}


def encoded(spark):
    df = both(spark)
    train = df.filter("split = 'train'")
    df = GroupStats(stat_blocks(["contract"], ["monthly"])).fit(train).transform(df)
    df = FrequencyEncoder(["contract"]).fit(train).transform(df)
    df = TargetEncoder(["contract"], "y", "fold", 10).fit(train).transform(df)
    df = WoeEncoder(["contract"], "y").fit(train).transform(df)
    df = pct_ranks(df, [RankSpec("monthly", "contract"), RankSpec("total")])
    return LabelEncoder(["contract"], suffix="_code").fit(df).transform(df)


def check(df):
    for name, values in EXPECTED.items():
        assert column(df, name) == dict(zip(IDS, values)), name


def test_expected_values(spark):
    check(encoded(spark))


def test_expected_values_when_nothing_is_small(spark, tiny_bounds):
    check(encoded(spark))


def test_expected_values_when_everything_is_broadcast(spark, monkeypatch):
    from tabloom.operators import lookup

    monkeypatch.setattr(lookup, "CONSTANT_KEYS", 0)
    check(encoded(spark))


def test_order_and_partitions_do_not_matter(spark):
    df = both(spark)
    turned = df.repartition(5, "payment").orderBy(F.desc("monthly"))
    for frame in (df, turned):
        train = frame.filter("split = 'train'")
        model = TargetEncoder(["payment"], "y", "fold").fit(train)
        values = column(model.transform(frame), "payment_te")
        if frame is df:
            first = values
    assert values == first


def test_own_label_does_not_reach_the_row(spark):
    """Flipping a label changes other folds' encodings, not the row's own
    category sums: with no smoothing towards the overall mean left, its own
    value stays."""
    df = both(spark).filter("split = 'train'")
    flipped = df.withColumn("y", F.when(F.col("id") == 2, 1).otherwise(F.col("y")))
    before, after = [
        column(TargetEncoder(["contract"], "y", "fold", smoothing=0).fit(d).transform(d), "contract_te")
        for d in (df, flipped)
    ]
    assert before[2] == after[2] and before[8] == after[8]
    assert before[1] != after[1]


def test_woe_of_the_other_folds(spark):
    train = both(spark).filter("split = 'train'")
    model = WoeEncoder(["contract"], "y", fold_col="fold").fit(train)
    got = column(model.transform(train), "contract_woe")
    # Fold 0 rows see ids 2, 4, 6, 8: three categories, no event.
    def woe(n, e, all_n, all_e, k):
        return np.log(((n - e + 10) / (all_n - all_e + 10 * k)) / ((e + 10) / (all_e + 10 * k)))

    assert got[1] == pytest.approx(woe(2, 0, 4, 0, 3), abs=1e-6)
    assert got[5] == pytest.approx(woe(1, 0, 4, 0, 3), abs=1e-6)
    assert got[7] == 0.0  # the missing category occurs in fold 0 only
    assert got[2] == pytest.approx(woe(2, 2, 4, 3, 3), abs=1e-6)


def test_group_of_missing_values_keeps_missing_for_training_rows(spark):
    df = spark.createDataFrame(
        [(1, "train", "a", 1.0), (2, "train", "b", None), (3, "test", "b", 5.0)],
        "id int, split string, k string, v double",
    )
    model = GroupStats([StatBlock(("k",), ("v",))]).fit(df.filter("split = 'train'"))
    out = model.transform(df)
    assert column(out, "k_v_mean") == {1: 1.0, 2: None, 3: 1.0}
    assert column(out, "k_v_std") == {1: 0.0, 2: 0.0, 3: 0.0}


def test_unseen_keys_get_zero_on_request(spark):
    df = spark.createDataFrame(
        [(1, "train", "a", 1.0), (2, "train", "a", 3.0), (3, "test", "b", 5.0)],
        "id int, split string, k string, v double",
    )
    block = StatBlock(("k",), ("v",), ("mean", "std", "median"), unseen="zero")
    out = GroupStats([block]).fit(df.filter("split = 'train'")).transform(df)
    row = out.filter("id = 3").first()
    assert (row["k_v_mean"], row["k_v_std"], row["k_v_median"], row["k_v_diff"]) == (0, 0, 0, 5.0)
    assert out.filter("id = 1").first()["k_v_median"] == 2.0


def skewed(spark, rows=4000):
    """One key and one value hold more than a third of all rows."""
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame(
        {
            "id": np.arange(rows),
            "k": np.where(rng.random(rows) < 0.4, "hot", rng.integers(0, 500, rows).astype(str)),
            "v": np.where(rng.random(rows) < 0.4, 0.0, np.round(rng.normal(size=rows), 2)),
        }
    )
    pdf.loc[::17, "k"] = None
    pdf.loc[::13, "v"] = np.nan
    return pdf, spark.createDataFrame(pdf).withColumn("v", F.expr("nullif(v, double('nan'))"))


def nodes(df):
    """All nodes of the physical plan."""
    found, rest = [], [df._jdf.queryExecution().executedPlan()]
    while rest:
        node = rest.pop()
        found.append(node)
        children = node.children()
        rest += [children.apply(i) for i in range(children.size())]
    return found


@pytest.mark.parametrize("large", [False, True])
def test_skewed_keys_and_values(spark, large, request):
    if large:
        request.getfixturevalue("tiny_bounds")
    pdf, df = skewed(spark)
    keyed = pdf.assign(k=pdf.k.fillna("nan"))
    groups = keyed.groupby("k").v
    stats = StatBlock(("k",), ("v",), ("mean", "std", "median"))
    frame = GroupStats([stats]).fit(df).transform(df)
    frame = pct_ranks(frame, [RankSpec("v", "k"), RankSpec("v")])
    frame = pct_rank(frame, "v", ["k"], "again")
    got = frame.toPandas().set_index("id").sort_index()
    want = pd.DataFrame(
        {
            "k_v_median": keyed.k.map(groups.median()),
            "k_v_std": keyed.k.map(groups.std().fillna(0)),
            "v_pctrank": pdf.v.rank(pct=True),
            "k_v_rank": pdf.groupby("k").v.rank(pct=True),
        }
    )
    assert len(got) == len(pdf)
    for name in want:
        ours = got[name].astype(float)
        if name == "k_v_median":
            ours = ours.where(want[name].notna())
        np.testing.assert_allclose(ours, want[name], atol=1e-9, err_msg=name)
    np.testing.assert_allclose(got.again.astype(float), want.k_v_rank, atol=1e-9)


def test_medians_of_several_key_sets(spark):
    pdf, df = skewed(spark, 1500)
    frame = df.fillna("nan", ["k"]).withColumn("m", F.col("id") % 3)
    rows = exact_medians(frame, [["k"], ["m", "k"]], ["v", "id"]).collect()
    keyed = pdf.assign(k=pdf.k.fillna("nan"), m=pdf.id % 3)
    one = keyed.groupby("k")[["v", "id"]].median()
    two = keyed.groupby(["m", "k"])[["v", "id"]].median()
    assert len(rows) == len(one) + len(two)
    for r in rows:
        want = one.loc[r.key0] if r.set_id == 0 else two.loc[(int(r.key0), r.key1)]
        assert r.median_id == pytest.approx(want.id)
        if not np.isnan(want.v):
            assert r.median_v == pytest.approx(want.v)


def test_label_codes_follow_code_points(spark, monkeypatch):
    values = ["b", "a", "B", None, "é", "nan", "ab", "a b", "Z", "0"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, x string")
    order = sorted({v or "nan" for v in values})
    want = {i: order.index(v or "nan") for i, v in enumerate(values)}
    assert column(LabelEncoder(["x"]).fit(df).transform(df), "x") == want
    assert column(LabelEncoder(["x"]).fit(df, max_rows=2).transform(df), "x") == want


def test_shares_and_scaling(spark):
    df = both(spark)
    shares = column(value_shares(df, "contract"), "share", "contract")
    assert shares == {"M": 0.555556, "1Y": 0.222222, "2Y": 0.111111, "3Y": 0.111111}
    constant = df.withColumn("one", F.lit(1.0))
    train = constant.filter("split = 'train'")
    out = Standardise(["monthly", "one"]).fit(train).transform(constant)
    values = [r[6] for r in train.select("*").collect()]
    z = column(out, "monthly_z")
    assert z[1] == pytest.approx((70 - np.mean(values)) / np.std(values), abs=1e-6)
    assert set(column(out, "one_z").values()) == {0.0}


def test_cluster_distances(spark):
    rng = np.random.default_rng(3)
    centres = np.array([[0, 0], [50, 0], [0, 50]])
    points = np.vstack([c + rng.normal(size=(60, 2)) for c in centres])
    pdf = pd.DataFrame(points, columns=["a", "b"]).assign(id=np.arange(180))
    df = spark.createDataFrame(pdf)
    out = ClusterFeatures(["a", "b"], ks=(3,), restarts=3).fit(df).transform(df).toPandas()
    out = out.sort_values("id")
    groups = out.cluster_3.to_numpy().reshape(3, 60)
    assert all(len(set(g)) == 1 for g in groups) and len(set(groups[:, 0])) == 3
    scaled = (points - points.mean(0)) / points.std(0)
    for g in range(3):
        part = scaled[g * 60 : (g + 1) * 60]
        want = np.linalg.norm(part - part.mean(0), axis=1)
        got = out.cluster_3_dist.to_numpy()[g * 60 : (g + 1) * 60]
        np.testing.assert_allclose(got, want, atol=1e-6)


def test_hot_keys_are_spread(spark, tiny_bounds):
    """Rows of a hot key end up in many partitions, also where it was not fitted."""
    _, df = skewed(spark)
    model = GroupStats([StatBlock(("k",), ("v",))]).fit(df.filter("k <> 'hot'"))
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = model.transform(df)
        by_key = [n for n in nodes(out) if n.nodeName() == "SortMergeJoin" and "k#" in n.toString().split("],")[0]]
        assert len(by_key) == 1
        asked = df.select(F.xxhash64("k").alias("h")).filter("k IS NOT NULL")
        assert lookup.frequent_keys(asked) == [df.filter("k = 'hot'").select(F.xxhash64("k")).first()[0]]
        # It meets no table by key: the filter is in the plan of both its sides.
        for side in (by_key[0].left(), by_key[0].right()):
            assert " IN (" in side.toString() or "INSET" in side.toString() or " = " in side.toString()
        sizes = (
            out.filter("k = 'hot'")
            .groupBy(F.spark_partition_id().alias("p"))
            .agg(F.count("*").alias("n"))
            .collect()
        )
        assert len(sizes) == int(width)
        assert max(r.n for r in sizes) < 2 * sum(r.n for r in sizes) / len(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def several(cols=("contract", "payment", "internet")):
    cols = list(cols)
    return [
        TargetEncoder(cols, "y", "fold"),
        FrequencyEncoder(cols),
        WoeEncoder(cols, "y", fold_col="fold"),
        LabelEncoder(cols, suffix="_code"),
    ]


def one_by_one(df, encoders):
    train = df.filter("split = 'train'")
    for encoder in encoders:
        fitted_on = df if isinstance(encoder, LabelEncoder) else train
        df = encoder.fit(fitted_on).transform(df)
    return df


@pytest.mark.parametrize("large", [False, True])
def test_encoders_fitted_together_give_what_each_gives(spark, large, request):
    if large:
        request.getfixturevalue("tiny_bounds")
    df = both(spark)
    # A category of test rows alone, the text of a missing one, and a fold that lacks a category.
    df = df.withColumn("payment", F.when(F.col("id") == 102, "test only").otherwise(F.col("payment")))
    df = df.withColumn("internet", F.when(F.col("id").isin(2, 103), "nan").otherwise(F.col("internet")))
    together = CategoryEncoders(several()).fit(df).transform(df)
    apart = one_by_one(df, several())
    assert set(together.columns) == set(apart.columns)
    for name in apart.columns:
        assert column(together, name) == column(apart, name), name


def test_encoders_fitted_together_read_the_rows_once(spark):
    df = both(spark)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        seen.add(1)
        return value

    watched = df.withColumn("contract", counted("contract")).select("id", "split", "fold", "y", "contract")
    CategoryEncoders(several(["contract"])).fit(watched)
    assert seen.value == df.count()


def test_long_columns_shuffle_the_rows_once(spark, tiny_bounds):
    """However many columns are long, and however many encoders there are."""
    df = both(spark).withColumn("wide", F.repeat(F.lit("x"), 100))
    model = CategoryEncoders(several()).fit(df)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = model.transform(df)
        carries = [n for n in nodes(out) if "Exchange" in n.nodeName() and "wide#" in n.output().toString()]
        assert len(carries) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_of_several_types_meet_in_the_narrow_join(spark, tiny_bounds):
    table = spark.createDataFrame(
        [(1, "a", 0.0, 10), (1, "a:1", 0.5, 20), (2, None, 1.0, 30)], "i int, t string, d double, v int"
    ).withColumn("n_rows", F.lit(1))
    rows = spark.createDataFrame(
        [(1, 1, "a", -0.0), (2, 1, "a:1", 0.5), (3, 2, None, 1.0), (4, None, "a", 0.0), (1, 1, "a", -0.0)],
        "id int, big long, t string, d double",
    )
    found = lookup.settle(table, ["i", "t", "d"])
    on = [F.col("big"), F.col("t"), F.col("d")]
    out = lookup.attach(rows, found, on, {"v": "got"})
    assert out.columns == [*rows.columns, "got"]
    assert sorted((r.id, r.got) for r in out.collect()) == [(1, 10), (1, 10), (2, 20), (3, None), (4, None)]
