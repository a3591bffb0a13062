"""Steps that are shared: rounds of k-means, and the frames that plans and runs read."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector

from tabloom.catalog import encodings, sets, training
from tabloom.operators import scale

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().analyzed().toString()


def points(spark, n=700):
    rng = np.random.default_rng(5)
    rows = np.round(rng.normal(size=(n, 3)), 3).tolist()
    df = spark.createDataFrame([(r,) for r in rows], "x array<double>").repartition(3)
    return scale.materialise(df)


def test_rounds_are_those_of_spark_and_read_the_points_once_for_all_sets(spark, monkeypatch):
    x = points(spark)
    vectors = scale.materialise(x.select(array_to_vector("x").alias("p")))
    tried = [(3, 1), (3, 2), (6, 1)]
    starts = [np.array(KMeans(featuresCol="p", k=k, seed=s, maxIter=0).fit(vectors).clusterCenters()) for k, s in tried]
    asked, gather = [], scale.gather
    monkeypatch.setattr(scale, "gather", lambda sets: asked.append(len(sets)) or gather(sets))
    fits = scale.lloyd(x.mapInArrow(scale.pack_points, "block binary"), starts, 300, 1e-4)
    for (k, seed), (centres, cost, rounds) in zip(tried, fits):
        whole = KMeans(featuresCol="p", k=k, seed=seed, maxIter=300, tol=1e-4).fit(vectors)
        assert np.allclose(whole.clusterCenters(), centres, atol=1e-9)
        assert whole.summary.trainingCost == pytest.approx(cost)
        assert whole.summary.numIter == rounds
    assert len(asked) == max(rounds for _, _, rounds in fits)
    assert asked[0] == 3


def test_equally_near_centres_and_centres_without_points(spark):
    x = spark.createDataFrame([([0.0],), ([2.0],), ([1.0],)], "x array<double>").coalesce(1)
    blocks = scale.materialise(x.mapInArrow(scale.pack_points, "block binary"))
    ((centres, cost, rounds),) = scale.lloyd(blocks, [np.array([[0.0], [2.0], [9.0]])], 1, 1e-4)
    assert centres.tolist() == [[0.5], [2.0], [9.0]]
    assert (cost, rounds) == (1.0, 1)


def test_points_fill_several_blocks(monkeypatch):
    monkeypatch.setattr(scale, "BLOCK", 50)
    x = np.arange(303.0).reshape(101, 3)
    batch = pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64()))], names=["x"])
    (packed,) = scale.pack_points(iter([batch]))
    assert packed.num_rows == 51
    centres = np.array([[0.0, 1.0, 2.0], [300.0, 301.0, 302.0]])
    (found,) = scale.gather([centres])(iter([packed.slice(0, 20), packed.slice(20)]))
    _, *sums = found.column(0)[0].as_py()
    assert np.allclose(np.array(sums).reshape(2, 4).sum(axis=0), [*x.sum(axis=0), 101])


def test_nearest_centres_are_checked_without_a_row_per_centre(spark):
    assert "explode" not in plan_of(encodings.cluster_nearest(spark, SF))


def test_counted_plans_share_one_frame(spark, monkeypatch):
    made = []
    monkeypatch.setattr(sets, "materialise", lambda df: made.append(df) or scale.materialise(df))
    sets.feature_counts(spark, SF)
    assert len(made) == 1


class Seen(Exception):
    pass


@pytest.mark.parametrize("name", ["run_plan_query", "kept_run", "preset_runs"])
def test_runs_read_a_frame_that_is_joined_once(spark, monkeypatch, name):
    def look(train, test, *_, **__):
        assert "Join" not in plan_of(train) + plan_of(test)
        raise Seen

    monkeypatch.setattr(training, "prepare", look)
    monkeypatch.setattr(training, "run_presets", look)
    with pytest.raises(Seen):
        getattr(training, name)(spark, SF)


def test_planted_signal_joins_its_frame_once(spark, monkeypatch):
    def look(df, *_, **__):
        assert "Join" not in plan_of(df)
        raise Seen

    monkeypatch.setattr(training.tr, "assemble", look)
    with pytest.raises(Seen):
        training.planted_signal(spark, SF)
