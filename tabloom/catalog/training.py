"""Cross-fitted models, searches and runs.

Trained models have no counterpart in SQL, so most of these queries carry
none; they fit on all training rows of the table they are given.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.catalog.base import orders_frame, query, rounded, subscriber_frame, table
from tabloom.catalog.sets import planned
from tabloom.operators import train as tr
from tabloom.operators.blend import pivot_scores, seed_mean_blend
from tabloom.operators.clean import fill_missing, row_weight, tag
from tabloom.operators.encode import LabelEncoder
from tabloom.operators.metrics import auc
from tabloom.operators.scale import Standardise
from tabloom.plans import PRESETS, load_run, prepare, run_plan, run_presets
from tabloom.session import discard, materialise, shared_folder

NUMERIC = ["total", "balance", "li_qty", "li_n"]


def _assembled(spark: SparkSession, sf_dir: str, folds: int = 3) -> DataFrame:
    """Orders with codes and numbers as one vector per row."""
    base = orders_frame(spark, sf_dir, lines=True)
    coded = LabelEncoder(["priority", "segment", "nation"]).fit(base).transform(base)
    filled = fill_missing(coded, NUMERIC)
    placed = tr.with_training_folds(filled, "y", folds, 42)
    return tr.assemble(placed, ["priority", "segment", "nation", *NUMERIC])


def _small_boost(**more) -> tr.ModelSpec:
    return tr.boosted(learning_rate=0.1, rounds=4, depth=3, row_share=0.8, min_rows=20, **more)


def _per_model(scores: DataFrame) -> DataFrame:
    """Rows and score range per model and split."""
    return scores.groupBy("model", "split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        (F.min("score") >= 0).alias("not_negative"),
        (F.max("score") <= 1).alias("at_most_one"),
    )


_SHAPE = """SELECT '{model}' AS model,
      CASE WHEN o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split, count(*) AS n_rows,
      count(*) AS n_ids, TRUE AS not_negative, TRUE AS at_most_one FROM orders GROUP BY ALL"""


@query("cross_fit_logistic", _SHAPE.format(model="logistic"))
def cross_fit_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row gets one score per model: held out for training rows, the
    mean over the folds for test rows."""
    base = orders_frame(spark, sf_dir, lines=True)
    filled = fill_missing(base, NUMERIC)
    scaled = Standardise(NUMERIC).fit(filled.filter("split = 'train'")).transform(filled)
    placed = tr.with_training_folds(scaled, "y", 3, 42)
    data = tr.assemble(placed, [f"{c}_z" for c in NUMERIC])
    fitted = tr.cross_fit(data, {"logistic": tr.logistic(C=1.0, max_iter=50)}, folds=3)
    return _per_model(fitted.scores)


@query("cross_fit_boosted", _SHAPE.format(model="boosted"))
def cross_fit_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _small_boost(column_share=0.7, bins=64)
    fitted = tr.cross_fit(_assembled(spark, sf_dir), {"boosted": spec}, folds=3)
    return _per_model(fitted.scores)


@query("cross_fit_early_stopping", _SHAPE.format(model="stopped"))
def cross_fit_early_stopping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosting that stops when the held-out loss no longer improves."""
    spec = _small_boost(early_stop=True)
    fitted = tr.cross_fit(_assembled(spark, sf_dir, 2), {"stopped": spec}, folds=2)
    return _per_model(fitted.scores)


@query(
    "cross_fit_auc_patience",
    """SELECT unnest(range(0, 3))::INTEGER AS fold, TRUE AS stopped_early, TRUE AS first_best,
      TRUE AS last_not_above, TRUE AS waited, TRUE AS cut_there, TRUE AS scores_agree, TRUE AS signal_found,
      TRUE AS fewer_fitted""",
)
def cross_fit_auc_patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosting stopped by held-out AUC, on a label with a signal and noise.

    Per fold: it stopped before its most rounds, at the first round of the
    highest AUC; the last AUC is not above it and patience was kept; the model
    is cut there and scores as that round did; the signal was found; and fits
    ended before the most rounds.
    """
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    base = orders_frame(spark, sf_dir).withColumn("y", (F.col("s1") + noise > 0.8).cast("int"))
    data = tr.assemble(tr.with_training_folds(base, "y", 3, 42), ["s1", "s2", "s3"])
    patience, most = 5, 160
    spec = tr.boosted(learning_rate=0.3, rounds=most, depth=3, row_share=0.8, min_rows=20, patience=patience)
    fitted = tr.cross_fit(data, {"patient": spec}, folds=3)
    scored = {r["fold"]: r["auc"] for r in auc(fitted.out_of_fold(), by=["fold"]).collect()}
    rows = []
    for (_, _, fold), found in sorted(fitted.stopped.items()):
        aucs, best = found.aucs, found.best_round
        rows.append(
            (
                fold,
                found.early,
                best == 1 + aucs.index(max(aucs[: best + patience])),
                aucs[-1] <= found.best_auc,
                len(aucs) >= best + patience,
                len(found.model.treeWeights) == best,
                abs(scored[fold] - found.best_auc) < 1e-9,
                found.best_auc > 0.7,
                found.fitted_rounds < most,
            )
        )
    names = "stopped_early first_best last_not_above waited cut_there scores_agree signal_found fewer_fitted"
    return spark.createDataFrame(rows, "fold int, " + ", ".join(f"{n} boolean" for n in names.split()))


@query("cross_fit_forest", _SHAPE.format(model="forest"))
def cross_fit_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = tr.forest(trees=10, depth=6, min_rows=50)
    fitted = tr.cross_fit(_assembled(spark, sf_dir), {"forest": spec}, folds=3)
    return _per_model(fitted.scores)


@query("weighted_fit")
def weighted_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one source weigh ten times as much as the others."""
    base = orders_frame(spark, sf_dir).withColumn(
        "source", F.when(F.col("segment") == "BUILDING", "external").otherwise("main")
    )
    weighted = row_weight(base, {"external": 10.0})
    placed = tr.with_training_folds(weighted, "y", 3, 42)
    data = tr.assemble(placed, ["s1", "s2", "s3"], weight="weight")
    fitted = tr.cross_fit(data, {"logistic": tr.logistic(max_iter=50)}, folds=3)
    return rounded(fitted.scores.drop("feature_set"))


@query("multi_seed")
def multi_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds and models per seed, AUC per seed and of the mean over seeds."""
    base = orders_frame(spark, sf_dir)

    def of_seed(seed: int) -> DataFrame:
        placed = tr.with_training_folds(base, "y", 3, seed)
        data = tr.assemble(placed, ["s1", "s2", "s3"])
        return tr.cross_fit(data, {"logistic": tr.logistic(max_iter=50)}, 3, seed).scores

    scores = tr.multi_seed(of_seed, tr.seed_list(3))
    return rounded(auc(scores.filter("split = 'train'"), by=["model", "seed"]))


@query("feature_sets_by_models")
def feature_sets_by_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feature sets times two models on the same folds."""
    base = tr.with_training_folds(orders_frame(spark, sf_dir), "y", 3, 42)
    sets = {
        "a": tr.assemble(base, ["s1", "s3"]),
        "b": tr.assemble(base, ["s1", "s2", "s3"]),
    }
    models = {"logistic": tr.logistic(max_iter=50), "forest": tr.forest(5, 4, 50)}
    return _per_model(tr.cross_sets(sets, models, folds=3))


@query("search_params")
def search_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random search over boosting parameters by mean fold AUC."""
    space = {
        "learning_rate": tr.Range(0.01, 0.3, log=True),
        "depth": tr.Range(2, 4),
        "row_share": tr.Range(0.5, 1.0),
    }

    def make(**params) -> tr.ModelSpec:
        return tr.boosted(rounds=3, min_rows=20, **params)

    trials = tr.search_params(_assembled(spark, sf_dir, 2), make, space, trials=3, folds=2)
    rows = [(t["trial"], float(t["mean_auc"]), str(sorted(t["params"]))) for t in trials]
    return spark.createDataFrame(rows, "trial int, mean_auc double, params string")


@query("feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features a boosted model relies on most."""
    data = _assembled(spark, sf_dir, 2)
    fitted = tr.cross_fit(data, {"boosted": _small_boost()}, folds=2)
    names = ["priority", "segment", "nation", *NUMERIC]
    model = fitted.models[("boosted", 42, 0)]
    return rounded(tr.importance_topk(model, names, 5, spark))


@query("stack_meta", _SHAPE.format(model="meta"))
def stack_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A logistic model over base scores, on the same folds."""
    from tabloom.catalog.scores import MODELS, score_table

    scores = score_table(spark, sf_dir)
    stacked = tr.stack_meta(scores, MODELS, folds=5)
    return _per_model(stacked.scores)


@query("ablation")
def ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fit with and without rows of another source."""
    base = orders_frame(spark, sf_dir).select("id", "split", "y", "s1", "s2", "s3")
    other = (
        table(spark, sf_dir, "customer")
        .select(
            (-F.col("c_custkey") - 1).alias("id"),
            F.lit("train").alias("split"),
            (F.col("c_acctbal") > 5000).cast("int").alias("y"),
            F.lit(0.5).alias("s1"),
            F.lit(0.5).alias("s2"),
            F.lit(0.5).alias("s3"),
        )
    )

    def scored(frame: DataFrame) -> DataFrame:
        placed = tr.with_training_folds(frame, "y", 3, 42)
        data = tr.assemble(placed, ["s1", "s2", "s3"])
        fitted = tr.cross_fit(data, {"logistic": tr.logistic(max_iter=50)}, 3)
        return fitted.out_of_fold()

    variants = {
        "without": lambda: scored(base),
        "with": lambda: scored(base.unionByName(other)),
    }
    return rounded(tr.ablate(variants))


@query("subscriber_model")
def subscriber_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature plan cross-fitted with boosting: AUC per fold."""
    built = planned(spark, sf_dir, "fast")
    placed = tr.with_training_folds(built.df.drop("fold"), "y", 3, 42)
    data = tr.assemble(placed, built.features)
    fitted = tr.cross_fit(data, {"boosted": _small_boost()}, folds=3, feature_set="fast")
    return rounded(auc(fitted.out_of_fold(), by=["model", "fold"]))


def customer_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as an external table: other rows than the orders, fewer columns, a key of their own."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), key).alias("customerID"),
        F.when(key % 2 == 0, "Male").otherwise("Female").alias("gender"),
        (nation % 6 == 0).cast("int").alias("SeniorCitizen"),
        F.when(key % 3 == 0, "Yes").otherwise("No").alias("Partner"),
        (key % 73).cast("int").alias("tenure"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "Month-to-month")
        .otherwise("Two year")
        .alias("Contract"),
        F.when(nation % 5 == 0, "Electronic check").otherwise("Mailed check").alias("PaymentMethod"),
        (F.abs("c_acctbal") / 100).alias("MonthlyCharges"),
        F.col("c_acctbal").cast("string").alias("TotalCharges"),
        F.when(F.col("c_acctbal") < 0, "Yes").otherwise("No").alias("Churn"),
    )


@query("run_plan")
def run_plan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run: union, features, three models, weight grid, test scores."""
    frame = materialise(subscriber_frame(spark, sf_dir).drop("fold"))
    train = frame.filter("split = 'train'").drop("split")
    test = frame.filter("split = 'test'").drop("split", "Churn")
    ready = prepare(train, test, customer_list(spark, sf_dir), folds=3)
    models = {
        "boosted": _small_boost(),
        "deeper": tr.boosted(rounds=3, depth=4, min_rows=20, bins=64),
        "forest": tr.forest(trees=8, depth=5, min_rows=50),
    }
    result = run_plan(ready, models, "fast", folds=3, seeds=1, method="grid")
    return rounded(result.test_scores)


@query(
    "kept_run",
    """SELECT count(*) AS n_rows, 0::BIGINT AS n_differ, TRUE AS same_features, count(*) AS n_bare
    FROM orders WHERE o_orderkey % 5 = 0""",
)
def kept_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run is saved, read again, and scores the test rows as the run did.

    They come without split, fold and target, as later rows do.
    """
    frame = materialise(subscriber_frame(spark, sf_dir).drop("fold"))
    train = frame.filter("split = 'train'").drop("split")
    test = frame.filter("split = 'test'").drop("split", "Churn")
    ready = prepare(train, test, folds=2)
    models = {"boosted": _small_boost(), "forest": tr.forest(trees=8, depth=5, min_rows=50)}
    result = run_plan(ready, models, "ensemble_target", folds=2, seeds=2, method="grid")
    # Of the frame only the test rows are still read.
    test = materialise(test)
    discard(frame)
    path = f"{shared_folder(spark)}/tabloom/{uuid.uuid4().hex}"
    result.kept.save(path)
    later = load_run(spark, path)
    bare = later.score(test).withColumnRenamed("score", "again")
    both = result.test_scores.join(bare, "id", "full")
    differ = F.abs(F.col("score") - F.col("again")) < 1e-12
    return both.agg(
        F.count("score").alias("n_rows"),
        F.count_if(~F.coalesce(differ, F.lit(False))).alias("n_differ"),
        F.lit(later.fitted.features == result.features).alias("same_features"),
        F.count("again").alias("n_bare"),
    )


_HELD = (
    "boosted_finds_signal forest_finds_signal logistic_finds_signal planted_feature_first weight_one_is_none "
    "weight_changes_scores seeds_differ seed_repeats best_trial_not_below_median mean_of_seeds_not_below_worst"
).split()


@query(
    "planted_signal",
    f"SELECT unnest([{', '.join(repr(n) for n in _HELD)}]) AS name, TRUE AS holds, count(*) AS n_rows "
    "FROM orders WHERE o_orderkey % 5 <> 0",
)
def planted_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of models fitted on a label that depends on one column.

    The label of an order is its price against a hash of its key; another
    column repeats nothing of it. Held-out AUCs, importances, weights, seeds and
    a search are held against that.
    """
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    base = orders_frame(spark, sf_dir).withColumn("y", (F.col("s1") + noise > 0.9).cast("int"))
    base = base.withColumn("w", F.when(F.col("segment") == "BUILDING", 10.0).otherwise(1.0)).withColumn("one", F.lit(1.0))
    # Each of the tables to fit on reads the frame, which is a join.
    base = materialise(base)
    names = ["s3", "s1", "s2"]

    def data(seed: int, weight: str | None = None) -> DataFrame:
        return tr.assemble(tr.with_training_folds(base, "y", 3, seed), names, weight=weight)

    def mean_auc(scores: DataFrame) -> float:
        return auc(scores.filter("split = 'train'")).first()["auc"]

    plain = data(42)
    trees = tr.boosted(learning_rate=0.3, rounds=8, depth=3, min_rows=20, row_share=0.8)
    models = {"boosted": trees, "forest": tr.forest(20, 5, 20), "logistic": tr.logistic(max_iter=50)}
    fitted = tr.cross_fit(plain, models, folds=3)
    reached = {r["model"]: r["auc"] for r in auc(fitted.out_of_fold(), by=["model"]).collect()}
    first = tr.importance_topk(fitted.models["boosted", 42, 0], names, 1, spark).first()["feature"]

    def scores_of(rows: DataFrame, model: str = "logistic", seed: int = 42) -> DataFrame:
        # Compared several times.
        return materialise(tr.cross_fit(rows, {model: models[model]}, folds=3, seed=seed).scores)

    def apart(one: DataFrame, two: DataFrame) -> float:
        both = one.select("id", "score").join(two.select("id", F.col("score").alias("other")), "id")
        return both.agg(F.max(F.abs(F.col("score") - F.col("other")))).first()[0]

    unweighted = scores_of(plain)
    by_seed = [scores_of(plain, "boosted"), scores_of(data(1042), "boosted", 1042)]
    blended = seed_mean_blend(by_seed[0].unionByName(by_seed[1]), by=["id", "split", "label"])
    space = {"depth": tr.Range(1, 4), "learning_rate": tr.Range(0.01, 0.5, log=True)}
    trials = tr.search_params(plain, lambda **p: tr.boosted(rounds=4, min_rows=20, **p), space, trials=3, folds=2)
    aucs = sorted(t["mean_auc"] for t in trials)
    held = [
        reached["boosted"] > 0.7,
        reached["forest"] > 0.7,
        reached["logistic"] > 0.7,
        first == "s1",
        apart(unweighted, scores_of(data(42, "one"))) < 1e-9,
        apart(unweighted, scores_of(data(42, "w"))) > 1e-6,
        apart(*by_seed) > 1e-6,
        apart(by_seed[0], scores_of(plain, "boosted")) < 1e-9,
        trials[0]["mean_auc"] >= aucs[len(aucs) // 2],
        mean_auc(blended) >= min(mean_auc(s) for s in by_seed),
    ]
    n_rows = base.filter("split = 'train'").count()
    rows = [(name, bool(holds), n_rows) for name, holds in zip(_HELD, held)]
    return spark.createDataFrame(rows, "name string, holds boolean, n_rows long")


_PRESETS = [PRESETS[name].smaller(rounds=3, depth=3, folds=2) for name in ("fast", "quick", "baseline")]
_VARIANTS = ", ".join(f"('{p.name}', '{v}', {not i})" for p in _PRESETS for i, v in enumerate(p.blends))


@query(
    "preset_runs",
    f"""SELECT preset, variant, taken, count(*) AS n_scores, TRUE AS in_range, 1::BIGINT AS n_records
    FROM (VALUES {_VARIANTS}) v(preset, variant, taken), orders WHERE o_orderkey % 5 = 0 GROUP BY ALL""",
)
def preset_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Presets with fewer rounds, end to end, and what they wrote: scores of each variant, a record each."""
    frame = materialise(subscriber_frame(spark, sf_dir).drop("fold"))
    train = frame.filter("split = 'train'").drop("split")
    test = frame.filter("split = 'test'").drop("split", "Churn")
    path = f"{shared_folder(spark)}/tabloom/{uuid.uuid4().hex}"
    board = run_presets(train, test, customer_list(spark, sf_dir), _PRESETS, path)
    written = spark.read.schema("id long, score double, preset string, variant string").option("header", True)
    scores = written.csv(f"{path}/variants")
    counts = scores.groupBy("preset", "variant").agg(
        F.countDistinct("id").alias("n_scores"),
        F.min(F.coalesce(F.col("score").between(0, 1), F.lit(False))).alias("in_range"),
    )
    records = spark.read.json(f"{path}/records").groupBy(F.col("version").alias("preset")).agg(
        F.count(F.lit(1)).alias("n_records")
    )
    return (
        board.join(counts, ["preset", "variant"], "left")
        .join(records, "preset", "left")
        .select("preset", "variant", "taken", "n_scores", "in_range", "n_records")
    )
