"""Boosted models stopped by held-out AUC, with patience."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.metrics import auc
from tabloom.session import materialise

#: Rounds whose scores are compared in one pass over the held-out rows.
ROUNDS_AT_ONCE = 32
#: Rounds of the first fit, in patiences; each further fit has twice as many.
FIRST_FIT = 2

_LEAF = re.compile(r"Predict: (\S+)")


@dataclass(frozen=True)
class Stopped:
    """A model cut at its best round, and the held-out AUC of each round looked at."""

    model: GBTClassificationModel
    aucs: list[float]
    best_round: int
    fitted_rounds: int

    @property
    def best_auc(self) -> float:
        return self.aucs[self.best_round - 1]

    @property
    def early(self) -> bool:
        """Whether rounds after the best one were given up."""
        return self.best_round < len(self.aucs)


def leaf_values(model: GBTClassificationModel) -> list[list[float]]:
    """What each leaf of each tree adds to the margin, in the order of leaf numbers."""
    return [
        [weight * float(v) for v in _LEAF.findall(tree.toDebugString)]
        for tree, weight in zip(model.trees, model.treeWeights)
    ]


def staged_scores(model: GBTClassificationModel, first: int, last: int) -> Column:
    """Positive-class probabilities after rounds first..last, for rows with ``__leaves``.

    ``__leaves`` holds the number of the leaf that a row meets in each tree.
    """
    values = leaf_values(model)[:last]
    leaves = F.slice("__leaves", 1, last)
    table = F.array(*[F.array(*[F.lit(v) for v in tree]) for tree in values])
    added = F.zip_with(leaves, table, lambda leaf, tree: F.get(tree, leaf))
    start = F.aggregate(F.slice(added, 1, first - 1), F.lit(0.0), lambda total, x: total + x)
    margins = F.aggregate(
        F.slice(added, first, last - first + 1),
        F.struct(start.alias("total"), F.array().cast("array<double>").alias("all")),
        lambda state, x: F.struct(
            (state["total"] + x).alias("total"), F.concat(state["all"], F.array(state["total"] + x)).alias("all")
        ),
        lambda state: state["all"],
    )
    return F.transform(margins, lambda m: F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * m)))


def best_round(
    model: GBTClassificationModel,
    held_out: DataFrame,
    label: str,
    patience: int,
) -> tuple[list[float], int, bool]:
    """AUC per round, the best round (from 1), and whether patience ran out.

    The first round whose AUC no later one of ``patience`` rounds exceeds. Rows
    meet all trees in one pass, which is stored; rounds are then compared in
    groups until patience has run out.
    """
    aucs: list[float] = []
    total = len(model.treeWeights)
    quiet = model.copy().setLeafCol("__leaf")
    seen = quiet.transform(held_out).select(
        F.col(label).alias("label"), vector_to_array("__leaf").cast("array<int>").alias("__leaves")
    )
    # Rows that meet the same leaves have the same scores, whatever the round.
    seen = materialise(seen.groupBy("label", "__leaves").agg(F.count(F.lit(1)).alias("n")))
    while True:
        best = first_stop(aucs, patience)
        if len(aucs) - 1 - best >= patience:
            return aucs, best + 1, True
        if len(aucs) == total:
            return aucs, best + 1, False
        first, last = len(aucs) + 1, min(total, len(aucs) + ROUNDS_AT_ONCE)
        scores = seen.select(
            "label", "n", F.posexplode(staged_scores(model, first, last)).alias("round", "score")
        )
        found = auc(scores, by=["round"], weight="n").collect()
        of_round = {r["round"]: r["auc"] for r in found}
        # Without positives or negatives no round is better than another.
        aucs += [of_round.get(i) if of_round.get(i) is not None else 0.5 for i in range(last - first + 1)]


def first_stop(aucs: list[float], patience: int) -> int:
    """The first best position up to where patience runs out; 0 if there is none."""
    best = 0
    for i, value in enumerate(aucs):
        if value > aucs[best]:
            best = i
        elif i - best >= patience:
            break
    return best


def cut(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` trees."""
    java, context = model._java_obj, SparkContext._active_spark_context
    trees, gateway, jvm = java.trees(), context._gateway, context._jvm
    kept = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        kept[i], weights[i] = trees[i], float(model.treeWeights[i])
    made = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), kept, weights, java.numFeatures(), 2
    )
    return GBTClassificationModel(made).setFeaturesCol(model.getFeaturesCol())


def fit_until(
    fit: Callable[[int], GBTClassificationModel],
    held_out: DataFrame,
    label: str,
    most_rounds: int,
    patience: int,
) -> Stopped:
    """Fit until the held-out AUC has not risen for ``patience`` rounds.

    ``fit`` makes a model of so many rounds. Boosting cannot go on from a model,
    so fits double until patience has run out within one; the work stays within
    about twice that of the last fit. The model is cut at its best round.
    """
    rounds = min(most_rounds, max(1, FIRST_FIT * patience))
    while True:
        model = fit(rounds)
        aucs, best, over = best_round(model, held_out, label, patience)
        if over or rounds >= most_rounds:
            return Stopped(cut(model, best), aucs, best, rounds)
        rounds = min(most_rounds, 2 * rounds)
