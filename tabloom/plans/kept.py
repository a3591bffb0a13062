"""Fitted plans and runs that can be kept, read again and applied to later rows.

A kept run is a folder: ``manifest`` (one line of JSON), Parquet tables of the
fitted group statistics, medians and categories, and the models. It holds no
row of the training table.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce
from operator import add
from typing import Any

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.clean import coerce_numeric, fill_missing
from tabloom.operators.encode import (
    CategoryEncoders,
    CategoryModel,
    Encoder,
    FrequencyEncoder,
    LabelEncoder,
    TargetEncoder,
    WoeEncoder,
)
from tabloom.operators.features import Feature, FeatureSet
from tabloom.operators.groupstats import GroupStatsModel, StatBlock
from tabloom.operators.lookup import Lookup, settle
from tabloom.operators.ranks import RankSpec
from tabloom.operators.scale import ClusterFeatures, ClusterModel, Standardise, StandardiseModel
from tabloom.operators.train import FEATURES
from tabloom.plans.plan import ClusterPlan, FeaturePlan
from tabloom.plans.subscription import ROW_FEATURES

#: Of the folder's layout; another one is refused.
VERSION = 1
KEYS = ("id", "split", "fold", "source", "weight")
MODELS = {c.__name__: c for c in (GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel)}


def plan_encoders(plan: FeaturePlan, categories: Sequence[str], target: str) -> list[Encoder]:
    """The encoders of a plan, in the order of their features; codes come last."""
    encoders: list[Encoder] = []
    if plan.target_encoding:
        encoders.append(TargetEncoder(categories, target, "fold"))
    if plan.frequency:
        encoders.append(FrequencyEncoder(categories))
    if plan.woe:
        encoders.append(WoeEncoder(categories, target))
    if plan.label_codes:
        encoders.append(LabelEncoder(categories))
    return encoders if categories else []


@dataclass(frozen=True)
class FittedPlan:
    """What a plan fitted: all that turns rows of the raw columns into features."""

    plan: FeaturePlan
    target: str
    raw: list[str]
    numbers: list[str]
    categories: list[str]
    features: list[str]
    stats: GroupStatsModel | None = None
    clusters: ClusterModel | None = None
    encoders: CategoryModel | None = None
    library: Mapping[str, Feature] = field(default_factory=lambda: ROW_FEATURES)

    def transform(self, frame: DataFrame) -> DataFrame:
        """Keys and features of other rows, by what was fitted.

        Rows without a ``split`` are later ones, which no fit has seen; they
        need neither fold nor target. Raw columns that are missing are an error.
        A category that was not seen gets the plan's value for missing numbers
        as its code.
        """
        if self.plan.ranks:
            raise ValueError(f"plan {self.plan.name} ranks rows within their table, so it cannot be applied to others")
        absent = [c for c in self.raw if c not in frame.columns]
        if absent:
            raise ValueError(f"columns not found: {absent}")
        if "split" not in frame.columns:
            frame = frame.withColumn("split", F.lit("later"))
        if "fold" not in frame.columns:
            frame = frame.withColumn("fold", F.lit(None).cast("int"))
        keys = [c for c in (*KEYS, self.target) if c in frame.columns]
        df = coerce_numeric(frame.select(*keys, *self.raw), self.numbers)
        df = FeatureSet([self.library[name] for name in self.plan.row_features]).apply(df)
        for fitted in (self.stats, self.clusters, self.encoders):
            if fitted is not None:
                df = fitted.transform(df)
        return self.finished(df, keys)

    def finished(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Missing numbers filled, and the columns in order."""
        numeric = [c for c in self.features if self.plan.label_codes or c not in self.categories]
        return fill_missing(df, numeric).select(*keys, *self.features)


@dataclass(frozen=True)
class KeptRun:
    """A fitted plan with the models and blend weights of its run.

    ``models`` are by (model, seed, fold), ``weights`` by seed and model.
    """

    fitted: FittedPlan
    models: dict[tuple[str, int, int], Model]
    weights: dict[int, dict[str, float]]

    def score(self, frame: DataFrame) -> DataFrame:
        """id, score of other rows, as the run scored its test rows.

        Per seed and model the mean over the folds' models, blended by the
        seed's weights, and the mean of that over the seeds. All models read
        the rows in one pass, without a shuffle.
        """
        features = self.fitted.transform(frame)
        rows = VectorAssembler(
            inputCols=self.fitted.features, outputCol=FEATURES, handleInvalid="error"
        ).transform(features)
        names = {}
        for i, (key, model) in enumerate(sorted(self.models.items())):
            quiet = model.copy().setRawPredictionCol("").setPredictionCol("")
            rows = quiet.setProbabilityCol(f"__p{i}").transform(rows)
            names[key] = vector_to_array(F.col(f"__p{i}"))[1]
        of_seeds = []
        for seed, weights in sorted(self.weights.items()):
            parts = []
            for name, weight in weights.items():
                of_folds = [p for (n, s, _), p in names.items() if (n, s) == (name, seed)]
                mean = reduce(add, of_folds) / F.lit(float(len(of_folds)))
                parts.append(mean * F.lit(float(weight)))
            of_seeds.append(reduce(add, parts))
        return rows.select("id", (reduce(add, of_seeds) / F.lit(float(len(of_seeds)))).alias("score"))

    def save(self, path: str) -> None:
        """Write the run to a new folder; an existing one is an error."""
        fitted, spark = self.fitted, SparkSession.active()
        if any(self.library_differs()):
            raise ValueError(f"features beside the library cannot be kept: {sorted(self.library_differs())}")
        manifest: dict[str, Any] = {
            "version": VERSION,
            "plan": asdict(fitted.plan),
            **{name: getattr(fitted, name) for name in ("target", "raw", "numbers", "categories", "features")},
            "models": [[*key, type(model).__name__] for key, model in sorted(self.models.items())],
            "weights": [[seed, weights] for seed, weights in sorted(self.weights.items())],
        }
        if fitted.stats is not None:
            manifest["stats"] = {
                "key_sets": fitted.stats.key_sets,
                "train_means": fitted.stats.train_means,
                "median_sets": fitted.stats.median_sets,
                "lookup": _save_lookup(fitted.stats.fitted, f"{path}/stats"),
                "medians": _save_lookup(fitted.stats.medians, f"{path}/medians"),
            }
        if fitted.clusters is not None:
            clusters = fitted.clusters
            manifest["clusters"] = {
                "means": clusters.scaler.means,
                "deviations": clusters.scaler.deviations,
                "centres": [[k, np.asarray(c).tolist()] for k, c in clusters.centres.items()],
            }
        if fitted.encoders is not None:
            manifest["encoders"] = {
                "overall": fitted.encoders.overall,
                "lookup": _save_lookup(fitted.encoders.fitted, f"{path}/categories"),
            }
        for i, (_, model) in enumerate(sorted(self.models.items())):
            model.write().save(f"{path}/model-{i}")
        # Last, so that a folder with a manifest is whole.
        spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{path}/manifest")

    def library_differs(self) -> set[str]:
        """Row features that are not those of the library under their names."""
        return {n for n in self.fitted.plan.row_features if self.fitted.library[n] is not ROW_FEATURES.get(n)}


def load_run(spark: SparkSession, path: str) -> KeptRun:
    """Read a run that ``KeptRun.save`` wrote."""
    manifest = json.loads(spark.read.text(os.path.join(path, "manifest")).first()[0])
    if manifest["version"] != VERSION:
        raise ValueError(f"a kept run of version {manifest['version']}, not {VERSION}")
    plan = _plan_of(manifest["plan"])
    stats = clusters = encoders = None
    if "stats" in manifest:
        own = manifest["stats"]
        stats = GroupStatsModel(
            list(plan.stats),
            [list(k) for k in own["key_sets"]],
            _load_lookup(spark, f"{path}/stats", own["lookup"], "set_id"),
            own["train_means"],
            _load_lookup(spark, f"{path}/medians", own["medians"], "set_id"),
            [tuple(k) for k in own["median_sets"]],
        )
    if "clusters" in manifest:
        own = manifest["clusters"]
        spec = ClusterFeatures(plan.clusters.cols, plan.clusters.ks, plan.clusters.restarts)
        scaler = Standardise(spec.cols, suffix="__z", fill=0.0)
        centres = {k: np.array(c) for k, c in own["centres"]}
        clusters = ClusterModel(spec, StandardiseModel(scaler, own["means"], own["deviations"]), centres)
    if "encoders" in manifest:
        own = manifest["encoders"]
        spec = CategoryEncoders(plan_encoders(plan, manifest["categories"], manifest["target"]))
        lookup = _load_lookup(spark, f"{path}/categories", own["lookup"], "col")
        encoders = CategoryModel(spec, lookup, own["overall"])
    names = ("target", "raw", "numbers", "categories", "features")
    fitted = FittedPlan(plan, *[manifest[n] for n in names], stats, clusters, encoders)
    models = {
        (name, seed, fold): MODELS[kind].load(f"{path}/model-{i}")
        for i, (name, seed, fold, kind) in enumerate(manifest["models"])
    }
    return KeptRun(fitted, models, {seed: weights for seed, weights in manifest["weights"]})


def _save_lookup(lookup: Lookup | None, path: str) -> dict[str, Any] | None:
    if lookup is None:
        return None
    lookup.table.write.parquet(path)
    return {"keys": list(lookup.keys), "weight": lookup.weight}


def _load_lookup(spark: SparkSession, path: str, kept: dict | None, part: str) -> Lookup | None:
    if kept is None:
        return None
    return settle(spark.read.parquet(path), kept["keys"], kept["weight"], part=part)


def _plan_of(kept: dict[str, Any]) -> FeaturePlan:
    """A plan from its JSON form, in which tuples are lists."""
    fixed = {k: tuple(v) if isinstance(v, list) else v for k, v in kept.items()}
    blocks = [
        StatBlock(**{k: tuple(v) if isinstance(v, list) else v for k, v in b.items()}) for b in kept["stats"]
    ]
    fixed["stats"] = tuple(blocks)
    fixed["ranks"] = tuple(RankSpec(**r) for r in kept["ranks"])
    if kept["clusters"]:
        own = kept["clusters"]
        fixed["clusters"] = ClusterPlan(tuple(own["cols"]), tuple(own["ks"]), own["restarts"])
    return FeaturePlan(**fixed)
