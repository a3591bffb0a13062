"""Turn a feature plan and a tagged table into the table a model reads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.clean import coerce_numeric, columns_of
from tabloom.operators.encode import CategoryEncoders
from tabloom.operators.features import Feature, FeatureSet
from tabloom.operators.groupstats import GroupStats
from tabloom.operators.ranks import pct_ranks
from tabloom.operators.scale import ClusterFeatures
from tabloom.plans.kept import KEYS, FittedPlan, plan_encoders
from tabloom.plans.plan import FeaturePlan
from tabloom.plans.subscription import NUMBERS, ROW_FEATURES
from tabloom.session import keep_code_compilable


@dataclass(frozen=True)
class FeatureTable:
    """The finished table, the names of its feature columns, in order, and what was fitted."""

    df: DataFrame
    features: list[str]
    fitted: FittedPlan


def build_features(
    plan: FeaturePlan,
    frame: DataFrame,
    target: str = "y",
    library: Mapping[str, Feature] = ROW_FEATURES,
    numbers: Sequence[str] = NUMBERS,
    seed: int = 42,
) -> FeatureTable:
    """Apply a plan to a table with ``id``, ``split``, ``fold`` and the target.

    Everything is fitted on the training rows, except category codes and
    ranks, which are defined over all rows. ``fold`` is the fold used for
    target encoding.
    """
    keep_code_compilable(frame.sparkSession)
    keys = [c for c in (*KEYS, target) if c in frame.columns]
    raw = [c for c in frame.columns if c not in keys]
    numbers = [c for c in numbers if c in raw]
    df = coerce_numeric(frame, numbers)
    categories = columns_of(df, "string", exclude=keys)
    row_set = FeatureSet([library[name] for name in plan.row_features])
    df = row_set.apply(df)
    features = [*raw, *[n for n in row_set.names if n in df.columns]]

    def training() -> DataFrame:
        return df.filter(F.col("split") == "train")

    stats = clusters = encoders = None
    if plan.stats:
        stats = GroupStats(plan.stats).fit(training())
        df = stats.transform(df)
        features += stats.names
    if plan.ranks:
        df = pct_ranks(df, plan.ranks)
        features += [spec.name for spec in plan.ranks]
    if plan.clusters:
        spec = plan.clusters
        clusters = ClusterFeatures(spec.cols, spec.ks, spec.restarts, seed).fit(training())
        df = clusters.transform(df)
        features += [n for k in plan.clusters.ks for n in (f"cluster_{k}", f"cluster_{k}_dist")]
    specs = plan_encoders(plan, categories, target)
    features += [f"{c}{e.suffix}" for e in specs for c in categories if e.suffix]
    if specs:
        # All encoders read the raw categories, so they are fitted in one scan
        # of the narrow input, not of the table that carries the features.
        encoders = CategoryEncoders(specs).fit(frame.select(*keys, *categories))
        df = encoders.transform(df)
    fitted = FittedPlan(
        plan, target, raw, numbers, categories, features, stats, clusters, encoders, library
    )
    return FeatureTable(fitted.finished(df, keys), features, fitted)
