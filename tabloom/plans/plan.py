"""A feature plan: which features and encodings a run uses, as data."""

from __future__ import annotations

from dataclasses import dataclass

from tabloom.operators.groupstats import StatBlock
from tabloom.operators.ranks import RankSpec


@dataclass(frozen=True)
class ClusterPlan:
    """k-means features over the named columns."""

    cols: tuple[str, ...]
    ks: tuple[int, ...] = (5, 10)
    restarts: int = 10


@dataclass(frozen=True)
class FeaturePlan:
    """Everything between the raw table and the table a model is fitted on."""

    name: str
    row_features: tuple[str, ...]
    stats: tuple[StatBlock, ...] = ()
    ranks: tuple[RankSpec, ...] = ()
    clusters: ClusterPlan | None = None
    frequency: bool = False
    target_encoding: bool = False
    woe: bool = False
    label_codes: bool = True
    uses_external: bool = True
