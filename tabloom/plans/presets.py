"""Whole runs as data, and steps that several runs share.

A preset says which feature plans, models, folds, seeds and blends a run takes.
``run_presets`` makes each step (rows, features, vectors, scores of one model)
once per specification, whichever presets need it, keeps its table until the
last of them is done, and writes every run's scores, variants and record.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Hashable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import combinations
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import blend
from tabloom.operators.clean import row_weight
from tabloom.operators.metrics import auc, correlation_matrix, score_summary
from tabloom.operators.scale import Standardise
from tabloom.operators.train import (
    ModelSpec,
    Range,
    assemble,
    boosted,
    cross_fit,
    forest,
    logistic,
    search_params,
    seed_list,
    stack_meta,
    with_training_folds,
)
from tabloom.plans.build import build_features
from tabloom.plans.runs import prepare
from tabloom.plans.subscription import PLANS
from tabloom.session import discard, materialise, run_tables
from tabloom.sources.writers import run_record, write_run_record, write_variants

#: Weight grids by name; ``blend`` makes them.
GRIDS: dict[str, Callable[[], list[tuple[float, ...]]]] = {
    "coarse": blend.grid3_coarse,
    "full": blend.grid3_full,
    "tenths": lambda: blend.grid3_full(0.1),
    "pair": blend.grid2,
    "four": blend.grid4,
}


@dataclass(frozen=True)
class Search:
    """Random search for a model's parameters before its cross-fit."""

    make: Callable[..., ModelSpec]
    space: Mapping[str, Range]
    trials: int = 50
    folds: int = 3


@dataclass(frozen=True)
class Preset:
    """A run as data.

    ``blends`` names the variants that are made, the first being the run's
    result; with ``best`` it is the variant of the greatest mean AUC. Variants
    are 'mean', 'rank', 'stack', 'climb', 'fixed' (with ``weights``), a grid
    over all models ('coarse', 'full', 'tenths'), 'stack_rank' and 'stack_mean'
    (a searched mix of the two), 'four' (three models, ``leads``, and the mean
    of all) and 'mean:a,b' (the mean of some models). With several plans a
    model is named after its plan too, as ``model_plan``.
    """

    name: str
    plans: tuple[str, ...]
    models: Mapping[str, ModelSpec | Search]
    blends: tuple[str, ...] = ("mean",)
    best: bool = False
    folds: int = 5
    seeds: int = 1
    external: bool = True
    external_weight: float | None = None
    weights: Mapping[str, float] = field(default_factory=dict)
    leads: tuple[str, ...] = ()

    def smaller(self, rounds: int, depth: int, folds: int, seeds: int = 1, trials: int = 2) -> Preset:
        """The same run with fewer and smaller fits, for a trial."""

        def less(spec: ModelSpec | Search) -> ModelSpec | Search:
            if isinstance(spec, Search):
                return replace(
                    spec, make=lambda **p: less(spec.make(**p)), trials=min(trials, spec.trials), folds=folds
                )
            most = {"maxIter": rounds, "numTrees": rounds, "maxDepth": depth}
            params = {k: min(v, most[k]) if k in most else v for k, v in spec.params.items()}
            return replace(spec, params=params, patience=None)

        models = {name: less(spec) for name, spec in self.models.items()}
        return replace(self, models=models, folds=min(folds, self.folds), seeds=min(seeds, self.seeds))


class Workshop:
    """Results of steps by their specification, each kept until its last user is done."""

    def __init__(self) -> None:
        self.made: dict[Hashable, Any] = {}
        self.users: Counter = Counter()
        #: How often a step of each kind was computed.
        self.computed: Counter = Counter()

    def expect(self, keys: Iterable[Hashable]) -> None:
        self.users.update(keys)

    def get(self, key: tuple, make: Callable[[], Any]) -> Any:
        if key not in self.made:
            self.made[key] = make()
            self.computed[key[0]] += 1
        return self.made[key]

    def release(self, keys: Iterable[Hashable]) -> None:
        """One user of each step is done; a step without further users is deleted."""
        for key in keys:
            self.users[key] -= 1
            if self.users[key] <= 0 and key in self.made:
                table = self.made.pop(key)
                table = table[0] if isinstance(table, tuple) else table
                if isinstance(table, DataFrame):
                    discard(table)


def _needs_scaling(spec: ModelSpec | Search) -> bool:
    return isinstance(spec, ModelSpec) and spec.family == "logistic"


def _spec_key(spec: ModelSpec) -> str:
    """Equal for equal specifications, whatever a preset calls the model."""
    return repr(replace(spec, params=dict(sorted(spec.params.items()))))


class _Steps:
    """The steps of one preset, by keys that hold all they depend on."""

    def __init__(self, preset: Preset):
        self.preset = preset
        self.seeds = seed_list(preset.seeds)

    def rows(self, plan: str) -> tuple:
        p = self.preset
        external = p.external and PLANS[plan].uses_external
        return "rows", external, p.external_weight if external else None, p.folds

    def features(self, plan: str) -> tuple:
        return "features", self.rows(plan), plan

    def vectors(self, plan: str, seed: int, scaled: bool, folds: int) -> tuple:
        return "vectors", self.features(plan), seed, scaled, folds

    def search(self, plan: str, search: Search, name: str) -> tuple:
        vectors = self.vectors(plan, self.seeds[0], False, search.folds)
        # A search is what its function makes of its draws, so it belongs to the preset.
        return "search", vectors, self.preset.name, name

    def scores(self, plan: str, seed: int, spec: ModelSpec | Search, name: str) -> tuple:
        vectors = self.vectors(plan, seed, _needs_scaling(spec), self.preset.folds)
        searched = isinstance(spec, Search)
        return "scores", vectors, self.search(plan, spec, name) if searched else _spec_key(spec)

    def all(self) -> list[tuple]:
        """Every step the preset uses, once each."""
        found: dict[tuple, None] = {}
        p = self.preset
        for plan in p.plans:
            found |= {self.rows(plan): None, self.features(plan): None}
            for name, spec in p.models.items():
                if isinstance(spec, Search):
                    found |= {self.search(plan, spec, name): None}
                    found |= {self.vectors(plan, self.seeds[0], False, spec.folds): None}
                for seed in self.seeds:
                    key = self.scores(plan, seed, spec, name)
                    found |= {key: None, key[1]: None}
        return list(found)


class _Run:
    """Makes a preset's steps out of the driver's tables, through a workshop."""

    def __init__(self, preset: Preset, shop: Workshop, tables: Sequence[DataFrame | None], workers: int):
        self.preset, self.shop, self.tables, self.workers = preset, shop, tables, workers
        self.steps = _Steps(preset)

    def rows(self, plan: str) -> DataFrame:
        key = self.steps.rows(plan)
        _, external, weight, folds = key
        train, test, other = self.tables

        def make() -> DataFrame:
            ready = prepare(train, test, other if external else None, folds=folds)
            if weight is not None:
                ready = row_weight(ready, {"external": weight})
            return materialise(ready)

        return self.shop.get(key, make)

    def features(self, plan: str) -> tuple[DataFrame, list[str]]:
        def make() -> tuple[DataFrame, list[str]]:
            # Models read numbers, so a plan that leaves categories as text gets their codes.
            built = build_features(replace(PLANS[plan], label_codes=True), self.rows(plan))
            return materialise(built.df), built.features

        return self.shop.get(self.steps.features(plan), make)

    def vectors(self, plan: str, seed: int, scaled: bool, folds: int) -> DataFrame:
        def make() -> DataFrame:
            table, names = self.features(plan)
            table = with_training_folds(table.drop("fold"), "y", folds, seed)
            if scaled:
                fitted = Standardise(names).fit(table.filter("split = 'train'"))
                table, names = fitted.transform(table), [f"{n}_z" for n in names]
            table = table.withColumn("y", F.coalesce("y", F.lit(0)))
            return assemble(table, names, weight="weight" if "weight" in table.columns else None)

        return self.shop.get(self.steps.vectors(plan, seed, scaled, folds), make)

    def scores(self, plan: str, seed: int, name: str) -> DataFrame:
        """Scores of one model: id, split, fold, label, score."""
        spec, p = self.preset.models[name], self.preset
        key = self.steps.scores(plan, seed, spec, name)

        def make() -> DataFrame:
            chosen = spec
            if isinstance(spec, Search):
                chosen = self.shop.get(self.steps.search(plan, spec, name), lambda: self.found(plan, spec))
            vectors = self.vectors(plan, seed, _needs_scaling(spec), p.folds)
            fitted = cross_fit(vectors, {"model": chosen}, p.folds, seed, plan, self.workers)
            return materialise(fitted.scores.drop("model", "feature_set", "seed"))

        return self.shop.get(key, make)

    def found(self, plan: str, search: Search) -> ModelSpec:
        vectors = self.vectors(plan, self.steps.seeds[0], False, search.folds)
        ranked = search_params(
            vectors, search.make, search.space, search.trials, search.folds, workers=self.workers
        )
        return search.make(**ranked[0]["params"])

    def named(self) -> dict[str, tuple[str, str]]:
        """Plan and model of each score column."""
        several = len(self.preset.plans) > 1
        return {
            f"{model}_{plan}" if several else model: (plan, model)
            for plan in self.preset.plans
            for model in self.preset.models
        }

    def base(self, seed: int) -> DataFrame:
        """The score table of all models."""
        parts = [
            self.scores(plan, seed, model).withColumn("model", F.lit(column))
            for column, (plan, model) in self.named().items()
        ]
        return reduce(DataFrame.unionByName, parts)


KEYS = ("id", "split")


def _searched(
    scores: DataFrame, names: Sequence[str], grid: Sequence[Sequence[float]]
) -> tuple[DataFrame, dict[str, float]]:
    """The best weighted sum of some models on the training rows, for all rows."""
    wide = blend.pivot_scores(scores.filter("split = 'train'"), names, keep=["label"])
    weights = dict(zip(names, blend.grid_blend(wide, names, "label", grid).weights))
    return blend.weighted_blend(scores, weights, KEYS, ["label"]), weights


def make_variants(
    base: DataFrame, names: Sequence[str], preset: Preset, seed: int, workers: int = 4
) -> tuple[DataFrame, dict[str, dict[str, float]]]:
    """variant, id, split, label, score of the preset's blends, and the weights of the searched ones."""
    made: dict[str, DataFrame] = {}
    used: dict[str, dict[str, float]] = {}

    def mean(of: Sequence[str]) -> DataFrame:
        return blend.weighted_blend(base, {m: 1.0 / len(of) for m in of}, KEYS, ["label"])

    def of(kind: str) -> DataFrame:
        """One blend; those that others mix are made once."""
        if kind not in made:
            made[kind] = make(kind)
        return made[kind]

    def mixed(parts: Mapping[str, DataFrame]) -> DataFrame:
        columns = ["id", "split", "label", "model", "score"]
        marked = [df.withColumn("model", F.lit(name)).select(columns) for name, df in parts.items()]
        return materialise(reduce(DataFrame.unionByName, marked))

    def make(kind: str) -> DataFrame:
        if kind == "mean":
            return mean(names)
        if kind.startswith("mean:"):
            return mean(kind.removeprefix("mean:").split(","))
        if kind == "rank":
            return blend.rank_mean_blend(base, names, KEYS, ["label"], within=("model", "split"))
        if kind == "stack":
            stacked = stack_meta(base, names, preset.folds, seed, workers=workers)
            return materialise(stacked.scores.select(*KEYS, "label", "score"))
        if kind in ("stack_rank", "stack_mean"):
            partner = kind.removeprefix("stack_")
            found, used[kind] = _searched(
                mixed({"stack": of("stack"), partner: of(partner)}), ["stack", partner], GRIDS["pair"]()
            )
            return found
        if kind == "four":
            parts = {m: base.filter(F.col("model") == m) for m in preset.leads} | {"mean": of("mean")}
            found, used[kind] = _searched(mixed(parts), list(parts), GRIDS["four"]())
            return found
        if kind == "climb":
            wide = blend.pivot_scores(base.filter("split = 'train'"), names, keep=["label"])
            used[kind] = blend.hill_climb(wide, names, "label").weights
            return blend.weighted_blend(base, used[kind], KEYS, ["label"])
        if kind == "fixed":
            used[kind] = dict(preset.weights)
            return blend.weighted_blend(base, used[kind], KEYS, ["label"])
        if kind in GRIDS:
            found, used[kind] = _searched(base, names, GRIDS[kind]())
            return found
        raise ValueError(f"unknown blend: {kind}")

    parts = [
        of(kind).select(F.lit(kind).alias("variant"), *KEYS, "label", "score") for kind in preset.blends
    ]
    return reduce(DataFrame.unionByName, parts), used


def run_presets(
    train: DataFrame,
    test: DataFrame,
    external: DataFrame | None,
    presets: Sequence[Preset | str],
    path: str,
    workers: int = 4,
    shop: Workshop | None = None,
) -> DataFrame:
    """Run presets end to end; preset, variant, taken, auc: a row per variant, best first.

    Below ``path`` each preset leaves ``scores/preset=...`` (id, score of its
    result), ``variants/preset=...`` (id, score, one folder per variant), and a
    line in ``records`` with AUCs, weights, correlations of its models and the
    summary of its scores. All else is deleted: a step's table once no further
    preset needs it, the rest at the end. With several seeds folds and models
    change per seed, blends are made per seed, and their scores averaged.

    A preset that wants an external table and gets none runs without it.
    """
    spark = train.sparkSession
    wanted = [PRESETS[p] if isinstance(p, str) else p for p in presets]
    wanted = [p if external is not None else replace(p, external=False) for p in wanted]
    if len({p.name for p in wanted}) < len(wanted):
        raise ValueError("presets need names of their own")
    shop = shop or Workshop()
    for p in wanted:
        shop.expect(_Steps(p).all())
    board: list[tuple[str, str, bool, float | None]] = []
    with run_tables(spark):
        for p in wanted:
            board += _run_one(p, shop, (train, test, external), path, workers)
            shop.release(_Steps(p).all())
    schema = "preset string, variant string, taken boolean, auc double"
    return spark.createDataFrame(board, schema).orderBy(F.desc_nulls_last("auc"), "preset", "variant")


def _run_one(
    preset: Preset, shop: Workshop, tables: Sequence[DataFrame | None], path: str, workers: int
) -> list[tuple[str, str, bool, float | None]]:
    run = _Run(preset, shop, tables, workers)
    names = list(run.named())
    metrics: dict[str, float] = {}
    weights: dict[str, float] = {}
    per_seed = []
    for seed in run.steps.seeds:
        base = run.base(seed)
        oof = base.filter("split = 'train'")
        metrics |= {f"{r['model']}_{seed}": r["auc"] for r in auc(oof, by=["model"]).collect() if r["auc"] is not None}
        pairs = correlation_matrix(blend.pivot_scores(oof, names), names).collect()
        known = {(r["a"], r["b"]): r["corr"] for r in pairs if r["corr"] is not None}
        metrics |= {f"corr_{a}_{b}_{seed}": known[a, b] for a, b in combinations(names, 2) if (a, b) in known}
        variants, used = make_variants(base, names, preset, seed, workers)
        weights |= {f"{kind}_{m}_{seed}": w for kind, of in used.items() for m, w in of.items()}
        per_seed.append(materialise(variants.withColumn("seed", F.lit(seed))))
    every = reduce(DataFrame.unionByName, per_seed)
    # One row per variant and seed.
    found = auc(every.filter("split = 'train'"), by=["variant", "seed"]).collect()
    metrics |= {f"{r['variant']}_{r['seed']}": r["auc"] for r in found if r["auc"] is not None}
    reached: dict[str, float | None] = {}
    for kind in preset.blends:
        values = [r["auc"] for r in found if r["variant"] == kind]
        reached[kind] = sum(values) / len(values) if values and None not in values else None
    taken = preset.blends[0]
    if preset.best:
        taken = max(preset.blends, key=lambda kind: (reached[kind] is not None, reached[kind] or 0.0))
    result = materialise(blend.seed_mean_blend(every.filter("split = 'test'"), ["variant", "id"]))
    write_variants(result, f"{path}/variants/preset={preset.name}", "overwrite")
    final = result.filter(F.col("variant") == taken)
    final.select("id", "score").write.mode("overwrite").parquet(f"{path}/scores/preset={preset.name}")
    summary = score_summary(final).first().asDict()
    metrics |= {k: float(v) for k, v in summary.items() if v is not None}
    n_features = sum(len(run.features(plan)[1]) for plan in preset.plans)
    details = {"folds": preset.folds, "seeds": run.steps.seeds, "method": taken, "plans": ",".join(preset.plans)}
    record = run_record(every.sparkSession, preset.name, metrics, weights, n_features, **details)
    write_run_record(record, f"{path}/records")
    return [(preset.name, kind, kind == taken, reached[kind]) for kind in preset.blends]


# -- the runs ----------------------------------------------------------------
# Rates, rounds, depths, shares, leaf sizes, patience, search
# ranges, folds, seeds, weights and grids of the runs.


def _trio(rate: float, rounds: int, depths: Sequence[int], patience: int, **shares: float) -> dict[str, ModelSpec]:
    """Three boosted models of one learning rate, by depth and least rows of a leaf."""
    leaves = (20, 5, 1)
    return {
        name: boosted(rate, rounds, depth, min_rows=rows, patience=patience, **shares)
        for name, depth, rows in zip("abc", depths, leaves)
    }


def _zoo(patience: int) -> dict[str, ModelSpec]:
    """Boosted models of several depths and rates, a forest, and a linear model."""
    return {
        "leafy_shallow": boosted(0.05, 3000, 5, 0.8, 0.7, 20, patience=patience),
        "leafy_deep": boosted(0.03, 3000, 7, 0.7, 0.5, 50, patience=patience),
        "leafy_slow": boosted(0.02, 3000, 6, 0.6, 0.6, 100, patience=patience),
        "level_shallow": boosted(0.05, 3000, 6, 0.8, 0.7, 5, patience=patience),
        "level_deep": boosted(0.03, 3000, 8, 0.7, 0.6, 10, patience=patience),
        "plain_shallow": boosted(0.05, 2000, 6, patience=patience),
        "plain_deep": boosted(0.03, 2000, 8, patience=patience),
        "binned": boosted(0.05, 1000, 6, min_rows=50, bins=255, patience=patience),
        "forest": forest(500, 20, 50),
        "linear": logistic(1.0, 500),
    }


_SPACE = {
    "learning_rate": Range(0.01, 0.1, log=True),
    "depth": Range(3, 12),
    "min_rows": Range(5, 100),
    "row_share": Range(0.5, 1.0),
    "column_share": Range(0.4, 1.0),
}
_FIXED = {"a": 0.20, "b": 0.30, "c": 0.50}
_SAMPLED = {"row_share": 0.8, "column_share": 0.7}
_EVEN = {"row_share": 0.8, "column_share": 0.8}
_SEARCHED = Search(lambda **p: boosted(rounds=3000, patience=50, **p), _SPACE)
_USUAL = _trio(0.05, 3000, (6, 7, 7), 50, **_SAMPLED)
_SLOW = _trio(0.03, 5000, (6, 7, 7), 100, **_SAMPLED)
_TUNED = _trio(0.03, 5000, (6, 8, 8), 100, row_share=0.75, column_share=0.65)
_SEVEN = {
    "leafy_a": boosted(0.05, 2000, 6, 0.8, 0.7, 20, patience=50),
    "leafy_b": boosted(0.03, 2000, 5, 0.7, 0.6, 50, patience=50),
    "leafy_c": boosted(0.02, 3000, 7, 0.6, 0.5, 100, patience=50),
    "level_a": boosted(0.05, 2000, 7, 0.8, 0.7, 5, patience=50),
    "level_b": boosted(0.03, 2000, 8, 0.7, 0.6, 10, patience=50),
    "plain_a": boosted(0.05, 1500, 7, patience=50),
    "plain_b": boosted(0.03, 1500, 6, patience=50),
}
_STACKED = ("stack_rank", "stack", "rank", "mean")

_LISTED = (
    Preset("fast", ("fast",), {"a": boosted(0.1, 500, 5, patience=30, **_EVEN)}),
    Preset("quick", ("quick",), {"a": boosted(0.05, 2000, 5, min_rows=20, patience=100, **_EVEN)}),
    Preset("baseline", ("baseline",), _trio(0.05, 2000, (5, 6, 6), 100, **_EVEN), ("coarse", "mean")),
    Preset("ten_folds", ("wide",), _SLOW, ("coarse", "mean"), folds=10),
    Preset("ensemble", ("ensemble",), _USUAL, ("coarse", "mean")),
    Preset("target_seeds", ("wide_target",), _SLOW, ("mean",), seeds=5),
    Preset("tuned_seeds", ("ensemble_target",), _TUNED, ("tenths", "mean"), seeds=3),
    Preset("searched", ("ensemble",), {"a": _SEARCHED, "b": _SEARCHED, "c": _SEARCHED}, ("full", "mean")),
    Preset("exhaustive", ("exhaustive",), _USUAL, ("full", "mean")),
    Preset("families", ("plain",), _zoo(50), ("stack", "mean", "climb"), best=True, folds=8),
    Preset("weighted_stack", ("stacked",), _zoo(50), _STACKED, external_weight=10.0),
    Preset("stack", ("exhaustive_risk",), _zoo(50), ("stack_mean", "stack", "rank", "mean")),
    Preset(
        "light_stack", ("lite",), _SEVEN, ("stack_mean", "stack", "mean", "four"),
        leads=("leafy_a", "level_a", "plain_a"),
    ),
    Preset("fixed_seeds", ("exhaustive_risk",), _USUAL, ("fixed", "mean"), seeds=5, weights=_FIXED),
    Preset("main_only", ("slim",), _USUAL, ("full", "mean"), external=False),
    Preset("evidence", ("evidence",), _USUAL, ("full", "mean")),
    Preset("main_only_seeds", ("slim",), _USUAL, ("fixed", "mean"), seeds=5, external=False, weights=_FIXED),
    Preset("solo", ("solo",), {"c": boosted(0.03, 3000, 8, min_rows=30, patience=100)}, seeds=5, external=False),
    Preset(
        "four_sets", ("set_a", "set_b", "set_c", "set_d"), _USUAL, ("climb", "stack", "mean"),
        best=True, external=False,
    ),
)

PRESETS: dict[str, Preset] = {p.name: p for p in _LISTED}
