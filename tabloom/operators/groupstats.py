"""Group statistics fitted on training rows and mapped back to any rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions import missing_as_text, numeric
from tabloom.operators.lookup import Lookup, Search, look_up, settle
from tabloom.operators.ranks import exact_medians

TRAIN = "train"


@dataclass(frozen=True)
class StatBlock:
    """Statistics of ``values`` per combination of ``keys``.

    ``unseen`` says what a key without fitted rows gets: 'train_mean' gives the
    train-wide mean for means and 0 for the other statistics, 'zero' gives 0.
    """

    keys: tuple[str, ...]
    values: tuple[str, ...]
    stats: tuple[str, ...] = ("mean", "std")
    deviation: bool = True
    unseen: str = "train_mean"

    def prefix(self, value: str) -> str:
        return "_".join((*self.keys, value))


def stat_blocks(
    keys: Sequence[Sequence[str] | str], values: Sequence[str], **options
) -> list[StatBlock]:
    """One block per key or key combination."""
    return [
        StatBlock((k,) if isinstance(k, str) else tuple(k), tuple(values), **options)
        for k in keys
    ]


def group_stats_table(
    train: DataFrame, key_sets: Sequence[Sequence[str]], values: Sequence[str]
) -> DataFrame:
    """Count, mean and sample deviation of every value for every key set.

    One scan and one partially aggregated shuffle for all key sets, including
    the empty one, which holds the train-wide statistics. ``set_id`` is the
    position of the key set.
    """
    scope = {f.name: f.dataType for f in train.schema.fields}
    key_cols = list(dict.fromkeys(k for keys in key_sets for k in keys))
    base = train.select(
        *[missing_as_text(F.col(f"`{k}`")).alias(f"k_{k}") for k in key_cols],
        *[numeric(F.col(f"`{v}`"), scope[v]).alias(f"v_{v}") for v in values],
    )
    sets = [[F.col(f"k_{k}") for k in keys] for keys in key_sets]
    grouped = base.groupingSets(sets, *[F.col(f"k_{k}") for k in key_cols]).agg(
        F.grouping_id().alias("grouping"),
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(f"v_{v}").alias(f"mean_{v}") for v in values],
        *[F.coalesce(F.stddev_samp(f"v_{v}"), F.lit(0.0)).alias(f"std_{v}") for v in values],
    )
    set_id = F.lit(None).cast("int")
    for position, keys in enumerate(key_sets):
        absent = sum(
            1 << (len(key_cols) - 1 - i) for i, k in enumerate(key_cols) if k not in keys
        )
        set_id = F.when(F.col("grouping") == absent, F.lit(position)).otherwise(set_id)
    return grouped.withColumn("set_id", set_id).drop("grouping")


class GroupStats:
    """Fit statistics on training rows, then add them to any rows."""

    def __init__(self, blocks: Sequence[StatBlock]):
        self.blocks = list(blocks)

    def fit(self, train: DataFrame) -> GroupStatsModel:
        values = list(dict.fromkeys(v for b in self.blocks for v in b.values))
        key_sets = [list(k) for k in dict.fromkeys(b.keys for b in self.blocks)]
        table = group_stats_table(train, [*key_sets, []], values)
        key_cols = list(dict.fromkeys(k for keys in key_sets for k in keys))
        fitted = settle(table, [f"k_{k}" for k in key_cols], part="set_id")
        overall = fitted.table.filter(F.col("set_id") == len(key_sets)).first()
        means = {v: overall[f"mean_{v}"] if overall else None for v in values}
        wanted = [block for block in self.blocks if "median" in block.stats]
        medians = _medians(train, wanted) if wanted else None
        median_sets = [block.keys for block in wanted]
        return GroupStatsModel(self.blocks, key_sets, fitted, means, medians, median_sets)


def _medians(train: DataFrame, blocks: Sequence[StatBlock]) -> Lookup:
    """Medians of all values for the key sets of all blocks, in one table."""
    scope = {f.name: f.dataType for f in train.schema.fields}
    key_cols = list(dict.fromkeys(k for block in blocks for k in block.keys))
    values = list(dict.fromkeys(v for block in blocks for v in block.values))
    base = train.select(
        *[missing_as_text(F.col(f"`{k}`")).alias(f"k_{k}") for k in key_cols],
        *[numeric(F.col(f"`{v}`"), scope[v]).alias(v) for v in values],
    )
    key_sets = [[f"k_{k}" for k in block.keys] for block in blocks]
    keys = [f"key{i}" for i in range(max(len(k) for k in key_sets))]
    medians = exact_medians(base, key_sets, values)
    return settle(medians, ["set_id", *keys], part="set_id")


@dataclass(frozen=True)
class GroupStatsModel:
    blocks: list[StatBlock]
    key_sets: list[list[str]]
    fitted: Lookup
    train_means: dict[str, float | None]
    medians: Lookup | None
    median_sets: list[tuple[str, ...]]

    @property
    def names(self) -> list[str]:
        return [name for block in self.blocks for name in self._names(block)]

    @staticmethod
    def _names(block: StatBlock) -> list[str]:
        suffixes = [*block.stats, *(["diff"] if block.deviation else [])]
        return [f"{block.prefix(v)}_{s}" for v in block.values for s in suffixes]

    def transform(self, df: DataFrame, split_col: str = "split") -> DataFrame:
        """Add the statistics. Training rows keep NULL where their whole group
        lacks the value; other rows get the default."""
        scope = {f.name: f.dataType for f in df.schema.fields}
        joined, found, helpers = look_up(
            df, [search for block in self.blocks for search in self._searches(block)]
        )
        results = iter(found)
        added: dict[str, Column] = {}
        for block in self.blocks:
            values = next(results)
            if "median" in block.stats:
                values = values | next(results)
            added |= self._columns(block, values, scope, split_col)
        return joined.withColumns(added).drop(*helpers)

    def _searches(self, block: StatBlock) -> list[Search]:
        on = tuple(missing_as_text(F.col(f"`{k}`")) for k in block.keys)
        of_keys = self.fitted.pick(
            "set_id", self.key_sets.index(list(block.keys)), *[f"k_{k}" for k in block.keys]
        )
        stats = [s for s in ("mean", "std") if s in block.stats or (s == "mean" and block.deviation)]
        searches = [Search(of_keys, on, tuple(f"{s}_{v}" for v in block.values for s in stats))]
        if "median" in block.stats:
            of_medians = self.medians.pick(
                "set_id",
                self.median_sets.index(block.keys),
                *[f"key{i}" for i in range(len(block.keys))],
            )
            searches.append(Search(of_medians, on, tuple(f"median_{v}" for v in block.values)))
        return searches

    def _columns(
        self, block: StatBlock, found: dict[str, Column], scope: dict, split_col: str
    ) -> dict[str, Column]:
        fitted_row = F.lit(False)
        if split_col in scope and block.unseen == "train_mean":
            fitted_row = F.col(split_col).eqNullSafe(F.lit(TRAIN))
        added: dict[str, Column] = {}
        for v in block.values:
            default = self.train_means[v] if block.unseen == "train_mean" else 0.0
            mean = found.get(f"mean_{v}")
            if mean is not None:
                filled = F.coalesce(mean, F.lit(default).cast("double"))
                mean = F.when(fitted_row, mean).otherwise(filled)
            for stat in block.stats:
                added[f"{block.prefix(v)}_{stat}"] = (
                    mean if stat == "mean" else F.coalesce(found[f"{stat}_{v}"], F.lit(0.0))
                )
            if block.deviation:
                value = numeric(F.col(f"`{v}`"), scope[v])
                added[f"{block.prefix(v)}_diff"] = value - mean
        return added


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Each non-missing value with its count and its share of all of them."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    return counts.withColumn("share", F.col("n_rows") / total)
