"""Exact ranks, order positions and medians without sorting in one task.

Values are first reduced to one row per distinct (group, value) with a count,
which takes care of values shared by many rows. The distinct values are then
cut into ranges at quantile edges of the whole column, so that every range
holds a bounded share of them whatever the groups look like. Running counts
inside a range plus the total of the ranges before it give exact positions,
for any choice of edges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloom.functions import numeric
from tabloom.operators import lookup as lookup_module
from tabloom.operators.lookup import Lookup, Search, attach, look_up, settle
from tabloom.session import materialise, shuffle_width

MIN_RANGES = 16
MAX_RANGES = 16_384
INFINITY = float("inf")
# A dictionary is tried as small when it is estimated to have less than this
# share of the rows allowed for one.
SMALL_SHARE = 0.8


def range_count(spark: SparkSession) -> int:
    """Ranges per column: a few per shuffle partition."""
    return max(MIN_RANGES, min(MAX_RANGES, 4 * shuffle_width(spark)))


def quantile_edges(df: DataFrame, cols: Sequence[str], ranges: int) -> dict[str, list[float]]:
    """Approximate quantiles of each column, without a shuffle of the rows.

    The edges only balance the work, results do not depend on them. Sketches
    of the tasks are merged in two steps, in about the square root of the
    number of shuffle partitions groups first, so that no single task has to
    merge the sketches of all tasks.
    """
    shares = [i / ranges for i in range(1, ranges)]
    accuracy = max(1_000, 4 * ranges)
    groups = max(1, math.isqrt(shuffle_width(df.sparkSession)))
    sketches = (
        df.select(
            F.pmod(F.spark_partition_id(), F.lit(groups)).alias("__group"),
            *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)],
        )
        .groupBy("__group")
        .agg(
            *[
                F.coalesce(
                    F.percentile_approx(f"x{i}", shares, accuracy), F.array().cast("array<double>")
                ).alias(f"x{i}")
                for i in range(len(cols))
            ]
        )
    )
    points = sketches.select(F.inline(F.arrays_zip(*[f"x{i}" for i in range(len(cols))])))
    row = points.agg(
        *[F.percentile_approx(f"x{i}", shares, accuracy).alias(f"x{i}") for i in range(len(cols))]
    ).first()
    return {
        c: sorted({e for e in (row[f"x{i}"] or []) if abs(e) < INFINITY})
        for i, c in enumerate(cols)
    }


def with_range(df: DataFrame, col: str, edges: Sequence[float], out: str = "range_id") -> DataFrame:
    """The index of the range a value lies in; monotone in the value."""
    if not edges:
        return df.withColumn(out, F.lit(0))
    as_double = df.withColumn("__sort_value", F.col(col).cast("double"))
    cutter = Bucketizer(
        splits=[-INFINITY, *edges, INFINITY],
        inputCol="__sort_value",
        outputCol="__range",
        handleInvalid="keep",
    )
    return (
        cutter.transform(as_double)
        .withColumn(out, F.col("__range").cast("int"))
        .drop("__sort_value", "__range")
    )


def _before(order: Sequence[str], by: Sequence[str]):
    """All rows strictly before the current one within ``by``."""
    parts = [F.col(c) for c in by] or [F.lit(0)]
    return (
        Window.partitionBy(*parts)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def range_offsets(
    rows: DataFrame, by: Sequence[str], sums: dict[str, Column], range_col: str = "range_id"
) -> DataFrame:
    """Per (by, range): sums over the range, over the ranges before it and over
    the whole group.

    Summed per task before the shuffle; the window runs over at most one row
    per range and group.
    """
    per_range = rows.groupBy(*by, range_col).agg(*[c.alias(s) for s, c in sums.items()])
    parts = [F.col(c) for c in by] or [F.lit(0)]
    whole = Window.partitionBy(*parts)
    return per_range.select(
        *by,
        range_col,
        *sums,
        *[
            F.coalesce(F.sum(s).over(_before([range_col], by)), F.lit(0)).alias(f"{s}_before")
            for s in sums
        ],
        *[F.sum(s).over(whole).alias(f"{s}_total") for s in sums],
    )


def count_offsets(rows: DataFrame, by: Sequence[str]) -> Lookup:
    """Row counts per (by, range) with those before and in the whole group."""
    offsets = range_offsets(rows, by, {"n_range": F.count(F.lit(1))})
    return settle(offsets, [*by, "range_id"], "n_range")


def _with_offsets(counted: DataFrame, offsets: Lookup) -> DataFrame:
    table = F.broadcast(offsets.table) if offsets.small else offsets.table
    return counted.join(table, list(offsets.keys))


def value_positions(
    rows: DataFrame, by: Sequence[str], value: str, offsets: Lookup | None = None
) -> DataFrame:
    """For each distinct (by, value) of ``rows`` (with their ``range_id``): its
    rows, the rows before it in the group, and all rows of the group."""
    offsets = offsets or count_offsets(rows, by)
    counted = rows.groupBy(*by, "range_id", value).agg(F.count(F.lit(1)).alias("n_rows"))
    inside = F.sum("n_rows").over(_before([value], [*by, "range_id"]))
    placed = counted.withColumn("n_inside", F.coalesce(inside, F.lit(0)))
    return _with_offsets(placed, offsets).select(
        *by,
        value,
        "n_rows",
        (F.col("n_range_before") + F.col("n_inside")).alias("n_before"),
        F.col("n_range_total").alias("n_total"),
    )


def _average_rank() -> Column:
    """Average rank of tied rows as a share of the rows in the group."""
    return (F.col("n_before") + (F.col("n_rows") + F.lit(1)) / F.lit(2.0)) / F.col("n_total")


def _distinct_estimates(rows: DataFrame, cols: dict[str, Sequence[str]]) -> dict[str, float]:
    """About how many distinct combinations each column list has; one scan."""
    row = rows.agg(
        *[
            F.approx_count_distinct(F.xxhash64(*names)).alias(f"d{i}")
            for i, names in enumerate(cols.values())
        ]
    ).first()
    return {name: row[f"d{i}"] for i, name in enumerate(cols)}


def _small_ranks(rows: DataFrame, by: Sequence[str], value: str) -> Lookup:
    """Ranks of few distinct values: counted, settled, ranked in one window."""
    counts = settle(
        rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n_rows")), [*by, value]
    )
    if not counts.small:
        return counts
    parts = [F.col(c) for c in by] or [F.lit(0)]
    ranked = counts.table.withColumns(
        {
            "n_before": F.coalesce(F.sum("n_rows").over(_before([value], by)), F.lit(0)),
            "n_total": F.sum("n_rows").over(Window.partitionBy(*parts)),
        }
    )
    return settle(ranked.select(*by, value, "n_rows", _average_rank().alias("pct")), [*by, value])


def _large_ranks(rows: DataFrame, by: Sequence[str], value: str) -> Lookup:
    """Ranks of many distinct values, given rows with a ``range_id``."""
    ranked = value_positions(rows, by, value).select(
        *by, value, "n_rows", _average_rank().alias("pct")
    )
    return Lookup(materialise(ranked), (*by, value), "n_rows")


def pct_rank(
    df: DataFrame, value: str, by: Sequence[str] = (), out: str = "pct_rank"
) -> DataFrame:
    """Average rank divided by the number of non-missing rows, per group.

    Rows whose value or group is missing get NULL.
    """
    by = [by] if isinstance(by, str) else list(by)
    sort_value = numeric(F.col(f"`{value}`"), df.schema[value].dataType)
    keys = [f"__by{i}" for i in range(len(by))]
    rows = df.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(by, keys)], sort_value.alias("__value")
    ).na.drop()
    estimate = _distinct_estimates(rows, {"all": [*keys, "__value"]})["all"]
    lookup = None
    if estimate < SMALL_SHARE * lookup_module.MAX_ROWS:
        lookup = _small_ranks(rows, keys, "__value")
    if lookup is None or not lookup.small:
        edges = quantile_edges(rows, ["__value"], range_count(df.sparkSession))["__value"]
        lookup = _large_ranks(with_range(rows, "__value", edges), keys, "__value")
    return attach(df, lookup, [*[F.col(f"`{c}`") for c in by], sort_value], {"pct": out})


@dataclass(frozen=True)
class RankSpec:
    """One percent-rank column: ``value`` within ``by``."""

    value: str
    by: str | None = None

    @property
    def name(self) -> str:
        return f"{self.by}_{self.value}_rank" if self.by else f"{self.value}_pctrank"


def pct_ranks(df: DataFrame, specs: Sequence[RankSpec], id_col: str = "id") -> DataFrame:
    """Many percent-rank columns at once.

    Columns with few distinct values are joined back as broadcast dictionaries.
    The others travel together as narrow (rank, group, value, id) rows and come
    back in one join on the key, so the wide rows are shuffled at most once.
    """
    scope = {f.name: f.dataType for f in df.schema.fields}
    values = list(dict.fromkeys(s.value for s in specs))
    groups = list(dict.fromkeys(s.by for s in specs if s.by))
    # All values stand side by side as DOUBLE: exact for whole numbers up to
    # 2^53; rank larger ones one by one with pct_rank.
    value_cols = {v: numeric(F.col(f"`{v}`"), scope[v]).cast("double") for v in values}
    group_cols = {b: F.col(f"`{b}`").cast("string") for b in groups}
    rows = df.select(
        F.col(id_col).alias("__id"),
        *[c.alias(f"v_{v}") for v, c in value_cols.items()],
        *[c.alias(f"b_{b}") for b, c in group_cols.items()],
    )
    combos = {s.name: [*([f"b_{s.by}"] if s.by else []), f"v_{s.value}"] for s in specs}
    estimates = _distinct_estimates(rows, combos)
    bound = SMALL_SHARE * lookup_module.MAX_ROWS
    few, room = [], bound
    for spec in sorted(specs, key=lambda s: estimates[s.name]):
        if estimates[spec.name] < room:
            few.append(spec)
            room -= estimates[spec.name]
    lookup = None
    if few:
        lookup = _small_ranks(_long_ranks(rows, few), ["spec", "grp"], "val")
    if lookup is not None and not lookup.small:
        few = []
    many = [s for s in specs if s not in few]
    if many:
        # Four passes follow over these few columns of what may be a long query.
        df = df.join(
            _ranks_by_id(materialise(rows), many), F.col(f"`{id_col}`") == F.col("__id"), "left"
        ).drop("__id")
    searches = [
        Search(
            lookup.pick("spec", i, "grp", "val"),
            (group_cols[spec.by] if spec.by else F.lit(""), value_cols[spec.value]),
            ("pct",),
        )
        for i, spec in enumerate(few)
    ]
    df, found, helpers = look_up(df, searches)
    df = df.withColumns({spec.name: f["pct"] for spec, f in zip(few, found)}).drop(*helpers)
    names = [s.name for s in specs]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in names], *names)


def _long_ranks(
    rows: DataFrame, specs: Sequence[RankSpec], edges: dict[str, list[float]] | None = None
) -> DataFrame:
    """(spec, grp, val) rows, with ``__id`` and ``range_id`` when edges are given."""
    if edges is not None:
        for v in dict.fromkeys(s.value for s in specs):
            rows = with_range(rows, f"v_{v}", edges[f"v_{v}"], f"r_{v}")
    entries = [
        F.struct(
            F.lit(i).alias("spec"),
            (F.col(f"b_{s.by}") if s.by else F.lit("")).alias("grp"),
            F.col(f"v_{s.value}").alias("val"),
            *([F.col(f"r_{s.value}").alias("range_id")] if edges is not None else []),
        )
        for i, s in enumerate(specs)
    ]
    kept = ["__id"] if edges is not None else []
    long = rows.select(*kept, F.inline(F.array(*entries)))
    return long.filter(F.col("grp").isNotNull() & F.col("val").isNotNull())


def _ranks_by_id(rows: DataFrame, specs: Sequence[RankSpec]) -> DataFrame:
    """One row per key with a rank column per spec; keys without any are absent."""
    cols = list(dict.fromkeys(f"v_{s.value}" for s in specs))
    edges = quantile_edges(rows, cols, range_count(rows.sparkSession))
    long = _long_ranks(rows, specs, edges)
    lookup = _large_ranks(long, ["spec", "grp"], "val")
    placed = attach(long, lookup, [F.col("spec"), F.col("grp"), F.col("val")], {"pct": "pct"})
    return placed.groupBy("__id").agg(
        *[F.max(F.when(F.col("spec") == i, F.col("pct"))).alias(s.name) for i, s in enumerate(specs)]
    )


def exact_medians(
    df: DataFrame, key_sets: Sequence[Sequence[str]], values: Sequence[str]
) -> DataFrame:
    """Exact median with linear interpolation of every value, for every key set.

    Gives ``set_id`` (position of the key set), ``key0``, ``key1``, ... (text,
    empty beyond the set's keys), ``n_rows`` and ``median_<value>``; a key whose
    values are all missing has no row. Row counts per range say which ranges
    hold the middle rows of each group; only the rows of those ranges are
    shuffled.
    """
    edges = quantile_edges(df, values, range_count(df.sparkSession))
    ranged = df
    for i, v in enumerate(values):
        ranged = with_range(ranged, v, edges[v], f"__r{i}")
    width = max(len(keys) for keys in key_sets)
    key_names = [f"key{i}" for i in range(width)]

    def key_entry(position: int) -> list[Column]:
        keys = list(key_sets[position])
        texts = [F.col(k).cast("string") for k in keys] + [F.lit("")] * (width - len(keys))
        return [
            F.lit(position).alias("set_id"),
            *[text.alias(name) for text, name in zip(texts, key_names)],
        ]

    entries = [
        F.struct(
            *key_entry(position),
            F.lit(i).alias("item"),
            F.col(v).cast("double").alias("val"),
            F.col(f"__r{i}").alias("range_id"),
        )
        for position in range(len(key_sets))
        for i, v in enumerate(values)
    ]
    group = ["set_id", *key_names]
    by = [*group, "item"]
    long = ranged.select(F.inline(F.array(*entries))).filter(F.col("val").isNotNull())
    offsets = count_offsets(long, by)

    def holds_middle(first: Column, count: Column, total: Column) -> Column:
        # 0-based positions of the middle rows; equal for an odd number of rows.
        low, high = F.floor((total - 1) / 2), F.floor(total / 2)
        return (first <= high) & (first + count > low)

    in_range = holds_middle(F.col("n_range_before"), F.col("n_range"), F.col("n_range_total"))
    needed = offsets.table.filter(in_range)
    near = long.join(
        F.broadcast(needed) if offsets.small else needed, [*by, "range_id"], "left_semi"
    )
    placed = value_positions(near, by, "val", Lookup(needed, offsets.keys, "n_range", offsets.local))
    of_value = holds_middle(F.col("n_before"), F.col("n_rows"), F.col("n_total"))
    middle = placed.filter(of_value).groupBy(*by).agg(
        ((F.min("val") + F.max("val")) / 2.0).alias("median"), F.max("n_total").alias("n_total")
    )
    return middle.groupBy(*group).agg(
        F.max("n_total").alias("n_rows"),
        *[
            F.max(F.when(F.col("item") == i, F.col("median"))).alias(f"median_{v}")
            for i, v in enumerate(values)
        ],
    )
