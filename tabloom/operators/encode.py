"""Category encoders fitted on training rows.

``fit`` reduces the training rows to one small table for all columns in one
scan; ``transform`` joins that table back once per column. A fitted encoder is
a table, so it can be saved and applied later.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions import missing_as_text
from tabloom.operators.lookup import MAX_ROWS, Lookup, Search, look_up, settle
from tabloom.operators.ranks import range_offsets
from tabloom.session import materialise, shuffle_width

TRAIN = "train"


def _unpivot(
    df: DataFrame, cols: Sequence[str], keep: dict[str, Column], fill: bool = True
) -> DataFrame:
    """One (col, val) row per category column, with the ``keep`` columns."""
    as_text = (lambda c: missing_as_text(c)) if fill else (lambda c: c.cast("string"))
    base = df.select(
        *[column.alias(name) for name, column in keep.items()],
        *[as_text(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)],
    )
    long = base.unpivot(list(keep), [f"c{i}" for i in range(len(cols))], "col", "val")
    position = F.substring("col", 2, 9).cast("int")
    return long.withColumn("col", position).filter(F.col("val").isNotNull())


def _settled(table: DataFrame, max_rows: int | None = None) -> Lookup:
    return settle(table, ["col", "val"], max_rows=max_rows, part="col")


def _add_per_column(
    df: DataFrame,
    fitted: Lookup,
    cols: Sequence[str],
    values: Sequence[str],
    out: Sequence[str],
    build: Callable[[dict[str, Column]], Column],
    fill: bool = True,
) -> DataFrame:
    """Look every category column up and add what ``build`` makes of the values."""
    searches = []
    for i, c in enumerate(cols):
        text = F.col(f"`{c}`").cast("string")
        key = missing_as_text(text) if fill else text
        searches.append(Search(fitted.pick("col", i, "val"), (key,), tuple(values)))
    joined, found, helpers = look_up(df, searches)
    return joined.withColumns({o: build(f) for o, f in zip(out, found)}).drop(*helpers)


class FrequencyEncoder:
    """Share of the category among the non-missing training rows.

    Missing and unseen categories get 0.
    """

    def __init__(self, cols: Sequence[str], suffix: str = "_freq"):
        self.cols, self.suffix = list(cols), suffix

    def fit(self, train: DataFrame) -> FrequencyModel:
        counts = (
            _unpivot(train, self.cols, {}, fill=False)
            .groupBy("col", "val")
            .agg(F.count(F.lit(1)).alias("n_rows"))
        )
        # One row per column; a window per column would gather a whole
        # dictionary in one task.
        totals = counts.groupBy("col").agg(F.sum("n_rows").alias("n_all"))
        table = counts.join(F.broadcast(totals), "col").select(
            "col", "val", "n_rows", (F.col("n_rows") / F.col("n_all")).alias("share")
        )
        return FrequencyModel(self.cols, self.suffix, _settled(table))


@dataclass(frozen=True)
class FrequencyModel:
    cols: list[str]
    suffix: str
    fitted: Lookup

    def transform(self, df: DataFrame) -> DataFrame:
        out = [f"{c}{self.suffix}" for c in self.cols]
        return _add_per_column(
            df,
            self.fitted,
            self.cols,
            ["share"],
            out,
            lambda found: F.coalesce(found["share"], F.lit(0.0)),
            fill=False,
        )


class LabelEncoder:
    """Position of the category in the sorted list of all categories.

    Fitted on all rows it will be applied to, training and test; missing is
    the category 'nan'. Order is that of the code points.
    """

    def __init__(self, cols: Sequence[str], suffix: str = ""):
        self.cols, self.suffix = list(cols), suffix

    def fit(self, df: DataFrame, max_rows: int = MAX_ROWS) -> LabelModel:
        seen = (
            _unpivot(df, self.cols, {})
            .groupBy("col", "val")
            .agg(F.count(F.lit(1)).alias("n_rows"))
        )
        found = _settled(seen, max_rows)
        short = range(len(self.cols)) if found.small else found.small_parts or ()
        coded = _with_codes(found.table, short, len(self.cols))
        fitted = _settled(coded, max_rows)
        return LabelModel(self.cols, self.suffix, fitted)


def _with_codes(seen: DataFrame, short: Iterable[int], n_cols: int) -> DataFrame:
    """Rows (col, val, ...) with the position of each value among those of its column.

    ``short`` says which columns are short enough to be sorted in one task.
    """
    short = list(short)
    is_short = F.col("col").isin(short)
    order = Window.partitionBy("col").orderBy("val")
    coded = seen.filter(is_short).withColumn("code", (F.row_number().over(order) - 1).cast("long"))
    if len(short) == n_cols:
        return coded
    rest = _ordered_codes(seen.filter(~is_short))
    return coded.unionByName(rest.withColumn("code", F.col("code").cast("long")))


def _ordered_codes(seen: DataFrame) -> DataFrame:
    """Codes of a large dictionary: sorted by range, numbered per range.

    The range number is written out with the rows, so that both readers below
    see the same ranges.
    """
    ranges = shuffle_width(seen.sparkSession)
    ranged = materialise(
        seen.repartitionByRange(ranges, "col", "val").withColumn(
            "range_id", F.spark_partition_id()
        )
    )
    inside = Window.partitionBy("col", "range_id").orderBy("val")
    offsets = range_offsets(ranged, ["col"], {"n": F.count(F.lit(1))})
    return (
        ranged.withColumn("inside", F.row_number().over(inside) - 1)
        .join(offsets, ["col", "range_id"])
        .select(*seen.columns, (F.col("n_before") + F.col("inside")).alias("code"))
    )


@dataclass(frozen=True)
class LabelModel:
    cols: list[str]
    suffix: str
    fitted: Lookup

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace each column by its code, or add the code under a suffix."""
        out = [f"{c}{self.suffix}" for c in self.cols]
        return _add_per_column(
            df, self.fitted, self.cols, ["code"], out, lambda found: found["code"].cast("int")
        )


def _target_counts(
    train: DataFrame, cols: Sequence[str], target: str, fold_col: str | None
) -> DataFrame:
    """Rows and positives per (col, val, fold); one partially aggregated scan."""
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(0)
    long = _unpivot(train, cols, {"fold": fold, "y": F.col(target).cast("bigint")})
    return long.groupBy("col", "val", "fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")
    )


def _by_category(counts: DataFrame) -> DataFrame:
    """One row per (col, val): totals, and a map fold -> (n, s)."""
    entry = F.struct(F.col("fold").cast("string"), F.struct("n", "s"))
    return counts.groupBy("col", "val").agg(
        F.sum("n").alias("n_rows"),
        F.sum("s").alias("n_pos"),
        F.map_from_entries(F.collect_list(entry)).alias("per_fold"),
    )


class TargetEncoder:
    """Smoothed category mean of the target, without a row's own fold.

    A training row of fold f gets ``(s + g*m) / (n + m)`` with n and s counted
    over the other folds, g the target mean of all training rows and m the
    smoothing. Other rows get the same formula over all training rows. Missing
    is a category; an unseen one gets g. All folds come from one scan.
    """

    def __init__(
        self,
        cols: Sequence[str],
        target: str,
        fold_col: str = "fold",
        smoothing: float = 10.0,
        suffix: str = "_te",
    ):
        self.cols, self.target, self.fold_col = list(cols), target, fold_col
        self.smoothing, self.suffix = float(smoothing), suffix

    def fit(self, train: DataFrame) -> TargetModel:
        overall = train.agg(F.avg(F.col(self.target).cast("double")).alias("g")).first()["g"]
        counts = _by_category(_target_counts(train, self.cols, self.target, self.fold_col))
        table = counts.select("col", "val", "n_rows", *self._values(overall))
        return TargetModel(self, _settled(table), overall)

    def _values(self, overall: float | None) -> tuple[Column, Column]:
        """``full`` and ``held_out`` (by fold) from n_rows, n_pos and per_fold."""
        g, m = F.lit(overall).cast("double"), F.lit(self.smoothing)

        def smooth(s: Column, n: Column) -> Column:
            # Without smoothing a category found in no other fold has no mean.
            return F.try_divide(s + g * m, n + m)

        held_out = F.transform_values(
            "per_fold", lambda _, own: smooth(F.col("n_pos") - own["s"], F.col("n_rows") - own["n"])
        )
        return smooth(F.col("n_pos"), F.col("n_rows")).alias("full"), held_out.alias("held_out")

    def _encoded(
        self, full: Column, held_out: Column, overall: float | None, split_col: str
    ) -> Column:
        in_train = F.col(split_col).eqNullSafe(F.lit(TRAIN))
        own = F.try_element_at(held_out, F.col(self.fold_col).cast("string"))
        return F.coalesce(F.when(in_train, own).otherwise(full), F.lit(overall))


@dataclass(frozen=True)
class TargetModel:
    spec: TargetEncoder
    fitted: Lookup
    overall: float

    def transform(self, df: DataFrame, split_col: str = "split") -> DataFrame:
        out = [f"{c}{self.spec.suffix}" for c in self.spec.cols]
        return _add_per_column(
            df,
            self.fitted,
            self.spec.cols,
            ["full", "held_out"],
            out,
            lambda found: self.spec._encoded(found["full"], found["held_out"], self.overall, split_col),
        )


class WoeEncoder:
    """Weight of evidence: log of the non-event share over the event share.

    Both shares are smoothed by ``alpha`` per category. By default all
    training rows are used for all rows, which lets a row see its own label;
    with ``fold_col`` a training row sees the other folds only.
    """

    def __init__(
        self,
        cols: Sequence[str],
        target: str,
        alpha: float = 10.0,
        fold_col: str | None = None,
        suffix: str = "_woe",
    ):
        self.cols, self.target, self.alpha = list(cols), target, float(alpha)
        self.fold_col, self.suffix = fold_col, suffix

    def fit(self, train: DataFrame) -> WoeModel:
        counts = _target_counts(train, self.cols, self.target, self.fold_col)
        per_category = _by_category(counts)
        table = self._with_values(per_category, counts).select("col", "val", "n_rows", "full", "held_out")
        return WoeModel(self, _settled(table))

    def _with_values(self, per_category: DataFrame, counts: DataFrame) -> DataFrame:
        """The categories with ``full`` and ``held_out`` (by fold).

        A category without training rows may be among them; it counts nowhere.
        """
        trained = per_category.filter("n_rows > 0")
        # One row per column and, below, one per column and fold.
        totals = trained.groupBy("col").agg(
            F.sum("n_rows").alias("all_n"),
            F.sum("n_pos").alias("all_s"),
            F.count(F.lit(1)).alias("k"),
        )
        full = self._woe(
            F.col("n_rows"), F.col("n_pos"), F.col("all_n"), F.col("all_s"), F.col("k")
        )
        table = per_category.join(F.broadcast(totals), "col", "left")
        held_out = F.lit(None).cast("map<string,double>")
        if self.fold_col:
            table = table.join(F.broadcast(self._fold_totals(counts, trained)), "col", "left")
            held_out = F.transform_values("fold_totals", self._held_out)
        return table.withColumns({"full": full, "held_out": held_out}).drop(
            "all_n", "all_s", "k", "fold_totals"
        )

    def _encoded(self, full: Column, held_out: Column, split_col: str) -> Column:
        value = full
        if self.fold_col:
            in_train = F.col(split_col).eqNullSafe(F.lit(TRAIN))
            own = F.try_element_at(held_out, F.col(self.fold_col).cast("string"))
            value = F.when(in_train, own).otherwise(full)
        return F.coalesce(value, F.lit(0.0))

    def _woe(self, n: Column, s: Column, all_n: Column, all_s: Column, k: Column) -> Column:
        a = F.lit(self.alpha)
        others = F.try_divide(n - s + a, all_n - all_s + a * k)
        events = F.try_divide(s + a, all_s + a * k)
        return F.log(F.try_divide(others, events))

    def _held_out(self, fold: Column, total: Column) -> Column:
        """WoE of a category over the rows outside ``fold``."""
        own = F.try_element_at(F.col("per_fold"), fold)
        own_n = F.coalesce(own["n"], F.lit(0))
        own_s = F.coalesce(own["s"], F.lit(0))
        n, s = F.col("n_rows") - own_n, F.col("n_pos") - own_s
        woe = self._woe(
            n, s, F.col("all_n") - total["n"], F.col("all_s") - total["s"], total["k"]
        )
        # A category found in no other fold is unseen there.
        return F.when(n > 0, woe).otherwise(F.lit(0.0))

    @staticmethod
    def _fold_totals(counts: DataFrame, per_category: DataFrame) -> DataFrame:
        """Per column a map fold -> rows and positives of the fold, and the
        number of categories that occur outside it."""
        sums = counts.groupBy("col", "fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        confined = (
            per_category.filter(F.size("per_fold") == 1)
            .select("col", F.element_at(F.map_keys("per_fold"), 1).cast("int").alias("fold"))
            .groupBy("col", "fold")
            .agg(F.count(F.lit(1)).alias("n_confined"))
        )
        categories = per_category.groupBy("col").agg(F.count(F.lit(1)).alias("n_categories"))
        rows = sums.join(confined, ["col", "fold"], "left").join(categories, "col")
        k = F.col("n_categories") - F.coalesce(F.col("n_confined"), F.lit(0))
        entry = F.struct(F.col("fold").cast("string"), F.struct("n", "s", k.alias("k")))
        return rows.groupBy("col").agg(
            F.map_from_entries(F.collect_list(entry)).alias("fold_totals")
        )


@dataclass(frozen=True)
class WoeModel:
    spec: WoeEncoder
    fitted: Lookup

    def transform(self, df: DataFrame, split_col: str = "split") -> DataFrame:
        """Add the encodings; an unseen category gets 0."""
        out = [f"{c}{self.spec.suffix}" for c in self.spec.cols]
        return _add_per_column(
            df,
            self.fitted,
            self.spec.cols,
            ["full", "held_out"],
            out,
            lambda found: self.spec._encoded(found["full"], found["held_out"], split_col),
        )


Encoder = FrequencyEncoder | TargetEncoder | WoeEncoder | LabelEncoder


class CategoryEncoders:
    """Several encoders of the same columns, fitted in one scan and added in one join.

    One table of sufficient statistics (rows and positives per column, category,
    fold, and whether they are training rows) holds all that frequencies,
    target encodings, weights of evidence and codes need. Each gives what it
    gives when it is fitted by itself: codes see all rows, the others the
    training rows.
    """

    def __init__(self, encoders: Sequence[Encoder], split_col: str = "split"):
        self.encoders, self.split_col = list(encoders), split_col
        self.cols = list(encoders[0].cols)
        aimed = [e for e in encoders if isinstance(e, (TargetEncoder, WoeEncoder))]
        folds = {e.fold_col for e in aimed if e.fold_col}
        if any(list(e.cols) != self.cols for e in encoders):
            raise ValueError("encoders that are fitted together take the same columns")
        if len(folds) > 1 or len({e.target for e in aimed}) > 1:
            raise ValueError("encoders that are fitted together take one target and one fold column")
        self.target = aimed[0].target if aimed else None
        self.fold_col = next(iter(folds), None)

    def fit(self, df: DataFrame, max_rows: int | None = None) -> CategoryModel:
        """Fit on a table of training and other rows, told apart by ``split``."""
        max_rows = MAX_ROWS if max_rows is None else max_rows
        counts = materialise(self._counts(df))
        trained = counts.filter("trained")
        entry = F.struct(F.col("fold").cast("string"), F.struct("n", "s"))
        own = F.col("trained")
        table = counts.groupBy("col", "val").agg(
            F.sum("n").alias("n_seen"),
            F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.when(own, F.col("s"))), F.lit(0)).alias("n_pos"),
            F.coalesce(F.sum(F.when(own, F.col("n_present"))), F.lit(0)).alias("n_present"),
            F.map_from_entries(F.collect_list(F.when(own, entry))).alias("per_fold"),
        )
        overall = None
        values: list[str] = []
        for i, encoder in enumerate(self.encoders):
            names = {"full": f"full{i}", "held_out": f"held_out{i}"}
            if isinstance(encoder, FrequencyEncoder):
                totals = trained.groupBy("col").agg(F.sum("n_present").alias("all_present"))
                table = table.join(F.broadcast(totals), "col", "left").withColumn(
                    f"share{i}", F.try_divide(F.col("n_present").cast("double"), F.col("all_present"))
                ).drop("all_present")
                values.append(f"share{i}")
            elif isinstance(encoder, TargetEncoder):
                overall = trained.filter("col = 0").agg(F.try_divide(F.sum("s"), F.sum("n_y"))).first()[0]
                seen = F.col("n_rows") > 0
                for value, name in zip(encoder._values(overall), names.values()):
                    table = table.withColumn(name, F.when(seen, value))
                values += names.values()
            elif isinstance(encoder, WoeEncoder):
                table = encoder._with_values(table, trained)
                seen = F.col("n_rows") > 0
                table = table.withColumn("full", F.when(seen, F.col("full"))).withColumnsRenamed(names)
                values += names.values()
            else:
                values.append("code")
        if "code" in values:
            table = materialise(table)
            sizes = dict(table.groupBy("col").count().collect())
            table = _with_codes(table, [c for c, n in sizes.items() if n <= max_rows], len(sizes))
        table = table.select("col", "val", F.col("n_seen").alias("n_rows"), *values)
        return CategoryModel(self, _settled(table, max_rows), overall)

    def _counts(self, df: DataFrame) -> DataFrame:
        """Per (col, val, fold, trained): rows, rows with a value, with a target, and positives."""
        y = F.col(self.target).cast("bigint") if self.target else F.lit(None).cast("bigint")
        keep = {
            "fold": F.col(self.fold_col).cast("int") if self.fold_col else F.lit(0),
            "trained": F.col(self.split_col).eqNullSafe(F.lit(TRAIN)),
            "y": y,
        }
        base = df.select(
            *[column.alias(name) for name, column in keep.items()],
            *[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(self.cols)],
        )
        # Missing stays in: it is a category to all but frequencies.
        pairs = F.array(
            *[F.struct(F.lit(i).alias("col"), F.col(f"c{i}").alias("raw")) for i in range(len(self.cols))]
        )
        long = base.select(*keep, F.explode(pairs).alias("e")).select(*keep, "e.col", "e.raw")
        return (
            long.groupBy("col", missing_as_text(F.col("raw")).alias("val"), "fold", "trained")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.count("raw").alias("n_present"),
                F.count("y").alias("n_y"),
                F.coalesce(F.sum("y"), F.lit(0)).alias("s"),
            )
        )


@dataclass(frozen=True)
class CategoryModel:
    spec: CategoryEncoders
    fitted: Lookup
    overall: float | None

    def transform(self, df: DataFrame) -> DataFrame:
        """Add every encoding; codes replace their column where they have no suffix."""
        values = [v for v in self.fitted.table.columns if v not in ("col", "val", "n_rows")]
        searches = [
            Search(self.fitted.pick("col", i, "val"), (missing_as_text(F.col(f"`{c}`").cast("string")),), tuple(values))
            for i, c in enumerate(self.spec.cols)
        ]
        joined, found, helpers = look_up(df, searches)
        added = {}
        for i, encoder in enumerate(self.spec.encoders):
            for c, own in zip(self.spec.cols, found):
                added[f"{c}{encoder.suffix}"] = self._value(i, encoder, own, F.col(f"`{c}`"))
        return joined.withColumns(added).drop(*helpers)

    def _value(self, i: int, encoder: Encoder, found: dict[str, Column], raw: Column) -> Column:
        if isinstance(encoder, FrequencyEncoder):
            return F.when(raw.isNull(), F.lit(0.0)).otherwise(F.coalesce(found[f"share{i}"], F.lit(0.0)))
        if isinstance(encoder, LabelEncoder):
            return found["code"].cast("int")
        full, held_out = found[f"full{i}"], found[f"held_out{i}"]
        if isinstance(encoder, TargetEncoder):
            return encoder._encoded(full, held_out, self.overall, self.spec.split_col)
        return encoder._encoded(full, held_out, self.spec.split_col)
