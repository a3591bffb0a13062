"""Row-wise features declared as data and applied as a few wide projections.

A feature names its inputs. Features whose inputs are raw columns form the
first projection, features that use those form the next one, and so on, so a
set of 150 features costs three or four ``select`` steps in the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions import (
    above,
    below,
    equals,
    flag,
    numeric,
    right_closed_bin,
    safe_ratio,
    text_matches,
)

Scope = dict[str, T.DataType]
Builder = Callable[[Scope], Column]


@dataclass(frozen=True)
class Feature:
    """A named expression over input columns."""

    name: str
    inputs: tuple[str, ...]
    build: Builder
    any_input: bool = False  # usable when at least one input is present


def _num(scope: Scope, name: str) -> Column:
    return numeric(F.col(f"`{name}`"), scope[name])


def _raw(name: str) -> Column:
    return F.col(f"`{name}`")


def _present(scope: Scope, names: Iterable[str]) -> list[str]:
    return [name for name in names if name in scope]


def ratio(name: str, top: str, bottom: str, eps: float = 0.0) -> Feature:
    """``top / (bottom + eps)``."""
    return Feature(
        name,
        (top, bottom),
        lambda s: safe_ratio(_num(s, top), _num(s, bottom) + F.lit(float(eps))),
    )


def product(name: str, *cols: str) -> Feature:
    return Feature(name, cols, lambda s: reduce(mul, [_num(s, c) for c in cols]))


def power(name: str, col: str, exponent: int = 2) -> Feature:
    return product(name, *[col] * exponent)


def log1p(name: str, *cols: str) -> Feature:
    """``ln(1 + product of cols)``; NULL at and below -1."""
    return Feature(
        name,
        cols,
        lambda s: F.log1p(reduce(mul, [_num(s, c) for c in cols]).cast("double")),
    )


def difference(name: str, left: str, right: str) -> Feature:
    return Feature(name, (left, right), lambda s: _num(s, left) - _num(s, right))


def relative_difference(name: str, left: str, right: str, eps: float = 0.01) -> Feature:
    """``(left - right) / (right + eps)``."""
    return Feature(
        name,
        (left, right),
        lambda s: safe_ratio(
            _num(s, left) - _num(s, right), _num(s, right) + F.lit(float(eps))
        ),
    )


def count_equal(name: str, cols: Sequence[str], value: str) -> Feature:
    """How many of the columns that are present equal ``value``."""
    return Feature(
        name,
        tuple(cols),
        lambda s: reduce(add, [equals(_raw(c), value, dtype=s[c]) for c in _present(s, cols)]),
        any_input=True,
    )


def count_positive(name: str, cols: Sequence[str]) -> Feature:
    """How many of the columns that are present are greater than 0."""
    return Feature(
        name,
        tuple(cols),
        lambda s: reduce(add, [above(_num(s, c), 0) for c in _present(s, cols)]),
        any_input=True,
    )


def count_active(name: str, cols: Sequence[str], value: str = "Yes") -> Feature:
    """Text columns count when equal to ``value``, numeric ones when positive."""

    def build(s: Scope) -> Column:
        return reduce(
            add,
            [
                equals(_raw(c), value)
                if isinstance(s[c], T.StringType)
                else above(_num(s, c), 0)
                for c in _present(s, cols)
            ],
        )

    return Feature(name, tuple(cols), build, any_input=True)


def flag_equal(name: str, col: str, value: str) -> Feature:
    return Feature(name, (col,), lambda s: equals(_raw(col), value, dtype=s[col]))


def flag_not_equal(name: str, col: str, value: str) -> Feature:
    """1 where the column differs from ``value`` or is missing."""
    return Feature(name, (col,), lambda s: equals(_raw(col), value, True, s[col]))


def flag_contains(name: str, col: str, pattern: str) -> Feature:
    return Feature(name, (col,), lambda s: text_matches(_raw(col), pattern))


def cross(flags: Sequence[str], numbers: Sequence[str], pattern: str = "{}_x_{}") -> list[Feature]:
    """Every flag times every number."""
    return [product(pattern.format(f, n), f, n) for f in flags for n in numbers]


@dataclass(frozen=True)
class Rule:
    """A 0/1 condition on one column; unknown counts as 0."""

    col: str
    build: Builder


def under(col: str, bound: float) -> Rule:
    return Rule(col, lambda s: below(_num(s, col), bound))


def over(col: str, bound: float) -> Rule:
    return Rule(col, lambda s: above(_num(s, col), bound))


def is_set(col: str) -> Rule:
    """The flag column is not 0."""
    return Rule(col, lambda s: flag(_num(s, col) != 0))


def is_zero(col: str) -> Rule:
    return Rule(col, lambda s: flag(_num(s, col) == 0))


def rule_flag(name: str, *rules: Rule) -> Feature:
    """1 where all rules hold."""
    return Feature(
        name,
        tuple(r.col for r in rules),
        lambda s: reduce(mul, [r.build(s) for r in rules]).cast("int"),
    )


def additive_score(name: str, *rules: Rule) -> Feature:
    """The number of rules that hold."""
    return Feature(
        name,
        tuple(r.col for r in rules),
        lambda s: reduce(add, [r.build(s) for r in rules]).cast("int"),
    )


def cut(name: str, col: str, edges: Sequence[float]) -> Feature:
    """Right-closed bins numbered from 0, NULL outside the edges."""
    return Feature(name, (col,), lambda s: right_closed_bin(_num(s, col), edges))


class FeatureSet:
    """An ordered list of features, applied layer by layer."""

    def __init__(self, features: Iterable[Feature | Sequence[Feature]]):
        flat: list[Feature] = []
        for item in features:
            flat.extend([item] if isinstance(item, Feature) else item)
        self.features = flat
        lowered = [f.name.lower() for f in flat]
        repeated = sorted({n for n in lowered if lowered.count(n) > 1})
        if repeated:
            raise ValueError(f"feature names must differ beyond case: {repeated}")

    @property
    def names(self) -> list[str]:
        return [feature.name for feature in self.features]

    def apply(self, df: DataFrame, skip_missing: bool = True) -> DataFrame:
        """Add the features; one whose inputs are absent is skipped or refused."""
        waiting = list(self.features)
        while waiting:
            scope: Scope = {f.name: f.dataType for f in df.schema.fields}
            pending = {f.name for f in waiting}
            ready = [f for f in waiting if self._ready(f, scope, pending)]
            if not ready:
                if skip_missing:
                    break
                absent = {c for f in waiting for c in f.inputs if c not in scope}
                raise ValueError(f"columns not found: {sorted(absent - pending)}")
            df = df.select("*", *[f.build(scope).alias(f.name) for f in ready])
            waiting = [f for f in waiting if f not in ready]
        return df

    @staticmethod
    def _ready(feature: Feature, scope: Scope, pending: set[str]) -> bool:
        if feature.any_input:
            wait = any(c in pending and c not in scope for c in feature.inputs)
            return not wait and any(c in scope for c in feature.inputs)
        return all(c in scope for c in feature.inputs)
