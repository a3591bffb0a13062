"""Look values up in a table of unique keys, for any number of rows.

Fitted statistics and dictionaries are tables with one row per key. How such a
table meets the rows is decided by its measured size: ``settle`` writes it out
once, counts its rows and bytes, and

* a handful of keys becomes a constant map inside the projection,
* a table proven to fit becomes a local relation that is broadcast,
* all larger ones together are joined narrowly: the rows are stored once with
  a number, their keys become one thin table (number, search, key) that meets
  one thin table of all key tables, and what is found goes back to the rows in
  one join by number. So rows of any width are shuffled once, however many
  tables are long. Keys that are frequent among the rows, whether or not they
  were when the table was fitted, are found by a sketch of frequent items; at
  most HOT_KEYS of them can hold 1/HOT_KEYS of all keys, so their part of the
  tables is broadcast and their rows are not shuffled by key.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.session import materialise

# Bounds of what may be broadcast.
MAX_ROWS = 100_000
MAX_BYTES = 32 * 1024 * 1024
# Parts of one table may together have so many times that.
PARTS_TOGETHER = 4
# Up to this many keys a scan of a constant map is as fast as a hash lookup.
CONSTANT_KEYS = 32
# Keys with at least this share (1/HOT_KEYS) of all keys are treated apart.
HOT_KEYS = 1024
# Items of the sketch that finds them: it misses none that has 1/4000.
TRACKED = 10_000


@dataclass(frozen=True)
class Lookup:
    """A table with unique ``keys``; ``weight`` counts the fitted rows per key.

    ``local`` holds the rows of a table that was proven small. Where a table
    has several parts, of which ``small_parts`` are small, it holds theirs.
    """

    table: DataFrame
    keys: tuple[str, ...]
    weight: str
    local: pa.Table | None = None
    small_parts: frozenset[Any] | None = None

    @property
    def small(self) -> bool:
        return self.local is not None and self.small_parts is None

    @property
    def constant(self) -> bool:
        """Whether the table can be a constant map keyed by text."""
        if self.local is None or self.local.num_rows > CONSTANT_KEYS:
            return False
        plain = (T.StringType, T.IntegerType, T.LongType)
        return all(isinstance(self.table.schema[k].dataType, plain) for k in self.keys)

    def pick(self, column: str, value: Any, *keys: str) -> Lookup:
        """The rows where ``column`` has a value, under other keys."""
        local = self.local
        if self.small_parts is not None and value not in self.small_parts:
            local = None
        if local is not None:
            local = local.filter(pc.equal(local[column], value))
        table = self.table.filter(F.col(column) == F.lit(value))
        return Lookup(table, keys, self.weight, local)


@dataclass(frozen=True)
class Search:
    """Look the ``on`` columns up and get the ``values`` columns of the table."""

    lookup: Lookup
    on: tuple[Column, ...]
    values: tuple[str, ...]


def settle(
    table: DataFrame,
    keys: Sequence[str],
    weight: str = "n_rows",
    max_rows: int | None = None,
    max_bytes: int | None = None,
    part: str | None = None,
) -> Lookup:
    """Compute a key table once and decide by its size how it will be joined.

    The table is written out and measured before any row of it is collected.
    With ``part``, a column of few values (one per encoded column or key set),
    every part is decided on by itself, so a long one leaves the short ones
    small.
    """
    max_rows = MAX_ROWS if max_rows is None else max_rows
    max_bytes = MAX_BYTES if max_bytes is None else max_bytes
    stored = materialise(table)
    by = [part] if part else []
    sizes = (
        stored.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(_row_bytes(stored.schema)), F.lit(0)).alias("bytes"),
        )
        .collect()
    )
    # Smallest first, as long as all of them together stay within a few bounds.
    small, rows, size = [], 0, 0
    for found in sorted(sizes, key=lambda r: r["bytes"]):
        rows, size = rows + found["rows"], size + found["bytes"]
        if found["rows"] > max_rows or found["bytes"] > max_bytes:
            continue
        if rows > PARTS_TOGETHER * max_rows or size > PARTS_TOGETHER * max_bytes:
            break
        small.append(found[part] if part else None)
    if len(small) == len(sizes):
        head: pa.Table = stored.toArrow()
        local = table.sparkSession.createDataFrame(head, schema=table.schema)
        return Lookup(local, tuple(keys), weight, head)
    if not small:
        return Lookup(stored, tuple(keys), weight)
    head = stored.filter(F.col(part).isin(small)).toArrow()
    return Lookup(stored, tuple(keys), weight, head, frozenset(small))


def _row_bytes(schema: T.StructType) -> Column:
    """About how many bytes a row takes once collected."""
    sizes = []
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            sizes.append(F.coalesce(F.octet_length(column), F.lit(0)) + 8)
        elif isinstance(field.dataType, (T.MapType, T.ArrayType)):
            sizes.append(F.greatest(F.size(column), F.lit(0)) * 64 + 8)
        else:
            sizes.append(F.lit(16))
    return reduce(add, sizes).cast("long")


def look_up(
    df: DataFrame, searches: Sequence[Search]
) -> tuple[DataFrame, list[dict[str, Column]], list[str]]:
    """Run several searches on the same rows.

    Returns the rows with helper columns, for each search its values as
    columns (NULL where the key is not found), and the helpers to drop.
    """
    columns = set(df.columns)
    long = {i: s for i, s in enumerate(searches) if not (s.lookup.constant or s.lookup.small)}
    if long:
        df = _join_narrow(df, long)
    found: list[dict[str, Column]] = []
    for i, search in enumerate(searches):
        if i in long:
            found.append({v: F.col(f"__n{i}_val{j}") for j, v in enumerate(search.values)})
        elif search.lookup.constant:
            found.append(_from_constant(search))
        else:
            side = _set_apart(search.lookup.table, search.lookup.keys, search.values, f"b{i}")
            df = df.join(F.broadcast(side), _meets(search.on, f"b{i}"), "left")
            found.append({v: F.col(f"__b{i}_val{j}") for j, v in enumerate(search.values)})
    return df, found, [c for c in df.columns if c not in columns]


def attach(
    df: DataFrame, lookup: Lookup, on: Sequence[Column], values: dict[str, str]
) -> DataFrame:
    """Add values of a table (table column -> new name) where ``on`` meets the keys."""
    joined, (found,), helpers = look_up(df, [Search(lookup, tuple(on), tuple(values))])
    return joined.withColumns({new: found[old] for old, new in values.items()}).drop(*helpers)


def _from_constant(search: Search) -> dict[str, Column]:
    """Values from a map literal; two keys make a map of maps."""
    entries: dict[str, Any] = {}
    for row in search.lookup.local.to_pylist():
        *outer, last = [row[k] for k in search.lookup.keys]
        level = entries
        for key in outer:
            level = level.setdefault(str(key), {})
        level[str(last)] = {f"v{j}": _plain(row[v]) for j, v in enumerate(search.values)}
    schema = search.lookup.table.schema
    fields = ",".join(
        f"v{j}:{schema[v].dataType.simpleString()}" for j, v in enumerate(search.values)
    )
    kind = f"struct<{fields}>"
    for _ in search.lookup.keys:
        kind = f"map<string,{kind}>"
    entry = F.from_json(F.lit(json.dumps(entries)), kind)
    for column in search.on:
        entry = F.try_element_at(entry, column.cast("string"))
    return {v: entry[f"v{j}"] for j, v in enumerate(search.values)}


def _plain(value: Any) -> Any:
    """Maps arrive from Arrow as lists of pairs."""
    return dict(value) if isinstance(value, list) else value


def _set_apart(
    table: DataFrame, keys: Sequence[str], values: Sequence[str], side: str
) -> DataFrame:
    """The key table under names that cannot meet those of the rows."""
    return table.select(
        *[F.col(f"`{k}`").alias(f"__{side}_key{i}") for i, k in enumerate(keys)],
        *[F.col(f"`{v}`").alias(f"__{side}_val{i}") for i, v in enumerate(values)],
    )


def _meets(on: Sequence[Column], side: str) -> Column:
    pairs = [column == F.col(f"__{side}_key{i}") for i, column in enumerate(on)]
    return reduce(and_, pairs)


def _common_type(one: T.DataType, two: T.DataType) -> T.DataType:
    """A type in which equal values of both have equal text."""
    if one == two:
        return one
    if all(isinstance(t, T.IntegralType) for t in (one, two)):
        return T.LongType()
    if all(isinstance(t, T.NumericType) for t in (one, two)):
        return T.DoubleType()
    return T.StringType()


def _key_text(columns: Sequence[Column], types: Sequence[T.DataType]) -> Column:
    """The columns as one text, different for different values; NULL if any is."""
    parts = []
    for column, kind in zip(columns, types):
        # Adding 0 makes -0.0 the 0.0 that it equals.
        value = column.cast(kind) + F.lit(0.0) if isinstance(kind, T.FractionalType) else column.cast(kind)
        parts.append(value.cast("string"))
    if len(parts) == 1:
        return parts[0]
    return F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)])


def frequent_keys(asked: DataFrame) -> list[int]:
    """Hashes ``h`` that at least 1/HOT_KEYS of the rows have, so at most HOT_KEYS.

    By a sketch of frequent items, which is merged from those of the tasks.
    """
    sketch = F.expr(f"approx_top_k(h, {HOT_KEYS}, {max(TRACKED, HOT_KEYS)})")
    total, top = asked.agg(F.count(F.lit(1)), sketch).first()
    return [item for item, count in top or () if count * HOT_KEYS >= total]


def _join_narrow(df: DataFrame, searches: dict[int, Search]) -> DataFrame:
    """The rows with the values of long key tables, as columns __n{search}_val{position}."""
    rows = materialise(df.withColumn("__row", F.monotonically_increasing_id()))
    entries, tables = [], []
    for i, search in searches.items():
        table, keys = search.lookup.table, search.lookup.keys
        own = [f.dataType for f in rows.select(*search.on).schema.fields]
        types = [_common_type(a, table.schema[k].dataType) for a, k in zip(own, keys)]
        entries.append(F.struct(F.lit(i).alias("s"), _key_text(search.on, types).alias("k")))
        tables.append(
            table.select(
                F.lit(i).alias("s"),
                _key_text([F.col(f"`{k}`") for k in keys], types).alias("k"),
                *[F.col(f"`{v}`").alias(f"__n{i}_val{j}") for j, v in enumerate(search.values)],
            )
        )
    hashed = F.xxhash64("s", "k").alias("h")
    asked = rows.select("__row", F.explode(F.array(*entries)).alias("e")).select("__row", "e.s", "e.k")
    asked = asked.filter("k IS NOT NULL").select("*", hashed)
    known = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables).select("*", hashed)
    values = known.columns[2:-1]

    hot = frequent_keys(asked)
    is_hot = F.col("h").isin(hot) if hot else F.lit(False)
    served = asked.filter(is_hot).join(F.broadcast(known.filter(is_hot).drop("h")), ["s", "k"])
    met = asked.filter(~is_hot).join(known.filter(~is_hot).drop("h"), ["s", "k"])
    met = met.select("__row", *values).union(served.select("__row", *values))
    # A row has at most one value of each search.
    found = met.groupBy("__row").agg(*[F.first(v, ignorenulls=True).alias(v) for v in values])
    return rows.join(found, "__row", "left")
