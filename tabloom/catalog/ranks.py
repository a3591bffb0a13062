"""Percent ranks and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.catalog.base import B, orders_frame, query, table
from tabloom.operators.folds import assign_folds
from tabloom.operators.ranks import RankSpec, pct_rank, pct_ranks


def _pct_sql(value: str, by: str | None, name: str) -> str:
    part = f"PARTITION BY {by} " if by else ""
    same = f"PARTITION BY {by + ', ' if by else ''}{value}"
    present = f"{value} IS NOT NULL" + (f" AND {by} IS NOT NULL" if by else "")
    # rank() counts the rows before in the order used; missing values come last.
    return (
        f"CASE WHEN {present} THEN (rank() OVER ({part}ORDER BY {value} NULLS LAST) "
        f"+ (count(*) OVER ({same}) - 1) / 2.0::DOUBLE) "
        f"/ count({value}) OVER ({part.strip()}) END AS {name}"
    )


@query(
    "group_pct_rank",
    B
    + "SELECT id, "
    + ", ".join(
        [
            _pct_sql("total", "segment", "segment_total_rank"),
            _pct_sql("li_qty", "priority", "priority_li_qty_rank"),
            _pct_sql("li_n", "priority", "priority_li_n_rank"),
        ]
    )
    + " FROM b",
)
def group_pct_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks within groups over all rows, missing groups and values left out."""
    base = orders_frame(spark, sf_dir, lines=True)
    specs = [
        RankSpec("total", "segment"),
        RankSpec("li_qty", "priority"),
        RankSpec("li_n", "priority"),
    ]
    ranked = pct_ranks(base, specs)
    return ranked.select("id", *[s.name for s in specs])


@query(
    "global_pct_rank",
    B
    + "SELECT id, "
    + ", ".join(
        [
            _pct_sql("total", None, "total_pctrank"),
            _pct_sql("balance", None, "balance_pctrank"),
            _pct_sql("li_qty", None, "li_qty_pctrank"),
        ]
    )
    + " FROM b",
)
def global_pct_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_frame(spark, sf_dir, lines=True)
    specs = [RankSpec("total"), RankSpec("balance"), RankSpec("li_qty")]
    return pct_ranks(base, specs).select("id", *[s.name for s in specs])


@query(
    "line_price_rank",
    """SELECT l_returnflag, count(*) AS n_rows,
      CAST(sum(CAST(round(r * 2 * n) AS BIGINT)) AS BIGINT) AS half_ranks,
      min(r) AS least, max(r) AS greatest
    FROM (SELECT l_returnflag, count(*) OVER () AS n, (rank() OVER (ORDER BY l_extendedprice)
        + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0::DOUBLE)
        / count(*) OVER () AS r FROM lineitem) GROUP BY l_returnflag""",
)
def line_price_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rank over the largest table, ranked range by range.

    Average ranks are halves, so their sum is compared as a whole number.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"
    )
    halves = F.round(F.col("r") * F.lit(2.0 * lines.count())).cast("bigint")
    ranked = pct_rank(lines, "l_extendedprice", out="r")
    return ranked.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(halves).alias("half_ranks"),
        F.min("r").alias("least"),
        F.max("r").alias("greatest"),
    )


@query(
    "assign_folds_exact",
    B
    + """, n AS (SELECT y, count(*) AS n FROM b GROUP BY y)
    SELECT y, CAST(f AS INTEGER) AS fold, n // 5 + (CASE WHEN f < n % 5 THEN 1 ELSE 0 END) AS n_rows
    FROM n CROSS JOIN range(5) r(f)""",
)
def assign_folds_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stratified folds whose sizes differ by at most one row per label."""
    base = orders_frame(spark, sf_dir).select("id", "y")
    folds = assign_folds(base, "id", "y", k=5, seed=42, mode="exact")
    return folds.groupBy("y", "fold").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "assign_folds_hash",
    "SELECT count(*) AS n_rows, 10::BIGINT AS n_folds, TRUE AS even, TRUE AS differ FROM orders",
)
def assign_folds_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash folds: all used, of even size, other ones for another seed."""
    base = orders_frame(spark, sf_dir).select("id", "y")
    folds = assign_folds(assign_folds(base, k=10, seed=42), k=10, seed=1042, out="other")
    sizes = folds.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("fold") != F.col("other")).alias("moved")
    )
    return sizes.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_folds"),
        (F.max("n") < F.min("n") * 2).alias("even"),
        (F.sum("moved") > F.sum("n") / 2).alias("differ"),
    )
