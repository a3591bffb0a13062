"""Readers, writers, alignment and appending."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.catalog.base import B, orders_frame, query, table
from tabloom.operators.align import align_to, surrogate_key, union_all
from tabloom.operators.blend import pivot_scores
from tabloom.operators.clean import tag
from tabloom.session import shared_folder
from tabloom.sources import read_table, write_run_record, write_scores, write_variants
from tabloom.sources.writers import run_record

CUSTOMER_CSV = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


def fresh_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), "tabloom", f"{name}-{uuid.uuid4().hex}")


@query(
    "read_table",
    """SELECT l_returnflag, l_linestatus, count(*) AS n_rows,
      round(sum(l_quantity), 2) AS quantity
    FROM lineitem GROUP BY ALL""",
)
def read_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read_table(spark, f"{sf_dir}/lineitem.parquet")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("quantity")
        )
    )


@query(
    "read_csv_with_schema",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def read_csv_with_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "customer-csv")
    table(spark, sf_dir, "customer").write.csv(path, header=True)
    return read_table(spark, path, CUSTOMER_CSV, fmt="csv")


@query(
    "optional_source",
    "SELECT o_orderstatus, count(*) AS n_rows FROM orders GROUP BY ALL",
)
def optional_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An absent and a switched-off table add nothing."""
    orders = table(spark, sf_dir, "orders")
    absent = read_table(spark, f"{sf_dir}/external.parquet", optional=True)
    off = read_table(spark, f"{sf_dir}/orders.parquet", optional=True, enabled=False)
    return (
        union_all(orders, absent, off)
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query(
    "write_scores",
    B
    + """SELECT id, CASE WHEN total > 100000 THEN s1 END AS churn
    FROM b WHERE split = 'test'""",
)
def write_scores_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores on the template's keys, written as CSV and read back."""
    base = orders_frame(spark, sf_dir)
    template = base.filter("split = 'test'").select("id")
    scores = base.filter("total > 100000").select("id", F.col("s1").alias("score"))
    path = fresh_path(spark, "scores")
    write_scores(scores, template, path, target="churn")
    return read_table(spark, path, "id BIGINT, churn DOUBLE", fmt="csv")


@query(
    "write_variants",
    B
    + """SELECT v.variant, count(*) AS n_rows, round(avg(v.score), 6) AS mean_score
    FROM (SELECT 'first' AS variant, s1 AS score FROM b UNION ALL
          SELECT 'second', s2 FROM b UNION ALL SELECT 'third', s3 FROM b) v GROUP BY ALL""",
)
def write_variants_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_frame(spark, sf_dir)
    scores = base.select(
        "id",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(v).alias("variant"), F.col(c).alias("score"))
                    for v, c in (("first", "s1"), ("second", "s2"), ("third", "s3"))
                ]
            )
        ),
    )
    path = fresh_path(spark, "variants")
    write_variants(scores, path)
    schema = "id BIGINT, score DOUBLE, variant STRING"
    return (
        read_table(spark, path, schema, fmt="csv")
        .groupBy("variant")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("score"), 6).alias("mean_score"))
    )


@query(
    "write_run_record",
    B
    + """SELECT 'orders' AS version, 12 AS features,
      round(avg(y), 6) AS positive_rate, CAST(count(*) AS DOUBLE) AS n_rows FROM b""",
)
def write_run_record_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_frame(spark, sf_dir)
    row = base.agg(F.avg("y").alias("rate"), F.count(F.lit(1)).alias("n")).first()
    record = run_record(
        spark, "orders", {"positive_rate": row["rate"], "n_rows": row["n"]},
        {"s1": 1.0}, features=len(base.columns),
    )
    path = fresh_path(spark, "runs")
    write_run_record(record, path)
    back = read_table(spark, path, record.schema, fmt="json")
    return back.select(
        "version",
        "features",
        F.col("metrics.positive_rate").alias("positive_rate"),
        F.col("metrics.n_rows").alias("n_rows"),
    )


@query(
    "align_and_union",
    """SELECT 'train' AS source, o_orderkey AS id, o_totalprice AS total,
      o_orderpriority AS priority FROM orders
    UNION ALL SELECT 'external', NULL, c_acctbal, NULL FROM customer""",
)
def align_and_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second table projected onto the first one's columns and appended."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderpriority").alias("priority"),
    )
    other = table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").cast("string").alias("total"), F.col("c_name").alias("extra")
    )
    aligned = align_to(other, orders.schema, min_common=1)
    return union_all(tag(orders, source="train"), tag(aligned, source="external"))


@query(
    "align_too_few_columns",
    "SELECT count(*) AS n_rows, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n_ids FROM orders",
)
def align_too_few_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fewer shared columns than asked for: the second table is left out."""
    orders = table(spark, sf_dir, "orders")
    other = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    both = union_all(orders, align_to(other, orders.schema, min_common=6))
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("o_orderkey").alias("n_ids")
    )


@query(
    "union_all",
    """SELECT kind, count(*) AS n_rows FROM (
      SELECT 'order' AS kind FROM orders UNION ALL SELECT 'order' FROM orders
      UNION ALL SELECT 'event' FROM events) GROUP BY ALL""",
)
def union_all_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.lit("order").alias("kind"))
    events = table(spark, sf_dir, "events").select(F.lit("event").alias("kind"))
    return (
        union_all(orders, orders, events).groupBy("kind").agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query(
    "surrogate_key",
    """SELECT count(*) AS n_rows, count(*) AS n_ids, TRUE AS apart FROM customer""",
)
def surrogate_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys for another source's rows: distinct, and apart from the main keys."""
    keyed = surrogate_key(table(spark, sf_dir, "customer"), "c_name", "external")
    return keyed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        (F.max("id") < 0).alias("apart"),
    )


@query(
    "pivot_scores",
    B + "SELECT id, y, s1, s2, s3 FROM b",
)
def pivot_scores_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabloom.catalog.scores import score_table

    scores = score_table(spark, sf_dir)
    wide = pivot_scores(scores, ["s1", "s2", "s3"], keep=["label"])
    return wide.withColumnRenamed("label", "y")
