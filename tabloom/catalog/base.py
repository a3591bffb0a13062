"""Registry, and the frames the queries run on.

``orders_frame`` joins orders, customer and nation into one row per order with
a target, categories, numbers, a split, a fold and three stand-in scores.
``subscriber_frame`` gives the same rows the columns of a subscription table,
which the feature-set plans are written for. Both use the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.sources import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where SQL can express it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def round_double(value: Column, digits: int) -> Column:
    """``F.round`` of a DOUBLE, bit for bit, mostly without its decimal arithmetic.

    That takes a decimal number per value. Scaled values below 2^40 are exact to
    1/4096, so those further than 1/1000 from a half have one nearest whole
    number; the others, NULL, NaN and infinities take ``F.round``.
    """
    scale = F.lit(10.0**digits)
    scaled = value * scale
    whole = F.rint(scaled)
    sure = (F.abs(scaled) < 2.0**40) & (F.abs(scaled - whole) < 0.499)
    # Adding 0 makes -0.0 the 0.0 that F.round gives.
    return F.when(sure, (whole + F.lit(0.0)) / scale).otherwise(F.round(value, digits))


def rounded(df: DataFrame, digits: int = 6, only: Sequence[str] | None = None) -> DataFrame:
    """DOUBLE columns rounded, for comparison with another engine.

    Only results whose last bits depend on the order of a sum, or on the
    engine's logarithm, need it; the others are equal bit for bit.
    """
    return df.select(
        *[
            round_double(F.col(f"`{c}`"), digits).alias(c)
            if t == "double" and (only is None or c in only)
            else F.col(f"`{c}`")
            for c, t in df.dtypes
        ]
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(F.sum("l_quantity").alias("li_qty"), F.count(F.lit(1)).alias("li_n"))
    )


def orders_frame(spark: SparkSession, sf_dir: str, lines: bool = False) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("o_orderkey")
    scaled_balance = (F.col("c_acctbal") + F.lit(1000.0)) / F.lit(11000.0)
    frame = joined.select(
        key.alias("id"),
        F.when(key % 5 == 0, F.lit("test")).otherwise(F.lit("train")).alias("split"),
        (F.expr("o_orderkey div 5") % 5).cast("int").alias("fold"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("nation"),
        F.col("o_totalprice").alias("total"),
        F.col("c_acctbal").alias("balance"),
        (F.col("o_totalprice") / F.lit(500000.0)).alias("s1"),
        F.least(F.greatest(scaled_balance, F.lit(0.0)), F.lit(1.0)).alias("s2"),
        ((key * 7919 % 1000) / F.lit(1000.0)).alias("s3"),
    )
    return frame.join(order_lines(spark, sf_dir), "id", "left") if lines else frame


# The same frame as a common table expression named b.
B = """
WITH li AS (
  SELECT l_orderkey, sum(l_quantity) AS li_qty, count(*) AS li_n
  FROM lineitem GROUP BY l_orderkey
), b AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split,
    CAST((o_orderkey // 5) % 5 AS INTEGER) AS fold,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
    nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority,
    c_mktsegment AS segment, n_name AS nation,
    o_totalprice AS total, c_acctbal AS balance,
    o_totalprice / 500000.0::DOUBLE AS s1,
    least(greatest((c_acctbal + 1000.0::DOUBLE) / 11000.0::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) AS s2,
    (o_orderkey * 7919 % 1000) / 1000.0::DOUBLE AS s3,
    li_qty, li_n
  FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN li ON l_orderkey = o_orderkey
)
"""

INTERNET_EXTRAS = [
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
]


def _yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit("Yes")).otherwise(F.lit("No"))


def subscriber_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        order_lines(spark, sf_dir).withColumnRenamed("id", "o_orderkey"), "o_orderkey", "left"
    )
    cust, nation = F.col("o_custkey"), F.col("c_nationkey")
    priority, segment = F.col("o_orderpriority"), F.col("c_mktsegment")
    internet = (
        F.when(priority.isin("1-URGENT", "2-HIGH"), "Fiber optic")
        .when(priority.isin("3-MEDIUM", "5-LOW"), "DSL")
        .otherwise("No")
    )
    extras = [
        F.when(priority == "4-NOT SPECIFIED", "No internet service")
        .otherwise(_yes_no((cust + k) % (k + 2) == 0))
        .alias(name)
        for k, name in enumerate(INTERNET_EXTRAS)
    ]
    status = F.col("o_orderstatus")
    key = F.col("o_orderkey")
    return rows.select(
        key.alias("id"),
        F.when(key % 5 == 0, F.lit("test")).otherwise(F.lit("train")).alias("split"),
        (F.expr("o_orderkey div 5") % 5).cast("int").alias("fold"),
        F.when(cust % 2 == 0, "Male").otherwise("Female").alias("gender"),
        (nation % 6 == 0).cast("int").alias("SeniorCitizen"),
        _yes_no(cust % 3 == 0).alias("Partner"),
        _yes_no(cust % 4 == 0).alias("Dependents"),
        (key % 73).cast("int").alias("tenure"),
        _yes_no(F.col("li_n").isNotNull()).alias("PhoneService"),
        F.when(F.col("li_n").isNull(), "No phone service")
        .otherwise(_yes_no(F.col("li_n") > 4))
        .alias("MultipleLines"),
        internet.alias("InternetService"),
        *extras,
        F.when(segment.isin("BUILDING", "MACHINERY"), "Month-to-month")
        .when(segment.isin("AUTOMOBILE", "FURNITURE"), "One year")
        .otherwise("Two year")
        .alias("Contract"),
        _yes_no(cust % 5 < 3).alias("PaperlessBilling"),
        F.when(nation % 5 == 0, "Electronic check")
        .when(nation % 5 == 1, "Mailed check")
        .when(nation % 5 == 2, "Bank transfer (automatic)")
        .when(nation % 5 == 3, "Credit card (automatic)")
        .alias("PaymentMethod"),
        (F.col("o_totalprice") / F.lit(5000.0)).alias("MonthlyCharges"),
        (F.col("li_qty") * F.lit(37.5)).alias("TotalCharges"),
        F.when(status == "F", "Yes").when(status == "O", "No").otherwise("0").alias("Churn"),
    )


_EXTRAS_SQL = ",\n    ".join(
    f"CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'No internet service' "
    f"WHEN (o_custkey + {k}) % {k + 2} = 0 THEN 'Yes' ELSE 'No' END AS {name}"
    for k, name in enumerate(INTERNET_EXTRAS)
)

# The subscription frame as a common table expression named s.
S = f"""
WITH li AS (
  SELECT l_orderkey, sum(l_quantity) AS li_qty, count(*) AS li_n
  FROM lineitem GROUP BY l_orderkey
), s AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split,
    CAST((o_orderkey // 5) % 5 AS INTEGER) AS fold,
    CASE WHEN o_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    CAST(c_nationkey % 6 = 0 AS INTEGER) AS SeniorCitizen,
    CASE WHEN o_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
    CASE WHEN o_custkey % 4 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
    CAST(o_orderkey % 73 AS INTEGER) AS tenure,
    CASE WHEN li_n IS NOT NULL THEN 'Yes' ELSE 'No' END AS PhoneService,
    CASE WHEN li_n IS NULL THEN 'No phone service' WHEN li_n > 4 THEN 'Yes' ELSE 'No' END
      AS MultipleLines,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Fiber optic'
      WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN 'DSL' ELSE 'No' END AS InternetService,
    {_EXTRAS_SQL},
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Month-to-month'
      WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN 'One year'
      ELSE 'Two year' END AS Contract,
    CASE WHEN o_custkey % 5 < 3 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
    CASE c_nationkey % 5 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
      WHEN 2 THEN 'Bank transfer (automatic)' WHEN 3 THEN 'Credit card (automatic)' END
      AS PaymentMethod,
    o_totalprice / 5000.0::DOUBLE AS MonthlyCharges,
    li_qty * 37.5::DOUBLE AS TotalCharges,
    CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No' ELSE '0' END AS Churn
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN li ON l_orderkey = o_orderkey
)
"""
