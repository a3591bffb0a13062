"""Cleaning and row-wise features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.catalog.base import (
    INTERNET_EXTRAS,
    B,
    S,
    orders_frame,
    query,
    rounded,
    subscriber_frame,
    table,
)
from tabloom.operators import clean
from tabloom.operators import features as fx

# -- cleaning ---------------------------------------------------------------

_MIXED = (
    "CASE WHEN event_id % 4 = 0 THEN ' ' WHEN event_id % 4 = 1 THEN '12f' "
    "WHEN event_id % 4 = 2 THEN 'nan' ELSE CAST(event_id AS {text}) END"
)


@query(
    "coerce_numeric",
    """SELECT event_id, CASE WHEN event_id % 4 = 3 THEN CAST(event_id AS DOUBLE) END AS reading,
      value FROM events""",
)
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select(
        "event_id", F.expr(_MIXED.format(text="string")).alias("reading"), "value"
    )
    return clean.coerce_numeric(raw, ["reading", "value"])


@query(
    "map_values",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS o_orderstatus
    FROM orders""",
)
def map_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return clean.map_values(orders, "o_orderstatus", {"F": 1, "O": 0})


@query(
    "normalise_target",
    S + "SELECT id, CASE WHEN Churn IN ('Yes', '1', '1.0') THEN 1 ELSE 0 END AS Churn FROM s",
)
def normalise_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.normalise_target(subscriber_frame(spark, sf_dir).select("id", "Churn"), "Churn")


@query("drop_columns", "SELECT c_custkey, c_nationkey FROM customer")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return clean.drop_columns(customer, ["c_name", "c_acctbal", "c_mktsegment", "absent"])


@query(
    "select_by_type",
    """SELECT count(DISTINCT o_orderstatus) AS o_orderstatus,
      count(DISTINCT o_orderpriority) AS o_orderpriority,
      sum(o_custkey)::BIGINT AS o_custkey, round(sum(o_totalprice), 2) AS o_totalprice FROM orders""",
)
def select_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories counted, numbers summed, chosen by column type."""
    orders = table(spark, sf_dir, "orders")
    texts = clean.columns_of(orders, "string")
    numbers = clean.columns_of(orders, "numeric", exclude=["o_orderkey"])
    return rounded(
        orders.agg(
            *[F.countDistinct(c).alias(c) for c in texts], *[F.sum(c).alias(c) for c in numbers]
        ),
        2,
    )


@query(
    "fill_missing",
    B
    + """SELECT id, coalesce(li_qty, -999.0) AS li_qty, coalesce(li_n, -999) AS li_n, priority
    FROM b""",
)
def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_frame(spark, sf_dir, lines=True).select("id", "li_qty", "li_n", "priority")
    return clean.fill_missing(base, ["li_qty", "li_n"])


@query(
    "fill_with_mean",
    B
    + """SELECT id, round(coalesce(li_qty,
      (SELECT avg(li_qty) FROM b WHERE split = 'train')), 4) AS li_qty FROM b""",
)
def fill_with_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_frame(spark, sf_dir, lines=True).select("id", "split", "li_qty")
    train = clean.take_split(base, "train")
    return rounded(clean.fill_with_mean(base, ["li_qty"], train).drop("split"), 4)


@query(
    "split_and_source",
    """SELECT 'train' AS split, 'main' AS source, count(*) AS n_rows FROM orders
      WHERE o_orderkey % 5 <> 0
    UNION ALL SELECT 'train', 'external', count(*) FROM customer""",
)
def split_and_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged tables appended, then cut back to one split."""
    base = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    main = [
        clean.tag(base.filter("id % 5 <> 0"), split="train", source="main"),
        clean.tag(base.filter("id % 5 = 0"), split="test", source="main"),
    ]
    other = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    whole = main[0].unionByName(main[1]).unionByName(clean.tag(other, "train", "external"))
    return (
        clean.take_split(whole, "train")
        .groupBy("split", "source")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query(
    "row_weight",
    """SELECT 'main' AS source, 1.0::DOUBLE AS weight, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'external', 10.0::DOUBLE, count(*) FROM customer""",
)
def row_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    main = clean.tag(table(spark, sf_dir, "orders").select("o_custkey"), source="main")
    other = clean.tag(
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey")),
        source="external",
    )
    weighted = clean.row_weight(main.unionByName(other), {"external": 10.0})
    return weighted.groupBy("source", "weight").agg(F.count(F.lit(1)).alias("n_rows"))


# -- features over the orders frame -----------------------------------------


def _on_orders(
    features: Sequence[fx.Feature | Sequence[fx.Feature]],
    lines: bool = True,
    logs: Sequence[str] = (),
):
    chosen = fx.FeatureSet(features)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = chosen.apply(orders_frame(spark, sf_dir, lines=lines), skip_missing=False)
        return rounded(frame.select("id", *chosen.names), only=logs)

    return run


def _on_subscribers(
    features: Sequence[fx.Feature | Sequence[fx.Feature]], keep: Sequence[str] | None = None
):
    chosen = fx.FeatureSet(features)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = chosen.apply(subscriber_frame(spark, sf_dir))
        wanted = keep or chosen.names
        return frame.select("id", *[c for c in wanted if c in frame.columns])

    return run


query(
    "ratio",
    B
    + """SELECT id, total / (li_n + 1.0) AS per_line,
      balance / nullif(li_qty + 0.01, 0) AS per_unit FROM b""",
)(_on_orders([fx.ratio("per_line", "total", "li_n", 1), fx.ratio("per_unit", "balance", "li_qty", 0.01)]))

query(
    "product",
    B + "SELECT id, total * li_qty AS ab, total * li_qty * y AS abc FROM b",
)(_on_orders([fx.product("ab", "total", "li_qty"), fx.product("abc", "total", "li_qty", "y")]))

query("power", B + "SELECT id, balance * balance AS squared FROM b")(
    _on_orders([fx.power("squared", "balance")], lines=False)
)

query(
    "log1p",
    B
    + """SELECT id, CASE WHEN balance > -1 THEN round(ln(1 + balance), 6) END AS of_balance,
      round(ln(1 + total * li_n), 6) AS of_product FROM b""",
)(_on_orders([fx.log1p("of_balance", "balance"), fx.log1p("of_product", "total", "li_n")],
    logs=["of_balance", "of_product"]))

query(
    "difference",
    B
    + """SELECT id, total - balance AS gap,
      (total - balance) / nullif(balance + 0.01, 0) AS gap_share FROM b""",
)(
    _on_orders(
        [
            fx.difference("gap", "total", "balance"),
            fx.relative_difference("gap_share", "total", "balance", 0.01),
        ],
        lines=False,
    )
)

_YES = " + ".join(f"(CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END)" for c in INTERNET_EXTRAS)
_NO_INTERNET = " + ".join(
    f"(CASE WHEN {c} = 'No internet service' THEN 1 ELSE 0 END)" for c in INTERNET_EXTRAS
)

query("count_equal", S + f"SELECT id, {_YES} AS n_yes, {_NO_INTERNET} AS n_none FROM s")(
    _on_subscribers(
        [
            fx.count_equal("n_yes", [*INTERNET_EXTRAS, "absent"], "Yes"),
            fx.count_equal("n_none", INTERNET_EXTRAS, "No internet service"),
        ]
    )
)

query(
    "count_positive",
    B
    + """SELECT id, (CASE WHEN balance > 0 THEN 1 ELSE 0 END)
      + (CASE WHEN li_n > 0 THEN 1 ELSE 0 END) AS n_positive,
      (CASE WHEN li_n > 0 THEN 1 ELSE 0 END)
      + (CASE WHEN segment = 'BUILDING' THEN 1 ELSE 0 END) AS n_active FROM b""",
)(
    _on_orders(
        [
            fx.count_positive("n_positive", ["balance", "li_n"]),
            fx.count_active("n_active", ["li_n", "segment"], "BUILDING"),
        ]
    )
)

query("per_unit", S + f"SELECT id, MonthlyCharges / (({_YES}) + 1.0) AS cost FROM s")(
    _on_subscribers(
        [fx.count_equal("n_yes", INTERNET_EXTRAS, "Yes"), fx.ratio("cost", "MonthlyCharges", "n_yes", 1)],
        keep=["cost"],
    )
)

query(
    "flag_equal",
    B
    + """SELECT id, CASE WHEN priority = '1-URGENT' THEN 1 ELSE 0 END AS urgent,
      CASE WHEN priority = '5-LOW' THEN 0 ELSE 1 END AS not_low FROM b""",
)(
    _on_orders(
        [
            fx.flag_equal("urgent", "priority", "1-URGENT"),
            fx.flag_not_equal("not_low", "priority", "5-LOW"),
        ],
        lines=False,
    )
)

query(
    "flag_contains",
    S
    + """SELECT id, CASE WHEN PaymentMethod ILIKE '%automatic%' THEN 1 ELSE 0 END AS autopay
    FROM s""",
)(_on_subscribers([fx.flag_contains("autopay", "PaymentMethod", "AUTOMATIC")]))

_FLAGS = [
    fx.flag_equal("mtm", "Contract", "Month-to-month"),
    fx.flag_equal("fiber", "InternetService", "Fiber optic"),
]
_MTM = "(CASE WHEN Contract = 'Month-to-month' THEN 1 ELSE 0 END)"
_FIBER = "(CASE WHEN InternetService = 'Fiber optic' THEN 1 ELSE 0 END)"
_NO_SECURITY = (
    "(CASE WHEN OnlineSecurity = 'Yes' OR TechSupport = 'Yes' THEN 0 ELSE 1 END)"
)

query(
    "flag_numeric_cross",
    S
    + f"""SELECT id, CAST({_MTM} * tenure AS BIGINT) AS mtm_x_tenure,
      {_MTM} * TotalCharges AS mtm_x_TotalCharges,
      CAST({_FIBER} * tenure AS BIGINT) AS fiber_x_tenure,
      {_FIBER} * TotalCharges AS fiber_x_TotalCharges FROM s""",
)(
    _on_subscribers(
        [*_FLAGS, fx.cross(["mtm", "fiber"], ["tenure", "TotalCharges"])],
        keep=["mtm_x_tenure", "mtm_x_TotalCharges", "fiber_x_tenure", "fiber_x_TotalCharges"],
    )
)

query(
    "flag_flag_cross",
    S
    + f"""SELECT id, CAST({_MTM} * {_FIBER} AS BIGINT) AS fiber_mtm,
      CAST(SeniorCitizen * {_MTM} * {_FIBER} AS BIGINT) AS senior_fiber_mtm FROM s""",
)(
    _on_subscribers(
        [
            *_FLAGS,
            fx.product("fiber_mtm", "fiber", "mtm"),
            fx.product("senior_fiber_mtm", "SeniorCitizen", "fiber", "mtm"),
        ],
        keep=["fiber_mtm", "senior_fiber_mtm"],
    )
)

query(
    "rule_flag",
    S
    + f"""SELECT id, {_FIBER} * {_NO_SECURITY} AS fiber_unsecured,
      {_MTM} * (CASE WHEN TotalCharges > 3000 THEN 1 ELSE 0 END) AS mtm_high,
      {_MTM} * (CASE WHEN tenure < 12 THEN 1 ELSE 0 END) AS new_mtm FROM s""",
)(
    _on_subscribers(
        [
            *_FLAGS,
            fx.count_equal("n_secure", ["OnlineSecurity", "TechSupport"], "Yes"),
            fx.rule_flag("fiber_unsecured", fx.is_set("fiber"), fx.is_zero("n_secure")),
            fx.rule_flag("mtm_high", fx.is_set("mtm"), fx.over("TotalCharges", 3000)),
            fx.rule_flag("new_mtm", fx.under("tenure", 12), fx.is_set("mtm")),
        ],
        keep=["fiber_unsecured", "mtm_high", "new_mtm"],
    )
)

query(
    "additive_score",
    S
    + f"""SELECT id, (CASE WHEN tenure < 12 THEN 1 ELSE 0 END) + {_MTM} + {_FIBER}
      + (CASE WHEN PaymentMethod = 'Electronic check' THEN 1 ELSE 0 END) + {_NO_SECURITY} AS risk
    FROM s""",
)(
    _on_subscribers(
        [
            *_FLAGS,
            fx.flag_equal("echeck", "PaymentMethod", "Electronic check"),
            fx.count_equal("n_secure", ["OnlineSecurity", "TechSupport"], "Yes"),
            fx.additive_score(
                "risk",
                fx.under("tenure", 12),
                fx.is_set("mtm"),
                fx.is_set("fiber"),
                fx.is_set("echeck"),
                fx.is_zero("n_secure"),
            ),
        ],
        keep=["risk"],
    )
)


def _cut_sql(col: str, edges: Sequence[float], name: str) -> str:
    arms = " ".join(
        f"WHEN {col} > {low} AND {col} <= {high} THEN {i}.0::DOUBLE"
        for i, (low, high) in enumerate(zip(edges, edges[1:]))
    )
    return f"CASE {arms} END AS {name}"


_TENURE_EDGES = [-1, 3, 6, 12, 24, 48, 72, 999]
_ZERO_EDGES = [0, 12, 24, 48, 72, 999]
_TOTAL_EDGES = [-1, 500, 1000, 2000, 4000, 6000, 999999]

query(
    "cut",
    S
    + "SELECT id, "
    + ", ".join(
        [
            _cut_sql("tenure", _TENURE_EDGES, "tenure_bin"),
            _cut_sql("tenure", _ZERO_EDGES, "tenure_bin0"),
            _cut_sql("TotalCharges", _TOTAL_EDGES, "total_bin"),
        ]
    )
    + " FROM s",
)(
    _on_subscribers(
        [
            fx.cut("tenure_bin", "tenure", _TENURE_EDGES),
            fx.cut("tenure_bin0", "tenure", _ZERO_EDGES),
            fx.cut("total_bin", "TotalCharges", _TOTAL_EDGES),
        ]
    )
)

query("only_if_present", B + "SELECT id, total / (balance + 20000) AS kept FROM b")(
    lambda spark, sf_dir: fx.FeatureSet(
        [
            fx.ratio("kept", "total", "balance", 20000),
            fx.product("skipped", "total", "absent"),
            fx.log1p("skipped_too", "skipped"),
        ]
    )
    .apply(orders_frame(spark, sf_dir).select("id", "total", "balance"))
    .drop("total", "balance")
)
