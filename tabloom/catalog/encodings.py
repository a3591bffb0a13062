"""Category encodings, scaling and clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.catalog.base import B, orders_frame, query, rounded, table
from tabloom.operators.encode import (
    CategoryEncoders,
    FrequencyEncoder,
    LabelEncoder,
    TargetEncoder,
    WoeEncoder,
)
from tabloom.operators.groupstats import GroupStats, StatBlock
from tabloom.operators.scale import ClusterFeatures, Standardise
from tabloom.session import materialise

CATS = ["priority", "segment", "nation"]


def _train(df: DataFrame) -> DataFrame:
    return df.filter("split = 'train'")


def _freq_sql(col: str) -> str:
    return (
        f"f_{col} AS (SELECT {col}, count(*) / sum(count(*)) OVER ()::DOUBLE AS share FROM b "
        f"WHERE split = 'train' AND {col} IS NOT NULL GROUP BY {col})"
    )


@query(
    "frequency_encode",
    B
    + ", "
    + ", ".join(_freq_sql(c) for c in CATS)
    + " SELECT id, "
    + ", ".join(f"coalesce(f_{c}.share, 0) AS {c}_freq" for c in CATS)
    + " FROM b "
    + " ".join(f"LEFT JOIN f_{c} ON b.{c} = f_{c}.{c}" for c in CATS),
)
def frequency_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_frame(spark, sf_dir)
    model = FrequencyEncoder(CATS).fit(_train(base))
    return model.transform(base).select("id", *[f"{c}_freq" for c in CATS])


def _code_sql(col: str) -> str:
    return (
        f"c_{col} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
        f"FROM (SELECT DISTINCT coalesce({col}, 'nan') AS v FROM b))"
    )


@query(
    "label_encode",
    B
    + ", "
    + ", ".join(_code_sql(c) for c in CATS)
    + " SELECT id, "
    + ", ".join(f"c_{c}.code AS {c}" for c in CATS)
    + " FROM b "
    + " ".join(f"JOIN c_{c} ON coalesce(b.{c}, 'nan') = c_{c}.v" for c in CATS),
)
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_frame(spark, sf_dir)
    return LabelEncoder(CATS).fit(base).transform(base).select("id", *CATS)


@query(
    "label_encode_many_values",
    """WITH c AS (SELECT url, CAST(row_number() OVER (ORDER BY url) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT url FROM pages))
    SELECT page_id, code AS url FROM pages JOIN c USING (url)""",
)
def label_encode_many_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary about as long as the table, coded range by range."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return LabelEncoder(["url"]).fit(pages, max_rows=10).transform(pages)


def _te_sql(col: str) -> str:
    return f"""te_{col} AS (
      SELECT coalesce({col}, 'nan') AS v, fold, sum(y) AS s, count(*) AS n
      FROM b WHERE split = 'train' GROUP BY ALL),
    all_{col} AS (SELECT v, sum(s) AS s, sum(n) AS n FROM te_{col} GROUP BY v)"""


_G = "(SELECT avg(y) FROM b WHERE split = 'train')"


def _te_value(col: str) -> str:
    held = f"a_{col}.s - coalesce(o_{col}.s, 0)"
    left = f"a_{col}.n - coalesce(o_{col}.n, 0)"
    return f"""round(CASE WHEN split = 'train'
      THEN coalesce(({held} + {_G} * 10) / ({left} + 10), {_G})
      ELSE coalesce((a_{col}.s + {_G} * 10) / (a_{col}.n + 10), {_G}) END, 9) AS {col}_te"""


@query(
    "target_encode_oof",
    B
    + ", "
    + ", ".join(_te_sql(c) for c in CATS)
    + " SELECT id, "
    + ", ".join(_te_value(c) for c in CATS)
    + " FROM b "
    + " ".join(
        f"LEFT JOIN all_{c} a_{c} ON coalesce(b.{c}, 'nan') = a_{c}.v "
        f"LEFT JOIN te_{c} o_{c} ON coalesce(b.{c}, 'nan') = o_{c}.v AND b.fold = o_{c}.fold"
        for c in CATS
    ),
)
def target_encode_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_frame(spark, sf_dir)
    model = TargetEncoder(CATS, "y", "fold", smoothing=10).fit(_train(base))
    return rounded(model.transform(base).select("id", *[f"{c}_te" for c in CATS]), 9)


@query(
    "target_encode_full",
    B
    + ", "
    + _te_sql("nation")
    + f""" SELECT id, round((s + {_G} * 5) / (n + 5), 9) AS nation_te
    FROM b JOIN all_nation ON nation = v WHERE split = 'test'""",
)
def target_encode_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows only, with less smoothing: all training rows count."""
    base = orders_frame(spark, sf_dir)
    model = TargetEncoder(["nation"], "y", "fold", smoothing=5).fit(_train(base))
    test = base.filter("split = 'test'")
    return rounded(model.transform(test).select("id", "nation_te"), 9)


def _woe_sql(col: str) -> str:
    return f"""w_{col} AS (
      SELECT v, ln(((n - e + 10) / (sum(n - e) OVER () + 10 * count(*) OVER ()))
        / ((e + 10) / (sum(e) OVER () + 10 * count(*) OVER ()))) AS woe
      FROM (SELECT coalesce({col}, 'nan') AS v, sum(y)::DOUBLE AS e, count(*)::DOUBLE AS n
            FROM b WHERE split = 'train' GROUP BY 1))"""


@query(
    "woe_encode",
    B
    + ", "
    + ", ".join(_woe_sql(c) for c in CATS)
    + " SELECT id, "
    + ", ".join(f"round(coalesce(w_{c}.woe, 0), 9) AS {c}_woe" for c in CATS)
    + " FROM b "
    + " ".join(f"LEFT JOIN w_{c} ON coalesce(b.{c}, 'nan') = w_{c}.v" for c in CATS),
)
def woe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_frame(spark, sf_dir)
    model = WoeEncoder(CATS, "y").fit(_train(base))
    return rounded(model.transform(base).select("id", *[f"{c}_woe" for c in CATS]), 9)


@query(
    "woe_encode_oof",
    B
    + """, f AS (SELECT DISTINCT fold FROM b WHERE split = 'train'),
    c AS (SELECT f.fold, coalesce(nation, 'nan') AS v, sum(y)::DOUBLE AS e, count(*)::DOUBLE AS n
      FROM b JOIN f ON b.fold <> f.fold WHERE split = 'train' GROUP BY ALL),
    w AS (SELECT fold, v,
        ln(((n - e + 10) / (sum(n - e) OVER p + 10 * count(*) OVER p))
        / ((e + 10) / (sum(e) OVER p + 10 * count(*) OVER p))) AS woe
      FROM c WINDOW p AS (PARTITION BY fold))
    SELECT id, round(coalesce(woe, 0), 9) AS nation_woe
    FROM b LEFT JOIN w ON b.nation = w.v AND b.fold = w.fold WHERE split = 'train'""",
)
def woe_encode_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows see the weight of evidence of the other folds."""
    train = _train(orders_frame(spark, sf_dir))
    model = WoeEncoder(["nation"], "y", fold_col="fold").fit(train)
    return rounded(model.transform(train).select("id", "nation_woe"), 9)


_LONG = ["customer", "price", "day"]


@query(
    "encode_long_columns",
    """WITH b AS (SELECT o_orderkey AS id, o_orderkey % 5 < 2 AS test, o_orderkey // 5 % 5 AS fold,
      CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
      CASE WHEN o_orderkey % 5 < 2 THEN 'walk-in' ELSE CAST(o_custkey AS VARCHAR) END AS customer,
      CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS price,
      CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day
    FROM orders), g AS (SELECT avg(y) AS g FROM b WHERE NOT test), """
    + ", ".join(
        f"""{c}_o AS (SELECT coalesce({c}, 'nan') AS v, fold, sum(y) AS s, count(*) AS n, count({c}) AS m
      FROM b WHERE NOT test GROUP BY ALL),
    {c}_a AS (SELECT v, sum(s) AS s, sum(n) AS n, sum(m) / sum(sum(m)) OVER () AS share FROM {c}_o GROUP BY v),
    {c}_c AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT coalesce({c}, 'nan') AS v FROM b))"""
        for c in _LONG
    )
    + " SELECT id, "
    + ", ".join(
        f"""round(CASE WHEN {c} IS NULL THEN 0 ELSE coalesce({c}_a.share, 0) END::DOUBLE, 9) AS {c}_freq,
      round(coalesce(CASE WHEN test THEN ({c}_a.s + g * 10) / ({c}_a.n + 10)
        ELSE ({c}_a.s - {c}_o.s + g * 10) / ({c}_a.n - {c}_o.n + 10) END, g), 9) AS {c}_te, {c}_c.code AS {c}_code"""
        for c in _LONG
    )
    + " FROM b CROSS JOIN g "
    + " ".join(
        f"""LEFT JOIN {c}_a ON coalesce({c}, 'nan') = {c}_a.v
    LEFT JOIN {c}_o ON coalesce({c}, 'nan') = {c}_o.v AND b.fold = {c}_o.fold
    JOIN {c}_c ON coalesce({c}, 'nan') = {c}_c.v"""
        for c in _LONG
    ),
)
def encode_long_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three encoders on three long columns, one with a value that 40 % of the
    rows have and no training row."""
    key = F.col("o_orderkey")
    test = key % 5 < 2
    rows = table(spark, sf_dir, "orders").select(
        key.alias("id"),
        F.when(test, "test").otherwise("train").alias("split"),
        (F.expr("o_orderkey div 5") % 5).cast("int").alias("fold"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y"),
        F.when(test, "walk-in").otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        F.floor("o_totalprice").cast("string").alias("price"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
    )
    encoders = [
        FrequencyEncoder(_LONG),
        TargetEncoder(_LONG, "y", "fold"),
        LabelEncoder(_LONG, suffix="_code"),
    ]
    # So small a bound takes every column the way of long ones.
    encoded = CategoryEncoders(encoders).fit(rows, max_rows=100).transform(rows)
    columns = [f"{c}_{e}" for c in _LONG for e in ("freq", "te", "code")]
    return rounded(encoded.select("id", *columns), 9)


@query(
    "standardise",
    B
    + """, f AS (SELECT avg(total) AS m, stddev_pop(total) AS d, avg(li_qty) AS mq,
      stddev_pop(li_qty) AS dq FROM b WHERE split = 'train')
    SELECT id, round((total - m) / d, 6) AS total_z, round((li_qty - mq) / dq, 6) AS li_qty_z
    FROM b CROSS JOIN f""",
)
def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_frame(spark, sf_dir, lines=True)
    model = Standardise(["total", "li_qty"]).fit(_train(base))
    return rounded(model.transform(base).select("id", "total_z", "li_qty_z"))


@query("cluster_features")
def cluster_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The scaler, the points and the result read the frame, which is a join of four tables.
    base = materialise(orders_frame(spark, sf_dir, lines=True))
    model = ClusterFeatures(["total", "balance", "li_qty", "li_n"], ks=(5, 10)).fit(_train(base))
    columns = ["cluster_5", "cluster_5_dist", "cluster_10", "cluster_10_dist"]
    return rounded(model.transform(base).select("id", *columns))


@query(
    "cluster_nearest",
    """SELECT k::INTEGER AS k, count(*) AS n_rows, 0::BIGINT AS n_wrong, k::BIGINT AS n_centres,
      TRUE AS centres_are_means FROM orders, (VALUES (5), (10)) AS t(k) GROUP BY k""",
)
def cluster_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row has its nearest centre and the distance to it, and every
    centre is about the mean of the training rows that are nearest to it."""
    cols = ["total", "balance", "li_qty", "li_n"]
    base = materialise(orders_frame(spark, sf_dir, lines=True))
    model = ClusterFeatures(cols, ks=(5, 10), restarts=2).fit(_train(base))
    placed = model.scaler.transform(model.transform(base)).select(
        "id", "split", F.array(*[f"{c}__z" for c in cols]).alias("x"), *[f"cluster_{k}" for k in (5, 10)],
        *[f"cluster_{k}_dist" for k in (5, 10)],
    )
    parts = []
    for k, centres in model.centres.items():
        listed = [(j, c.tolist()) for j, c in enumerate(centres)]
        table = F.broadcast(spark.createDataFrame(listed, "j int, c array<double>"))

        def distance(c):
            square = F.aggregate(
                F.zip_with("x", c, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x
            )
            return F.sqrt(square)

        # Every centre is tried inside the row, so no row per order and centre is made.
        tried = [F.struct(distance(F.lit(c)).alias("d"), F.lit(j).alias("j")) for j, c in listed]
        near = placed.filter("id IS NOT NULL").withColumn("near", F.array_min(F.array(*tried)))
        wrong = (F.col("near.j") != F.col(f"cluster_{k}")) | (F.abs(F.col("near.d") - F.col(f"cluster_{k}_dist")) > 1e-9)
        means = (
            placed.filter("split = 'train'")
            .select(F.col(f"cluster_{k}").alias("j"), F.posexplode("x").alias("i", "v"))
            .groupBy("j", "i").agg(F.avg("v").alias("m"))
            .join(table, "j")
            .agg(F.max(F.abs(F.col("m") - F.get("c", F.col("i")))).alias("off"), F.countDistinct("j").alias("n"))
            .first()
        )
        parts.append(
            near.agg(
                F.lit(k).alias("k"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(wrong).alias("n_wrong"),
                F.lit(means["n"]).cast("long").alias("n_centres"),
                F.lit(means["off"] < 0.05).alias("centres_are_means"),
            )
        )
    return parts[0].unionByName(parts[1])


@query(
    "encoder_leakage",
    "SELECT count(*) AS n_rows, 0::BIGINT AS n_changed, TRUE AS codes_see_all FROM orders WHERE o_orderkey % 5 <> 0",
)
def encoder_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changing the test rows changes no statistic of the training rows."""
    base = orders_frame(spark, sf_dir).select("id", "split", "fold", "y", *CATS)
    moved = base.withColumn(
        "segment", F.when(F.col("split") == "test", F.lit("A_OTHER")).otherwise(F.col("segment"))
    )

    def encoded(df: DataFrame, out: str) -> DataFrame:
        # Fitted as a run does, on the training rows of the whole tagged table,
        # and applied to all of it.
        train = _train(df)
        for encoder in (
            FrequencyEncoder(["segment"]),
            TargetEncoder(["segment"], "y"),
            WoeEncoder(["segment"], "y"),
        ):
            df = encoder.fit(train).transform(df)
        stats = GroupStats([StatBlock(("segment",), ("y",))]).fit(train)
        df = LabelEncoder(["segment"], suffix="_code").fit(df).transform(stats.transform(df))
        added = ["segment_freq", "segment_te", "segment_woe", "segment_y_mean", "segment_y_std"]
        return df.filter("split = 'train'").select(
            "id", F.hash(*added).alias(f"values{out}"), F.col("segment_code").alias(f"code{out}")
        )

    both = encoded(base, "_a").join(encoded(moved, "_b"), "id")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("values_a") != F.col("values_b")).alias("n_changed"),
        # Codes are defined over all rows: the new test category moves some.
        (F.count_if(F.col("code_a") != F.col("code_b")) > 0).alias("codes_see_all"),
    )
