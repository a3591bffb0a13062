"""Group statistics, shares, summaries and correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.catalog.base import B, orders_frame, query, rounded, table
from tabloom.operators.groupstats import GroupStats, StatBlock, stat_blocks, value_shares
from tabloom.operators.metrics import correlation_matrix, score_summary

_FIT = """, t AS (SELECT *, coalesce(priority, 'nan') AS pk FROM b WHERE split = 'train'),
overall AS (SELECT avg(total) AS total, avg(li_qty) AS li_qty FROM t)"""


@query(
    "group_stats",
    B
    + _FIT
    + """, g AS (SELECT pk, avg(total) AS m_total, coalesce(stddev_samp(total), 0) AS d_total,
      avg(li_qty) AS m_qty, coalesce(stddev_samp(li_qty), 0) AS d_qty FROM t GROUP BY pk)
    SELECT id, round(m_total, 4) AS priority_total_mean, round(d_total, 4) AS priority_total_std,
      round(total - m_total, 4) AS priority_total_diff,
      round(m_qty, 4) AS priority_li_qty_mean, round(d_qty, 4) AS priority_li_qty_std,
      round(li_qty - m_qty, 4) AS priority_li_qty_diff
    FROM b JOIN g ON coalesce(b.priority, 'nan') = g.pk""",
)
def group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_frame(spark, sf_dir, lines=True)
    stats = GroupStats(stat_blocks(["priority"], ["total", "li_qty"]))
    model = stats.fit(base.filter("split = 'train'"))
    return rounded(model.transform(base).select("id", *model.names), 4)


@query(
    "group_stats_two_keys",
    B
    + _FIT
    + """, g AS (SELECT pk, segment, avg(total) AS m FROM t GROUP BY ALL),
    h AS (SELECT segment, nation, avg(li_qty) AS m FROM t GROUP BY ALL)
    SELECT id, round(coalesce(g.m, overall.total), 4) AS priority_segment_total_mean,
      round(b.total - coalesce(g.m, overall.total), 4) AS priority_segment_total_diff,
      round(coalesce(h.m, overall.li_qty), 4) AS segment_nation_li_qty_mean,
      round(b.li_qty - coalesce(h.m, overall.li_qty), 4) AS segment_nation_li_qty_diff
    FROM b CROSS JOIN overall
      LEFT JOIN g ON coalesce(b.priority, 'nan') = g.pk AND b.segment = g.segment
      LEFT JOIN h ON b.segment = h.segment AND b.nation = h.nation""",
)
def group_stats_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_frame(spark, sf_dir, lines=True)
    stats = GroupStats(
        [
            StatBlock(("priority", "segment"), ("total",), ("mean",)),
            StatBlock(("segment", "nation"), ("li_qty",), ("mean",)),
        ]
    )
    model = stats.fit(base.filter("split = 'train'"))
    return rounded(model.transform(base).select("id", *model.names), 4)


@query(
    "group_medians",
    B
    + """, g AS (SELECT nation, avg(total) AS m, coalesce(stddev_samp(total), 0) AS d,
      median(total) AS e FROM b WHERE split = 'train' GROUP BY nation)
    SELECT id, round(m, 4) AS nation_total_mean, round(d, 4) AS nation_total_std,
      round(e, 4) AS nation_total_median, round(total - m, 4) AS nation_total_diff
    FROM b JOIN g USING (nation)""",
)
def group_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_frame(spark, sf_dir)
    stats = GroupStats(
        [StatBlock(("nation",), ("total",), ("mean", "std", "median"), unseen="zero")]
    )
    model = stats.fit(base.filter("split = 'train'"))
    return rounded(model.transform(base).select("id", *model.names), 4)


@query(
    "unseen_keys",
    B
    + """, t AS (SELECT * FROM b WHERE split = 'train' AND segment <> 'BUILDING'),
    g AS (SELECT segment, avg(total) AS m, coalesce(stddev_samp(total), 0) AS d FROM t GROUP BY ALL)
    SELECT id, round(coalesce(m, (SELECT avg(total) FROM t)), 4) AS segment_total_mean,
      round(coalesce(d, 0), 4) AS segment_total_std,
      round(total - coalesce(m, (SELECT avg(total) FROM t)), 4) AS segment_total_diff
    FROM b LEFT JOIN g USING (segment) WHERE split = 'test'""",
)
def unseen_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category absent from the training rows gets the train-wide mean."""
    base = orders_frame(spark, sf_dir)
    train = base.filter("split = 'train' AND segment <> 'BUILDING'")
    model = GroupStats(stat_blocks(["segment"], ["total"])).fit(train)
    test = base.filter("split = 'test'")
    return rounded(model.transform(test).select("id", *model.names), 4)


@query(
    "group_stats_many_keys",
    """WITH g AS (SELECT l_partkey, avg(l_extendedprice) AS m,
      coalesce(stddev_samp(l_extendedprice), 0) AS d FROM lineitem GROUP BY 1)
    SELECT l_returnflag, count(*) AS n_rows, round(avg(m), 4) AS mean_of_means,
      round(avg(d), 4) AS mean_of_stds FROM lineitem JOIN g USING (l_partkey) GROUP BY 1""",
)
def group_stats_many_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that grow with the data; how they are joined depends on their number."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_extendedprice")
    model = GroupStats(stat_blocks(["l_partkey"], ["l_extendedprice"])).fit(lines)
    added = model.transform(lines)
    summary = added.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg("l_partkey_l_extendedprice_mean").alias("mean_of_means"),
        F.avg("l_partkey_l_extendedprice_std").alias("mean_of_stds"),
    )
    return rounded(summary, 4)


@query(
    "overall_stat",
    B
    + """SELECT round(avg(y), 6) AS positive_rate, round(avg(total), 4) AS mean_total,
      round(avg(li_qty), 4) AS mean_qty FROM b WHERE split = 'train'""",
)
def overall_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = orders_frame(spark, sf_dir, lines=True).filter("split = 'train'")
    return train.agg(
        F.round(F.avg("y"), 6).alias("positive_rate"),
        F.round(F.avg("total"), 4).alias("mean_total"),
        F.round(F.avg("li_qty"), 4).alias("mean_qty"),
    )


@query(
    "value_shares",
    B
    + """SELECT priority, count(*) AS n_rows,
      round(count(*) / (SELECT count(priority) FROM b)::DOUBLE, 6) AS share
    FROM b WHERE priority IS NOT NULL GROUP BY priority""",
)
def value_shares_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(value_shares(orders_frame(spark, sf_dir), "priority"))


@query(
    "score_summary",
    B
    + """SELECT split, round(min(s1), 6) AS min_score, round(max(s1), 6) AS max_score,
      round(avg(s1), 6) AS mean_score, count(*) AS n_rows FROM b GROUP BY split""",
)
def score_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(score_summary(orders_frame(spark, sf_dir), "s1", ["split"]))


_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM b"
    for a in ("s1", "s2", "s3")
    for b in ("s1", "s2", "s3")
)


@query("correlation_matrix", B + _PAIRS)
def correlation_matrix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(correlation_matrix(orders_frame(spark, sf_dir), ["s1", "s2", "s3"]))
