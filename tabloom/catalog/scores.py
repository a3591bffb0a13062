"""Metrics and blends over three stand-in scores per order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.catalog.base import B, orders_frame, query, rounded, table
from tabloom.operators import blend
from tabloom.operators.metrics import auc, fold_auc
from tabloom.operators.train import leaderboard

MODELS = ["s1", "s2", "s3"]


def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in scores as a long score table."""
    base = orders_frame(spark, sf_dir)
    entries = [F.struct(F.lit(m).alias("model"), F.col(m).alias("score")) for m in MODELS]
    return base.select(
        "id",
        F.lit(42).alias("seed"),
        "fold",
        "split",
        F.col("y").alias("label"),
        F.inline(F.array(*entries)),
    )


def wide_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column per stand-in model, training rows."""
    base = orders_frame(spark, sf_dir)
    return base.filter("split = 'train'").select("id", "fold", F.col("y").alias("label"), *MODELS)


_LONG = (
    B
    + """, scores AS (SELECT id, fold, split, y, 's1' AS model, s1 AS score FROM b
    UNION ALL SELECT id, fold, split, y, 's2', s2 FROM b
    UNION ALL SELECT id, fold, split, y, 's3', s3 FROM b)"""
)


def auc_sql(source: str, by: Sequence[str], digits: int = 8) -> str:
    """Rank formula of the AUC per group of a relation (by..., y, score)."""
    keys = ", ".join(by)
    part = f"PARTITION BY {keys}" if by else ""
    same = f"PARTITION BY {keys + ', ' if by else ''}k"
    lead = f"{keys}, " if by else ""
    group = f"GROUP BY {keys}" if by else ""
    return f"""SELECT {lead}round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0)
      / (sum(y) * (count(*) - sum(y))::DOUBLE), {digits}) AS auc,
      CAST(sum(y) AS BIGINT) AS n_pos, CAST(count(*) - sum(y) AS BIGINT) AS n_neg
    FROM (SELECT *, rank() OVER ({part} ORDER BY k)
        + (count(*) OVER ({same}) - 1) / 2.0::DOUBLE AS r
      FROM (SELECT *, round(score * 1e12)::BIGINT AS k FROM ({source}))) {group}"""


def _auc(df: DataFrame) -> DataFrame:
    return rounded(df, 8)


@query("auc", _LONG + auc_sql("SELECT model, y, score FROM scores", ["model"]))
def auc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _auc(auc(score_table(spark, sf_dir), by=["model"]))


@query("fold_auc", _LONG + auc_sql("SELECT model, 42 AS seed, fold, y, score FROM scores", ["model", "seed", "fold"]))
def fold_auc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _auc(fold_auc(score_table(spark, sf_dir)))


@query(
    "auc_many_ties",
    auc_sql(
        "SELECT quality AS y, least(n_chars, 2000) / 100 / 20.0 AS score "
        "FROM documents JOIN labels USING (doc_id)",
        [],
    ),
)
def auc_many_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A skewed target and one score value shared by many rows."""
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    score = F.least(F.col("n_chars"), F.lit(2000)) / F.lit(100) / F.lit(20.0)
    return _auc(auc(joined.select(score.alias("score"), F.col("quality").alias("label"))))


@query("mean_blend", B + "SELECT id, round((s1 + s2 + s3) / 3, 10) AS score FROM b")
def mean_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(blend.mean_blend(score_table(spark, sf_dir)), 10)


@query("subset_mean_blend", B + "SELECT id, y AS label, round((s1 + s3) / 2, 10) AS score FROM b")
def subset_mean_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(blend.mean_blend(score_table(spark, sf_dir), ["s1", "s3"], keep=["label"]), 10)


@query(
    "fixed_weight_blend",
    B + "SELECT id, round(0.20 * s1 + 0.30 * s2 + 0.50 * s3, 10) AS score FROM b",
)
def fixed_weight_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = {"s1": 0.20, "s2": 0.30, "s3": 0.50}
    return rounded(blend.weighted_blend(score_table(spark, sf_dir), weights), 10)


_RANKED = (
    _LONG
    + """, ranked AS (SELECT *, (rank() OVER (PARTITION BY model ORDER BY score)
      + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0::DOUBLE)
      / count(*) OVER (PARTITION BY model) AS rank_score FROM scores)"""
)


@query("rank_normalise", _RANKED + "SELECT id, model, rank_score FROM ranked")
def rank_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = blend.rank_normalise(score_table(spark, sf_dir))
    return ranked.select("id", "model", "rank_score")


@query(
    "rank_mean_blend",
    _RANKED + "SELECT id, round(avg(rank_score), 10) AS score FROM ranked GROUP BY id",
)
def rank_mean_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(blend.rank_mean_blend(score_table(spark, sf_dir)), 10)


@query(
    "seed_mean_blend",
    B + "SELECT id, round(((s1 + s2) / 2 + (s2 + s3) / 2) / 2, 10) AS score FROM b",
)
def seed_mean_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blend per seed, then the mean over seeds."""
    scores = score_table(spark, sf_dir)
    first = blend.mean_blend(scores, ["s1", "s2"]).withColumn("seed", F.lit(42))
    second = blend.mean_blend(scores, ["s2", "s3"]).withColumn("seed", F.lit(1042))
    return rounded(blend.seed_mean_blend(first.unionByName(second)), 10)


@query(
    "blend_score_tables",
    B + "SELECT id, round(s1 * 0.7 + s2 * 0.3, 10) AS score FROM b WHERE id % 3 <> 0",
)
def blend_score_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_frame(spark, sf_dir)
    first = base.filter("id % 3 <> 0").select("id", F.col("s1").alias("score"))
    second = base.select("id", F.col("s2").alias("score"))
    return rounded(blend.blend_score_tables(first, second, 0.7, 0.3), 10)


def _best_frame(spark: SparkSession, best: blend.Best) -> DataFrame:
    weights = [round(w, 6) for w in best.weights]
    columns = ", ".join(f"w{i + 1} double" for i in range(len(weights)))
    return spark.createDataFrame(
        [(best.w_id, round(best.auc, 8), *weights)], f"w_id int, auc double, {columns}"
    )


def _grid_sql(grid: Sequence[Sequence[float]], cols: Sequence[str], top: int | None = 1) -> str:
    rows = ", ".join(
        f"({i}, " + ", ".join(f"{w!r}::DOUBLE" for w in ws) + ")" for i, ws in enumerate(grid)
    )
    names = ", ".join(f"w{j + 1}" for j in range(len(cols)))
    total = " + ".join(f"w{j + 1} * {c}" for j, c in enumerate(cols))
    source = f"SELECT w_id, label AS y, {total} AS score FROM t CROSS JOIN grid"
    shown = ", ".join(f"round(w{j + 1}, 6) AS w{j + 1}" for j in range(len(cols)))
    best = "ORDER BY auc DESC, w_id LIMIT 1" if top else ""
    return (
        B
        + f""", t AS (SELECT y AS label, *, (s1 + s2 + s3) / 3 AS mean_score
      FROM b WHERE split = 'train'),
    grid(w_id, {names}) AS (VALUES {rows}),
    aucs AS ({auc_sql(source, ["w_id"], 12)})
    SELECT w_id, round(auc, 8) AS auc, {shown} FROM aucs JOIN grid USING (w_id) {best}"""
    )


def _searched(cols: Sequence[str], grid: Sequence[Sequence[float]]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wide = wide_scores(spark, sf_dir).withColumn("mean_score", F.expr("(s1 + s2 + s3) / 3"))
        return _best_frame(spark, blend.grid_blend(wide, cols, "label", grid))

    return run


for _name, _cols, _grid in (
    ("grid_blend_two", ["s1", "mean_score"], blend.grid2()),
    ("grid_blend_coarse", MODELS, blend.grid3_coarse()),
    ("grid_blend_full", MODELS, blend.grid3_full()),
    ("grid_blend_tenths", MODELS, blend.grid3_full(0.1)),
    ("grid_blend_four", [*MODELS, "mean_score"], blend.grid4()),
):
    query(_name, _grid_sql(_grid, _cols))(_searched(_cols, _grid))


@query("grid_aucs", _grid_sql(blend.grid2(), ["s1", "s2"], top=None))
def grid_aucs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The AUC of every weight of a grid, not only the best."""
    grid = blend.grid2()
    aucs = blend.blend_aucs(wide_scores(spark, sf_dir), ["s1", "s2"], "label", grid)
    weights = spark.createDataFrame(
        [(i, *map(float, w)) for i, w in enumerate(grid)], "w_id int, w1 double, w2 double"
    )
    joined = aucs.join(weights, "w_id").select("w_id", "auc", "w1", "w2")
    return joined.select(
        "w_id", F.round("auc", 8).alias("auc"), F.round("w1", 6).alias("w1"), F.round("w2", 6).alias("w2")
    )


@query(
    "leaderboard",
    _LONG
    + "SELECT model, auc FROM ("
    + auc_sql("SELECT model, y, score FROM scores WHERE split = 'train'", ["model"])
    + ")",
)
def leaderboard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _auc(leaderboard(score_table(spark, sf_dir)))


@query(
    "pick_best",
    _LONG
    + """, v AS (SELECT 'mean' AS variant, y, (s1 + s2 + s3) / 3 AS score FROM b
      UNION ALL SELECT 'first', y, s1 FROM b UNION ALL SELECT 'second', y, s2 FROM b)
    SELECT variant, auc FROM ("""
    + auc_sql("SELECT variant, y, score FROM v", ["variant"])
    + ") ORDER BY auc DESC, variant LIMIT 1",
)
def pick_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = score_table(spark, sf_dir)
    mean = blend.mean_blend(scores, keep=["label"]).withColumn("variant", F.lit("mean"))
    single = [
        scores.filter(F.col("model") == m).select("id", "score", "label", F.lit(v).alias("variant"))
        for m, v in (("s1", "first"), ("s2", "second"))
    ]
    variants = mean.unionByName(single[0]).unionByName(single[1])
    return _auc(blend.pick_best(variants))


def _climb_sql() -> str:
    """Best single model, then the best pair with it."""
    pairs = "SELECT a.model || '+' || c.model AS pair, a.y, (a.score + c.score) / 2 AS score " \
        "FROM scores a JOIN top ON a.model = top.model JOIN scores c ON a.id = c.id " \
        "WHERE a.split = 'train' AND c.split = 'train'"
    single = auc_sql("SELECT model, y, score FROM scores WHERE split = 'train'", ["model"], 12)
    return (
        _LONG
        + f""", single AS ({single}), top AS (SELECT model, auc FROM single
      ORDER BY auc DESC, model LIMIT 1), pairs AS ({auc_sql(pairs, ["pair"], 12)}),
    second AS (SELECT pair, auc FROM pairs ORDER BY auc DESC, pair LIMIT 1)
    SELECT top.model AS first, round(top.auc, 8) AS first_auc,
      CASE WHEN second.auc - top.auc > 1e-5 THEN second.pair END AS pair,
      CASE WHEN second.auc - top.auc > 1e-5 THEN round(second.auc, 8) END AS pair_auc
    FROM top CROSS JOIN second"""
    )


@query("hill_climb_first_steps", _climb_sql())
def hill_climb_first_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    climb = blend.hill_climb(wide_scores(spark, sf_dir), MODELS, "label", max_add=1)
    more = len(climb.selected) > 1
    row = (
        climb.selected[0],
        round(climb.aucs[0], 8),
        "+".join(climb.selected) if more else None,
        round(climb.aucs[1], 8) if more else None,
    )
    return spark.createDataFrame(
        [row], "first string, first_auc double, pair string, pair_auc double"
    )


@query("hill_climb")
def hill_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    climb = blend.hill_climb(wide_scores(spark, sf_dir), MODELS, "label")
    rows = [(i, m, round(a, 8)) for i, (m, a) in enumerate(zip(climb.selected, climb.aucs))]
    return spark.createDataFrame(rows, "step int, model string, auc double")
