"""Text quality learned from trusted positives and unlabelled text."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import bounded_sample, pick

BITS = 12
LETTERS, DIGITS, REST = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"[^\w\s]")
#: Hashed token shapes, then some rates, then a constant.
N_RATES = 10
WIDTH = (1 << BITS) + N_RATES + 1
#: The longest token whose counts fit their 15 bits.
PACKED = (1 << 15) - 1


def shape(token: str) -> str:
    """The token with letter runs as 'a' and digit runs as '0', at most 8 characters."""
    return DIGITS.sub("0", LETTERS.sub("a", token))[:8]


def signs_of(token: str) -> tuple[int, int, int]:
    """How many letters, digits and signs a token has."""
    letters, digits = (sum(map(len, kind.findall(token))) for kind in (LETTERS, DIGITS))
    return letters, digits, len(REST.findall(token))


class Shapes(dict):
    """For a token, its shape's bucket and its numbers of letters, digits and signs.

    They are packed into one number, 16 bits each; short tokens are remembered.
    Numbers of a token longer than ``PACKED`` do not fit and are left at 0.
    """

    def __missing__(self, token: str) -> int:
        found = zlib.crc32(shape(token).encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)
        if len(token) <= PACKED:
            for i, n in enumerate(signs_of(token), 1):
                found |= n << 16 * i
        if len(token) <= 32:
            if len(self) > 100_000:
                self.clear()
            self[token] = found
        return found


SHAPES = Shapes()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of a whole text's features; the constant is always there."""
    text = text or ""
    tokens = text.split()
    n = len(tokens)
    found = np.fromiter(map(SHAPES.__getitem__, tokens), np.int64, n)
    at, counts = np.unique(found & 0xFFFF, return_counts=True)
    letters, digits, signs = (int(((found >> 16 * i) & 0xFFFF).sum()) for i in (1, 2, 3))
    lines = [x for x in text.split("\n") if x.strip()]
    chars = max(len(text), 1)
    lengths = list(map(len, tokens))
    if max(lengths, default=0) > PACKED:
        more = [signs_of(t) for t in tokens if len(t) > PACKED]
        letters, digits, signs = (a + sum(b) for a, b in zip((letters, digits, signs), zip(*more)))
    rates = [
        np.log1p(n) / 10,
        min(sum(lengths) / max(n, 1), 30) / 30,
        len(set(tokens)) / max(n, 1),
        len(set(lines)) / max(len(lines), 1),
        min(n / max(len(lines), 1), 100) / 100,
        letters / chars,
        digits / chars,
        signs / chars,
        min(max(lengths, default=0), 100) / 100,
        1.0 if n < 5 else 0.0,
    ]
    positions = np.concatenate([at, np.arange(1 << BITS, WIDTH)])
    return positions, np.concatenate([np.sqrt(counts / max(n, 1)), rates, [1.0]])


def packed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position and value of all features of some texts."""
    own = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])
    empty = np.zeros(0)
    return (
        own,
        np.concatenate([x[0] for x in found] or [empty]).astype(int),
        np.concatenate([x[1] for x in found] or [empty]),
    )


def minimise(own, at, values, positive, prior: float, rounds: int = 300, rate: float = 0.05, ridge=1e-4):
    """Weights of least non-negative unbiased risk under the logistic loss.

    With Rp+ and Rp- the mean loss of the positives taken as positive and as
    negative, and Ru- that of the unlabelled taken as negative, the risk is
    prior * Rp+ + max(0, Ru- - prior * Rp-). Where the second part would turn
    negative, the step goes up along it instead.
    """
    n = len(positive)
    share_p, share_u = positive / max(positive.sum(), 1), ~positive / max((~positive).sum(), 1)
    weights, first, second = np.zeros(WIDTH), np.zeros(WIDTH), np.zeros(WIDTH)
    for step in range(1, rounds + 1):
        z = np.bincount(own, values * weights[at], minlength=n)
        p = 1 / (1 + np.exp(-z))
        as_negative = np.logaddexp(0, z)
        rest = (share_u * as_negative).sum() - prior * (share_p * as_negative).sum()
        slope_rest = (share_u - prior * share_p) * p
        slope = prior * share_p * (p - 1) + slope_rest if rest >= 0 else -slope_rest
        gradient = np.bincount(at, values * slope[own], minlength=WIDTH)
        gradient[:-1] += ridge * weights[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        weights -= rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return weights


def estimate_prior(scores: np.ndarray, positive: np.ndarray) -> float:
    """The largest share of positives that the unlabelled scores allow.

    The unlabelled are a mix of positives and others, so above any threshold
    their share is at least prior times that of the positives. The least ratio
    over thresholds that keep a tenth to nine tenths of the positives bounds
    the prior, and reaches it if some threshold leaves out all others.
    """
    mine, others = np.sort(scores[positive]), np.sort(scores[~positive])
    if not len(mine) or not len(others):
        return 0.5
    cuts = np.quantile(mine, np.linspace(0.1, 0.9, 33))
    above = lambda x: 1 - np.searchsorted(x, cuts, "left") / len(x)
    margin = 1 / np.sqrt(len(others)) * 0.5
    ratios = (above(others) + margin) / np.maximum(above(mine), 1e-9)
    return float(np.clip(ratios.min(), 0.05, 0.98))


def fit_quality(
    found: list[tuple[np.ndarray, np.ndarray]], positive: np.ndarray, prior: float | None = None
) -> np.ndarray:
    """Weights from the features of texts of which some are trusted positives and the rest unlabelled."""
    own, at, values = packed(found)
    if prior is None:
        first = minimise(own, at, values, positive, 0.5, rounds=150)
        prior = estimate_prior(np.bincount(own, values * first[at], minlength=len(found)), positive)
    return minimise(own, at, values, positive, prior)


def listed_features(texts: pa.Array) -> pa.Array:
    """For an Arrow UDF: the features of each text, at most ``WIDTH`` however long it is."""
    found = [features(t.as_py()) for t in texts]
    return pa.StructArray.from_arrays(
        [
            pa.array([x[0] for x in found], pa.list_(pa.int32())),
            pa.array([x[1] for x in found], pa.list_(pa.float64())),
        ],
        ["at", "values"],
    )


def fit_scorer(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    label_col: str = "quality",
    class_prior: float | None = None,
    sample_rows: int = 6_000,
    id_col: str = "doc_id",
    text_col: str = "text",
):
    """A function of a text column that gives its score; parameters as in ``score_quality``."""
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    known = (
        pick(labels, doc_id=id_col, label=label_col)
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & learn_from)
        .groupBy("doc_id")
        .agg(F.min(F.col("label").cast("int")).alias("label"))
    )
    trusted = bounded_sample(known.filter("label = 1"), "doc_id", sample_rows)
    free = rows.filter(learn_from).select("doc_id").distinct().join(known, "doc_id", "left_anti")
    ids = bounded_sample(free, "doc_id", sample_rows).withColumn("label", F.lit(0))
    ids = trusted.select("doc_id", "label").unionByName(ids)
    features_of = F.arrow_udf(listed_features, "struct<at:array<int>,values:array<double>>")
    # One text of each id, and its features instead of it: the bound holds for
    # ids with many rows, and for texts of any length.
    training = (
        rows.join(F.broadcast(ids), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "label", features_of("text").alias("found"))
        .select("doc_id", "label", "found.*")
        .toArrow()
        .sort_by("doc_id")
    )
    positive = training["label"].to_numpy().astype(bool)
    weights = np.zeros(WIDTH)
    if positive.any():
        found = [(at.values.to_numpy(), v.values.to_numpy()) for at, v in zip(training["at"], training["values"])]
        weights = fit_quality(found, positive, class_prior)
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def judge(texts: pa.Array) -> pa.Array:
        scores = []
        for text in texts:
            at, values = features(text.as_py())
            scores.append(1 / (1 + np.exp(-np.clip((sent.value[at] * values).sum(), -500, 500))))
        return pa.array(scores, pa.float64())

    return judge


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """Per row: doc_id, score (0 to 1) and predicted (score >= threshold).

    Positives are the rows labelled 1 (in ``label_col``) whose ``doc_id`` meets
    ``learn_from``; unlabelled are those without a label that meet it too, so
    other rows have no part in the fit. About ``sample_rows`` ids of each are
    used, all if there are fewer, each with the least of its texts. Labels of 0
    are not used. ``class_prior``, the share of positives among the unlabelled, is
    estimated if None. Features are shapes of tokens and rates of a whole text;
    every whole text is scored.

    NULL and empty texts are scored like each other, by the features of an
    empty text. Without a positive every score is 0.5. Labels of a NULL id are
    not used; of several labels of an id the lowest counts. A NULL id stays;
    repeated rows each give a row; an empty table gives an empty one; further
    columns are left out.
    """
    judge = fit_scorer(docs, labels, learn_from, id_col=id_col, text_col=text_col, **options)
    rows = pick(docs, doc_id=id_col, text=text_col)
    return rows.select("doc_id", judge(F.col("text").cast("string")).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def keep_good(docs: DataFrame, labels: DataFrame, learn_from: Column, threshold: float = 0.3, **options) -> DataFrame:
    """The rows of ``docs`` that ``score_quality`` predicts 1, with all columns.

    Each row is judged by its own text, so rows of one id may part; NULL and
    empty texts are judged like each other. Without a positive every row stays,
    as 0.5 reaches the default threshold. An empty table gives an empty one.
    """
    judge = fit_scorer(docs, labels, learn_from, **options)
    return docs.filter(judge(F.col(options.get("text_col", "text")).cast("string")) >= threshold)
