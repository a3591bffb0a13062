"""Toxicity from document labels: sentence probabilities combined by noisy-or."""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import bounded_sample, pick, sampled_texts

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


def word_features(word: str) -> list[str]:
    """The word, and its beginnings of 4 to 6 letters, which inflected forms share."""
    return [word] + [word[:k] + "~" for k in (4, 5, 6) if len(word) > k]


def sentences(text: str | None) -> list[tuple[int, int, set[str]]]:
    """Start, end and distinct words of each sentence that has a word."""
    found = ((m.start(), m.end(), set(WORD.findall(m[0].lower()))) for m in SENTENCE.finditer(text or ""))
    return [x for x in found if x[2]]


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


class SentenceModel(dict):
    """Gives a sentence of words the probability p = 1 / (1 + exp(-bias - sum of weights)).

    A document is toxic unless all its sentences are harmless:
    P = 1 - prod(1 - p). With S = sum of softplus(z) over its sentences,
    P = 1 - exp(-S). The dictionary remembers the weight of a word, the sum
    over its features.
    """

    def __init__(self, bias: float, weights: dict[str, float]):
        super().__init__()
        self.bias, self.weights = bias, weights

    def __missing__(self, word: str) -> float:
        if len(self) > 100_000:
            self.clear()
        found = sum(self.weights.get(f, 0.0) for f in word_features(word))
        if len(word) <= 32:
            self[word] = found
        return found

    def logits(self, found: list[tuple[int, int, set[str]]]) -> np.ndarray:
        of = self.__getitem__
        return np.array([self.bias + sum(map(of, x[2])) for x in found])

    def judge(self, text: str | None, least: float) -> tuple[float, list[dict]]:
        """The text's score, and its sentences of at least the probability ``least``."""
        found = sentences(text)
        z = self.logits(found)
        (hits,) = np.nonzero(z >= np.log(least / (1 - least)))
        return float(-np.expm1(-softplus(z).sum())), [
            {"start": found[i][0], "end": found[i][1], "score": float(1 / (1 + np.exp(-z[i])))}
            for i in hits
        ]


def fit_sentence_model(
    texts: list[str | None],
    labels: np.ndarray,
    least_docs: int = 8,
    most_features: int = 200_000,
    rounds: int = 400,
    rate: float = 0.2,
    ridge: float = 0.005,
) -> SentenceModel:
    """Fit weights by Adam on the documents' log loss under noisy-or.

    A feature takes part if at least ``least_docs`` documents have it. ``ridge``
    is the weight of the squared weights against the summed loss, so what a
    handful of documents share by chance gets little. Weights are not negative:
    a word can make its sentence toxic, but harmless words around it cannot
    hide that. Of one label only, the model gives every sentence that label's
    rate.
    """
    n = len(texts)
    ones = float(np.clip(labels.mean() if n else 0, 1e-6, 1 - 1e-6))
    if n == 0 or labels.min() == labels.max():
        return SentenceModel(float(np.log(ones / (1 - ones))), {})
    # Words by number: those of each sentence, and the features of each word.
    numbers: dict[str, int] = {}
    tokens, lengths, docs = array("i"), array("i"), array("i")
    for d, text in enumerate(texts):
        for _, _, words in sentences(text):
            tokens.extend([numbers.setdefault(w, len(numbers)) for w in sorted(words)])
            lengths.append(len(words))
            docs.append(d)
    tokens, docs = np.array(tokens, np.int32), np.array(docs, np.int32)
    place: dict[str, int] = {}
    of_word = [[place.setdefault(f, len(place)) for f in word_features(w)] for w in numbers]
    word = np.repeat(np.arange(len(of_word), dtype=np.int32), [len(x) for x in of_word])
    feature = np.fromiter((f for x in of_word for f in x), np.int32, len(word))
    first_of = np.searchsorted(word, np.arange(len(of_word) + 1))
    # In how many documents each feature is.
    seen, start = np.zeros(len(place), np.int64), 0
    sizes = np.bincount(docs, np.array(lengths), minlength=n).astype(int)
    for size in sizes:
        own = np.unique(tokens[start : start + size])
        start += size
        if size:
            seen[np.unique(np.concatenate([feature[first_of[w] : first_of[w + 1]] for w in own]))] += 1
    order = np.argsort(-seen, kind="stable")[:most_features]
    order = np.sort(order[seen[order] >= least_docs])
    renumbered = np.full(len(place), -1)
    renumbered[order] = np.arange(len(order))
    word, feature = word[renumbered[feature] >= 0], renumbered[feature[renumbered[feature] >= 0]]
    sentence = np.repeat(np.arange(len(docs), dtype=np.int32), np.array(lengths, int))
    n_words, n_features = len(numbers), len(order)
    y, weights, bias = labels.astype(float), np.zeros(n_features), -7.0
    first, second = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, rounds + 1):
        of_words = np.bincount(word, weights[feature], minlength=n_words)
        z = bias + np.bincount(sentence, of_words[tokens], minlength=len(docs))
        total = np.bincount(docs, softplus(z), minlength=n) + 1e-9
        by_total = np.where(y == 1, -np.exp(-total) / -np.expm1(-total), 1.0)
        slope = by_total[docs] / (1 + np.exp(-z))
        by_word = np.bincount(tokens, slope[sentence], minlength=n_words)
        gradient = np.bincount(feature, by_word[word], minlength=n_features) + ridge * weights
        gradient = np.append(gradient, slope.sum()) / n
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights, bias = np.maximum(weights - move[:-1], 0), bias - move[-1]
    names = list(place)
    chosen = {names[f]: float(w) for f, w in zip(order, weights) if w > 0.01}
    return SentenceModel(float(bias), chosen)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    label_col: str = "toxic",
    threshold: float = 0.7,
    sentence_threshold: float = 0.5,
    sample_rows: int = 8_000,
    sample_chars: int = 100_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, score, predicted (score >= threshold) and offending.

    ``offending`` lists start, end and probability of the sentences of at least
    ``sentence_threshold``. ``learn_from`` is a condition on ``doc_id`` that
    marks the rows whose label may be used. The model is fitted in one task's
    worth of memory on the whole texts of about ``sample_rows`` labelled ids,
    all if there are fewer, at most ``sample_chars`` characters together; of
    several texts of an id the least counts. Scoring covers every whole text.

    NULL, empty and wordless texts score 0. Labels that are NULL or belong to a
    NULL id are not used; of several labels of an id the highest counts. A NULL
    id stays; repeated rows each give a row; an empty table gives an empty one;
    further columns are left out.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    known = (
        pick(labels, doc_id=id_col, label=label_col)
        .filter(F.col("label").isNotNull() & learn_from)
        .groupBy("doc_id")
        .agg(F.max(F.col("label").cast("int")).alias("label"))
    )
    sample = bounded_sample(known, "doc_id", sample_rows)
    training = sampled_texts(rows, sample, sample_chars).toArrow().sort_by("doc_id")
    model = fit_sentence_model(training["text"].to_pylist(), training["label"].to_numpy())
    sent = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights))
    spans = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    )

    @F.arrow_udf("struct<score:double,offending:array<struct<start:int,end:int,score:double>>>")
    def judge(texts: pa.Array) -> pa.Array:
        own = SentenceModel(*sent.value)
        found = [own.judge(t.as_py(), sentence_threshold) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([x[0] for x in found], pa.float64()), pa.array([x[1] for x in found], spans)],
            ["score", "offending"],
        )

    return (
        rows.select("doc_id", judge("text").alias("found"))
        .select("doc_id", "found.*")
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
