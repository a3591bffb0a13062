"""Language identification by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import bounded_sample, pick

UNKNOWN = "und"
#: Characters taken at a time, which bounds a worker's memory for any text.
CHUNK = 1 << 18
MOST_LANGUAGES = 500


def ngram_buckets(text: str, bits: int, longest: int) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of 1 to ``longest`` characters, in chunks."""
    text = " " + text.lower() + " "
    for start in range(0, len(text), CHUNK):
        # A chunk reads on into the next, so that no n-gram is lost between.
        part = text[start : start + CHUNK + longest - 1]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        keys = np.zeros(len(codes), np.uint64)
        for n in range(1, longest + 1):
            starts = min(CHUNK, len(text) - start - n + 1)
            if starts <= 0:
                break
            keys = (keys[:starts] * np.uint64(0x100000001B3)) ^ codes[n - 1 : n - 1 + starts]
            mixed = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            yield (mixed >> np.uint64(64 - bits)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def fit(labelled: DataFrame, bits: int, longest: int, smoothing: float) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities per bucket, from (lang, text) rows.

    Each task counts its rows; only sums per language and bucket, which the
    number of languages bounds, reach the driver.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                own = found.setdefault(lang.as_py(), np.zeros(1 << bits, np.int64))
                for buckets in ngram_buckets(text.as_py(), bits, longest):
                    own += np.bincount(buckets, minlength=1 << bits)
        for lang, own in found.items():
            (filled,) = own.nonzero()
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * len(filled), "bucket": filled, "n": own[filled]}
            )

    partial = labelled.select("lang", "text").mapInArrow(counts, "lang string, bucket long, n long")
    rows = partial.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(rows["lang"].to_pylist(), object)
    languages = sorted(set(names))
    table = np.full((1 << bits, len(languages)), smoothing)
    if languages:
        position = {lang: i for i, lang in enumerate(languages)}
        table[rows["bucket"].to_numpy(), [position[x] for x in names]] += rows["n"].to_numpy()
    return languages, np.log(table / table.sum(axis=0))


def identify(
    text: str | None, languages: list[str], table: np.ndarray, bits: int, longest: int
) -> tuple[str, float]:
    if not languages or not has_letter(text):
        return UNKNOWN, 0.0
    total = np.zeros(len(languages))
    for buckets in ngram_buckets(text, bits, longest):
        total += table[buckets].sum(axis=0, dtype=np.float64)
    best = int(total.argmax())
    return languages[best], float(1 / np.exp(total - total[best]).sum())


def predict_language(
    docs: DataFrame,
    learn_from: Column,
    bits: int = 16,
    longest: int = 3,
    smoothing: float = 0.5,
    sample_rows: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Per row: doc_id, lang_pred, score (the posterior of the language).

    ``learn_from`` is a condition on ``doc_id`` that marks rows whose language
    may be used. The counts are fitted on about ``sample_rows`` of those that
    have a language and a letter, all of them if there are fewer; a language's
    prior is uniform. The table of log probabilities (2**bits rows, one column
    per language, at most 500 of them) is sent to the executors, which score
    whole texts with numpy.

    A NULL or letterless text, and any text if nothing could be learned, gives
    'und' with score 0. A NULL id stays and is not learned from; equal scores
    go to the language first in code-point order; repeated rows each give a
    row; an empty table gives an empty one; further columns are left out.
    """
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).withColumn(
        "text", F.col("text").cast("string")
    )
    known = rows.filter(learn_from & F.col("lang").isNotNull())
    chosen = bounded_sample(known.select("doc_id", "lang", "text"), "doc_id", sample_rows)
    languages, table = fit(
        chosen.filter(F.col("text").rlike(r"\p{L}")), bits, longest, smoothing
    )
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"{len(languages)} languages: the table would grow past its bound")
    sent = docs.sparkSession.sparkContext.broadcast(table.astype(np.float32))

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        found = [identify(t.as_py(), languages, sent.value, bits, longest) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
            ["lang_pred", "score"],
        )

    return rows.select("doc_id", predict("text").alias("found")).select("doc_id", "found.*")
