"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabloom.session import materialise

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
ASCII_LOWER = str.maketrans(UPPER, LOWER)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, as ``new_name="name"``.

    Takes each by its exact name and first position, so further columns whose
    names are equal or differ in case only do no harm.
    """
    names = list(df.columns)
    plain = df.toDF(*[f"_{i}" for i in range(len(names))])
    return plain.select(
        *[plain[f"_{names.index(source)}"].alias(new) for new, source in columns.items()]
    )


def id_bucket(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string")) % parts


def bounded_sample(keyed: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows of ``keyed``, all of them if there are fewer.

    Rows are taken by a hash of ``key``, so the choice is the same in every run
    and the bound, not the size of the table, decides how many come.
    """
    total = keyed.count()
    if total <= rows:
        return keyed
    share = int(rows / total * 1_000_003)
    return keyed.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1_000_003)) < share)


def sampled_texts(rows: DataFrame, ids: DataFrame, chars: int) -> DataFrame:
    """doc_id, label, text of ``ids`` (doc_id, label; a bounded sample): the least text of each id.

    ``chars`` bounds the characters of all texts together: ids are taken by a
    hash while their texts fit, so neither an id of many rows nor very long
    texts can fill the memory of the task that fits a model on them.
    """
    texts = materialise(
        rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    )
    # One window over the sample's lengths, of which there are as many as ids.
    upto = W.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(W.unboundedPreceding, 0)
    lengths = texts.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n"))
    fitting = lengths.filter(F.col("n") <= chars).withColumn("upto", F.sum("n").over(upto))
    fitting = fitting.filter(F.col("upto") <= chars)
    return texts.join(F.broadcast(fitting.select("doc_id")), "doc_id", "left_semi")


def with_text_ids(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (doc_id, a long, and text) with text_id; and doc_id, digest, text_id of each text.

    A text_id names one text of one id, and ascends with the id, then with the
    text's digest. Where each id has one text it is the id. Rows without id
    have none.
    """
    digest = F.xxhash64("text").alias("digest")
    known = rows.filter(F.col("doc_id").isNotNull()).select("doc_id", digest).distinct()
    known = materialise(known)
    if known.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return rows.withColumn("text_id", F.col("doc_id")), known.withColumn("text_id", F.col("doc_id"))
    # Numbers by partition, then row, of a table in order ascend with it.
    known = materialise(
        known.repartitionByRange("doc_id", "digest")
        .sortWithinPartitions("doc_id", "digest")
        .withColumn("text_id", F.monotonically_increasing_id())
    )
    keyed = rows.withColumn("digest", digest).join(known, ["doc_id", "digest"], "left")
    return keyed.select(*rows.columns, "text_id"), known
