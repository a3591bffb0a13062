"""Benchmark decontamination by winnowing, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabloom.llm.common import LOWER, UPPER, pick
from tabloom.session import materialise

#: Words are runs of what is not one of these, after lower-casing A-Z.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Tables of the benchmark up to this many rows and characters are broadcast.
MOST_ROWS = 1_000_000
MOST_CHARS = 64_000_000


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, NOT_WORD), lambda w: w != "")


def gram_hashes(df: DataFrame, n: int) -> DataFrame:
    """Adds ``grams``: the hash of the ``n`` words from each position on."""
    last = F.size("hashes") - n
    hashed = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(F.lit(n), *[F.get("hashes", i + j) for j in range(n)]),
    )
    return df.withColumn("grams", F.when(last >= 0, hashed).otherwise(F.array().cast("array<bigint>")))


def window_keys(df: DataFrame, length: int, window: int, gram: int) -> DataFrame:
    """Adds ``keys``: for each span of ``length`` words from its start, what it is looked up by.

    A span of the full window has its minimum k-gram hash, the fingerprint that
    winnowing keeps: neighbouring spans mostly share it, equal spans always
    do. A shorter one, of an item with few words, has the hash of all its words.
    """
    hashed = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    if length < window:
        return gram_hashes(hashed, length).withColumn("keys", F.col("grams")).drop("hashes", "grams")
    grams = window - gram + 1
    last = F.size("grams") - grams
    least = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.least(*[F.get("grams", i + j) for j in range(grams)]),
    )
    keys = F.when(last >= 0, least).otherwise(F.array().cast("array<bigint>"))
    return gram_hashes(hashed, gram).withColumn("keys", keys).drop("hashes", "grams")


def span_text(words: str, start: Column, length: int) -> Column:
    return F.array_join(F.slice(words, start + 1, length), " ")


def small(df: DataFrame, chars: Column) -> bool:
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(chars), F.lit(0))).first()
    return rows <= MOST_ROWS and size <= MOST_CHARS


def item_spans(items: DataFrame, window: int, gram: int) -> DataFrame:
    """item_id, length, key, span: every window of every item."""
    worded = (
        pick(items, item_id="item_id", text="text")
        .filter(F.col("item_id").isNotNull())
        .select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
        .withColumn("length", F.least(F.size("words"), F.lit(window)))
        .filter("length > 0")
    )
    worded = materialise(worded)
    parts = []
    for length in sorted(r[0] for r in worded.select("length").distinct().collect()):
        keyed = window_keys(worded.filter(F.col("length") == length), length, window, gram)
        # A bare column would be filtered for emptiness first, computing it anew.
        each = F.posexplode(F.concat("keys", F.array().cast("array<bigint>"))).alias("start", "key")
        parts.append(
            keyed.select("item_id", "length", "words", each).select(
                "item_id", "length", "key", span_text("words", F.col("start"), length).alias("span")
            )
        )
    if not parts:
        return worded.select("item_id", "length", F.lit(0).cast("long").alias("key"), F.lit("").alias("span"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.distinct()


def matched_spans(docs: DataFrame, spans: DataFrame, length: int, window: int, gram: int) -> DataFrame:
    """doc_id, digest, n_words, start, span: spans of documents that some item has.

    Each document also has a row with start -1 that carries its word count.
    ``docs`` has doc_id, digest and words.
    """
    own = spans.filter(F.col("length") == length)
    keys, texts = own.select("key").distinct(), own.select("span").distinct()
    keyed = window_keys(docs, length, window, gram)
    if small(texts, F.length("span")):
        # All of the benchmark goes to the documents: one pass without a shuffle.
        keys = F.broadcast(keys.withColumnRenamed("key", "listed"))
        texts = F.broadcast(texts.withColumnRenamed("span", "known"))
    else:
        # Fingerprints meet by a shuffle of distinct ones per document; spans
        # are then read out of the documents that have a hit.
        prints = keyed.select("doc_id", "digest", F.explode(F.array_distinct("keys")).alias("key"))
        hits = (
            prints.join(keys, "key")
            .groupBy("doc_id", "digest")
            .agg(F.collect_set("key").alias("hits"))
            .select(F.col("doc_id").alias("d"), F.col("digest").alias("g"), "hits")
        )
        keyed = keyed.join(hits, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g")), "left")
        hit = F.coalesce("hits", F.array().cast("array<bigint>"))
        keyed = keyed.withColumn(
            "keys", F.transform("keys", lambda k: F.when(F.array_contains(hit, k), k))
        ).drop("d", "g", "hits")
        keys = None
        texts = texts.withColumnRenamed("span", "known")
    marked = F.concat(F.array(F.lit(None).cast("long")), "keys")
    rows = keyed.select("doc_id", "digest", "words", F.posexplode(marked).alias("at", "key"))
    if keys is not None:
        rows = rows.join(keys, F.col("key") == F.col("listed"), "left").filter("at = 0 or listed is not null")
    else:
        rows = rows.filter("at = 0 or key is not null")
    rows = rows.select(
        "doc_id",
        "digest",
        F.when(F.col("at") == 0, F.size("words")).alias("n_words"),
        (F.col("at") - 1).alias("start"),
        F.when(F.col("at") > 0, span_text("words", F.col("at") - 1, length)).alias("span"),
    )
    known = rows.filter("start >= 0").join(texts, F.col("span") == F.col("known")) if keys is None else None
    if known is not None:
        return rows.filter("start < 0").unionByName(known.drop("known"))
    return (
        rows.join(texts, F.col("span") == F.col("known"), "left")
        .filter("start < 0 or known is not null")
        .drop("known")
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    gram: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, item_ids (sorted as strings), spans.

    A window is ``window`` consecutive words of an item; an item of fewer words
    is one window as a whole. A document's word inside an occurrence of a window
    is hit; ``spans`` lists the hit stretches (first word, word after the last)
    and ``item_ids`` the items with an occurring window.

    Every window keeps the minimum of its k-gram hashes (winnowing with windows
    of ``window`` - ``gram`` + 1 hashes). Equal windows keep equal minima, so
    every shared span of ``window`` words meets in a join on them; the spans
    around a hit are then compared word by word. With a benchmark within the
    stated bounds this is one pass over the documents.

    A NULL, empty or wordless text has no words. Items without id, text or
    words have no windows; equal ids are one item. A NULL doc_id stays;
    repeated rows each give a row; empty tables are fine; further columns are
    left out.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    worded = rows.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"),
        words_of(F.col("text")).alias("words"),
    )
    spans = materialise(item_spans(items, window, gram))
    lengths = sorted((r[0] for r in spans.select("length").distinct().collect()), reverse=True)
    found = None
    for length in lengths or [window]:
        part = matched_spans(worded, spans, length, window, gram)
        part = part.withColumn("end", F.col("start") + length)
        found = part if found is None else found.unionByName(part.filter("start >= 0"))
    found = materialise(found)

    same = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (
        F.col(f"{a}.digest") == F.col(f"{b}.digest")
    )
    base = found.filter("start < 0").select("doc_id", "digest", F.col("n_words").cast("long")).alias("base")
    hits = found.filter("start >= 0")
    before = W.partitionBy("doc_id", "digest").orderBy("start", "end")
    before = before.rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("doc_id", "digest").orderBy("start", "end").rowsBetween(W.unboundedPreceding, 0)
    stretches = (
        hits.select("doc_id", "digest", "start", "end")
        .distinct()
        .withColumn("reached", F.max("end").over(before))
        .withColumn("opens", F.when(F.col("start") <= F.col("reached"), 0).otherwise(1))
        .withColumn("stretch", F.sum("opens").over(upto))
        .groupBy("doc_id", "digest", "stretch")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("doc_id", "digest")
        .agg(
            F.sum(F.col("end") - F.col("start")).alias("n_hit"),
            F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"),
        )
        .alias("hit")
    )
    by_span = spans.select("item_id", "span").distinct()
    of_items = (
        hits.select("doc_id", "digest", "span")
        .distinct()
        .join(by_span, "span")
        .groupBy("doc_id", "digest")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
        .alias("item")
    )
    return (
        base.join(stretches, same("base", "hit"), "left")
        .join(of_items, same("base", "item"), "left")
        .select(
            F.col("base.doc_id").alias("doc_id"),
            F.col("base.n_words").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        )
    )
