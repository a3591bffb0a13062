"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables, odd columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import (
    common,
    decontamination,
    language_id,
    near_dedup,
    packing,
    quality,
    substring_dedup,
    token_counts,
    topk,
    toxicity,
    url_filter,
)
from tabloom.llm.queries import tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
ROWS = [
    (1, "A plain sentence, with some words in it.", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (None, "no id here at all", "en", None, 3),
    (4, LONG, "en", "a", 1),
    (5, "same text twice over", "fr", "a", 1),
    (5, "same text twice over", "fr", "a", 1),
    (6, "same text twice over", "fr", "b", 1),
    (7, " \n\t ", "de", "b", 1),
    (8, "日本語 \U0001d4b3 ﬁ \u200d 123", None, "b", 1),
]
LABELS = [(1, 1, 0), (3, 0, 1), (5, 1, 1), (5, 1, 0), (None, 1, 1), (6, None, None), (8, 1, 0)]
ITEMS = [(1, "with some words"), (2, None), (None, "same text twice over"), (3, ""), (1, "with some words"),
         (4, "w0x0 w1x1 w2x2 w3x3 w4x4 w5x5 w6x6 w7x7 w8x8 w9x9 w10x10")]


def learn():
    return F.col("doc_id").isNotNull()


def operators():
    """Name, and what runs it over documents, labels and items."""
    return {
        "decontamination": lambda d, l, i: decontamination.contamination(d, i),
        "token_counts": lambda d, l, i: token_counts.token_counts(d, tokenizer("piece_bpe_32k.model"), 4),
        "toxicity": lambda d, l, i: toxicity.score_toxicity(d, l, learn()),
        "quality": lambda d, l, i: quality.score_quality(d, l, learn()),
        "language_id": lambda d, l, i: language_id.predict_language(d, learn()),
        "near_dedup": lambda d, l, i: near_dedup.near_duplicates(d),
        "packing": lambda d, l, i: packing.pack(d, tokenizer("byte_bpe_50k.json"), 64),
        "substring_dedup": lambda d, l, i: substring_dedup.repeated_passages(d),
    }


def tables(spark, rows=ROWS, labels=LABELS, items=ITEMS):
    return (
        spark.createDataFrame(rows, SCHEMA),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def values(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def plain(spark):
    return {name: values(run(*tables(spark))) for name, run in operators().items()}


@pytest.mark.parametrize("name", operators())
def test_one_row_per_row(plain, name):
    """Every row, repeated ones and those without text or id too, has its result."""
    per_row = {"decontamination", "token_counts", "toxicity", "quality", "language_id", "near_dedup"}
    if name in per_row:
        # A repeated row of the same id and text counts once where rows are keyed.
        assert len(plain[name]) == len(ROWS)


@pytest.mark.parametrize("name", operators())
def test_columns_that_clash(spark, plain, name):
    docs, labels, items = tables(spark)
    names = ["TEXT", "text_b", "score", "n", "component", "digest", "key", "n_words", "words", "Doc_Id", "start"]
    for df_name in names:
        docs = docs.withColumn(df_name + " ", F.lit(1)) if df_name.lower() in ("text", "doc_id") else docs.withColumn(df_name, F.lit("x"))
    odd = docs.toDF(*[c.strip() for c in docs.columns])
    assert values(operators()[name](odd, labels.withColumn("Label", F.lit(7)), items.select("*", F.lit(1).alias("Text")))) == plain[name]


@pytest.mark.parametrize("name", operators())
def test_empty_tables(spark, name):
    docs, labels, items = tables(spark, [], [], [])
    assert operators()[name](docs, labels, items).collect() == []


@pytest.mark.parametrize("name", ["decontamination", "toxicity", "quality"])
def test_nothing_to_learn_from(spark, name):
    docs, labels, items = tables(spark, labels=[], items=[])
    assert operators()[name](docs, labels, items).count() == len(ROWS)


@pytest.mark.parametrize("name", operators())
def test_partitions_do_not_matter(spark, plain, name):
    if name == "packing":
        pytest.skip("numbers of equal pieces may change hands")
    docs, labels, items = tables(spark)
    assert values(operators()[name](docs.repartition(7), labels.repartition(3), items)) == plain[name]


def test_url_edges(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://Example.COM/de/x?y"),
            (2, None),
            (3, "no scheme"),
            (4, "https://a.b.example.net/en/1#f"),
            (5, "https://example.net/e"),
            (None, "https://x.net"),
            (6, "https://x.net/"),
            (6, "https://x.net/"),
            (7, "http://notexample.com/de/"),
            (8, "ftp://a?b://net/"),
            (9, "://net/q"),
        ],
        "page_id long, url string",
    ).withColumn("PATH", F.lit(1)).withColumn("verdict", F.lit(2))
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), (None, "/", "block"),
         ("net", "/", "allow")],
        "host string, path string, verdict string",
    )
    found = sorted(tuple(r) for r in url_filter.filter_urls(pages, rules).filter("page_id is not null").collect())
    assert found == [
        (1, "example.com", "/de/x", "example.com/de/", "block"),
        (2, "", "", None, "allow"),
        (3, "", "", None, "allow"),
        (4, "a.b.example.net", "/en/1", "example.net/en/", "allow"),
        (5, "example.net", "/e", "net/", "block"),
        (6, "x.net", "/", "net/", "block"),
        (6, "x.net", "/", "net/", "block"),
        (7, "notexample.com", "/de/", None, "allow"),
        (8, "a", "", None, "allow"),
        (9, "net", "/q", "net/", "block"),
    ]
    assert url_filter.filter_urls(pages, rules).filter("page_id is null").first()["verdict"] == "allow"
    assert {r.verdict for r in url_filter.filter_urls(pages, rules.limit(0)).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.limit(0), rules).collect() == []


def test_vector_edges(spark):
    rows = [
        (0, [0.5, 0.5]),
        (1, [0.5, 0.5]),
        (2, [0.5]),
        (3, None),
        (4, [None, 1.0]),
        (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]),
        (None, [1.0, 1.0]),
        (50, [-1.0, 0.25]),
        (50, [-1.0, 0.25]),
        (7, []),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("V", F.lit(1))
    found = [tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert found == [
        (0, 1, 1, 32768),
        (0, 2, 2, 16384),
        (0, 3, 7, 0),
        (0, 4, 50, -24576),
        (0, 5, 50, -24576),
    ] + [
        # Two equal rows of one id are queries and candidates, each for the other.
        row
        for row in [(50, 1, 50, 69632), (50, 2, 7, 0), (50, 3, 0, -24576), (50, 4, 1, -24576), (50, 5, 2, -32768)]
        for _ in range(2)
    ]
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_rows_that_repeat_an_id_are_searched_by_themselves(spark):
    rng = np.random.default_rng(12)
    distinct = [(int(i), rng.integers(-3, 4, 4).astype(float).tolist()) for i in rng.integers(0, 6, 40)]
    rows = [(50 * i, v) for i, v in distinct for _ in range(int(rng.integers(1, 10)))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = topk.top_k(vectors, F.col("vec_id") % 100 == 0, k=3, scale=1).collect()
    expected = []
    for n, (own, query) in enumerate(rows):
        if own % 100 == 0:
            others = [(-int(np.dot(query, v)), i) for m, (i, v) in enumerate(rows) if m != n]
            expected += [(own, rank, i, -s) for rank, (s, i) in enumerate(sorted(others)[:3], 1)]
    assert sorted(tuple(r) for r in found) == sorted(expected)


def test_counts_of_a_very_long_token_are_whole():
    for n in (100, 40_000, 200_000):
        at, values = quality.features("a" * n + "7" * n + "-" * n)
        rates = dict(zip(at.tolist(), values.tolist()))
        first = 1 << quality.BITS
        assert [round(rates[first + i], 4) for i in (5, 6, 7)] == [0.3333] * 3


def test_held_out_rows_have_no_part_in_the_quality_fit(spark):
    docs = [(i, f"plain words number {i} in a row" if i % 3 else f"$$ {i} 00 ##") for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    kept_out = F.col("doc_id") % 5 != 0

    def scores(rows, marks):
        table = spark.createDataFrame(rows, "doc_id long, text string")
        found = quality.score_quality(table, marks, kept_out).filter("doc_id % 5 > 0").collect()
        return sorted((r.doc_id, r.score) for r in found)

    plain = scores(docs, labels)
    other = [(i, t if i % 5 else "quite another text") for i, t in docs]
    assert plain == scores(other, labels)
    assert plain == scores(docs, labels.filter(kept_out))


def test_samples_are_bounded_in_rows_and_characters(spark):
    rows = spark.range(200).select((F.col("id") % 2).alias("doc_id"), F.format_string("text %d", "id").alias("text"))
    rows = rows.union(spark.createDataFrame([(2, "x" * 5000), (3, None)], "doc_id long, text string"))
    ids = spark.createDataFrame([(i, 1) for i in range(4)], "doc_id long, label int")
    found = common.sampled_texts(rows, ids, 1000).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == [(0, 1, "text 0"), (1, 1, "text 1"), (3, 1, None)]
    few = common.sampled_texts(rows, ids, 6).collect()
    assert few and sum(len(r.text or "") for r in few) <= 6


def test_passages_of_ids_with_several_texts(spark):
    """Words are cut from the text that repeats them, not from another text of its id."""
    p, q, other = (" ".join(f"{x}{i}" for i in range(n)) for x, n in (("p", 60), ("q", 70), ("o", 80)))
    rows = [(1, p), (2, p + " tail"), (2, other), (2, p + " tail"), (3, q), (3, "head " + q), (None, p), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = substring_dedup.repeated_passages(docs)
    places = found.select("doc_id", "start", "end", "source_id", "source_start", "source_end").collect()
    places = sorted(tuple(r) for r in places)
    assert places[0] == (2, 0, 60, 1, 0, 60)
    assert places[1:] in ([(3, 0, 70, 3, 1, 71)], [(3, 1, 71, 3, 0, 70)])
    assert found.filter("digest = source_digest").isEmpty()
    left = sorted((r.doc_id or 0, (r.text or "").strip()) for r in substring_dedup.without_passages(docs, found).collect())
    assert left[:5] == [(0, p), (1, p), (2, other), (2, "tail"), (2, "tail")]
    assert left[5:] in ([(3, ""), (3, "head " + q), (4, "")], [(3, "head"), (3, q), (4, "")])
    nothing = docs.limit(0)
    assert substring_dedup.without_passages(nothing, substring_dedup.repeated_passages(nothing)).collect() == []


STAGE_ROWS = [
    (1, " ".join(f"p{i}" for i in range(60)), "en", "a", 10),
    (2, " ".join(f"p{i}" for i in range(60)) + " tail", "en", "a", 10),
    (2, " ".join(f"o{i}" for i in range(80)), "en", "a", 10),
    (3, " ".join(f"b{i}" for i in range(12)) + " end", "en", "a", 10),
    (3, "a clean text of the same id", "en", "a", 10),
    (3, "a clean text of the same id", "en", "a", 10),
    (4, None, None, None, None),
    (5, "", "en", "a", 0),
    (None, "no id here at all", "en", "a", 10),
]


@pytest.fixture(scope="module")
def stage_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stages"))
    items = [(1, " ".join(f"b{i}" for i in range(12))), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return folder


def staged(spark, folder, name, rows=STAGE_ROWS):
    import corpus_pipeline

    docs = spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit(7)).withColumn("kept", F.lit(False))
    found = dict(corpus_pipeline.STAGES)[name](spark, docs.repartition(3), folder)
    if name != "packing":
        assert found.columns == docs.columns
    return sorted(((r.doc_id or 0, r.text or "") for r in found.select("doc_id", "text").collect())
                  if name != "packing" else ((r.doc_id or 0, r.doc_tokens) for r in found.collect()))


def test_stages_judge_each_text_of_an_id(spark, stage_dir):
    every = sorted((r[0] or 0, r[1] or "") for r in STAGE_ROWS)
    assert staged(spark, stage_dir, "quality") == every
    without_copy = [x for x in every if not x[1].endswith("tail")]
    assert staged(spark, stage_dir, "near_dedup") == without_copy
    cut = [(i, t.replace(STAGE_ROWS[0][1], "") if i == 2 else t) for i, t in every]
    assert sorted((i, t.strip()) for i, t in staged(spark, stage_dir, "substring_dedup")) == sorted(
        (i, t.strip()) for i, t in cut
    )
    assert staged(spark, stage_dir, "decontamination") == [x for x in every if not x[1].startswith("b0")]
    assert len(staged(spark, stage_dir, "packing")) >= len(every)


@pytest.mark.parametrize("name", ["quality", "near_dedup", "substring_dedup", "decontamination", "packing"])
def test_stages_on_empty_tables(spark, stage_dir, name):
    assert staged(spark, stage_dir, name, []) == []
