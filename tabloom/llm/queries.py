"""The queries that apply the operators to the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import decontamination, language_id, near_dedup, packing, personal_data, prefix_trie
from tabloom.llm import quality, substring_dedup, token_counts, topk, toxicity, url_filter, whitening
from tabloom.llm.common import id_bucket

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer("piece_bpe_32k.model")
    return token_counts.token_counts(read(spark, sf_dir, "documents"), model, 4096)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(read(spark, sf_dir, "pages"), rules)


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = id_bucket("doc_id", 3)
    found = toxicity.score_toxicity(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), bucket != 1
    )
    return found.select(
        "doc_id",
        F.coalesce(bucket == 1, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
        F.size("offending").alias("n_offending"),
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(read(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = id_bucket("doc_id", 5)
    found = quality.score_quality(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), bucket != 0
    )
    return found.withColumn("held_out", F.coalesce(bucket == 0, F.lit(False)))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = id_bucket("doc_id", 4)
    found = language_id.predict_language(read(spark, sf_dir, "documents"), bucket != 2)
    return found.withColumn("held_out", F.coalesce(bucket == 2, F.lit(False)))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["by_rule"])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in personal_data.KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_added"),
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_token_counts,
        op3_url_filter,
        op4_topk_search,
        op5_toxicity,
        op6_substring_dedup,
        op7_quality,
        op8_language_id,
        op9_near_dedup,
        op10_packing,
        op11_personal_data,
        op12_embedding_whitening,
        op13_prefix_trie,
    )
}

ORACLE = {
    "op1_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
      array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS span
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS span
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM d CROSS JOIN (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw USING (n, span)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op3_url_filter": r"""
WITH p AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
r(rhost, rpath, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (SELECT p.*, rhost || rpath AS rule, v, row_number() OVER (
      PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) AS k
    FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1""",
    "op9_near_dedup": r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 3) - 1], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
    GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
    WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM t UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT m.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, m.doc_id = component_id AS kept
FROM m LEFT JOIN n USING (doc_id)""",
    "op4_topk_search": """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings WHERE embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c AS (SELECT r, vec_id, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM v),
s AS (SELECT q.r AS q, c.r, q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM c q JOIN c ON q.i = c.i AND q.r <> c.r WHERE q.vec_id % 50 = 0 GROUP BY ALL),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5""",
    "op13_prefix_trie": """
WITH o AS (SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
c AS (SELECT conv_id, t, CAST(xor(4294967295::BIGINT, list_reduce(
      list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda a, b: list_reduce(range(8::BIGINT), lambda x, i: xor(x >> 1, CASE WHEN (x & 1) = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END),
        CAST(xor(a, b) AS BIGINT)), 4294967295::BIGINT)) % 9 AS INTEGER) AS h FROM o),
r AS (SELECT c.conv_id, coalesce(b.t[1:c.h], []) || c.t[c.h + 1:] AS t
    FROM c LEFT JOIN o b ON b.conv_id = c.conv_id - c.conv_id % 5),
p AS (SELECT conv_id, len(t) AS n, d, t[1:d] AS k FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM r)),
n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs,
      coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends
    FROM p GROUP BY k, d),
y AS (SELECT k[1:d - 1] AS k1, d - 1 AS d1, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
g AS (SELECT n.*, u.conv_id AS parent_conv_id, coalesce(n_children, 0) AS n_children,
      (n.n_convs - 1) * coalesce(strlen(n.k[-1].t), 0) AS saved
    FROM n LEFT JOIN y ON d1 = n.d AND k1 = n.k LEFT JOIN n u ON u.d = n.d - 1 AND u.k = n.k[1:n.d - 1]),
s AS (SELECT k[1:i] AS k, i AS d, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT k, n_children, saved, unnest(range(0, d + 1)) AS i FROM g) GROUP BY ALL)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM g JOIN s USING (k, d)""",
}
