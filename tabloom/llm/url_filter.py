"""URL filtering by listed canonical URLs: a blocked Bloom filter, then an exact join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import LOWER, UPPER, pick
from tabloom.session import materialise

#: A block is this many words of 64 bits; a key sets one bit in each.
WORDS = 4
KEYS_PER_BLOCK = 16
#: Up to this many blocks (40 bytes each) are broadcast, and listed keys joined
#: by broadcast; beyond it both joins shuffle.
MOST_BLOCKS = 500_000
MOST_BROADCAST_KEYS = 100_000
SEPARATOR = "\x01"


def host_of(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end, A-Z in lower case."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to '?', '#' or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def bloom_hash(key: Column) -> Column:
    return F.xxhash64(key, F.lit(17))


def block_of(hashed: Column, blocks: int) -> Column:
    return F.pmod(hashed, F.lit(blocks))


def bit(hashed: Column, word: int) -> Column:
    """The one bit that a key sets in this word of its block."""
    position = F.shiftrightunsigned(hashed, 20 + 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), position)


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter's blocks as rows: block, w0 .. w3. Built by OR per block."""
    hashed = keys.select(bloom_hash(F.col("key")).alias("h"))
    return hashed.groupBy(block_of(F.col("h"), blocks).alias("block")).agg(
        *[F.bit_or(bit(F.col("h"), i)).alias(f"w{i}") for i in range(WORDS)]
    )


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Per row: page_id, host, path, rule (like ``example.com/de/``, or NULL), verdict.

    ``listed`` has host, path and verdict ('block' or 'allow') per rule. A rule
    fits its host and all its subdomains, if the URL's path starts with the
    rule's. The longest rule wins; of equally long ones that with the longer
    host; a host and path listed with both verdicts blocks. Without a rule the
    verdict is ``default``, that of an unlisted URL.

    A rule is a canonical key of host and path. A distinct URL gives the keys
    of the rules that could fit it (its host and parent domains with its path's
    beginnings of the lengths that rules have). A blocked Bloom filter over the
    listed keys (16 bits a key) lets possible hits pass; an exact join with the
    list removes the false ones. Verdicts then join back to the rows.

    A NULL URL or one without '://' has an empty host and path, which no rule
    fits. A NULL id stays; repeated rows each give a row; an empty table or
    list is fine; rules with a NULL are ignored; further columns are left out.
    """
    rules = (
        pick(listed, host="host", path="path", verdict="verdict")
        .dropna()
        .filter("host <> ''")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("key", F.concat("host", F.lit(SEPARATOR), "path"))
    )
    rules = materialise(rules)
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().limit(10_001).collect())
    if len(lengths) > 10_000:
        raise ValueError("more than 10000 lengths of rule paths")
    n_rules = rules.count()
    blocks = n_rules // KEYS_PER_BLOCK + 1
    bloom = bloom_filter(rules, blocks)
    if blocks <= MOST_BLOCKS:
        bloom = F.broadcast(bloom)
    exact = rules.withColumnRenamed("key", "listed_key").select("listed_key", "verdict")
    if n_rules <= MOST_BROADCAST_KEYS:
        exact = F.broadcast(exact)

    rows = pick(pages, page_id=id_col, url=url_col).withColumn("url", F.col("url").cast("string"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    beginnings = F.transform(
        F.filter(
            F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path")
        ),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    keys = (
        rows.filter("host <> ''")
        .select("host", "path")
        .distinct()
        .withColumn("domain", F.explode(domains))
        .withColumn("beginning", F.explode(beginnings))
        .withColumn("key", F.concat("domain", F.lit(SEPARATOR), "beginning"))
        .withColumn("h", bloom_hash(F.col("key")))
        .withColumn("block", block_of(F.col("h"), blocks))
    )
    possible = keys.join(bloom, "block")
    for i in range(WORDS):
        own = bit(F.col("h"), i)
        possible = possible.filter(F.col(f"w{i}").bitwiseAND(own) == own)
    hits = possible.join(exact, F.col("key") == F.col("listed_key"))
    fitting = F.struct(
        (F.length("domain") + F.length("beginning")).alias("size"),
        F.length("domain").alias("host_size"),
        F.concat("domain", "beginning").alias("rule"),
        "verdict",
    )
    judged = hits.groupBy("host", "path").agg(F.max(fitting).alias("best"))
    return rows.join(judged, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )
