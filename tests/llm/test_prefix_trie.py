"""The trie of rebuilt conversations against one that rebuilds the texts."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tabloom.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt_texts(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(found)] for c, found in turns.items()}
    result = {}
    for conv in turns:
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - (abs(conv) % 5) * (1 if conv >= 0 else -1)
        result[conv] = tuple(turns.get(base, [])[:h] + turns[conv][h:])
    return result


def brute(rows):
    texts = rebuilt_texts(rows)
    nodes = defaultdict(list)
    for conv, turns in texts.items():
        for depth in range(len(turns) + 1):
            nodes[turns[:depth]].append(conv)
    children = Counter(node[:-1] for node in nodes if node)
    leaves, saved = Counter(), Counter()
    for node, members in nodes.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += (len(members) - 1) * len(node[-1][1].encode()) if node else 0
    found = []
    for node, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(texts[c]) == len(node))
        parent = min(nodes[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        found.append(
            (min(members), len(node), parent, len(members), children[node], leaves[node], saved[node], sha)
        )
    return sorted(found, key=str)


def run(spark, rows, **options):
    found = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), **options)
    return sorted(map(tuple, found.collect()), key=str)


def talks(seed=3, convs=60):
    """Few texts, so prefixes are shared between families too."""
    draw = random.Random(seed)
    ids = draw.sample(range(-40, 200), convs)
    rows = []
    for conv in ids:
        for turn in range(draw.choice([1, 2, 4, 9, 14])):
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", draw.choice(["a", "b", "ü", ""])))
    return rows


def test_equals_rebuilt_texts(spark):
    rows = talks()
    assert run(spark, rows) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = talks(5, 30)
    rows += [
        (None, 0, "user", "no conversation"),
        (300, None, None, None),
        (300, None, "user", "first"),
        (300, 0, "user", "x" * 50_000),
        (300, 0, "user", "x" * 50_000),
        (300, 0, "assistant", "x"),
        (301, 7, None, "tie"),
        (301, 7, "user", None),
        # No base, and fewer turns than the head replaces.
        (401, 0, "user", "gone"),
        (403, 0, "user", "gone"),
    ]
    assert run(spark, rows) == brute(rows)


def test_long_conversations_fill_several_tasks(spark, monkeypatch):
    """Half of all rows in one conversation, whose sums go over several blocks."""
    monkeypatch.setattr(trie, "DEPTHS", 16)
    monkeypatch.setattr(trie, "CHUNK", 60)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = talks(7, 40)
    rows += [(10, 100 + i, "user", f"{i % 3}") for i in range(300)]
    rows += [(500 + i, 0, "user", "all alike") for i in range(100)]
    turns = spark.createDataFrame(rows, SCHEMA)
    numbered = trie.identified(turns.withColumn("bytes", F.lit(0).cast("long")), F.xxhash64("role", "text"))
    try:
        placed = trie.placed(numbered, trie.BASES[0])
        assert placed.filter("hot").count() >= 300
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equal_hashes_are_told_apart(spark):
    rows = talks(11, 30)
    assert run(spark, rows, digest=F.length("text").cast("long")) == brute(rows)


def test_colliding_fingerprints_are_seen(spark, monkeypatch):
    """A prime so small that prefixes collide: another base is tried, then it is an error."""
    monkeypatch.setattr(trie, "PRIME", 31)
    monkeypatch.setattr(trie, "BASES", (3,))
    with pytest.raises(RuntimeError, match="collide"):
        run(spark, talks(13, 40))


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    rows = talks(17, 10)
    table = spark.createDataFrame(rows, SCHEMA)
    wide = table.select("*", F.lit(1).alias("Text"), F.lit("x").alias("text"), F.lit(2).alias("depth"))
    assert sorted(map(tuple, trie.prefix_trie(wide).collect()), key=str) == brute(rows)
    assert run(spark, [(5, 0, "user", "one")]) == brute([(5, 0, "user", "one")])
