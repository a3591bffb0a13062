"""The operators against brute force, exact round trips and held-out rows."""

import random
import zlib
from itertools import combinations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabloom.llm import (
    decontamination,
    near_dedup,
    packing,
    queries,
    substring_dedup,
    token_counts,
    topk,
    url_filter,
)
from tabloom.llm.components import smallest_reachable
from tabloom.llm.shingles import hash_words, shingle_hashes

SMALL = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark embeddings labels".split()


@pytest.fixture(scope="module")
def small():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def rows_of(df):
    names = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in names) for r in df.collect())


@pytest.mark.parametrize("name", queries.ORACLE)
def test_queries_agree_with_sql(spark, small, name):
    found = queries.QUERIES[name](spark, SMALL)
    relation = small.sql(queries.ORACLE[name])
    order = sorted(range(len(relation.columns)), key=lambda i: relation.columns[i])
    assert sorted(found.columns) == sorted(relation.columns)
    assert rows_of(found) == sorted(tuple(str(r[i]) for i in order) for r in relation.fetchall())


def test_token_counts_equal_the_library(spark):
    import sentencepiece

    model = queries.tokenizer("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    rng = random.Random(4)
    letters = " ▁\n\t\r\x00aé日本𝒳thein,.<s>0x41  Ａﬁ\xa0"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    texts += ["", " ", "a" * 5000, " " * 700, "</s><unk><0x41>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in token_counts.token_counts(df, model, 10).collect()}
    for i, text in enumerate(texts):
        assert found[i].n_tokens == len(library.encode(text)), repr(text)
        assert found[i].n_bytes == len(text.encode())
        assert found[i].over_limit == (found[i].n_tokens > 10)
    whole = queries.op2_token_counts(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id")
    for row in whole.collect():
        assert row.n_tokens == len(library.encode(row.text))


def corpus(seed=1, n=60, words=60, vocabulary=400):
    rng = random.Random(seed)
    texts = [" ".join(f"t{rng.randrange(vocabulary)}" for _ in range(rng.randint(0, words))) for _ in range(n)]
    for i in range(0, n, 3):
        copy = texts[i].split()
        for _ in range(rng.randint(0, 2)):
            if copy:
                copy[rng.randrange(len(copy))] = "changed"
        texts.append(" ".join(copy))
    return texts


def brute_components(texts, size, similarity):
    sets = [set(shingle_hashes(hash_words(t.encode().lower().split()), size).tolist()) for t in texts]
    part = list(range(len(texts)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 100 * similarity * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            part[max(x, y)] = min(x, y)
    return [(i, len(sets[i]), root(i), root(i) == i) for i in range(len(texts))]


@pytest.mark.parametrize("crowded", [near_dedup.CROWDED, 1])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, crowded):
    """Also with a large group of near copies, in small blocks that bring their sets."""
    monkeypatch.setattr(near_dedup, "CROWDED", crowded)
    monkeypatch.setattr(near_dedup, "BLOCK", 8 if crowded == 1 else 1024)
    texts = corpus()
    rng = random.Random(9)
    base = [f"u{i}" for i in range(80)]
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = f"v{rng.randrange(50)}"
        texts.append(" ".join(copy))
    texts += ["one", "one", "one two", "ONE two", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted(tuple(r) for r in near_dedup.near_duplicates(df).collect())
    assert found == brute_components(texts, 3, 0.85)


def test_bands_for_lower_similarity():
    assert near_dedup.band_count(0.85) == near_dedup.BANDS
    for hundredths in range(78, 101):
        similarity = hundredths / 100
        assert (1 - similarity**near_dedup.ROWS) ** near_dedup.band_count(similarity) <= 5e-7


def test_near_duplicate_stage_takes_five_words_and_lower_similarity(spark):
    """A fifth of new text appended leaves a similarity of 0.83; 70 of 90 shingles (0.78) are too few."""
    import corpus_pipeline

    base = [f"b{i}" for i in range(104)]
    other = [f"o{i}" for i in range(74)]
    texts = [base, base + [f"n{i}" for i in range(20)], other, other + [f"m{i}" for i in range(20)]]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, SMALL).collect()) == [0, 2, 3]


def test_odd_sketch_lets_similar_sets_pass():
    rng = np.random.default_rng(3)
    most = near_dedup.most_different_bits(0.85)
    apart = []
    for _ in range(60):
        universe = rng.integers(0, 2**63, 600).astype(np.uint64)
        one, two = np.unique(universe[:545]), np.unique(universe[45:590])
        x, y = (near_dedup.odd_sketch(near_dedup.min_hashes(s)) for s in (one, two))
        alike = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
        bits = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
        assert alike < 0.85 or bits <= most
        far = near_dedup.odd_sketch(near_dedup.min_hashes(np.unique(universe[250:])))
        apart.append(int(np.bitwise_count((x ^ far).view(np.uint64)).sum()) > most)
    assert np.mean(apart) > 0.9


@pytest.mark.parametrize("shape", ["path", "star", "random", "two"])
def test_components(spark, shape):
    rng = random.Random(5)
    links = {
        "path": [(i, i + 1) for i in range(120)],
        "star": [(500, i) for i in range(100)],
        "random": [(rng.randrange(90), rng.randrange(90)) for _ in range(70)],
        "two": [(1, 2), (3, 4), (4, 5), (2, 2)],
    }[shape]
    part = {x: x for link in links for x in link}
    for _ in part:
        for a, b in links:
            part[a] = part[b] = min(part[a], part[b])
    found = smallest_reachable(spark.createDataFrame(links, "a long, b long"))
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.component for r in found.collect()} == {x: part[x] for x in linked}


def brute_windows(values, width):
    n = len(values)
    return {(i, j) for i in range(n) for j in range(i + width - 1, n)}


def test_compact_windows_cover_each_run_once():
    rng = np.random.default_rng(0)
    for k in range(200):
        n, width = int(rng.integers(1, 40)), int(rng.integers(1, 8))
        values = rng.integers(1, 9 if k % 2 else 10**9, n).astype(np.uint64)
        seen = []
        for low, centre, high in zip(*substring_dedup.compact_windows(values, width)):
            for i in range(low, centre + 1):
                for j in range(centre, high + 1):
                    if j - i + 1 >= width:
                        assert values[centre] == values[i : j + 1].min()
                        seen.append((i, j))
        assert len(seen) == len(set(seen)) and set(seen) == brute_windows(values, width)


def passage_docs(seed=2):
    """Documents of fresh words; shared passages of 60 words, some with a changed word."""
    rng = random.Random(seed)
    fresh = iter(range(10**9))
    own = lambda n: [f"f{next(fresh)}" for _ in range(n)]
    passages = [own(60) for _ in range(4)]
    docs, holds = [], []
    for i in range(60):
        words = own(rng.randint(0, 150))
        if i % 2:
            which, copy = rng.randrange(4), None
            copy = list(passages[which])
            if i % 4 == 1:
                copy[30] = f"f{next(fresh)}"
            at = rng.randint(0, len(words))
            words[at:at] = copy
            holds.append((i, which, at))
        docs.append(" ".join(words))
    return docs, holds


def test_repeated_passages(spark):
    texts, holds = passage_docs()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = substring_dedup.repeated_passages(df)
    rows = found.collect()
    first = {which: i for i, which, _ in reversed(holds)}
    for i, which, at in holds:
        own = [r for r in rows if r.doc_id == i]
        if first[which] == i:
            assert not own
        else:
            assert any(r.start <= at + 1 and r.end >= at + 59 for r in own), (i, which)
    holders = {i for i, _, _ in holds}
    assert {r.doc_id for r in rows} | {r.source_id for r in rows} <= holders
    assert all(r.similarity >= 0.8 and r.source_id < r.doc_id for r in rows)
    left = {r.doc_id: r.text for r in substring_dedup.without_passages(df, found).collect()}
    for i, text in enumerate(texts):
        if i not in holders:
            assert left[i] == text
    assert len(substring_dedup.repeated_passages(df.withColumn("text", F.lit("a b c " * 8))).collect()) == 0


def test_holders_with_other_windows_between_meet(spark):
    """The keys' smallest documents differ, and hold no passage; only the pair of keys links 5 and 9."""
    rng = random.Random(21)
    fresh = iter(range(10**9))
    own = lambda n: [f"g{next(fresh)}" for _ in range(n)]
    docs, wanted = {}, []
    for n in range(40):
        passage = own(58)
        base = 1000 * (n + 1)
        # Ten smaller documents share 20 words each of the passage, and with them its keys.
        for k in range(10):
            at = 4 * k if k < 9 else 38
            docs[base + k] = own(30) + passage[at : at + 20] + own(30)
        # Between the passage's windows the copy has others, of a changed word.
        copy = list(passage)
        copy[rng.randrange(20, 38)] = next(iter(own(1)))
        docs[base + 50] = own(rng.randint(0, 40)) + passage + own(20)
        docs[base + 90] = own(rng.randint(0, 40)) + copy + own(20)
        wanted.append((base + 90, base + 50))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs.items()], "doc_id long, text string")
    found = {(r.doc_id, r.source_id) for r in substring_dedup.repeated_passages(df).collect()}
    # Similarity is at least 49 / 59; two of five functions agree in 995 of 1000 such pairs.
    assert len(found & set(wanted)) >= 39 and found <= set(wanted)


def test_window_pairs_are_those_with_a_run_in_common():
    rng = np.random.default_rng(5)
    for k in range(60):
        n, width = int(rng.integers(8, 40)), int(rng.integers(2, 8))
        rows = []
        for f in range(3):
            values = rng.integers(1, 6 if k % 2 else 10**9, n).astype(np.uint64)
            rows += [(c, lo, hi, f) for lo, c, hi in zip(*substring_dedup.compact_windows(values, width))]
        rows.sort()
        keys = list(range(100, 100 + len(rows)))
        batch = pa.RecordBatch.from_pydict(
            {"doc": [7] * len(rows), "key": pa.array(keys, pa.int64()), "l": [x[1] for x in rows],
             "c": [x[0] for x in rows], "r": [x[2] for x in rows], "open": [False] * len(rows)}
        )
        found = [t for b in substring_dedup.window_pairs(width)(iter([batch])) for t in b.to_pylist()]
        wanted = set()
        for (c, lo, hi, f), (d, low, high, g) in combinations(rows, 2):
            start, end = max(lo, low), min(hi, high)
            if start <= min(c, d) and max(c, d) <= end and end - start + 1 >= width:
                assert f != g
                wanted.add((min(c, d), max(c, d), min(c, d) - start, end - max(c, d)))
        assert len(found) >= len(wanted)
        assert {(t["low"], t["high"], t["before"], t["after"]) for t in found} == wanted


def test_enough_functions_for_least_similar_passages():
    """Of sets of 45 shingles each with 40 in common (similarity 0.8), at most 2 in 100 are missed."""
    rng = np.random.default_rng(11)
    met, tries = 0, 4000
    for _ in range(tries):
        universe = rng.integers(0, 2**63, 50).astype(np.uint64)
        values = [substring_dedup.mix(universe ^ seed) for seed in substring_dedup._SEEDS]
        agree = sum(v[:45].min() == v[5:].min() for v in values)
        met += agree >= substring_dedup.LEAST_AGREEING
    assert met / tries >= 0.98


def shingles_of_words(words, size=5):
    return shingle_hashes(np.array([zlib.crc32(w.encode()) for w in words], np.uint64), size)


@pytest.mark.parametrize("swapped", [False, True])
@pytest.mark.parametrize("left,inserted,right", [(40, 7, 40), (45, 7, 45), (25, 11, 75), (20, 1, 30), (9, 0, 41)])
def test_passages_over_inserted_words(left, inserted, right, swapped):
    """Also where no run alone has the least words; both sides may have the longer text."""
    words = [f"w{i}" for i in range(left + right)]
    longer = words[:left] + [f"i{i}" for i in range(inserted)] + words[left:]
    one, two = ["p"] * 3 + words + ["q"] * 9, ["r"] * 6 + longer + ["s"]
    if swapped:
        one, two = two, one
    found = substring_dedup.shared_passages(shingles_of_words(one), shingles_of_words(two), 5, 50, 0.75)
    starts = (6, 3) if swapped else (3, 6)
    lengths = (len(longer), len(words)) if swapped else (len(words), len(longer))
    assert [f[:4] for f in found] == [(starts[0], starts[0] + lengths[0], starts[1], starts[1] + lengths[1])]


def test_passages_equal_brute_force_over_edits():
    """A passage is found if any two spans are similar enough, and each found one is."""
    rng = random.Random(13)
    some = 0
    for _ in range(120):
        words = [f"w{i}" for i in range(rng.randint(18, 30))]
        copy = list(words)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(copy))
            copy[at : at + rng.randint(0, 3)] = [f"e{rng.random()}" for _ in range(rng.randint(0, 3))]
        a, b = shingles_of_words(words, 2), shingles_of_words(copy, 2)
        best = 0.0
        for p in range(len(a)):
            for x in np.flatnonzero(b == a[p]):
                for q in range(p + 11, len(a) + 1):
                    for v in np.flatnonzero(b == a[q - 1]) + 1:
                        if v - x >= 11:
                            best = max(best, substring_dedup.jaccard(a[p:q], b[x:v]))
        found = substring_dedup.shared_passages(a, b, 2, 12, 0.7)
        assert bool(found) == (best >= 0.7)
        some += bool(found)
        for p, q, x, v, alike in found:
            assert q - p >= 12 and v - x >= 12 and alike >= 0.7
            assert alike == substring_dedup.jaccard(a[p : q - 1], b[x : v - 1])
    assert 20 < some < 115


def test_phrase_repeated_throughout_is_a_passage(monkeypatch):
    words = ["a", "b", "c"] * 40
    for matches in (1 << 22, 0):
        monkeypatch.setattr(substring_dedup, "MATCHES", matches)
        found = substring_dedup.shared_passages(shingles_of_words(words), shingles_of_words(words), 5, 50, 0.8)
        assert (0, 120, 0, 120, 1.0) in found


def test_passages_of_repeated_phrases_do_not_depend_on_size(monkeypatch):
    """Each place that a phrase repeated throughout can be laid on counts, however many equal pairs there are."""
    a, b = np.full(150, 7, np.uint64), np.full(200, 7, np.uint64)
    found = []
    for matches in (1 << 22, 100, 0):
        monkeypatch.setattr(substring_dedup, "MATCHES", matches)
        runs = substring_dedup.equal_runs(a, b)
        found.append(([x.tolist() for x in runs], substring_dedup.shared_passages(a, b, 5, 50, 0.8)))
    assert found[0] == found[1] == found[2]
    assert len(found[0][0][0]) == 349 and len(found[0][1]) == 51


def test_shingles_of_many_parts():
    rng = np.random.default_rng(3)
    parts = [rng.integers(-(2**31), 2**31, n, dtype=np.int32) for n in (0, 3, 5, 90, 4, 0, 7)]
    column = pa.array(parts, pa.list_(pa.int32()))
    for chunk in (1, 8, 1 << 18):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(substring_dedup, "CHUNK", chunk)
            found = list(substring_dedup.shingles_of(column.slice(1), 5))
        assert len(found) == len(parts) - 1
        for part, got in zip(parts[1:], found):
            alone = shingle_hashes(part.view(np.uint32).astype(np.uint64), 5) if len(part) >= 5 else []
            assert list(got) == list(alone)


def test_whole_copies_are_passages(spark):
    rng = random.Random(8)
    text = " ".join(f"c{rng.randrange(10**6)}" for _ in range(120))
    df = spark.createDataFrame([(i, text) for i in range(30)], "doc_id long, text string")
    rows = substring_dedup.repeated_passages(df).collect()
    assert {(r.doc_id, r.source_id, r.start, r.end) for r in rows} == {(i, 0, 0, 120) for i in range(1, 30)}


def test_cutting_words():
    text = "  a b\n\nc  d e"
    assert substring_dedup.cut_words(text, [{"start": 1, "end": 3}]) == "  a   d e"
    assert substring_dedup.cut_words(text, [{"start": 0, "end": 9}]) == "  "
    assert substring_dedup.cut_words(None, [{"start": 0, "end": 9}]) is None


@pytest.mark.parametrize("bound", [None, 0])
def test_decontamination_of_any_size(spark, monkeypatch, bound):
    """The way of a benchmark that is too large to broadcast gives the same."""
    if bound is not None:
        monkeypatch.setattr(decontamination, "MOST_ROWS", bound)
    texts = ["x " * 7 + "a b c d e f g h i j k l " + "y " * 5, "a b c d e f g h i", "short one", None, "A,b.C d e f g h i J"]
    items = [(10, "a b c d e f g h i j k"), (9, "one"), (7, "zz"), (8, "a a")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontamination.contamination(docs, spark.createDataFrame(items, "item_id long, text string"))
    rows = {r.doc_id: (r.n_words, r.n_hit, r.item_ids, [tuple(s) for s in r.spans]) for r in found.collect()}
    assert rows == {
        0: (24, 11, ["10"], [(7, 18)]),
        1: (9, 0, [], []),
        2: (2, 1, ["9"], [(1, 2)]),
        3: (0, 0, [], []),
        4: (10, 10, ["10"], [(0, 10)]),
    }


def test_decontamination_is_native(spark):
    plan = queries.op1_decontamination(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    blocks = 10_000 // url_filter.KEYS_PER_BLOCK
    bloom = url_filter.bloom_filter(keys.filter("id < 10000"), blocks)
    probed = keys.withColumn("h", url_filter.bloom_hash(F.col("key")))
    probed = probed.withColumn("block", url_filter.block_of(F.col("h"), blocks)).join(bloom, "block")
    for i in range(url_filter.WORDS):
        own = url_filter.bit(F.col("h"), i)
        probed = probed.filter(F.col(f"w{i}").bitwiseAND(own) == own)
    assert probed.filter("id < 10000").count() == 10_000
    assert probed.filter("id >= 10000").count() < 1_000


def test_index_search_equals_brute_force(monkeypatch):
    rng = np.random.default_rng(7)
    for n, dims, k in ((300, 8, 5), (4, 3, 5), (500, 24, 3)):
        matrix = rng.integers(-150, 150, (n, dims))
        matrix[n // 2 :] = matrix[: n - n // 2]  # ties
        ids = rng.permutation(10 * n)[:n]
        order = np.argsort(ids)
        index = topk.Index(ids[order], matrix[order])
        for own, query in zip(ids[::7], matrix[::7]):
            scores = matrix @ query
            best = [j for j in np.lexsort((ids, -scores)) if ids[j] != own][:k]
            found, values = index.best(query, own, k, None)
            assert list(found) == list(ids[best]) and list(values) == list(scores[best])


def test_search_of_large_components_is_exact():
    """Whole numbers whose scores fit 64 bits, but not the digits of a double."""
    rng = np.random.default_rng(8)
    for size in (10**4, 10**5, 26 * 10**6, 2 * 10**8):
        matrix = rng.integers(-size, size, (200, 24))
        index = topk.Index(np.arange(200), matrix)
        for own in range(0, 200, 9):
            scores = matrix @ matrix[own]
            best = [j for j in np.lexsort((np.arange(200), -scores)) if j != own][:5]
            found, values = index.best(matrix[own], own, 5, None)
            assert list(found) == best and list(values) == list(scores[best])


def test_search_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 37)
    monkeypatch.setattr(topk, "QUERY_ROWS", 2)
    few = queries.op4_topk_search(spark, SMALL)
    monkeypatch.undo()
    assert rows_of(few) == rows_of(queries.op4_topk_search(spark, SMALL))


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer("byte_bpe_50k.json"))
    found = [r.asDict() for r in queries.op10_packing(spark, SMALL).collect()]
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    of_doc, of_sequence = {}, {}
    for row in found:
        of_doc.setdefault(row["doc_id"], []).append(row)
        of_sequence.setdefault(row["sequence_id"], []).append(row)
    assert set(of_doc) == set(texts)
    for doc_id, pieces in of_doc.items():
        ids = np.array([*library.encode(texts[doc_id], add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for piece in sorted(pieces, key=lambda p: p["start"]):
            assert piece["start"] == at and piece["doc_tokens"] == len(ids)
            at += piece["length"]
            assert piece["ids_crc32"] == zlib.crc32(ids[piece["start"] : at].tobytes())
        assert at == len(ids)
    padding = 0
    for pieces in of_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda p: p["offset"]):
            assert piece["offset"] == at
            at += piece["length"]
        assert at <= 2048
        padding += packing.padding(at, 2048)
    assert sorted(of_sequence) == list(range(len(of_sequence)))
    # The last windows take what is left, however few documents there are.
    assert padding <= 2 * 2048


def test_encoder_equals_the_library():
    encode = packing.Encoder(queries.tokenizer("byte_bpe_50k.json"))
    rng = random.Random(3)
    parts = ["'s", "the ", " a", "é", "日", "<|endoftext|>", "\n", " ", "  ", "12", "$$", "‍", "𝒳", "\t", "Ing"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert encode.ids(text) == encode.exact.encode(text, add_special_tokens=False).ids


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(1)
    for counts in (rng.poisson(3, 65), np.r_[0, rng.poisson(1e6, 64)], (np.arange(65) > 40) * 7):
        counts = np.array(counts, np.int64)
        counts[0] = 0
        used = np.zeros_like(counts)
        for pattern, times in packing.plan_windows(counts, 64):
            assert sum(length * n for length, n in pattern.items()) <= 64
            for length, n in pattern.items():
                used[length] += n * times
        assert (used == counts).all()


def best_slack(counts, most):
    reach = {0}
    for length, n in enumerate(counts):
        for _ in range(int(n)):
            reach |= {s + length for s in reach if s + length <= most}
    return reach


def test_fill_is_the_closest():
    rng = np.random.default_rng(2)
    for _ in range(100):
        counts = rng.integers(0, 3, 33) * (rng.random(33) < 0.3)
        counts[0] = 0
        reserved = int(rng.integers(1, 32))
        most = 32 - reserved
        fill = packing.best_fill(counts, most, reserved, 32)
        total = sum(length * n for length, n in fill.items())
        assert total <= most and all(n <= counts[length] for length, n in fill.items())
        best = min(packing.padding(reserved + s, 32) for s in {max(best_slack(counts, most))} | best_slack(counts, most))
        assert packing.padding(reserved + total, 32) <= max(best, packing.padding(reserved + max(best_slack(counts, most)), 32))


def auc(labels, scores):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    for value in np.unique(scores):
        same = scores == value
        ranks[same] = ranks[same].mean()
    ones = labels == 1
    return (ranks[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


@pytest.mark.parametrize("name,label,floor", [("op5_toxicity", "toxic", 0.93), ("op7_quality", "quality", 0.96)])
def test_scores_on_held_out_rows(spark, name, label, floor):
    folder = "/root/testdata/sf0.1"
    found = queries.QUERIES[name](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = found.filter("held_out").join(labels, "doc_id").select(label, "score", "predicted").collect()
    y, score, predicted = (np.array([r[i] for r in rows], float) for i in range(3))
    assert auc(y, score) > floor
    assert (predicted == y).mean() > 0.95


def test_languages_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op8_language_id(spark, folder).filter("held_out")
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").dropna()
    rows = found.join(truth, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxic_sentences_are_located(spark):
    from tabloom.llm import toxicity

    texts = ["The day is fine. You are a zonk here. We go on."] * 30 + ["The day is fine. You are a friend here. We go on."] * 60
    labels = np.array([1] * 30 + [0] * 60)
    model = toxicity.fit_sentence_model(texts, labels)
    score, found = model.judge("We go on. A zonk again. The day is fine.", 0.5)
    assert score > 0.7 and [(x["start"], x["end"]) for x in found] == [(9, 22)]
    assert model.judge("We go on. The day is fine.", 0.5)[0] < 0.3


def test_prior_of_unlabelled_text():
    from tabloom.llm import quality

    rng = np.random.default_rng(6)
    scores = np.r_[rng.normal(2, 1, 4000), rng.normal(2, 1, 2100), rng.normal(-4, 1, 900)]
    positive = np.arange(len(scores)) < 4000
    assert abs(quality.estimate_prior(scores, positive) - 0.7) < 0.05
