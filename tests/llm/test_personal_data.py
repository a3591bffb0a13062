"""Personal data: rules against plain patterns, the tagger against plain computation and held-out texts."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import personal_data as found_by
from tabloom.llm import tagger
from tabloom.llm.queries import QUERIES

SF, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
#: The four patterns as they are stated; slow on long runs.
PLAIN = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(c)))) for c in even)) % 10 == 0


def plain_spans(text):
    found = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = (
                kind == 0
                or (kind == 1 and all(int(p) <= 255 for p in m.group().split(".")))
                or (kind == 2 and 16 <= len(digits) <= 19 and luhn(digits))
                or (kind == 3 and 8 <= len(digits) <= 15)
            )
            if good:
                found.append((kind, m.start(), m.end()))
    return found


def test_rules_equal_the_stated_patterns():
    draw = random.Random(4)
    for _ in range(4000):
        text = "".join(draw.choice(["a", "B", "@", "@", ".", ".", "1", "25", "300", "+1", " ", "-", "(", "é", "4539578763621486"])
                       for _ in range(draw.randrange(40)))
        assert found_by.base_spans(text) == plain_spans(text), text


def test_rules_are_linear_on_long_runs():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" + " 1" * 150_000, "@a.b" * 80_000):
        found_by.base_spans(text)


def random_model(seed=0, kinds=2, size=3):
    model = tagger.fresh(2 * kinds + 1, size, seed)
    draw = np.random.default_rng(seed)
    return model._replace(moves=draw.normal(size=model.moves.shape), bias=draw.normal(size=model.bias.shape))


def test_gradients_are_slopes_of_the_loss():
    draw = np.random.default_rng(1)
    model = random_model()
    ids = draw.integers(1, tagger.CLASSES, (5, 3)).astype(np.uint8)
    tags = draw.integers(0, 5, (5, 3))
    _, slopes = tagger.gradients(model, ids, tags)
    for part, slope in zip(model, slopes):
        for at in draw.integers(0, part.size, 12):
            kept, values = part.flat[at], []
            for step in (1e-6, -1e-6):
                part.flat[at] = kept + step
                values.append(tagger.gradients(model, ids, tags)[0])
            part.flat[at] = kept
            assert abs((values[0] - values[1]) / 2e-6 - slope.flat[at]) < 1e-4


def test_likelihood_sums_over_all_paths():
    draw = np.random.default_rng(2)
    emitted, moves = draw.normal(size=(4, 1, 3)), draw.normal(size=(3, 3))

    def score(path):
        return sum(emitted[t, 0, k] for t, k in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))

    paths = list(itertools.product(range(3), repeat=4))
    tags = np.array([[0], [2], [1], [1]])
    loss, _, _ = tagger.crf(emitted, moves, tags)
    assert np.isclose(loss, np.log(sum(np.exp(score(p)) for p in paths)) - score(tags[:, 0]))
    best = tagger.best_paths(emitted.transpose(1, 0, 2), moves)[0]
    assert tuple(best) == max(paths, key=score)


def test_scorer_equals_training_states_whatever_the_padding():
    model = random_model(3)
    ids = np.random.default_rng(3).integers(1, tagger.CLASSES, (20, 4)).astype(np.uint8)
    forward = tagger.states(model.inputs[0], model.recurrent[0], ids)[2][1:]
    backward = tagger.states(model.inputs[1], model.recurrent[1], ids[::-1])[2][1:][::-1]
    plain = np.concatenate([forward, backward], 2) @ model.scores + model.bias
    padded = np.concatenate([ids, np.zeros((12, 4), np.uint8)])
    for scored in (tagger.Scorer(model)(ids), tagger.Scorer(model)(padded)[:20]):
        assert np.allclose(scored.transpose(0, 2, 1), plain, atol=1e-5)


def test_places_left_out_are_outside_in_the_best_path(monkeypatch):
    """Decoding runs of uncertain places gives the best path over the whole text."""
    monkeypatch.setattr(found_by, "KINDS", ("a", "b"))
    monkeypatch.setattr(found_by, "WIDTH", 64)
    monkeypatch.setattr(found_by, "HALO", 16)
    draw = random.Random(5)
    skipped = 0
    for seed in range(30):
        model = random_model(seed)
        model.bias[0] += draw.choice([1, 4, 7])
        model = model._replace(moves=model.moves / 2)
        finder = found_by.Finder(model)
        text = "".join(draw.choice("ab C1.@\n+é") for _ in range(60))
        ids = tagger.classes_of(text)
        emitted = finder.scorer(np.ascontiguousarray(np.r_[ids, np.zeros(4, np.uint8)][:, None]))[:60, :, 0]
        edge = np.array([[0] + [-1e9] * 4], np.float32)
        best = tagger.best_paths(np.r_[edge, emitted, edge][None], finder.moves)[0, 1:-1]
        assert finder([text]) == [found_by.spans_of(best, 0)]
        skipped += 60 - len(finder.uncertain([ids])[0])
    assert skipped > 100


def test_windows_take_each_place_once():
    model = random_model(7, kinds=4)
    model.bias[0] -= 50  # every place is left
    finder = found_by.Finder(model)
    texts = [tagger.classes_of("ab1 " * n) for n in (0, 1, 100, 128, 129, 1000)]
    which, place, _ = finder.uncertain(texts)
    assert [(w, p) for w, p in zip(which, place)] == [(i, p) for i, t in enumerate(texts) for p in range(len(t))]


@pytest.fixture(scope="module")
def model(spark):
    return found_by.learn_tagger(spark.read.parquet(f"{LARGER}/documents.parquet").filter("doc_id % 2 = 0"))


def test_held_out_spans(spark, model):
    """The tagger alone finds what the rules find in texts it has not seen."""
    texts = [r[0] for r in spark.read.parquet(f"{LARGER}/documents.parquet").filter("doc_id % 4 = 1").select("text").collect()]
    texts = [t for t in texts if t]
    want = {(i, *s) for i, t in enumerate(texts) for s in found_by.base_spans(t)}
    got = {(i, *s) for i, found in enumerate(found_by.Finder(model)(texts)) for s in found}
    assert len(want) > 100
    assert len(want & got) / len(want) > 0.95
    # A number with a wrong check digit looks like a card to it, and is refused.
    accepted = {(i, k, s, e) for i, k, s, e in got if found_by.whole(k, texts[i][s:e])}
    assert len(accepted) > 0.95 * len(want) and len(accepted - want) < 0.05 * len(want)


def test_neighbours_that_the_rules_read_as_one(model):
    finder = found_by.Finder(model)
    texts = [
        "Anhe in hsr er +1 (269) 555-3296 4524132264652876 and onrend of the.",
        "éouére 4451718024887799 27.65.93.188 et le.",
        "nothing here at all, but 42 and 1,234 and 9.9. and a=b9c8d7",
        "",
    ]
    first, second, third, fourth = found_by.all_spans(texts, finder)
    assert [(texts[0][s:e], rule) for _, s, e, rule in first] == [
        ("4524132264652876", False),
        ("+1 (269) 555-3296", False),
    ]
    assert ("4451718024887799", False) in [(texts[1][s:e], rule) for _, s, e, rule in second]
    assert third == fourth == []


def test_query_and_edges(spark):
    found = QUERIES["op11_personal_data"](spark, SF).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(found) == len(docs)
    for row in found:
        base = plain_spans(docs[row.doc_id])
        joined = ",".join(f"{found_by.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == i for k, _, _ in base) for i in range(4)]
        spans = row.spans.split(",") if row.spans else []
        assert set(joined.split(",") if joined else []) <= set(spans) and len(spans) == len(base) + row.n_added


def test_edges(spark):
    schema = "doc_id long, text string"
    rows = [(1, None), (2, ""), (None, "a@b.c"), (3, "a@b.c"), (3, "a@b.c"), (4, "x" * 200_000 + " a@b.c"), (5, "😀 1.2.3.4")]
    table = spark.createDataFrame(rows, schema)
    found = found_by.find_personal_data(table).collect()
    assert sorted((r.doc_id or 0, [(s.kind, s.start, s.end) for s in r.spans]) for r in found) == [
        (0, [("email", 0, 5)]),
        (1, []),
        (2, []),
        (3, [("email", 0, 5)]),
        (3, [("email", 0, 5)]),
        (4, [("email", 200_001, 200_006)]),
        (5, [("ip", 2, 9)]),
    ]
    wide = table.select("*", F.lit(1).alias("Text"), F.lit("x").alias("spans"), F.lit("y").alias("text"))
    again = found_by.find_personal_data(wide)
    assert again.columns == ["doc_id", "spans"] and sorted(map(str, again.collect())) == sorted(map(str, found))
    assert found_by.find_personal_data(table.limit(0)).count() == 0
    assert found_by.find_personal_data(table.filter("doc_id <= 2")).filter("size(spans) = 0").count() == 2
