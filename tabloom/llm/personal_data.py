"""Personal data: rules for clear cases, and a character tagger that learns from them for the rest."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm import tagger
from tabloom.llm.common import bounded_sample, pick

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Documents with a digit or an @ whose rule spans the tagger learns from, about; and windows of them.
SAMPLE_DOCS = 6000
SAMPLE_WINDOWS = 1200
#: Characters of a window in training, states in each direction, and training steps.
TRAIN_WIDTH = 96
STATES = 8
STEPS = 300
#: Characters of a window, of which HALO on either side are its neighbours' to score.
WIDTH, HALO = 512, 32
#: Windows scored at once, and characters of texts taken together.
WINDOWS_AT_ONCE = 512
CHARS_AT_ONCE = 4_000_000

# Fixed patterns of the four kinds. A digit run is entered at its start only,
# which finds the same and keeps long runs linear.
LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
NUMBER = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) << (i & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def passes(kind: int, found: str) -> bool:
    """The kind's check of what its pattern found."""
    if kind == EMAIL:
        return True
    if kind == IP:
        return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))
    if kind == CARD:
        digits = NO_DIGIT.sub("", found) if len(found) < 64 else ""
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= sum(c.isdigit() for c in found) <= 15


def matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """Leftmost non-overlapping matches of each kind's pattern, and whether they pass its check."""
    end = 0
    for m in DOMAIN.finditer(text):
        # An @ belongs to no name, so a name begins after the last one.
        begin = max(end, text.rfind("@", end, m.start()) + 1)
        name = text[begin : m.start()]
        length = len(name) - len(name.rstrip(LOCAL))
        if length:
            end = m.end()
            yield EMAIL, m.start() - length, end, True
    for kind, pattern in ((IP, ADDRESS), (CARD, DIGITS), (PHONE, NUMBER)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end(), passes(kind, m.group())


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the rules, by kind and start."""
    return [(kind, start, end) for kind, start, end, good in matches(text) if good]


def whole(kind: int, found: str) -> bool:
    """Whether the rule of the kind takes ``found`` as a whole."""
    return any(m == (kind, 0, len(found), True) for m in matches(found))


def trimmed(kind: int, text: str, start: int, end: int) -> tuple[int, int]:
    """The span without what cannot stand at an end of its kind."""
    first, last = {
        EMAIL: (LOCAL, LOCAL.replace(".", "").replace("_", "").replace("%", "").replace("+", "")),
        PHONE: ("+", "0123456789"),
    }.get(kind, ("0123456789", "0123456789"))
    while start < end and text[start] not in first:
        start += 1
    while start < end and text[end - 1] not in last:
        end -= 1
    return start, end


def training_windows(text: str, most: int) -> list[tuple[str, list[Span], bool]]:
    """Windows with their rule spans, from places with digits or an @; and whether they hold any.

    Windows with a match that fails its check, though long enough for the
    kind, are left out: the rules cannot tell what they are.
    """
    found = list(matches(text))
    spans = [m[:3] for m in found if m[3]]
    unclear = sorted(m[1] for m in found if not m[3] and m[2] - m[1] >= 12)
    places = [s for _, s, _ in spans] + [m.start() for m, _ in zip(re.finditer(r"[0-9]+", text), range(most))]
    windows = []
    for place in sorted(set(places))[: 4 * most]:
        begin = max(0, place - TRAIN_WIDTH // 3)
        end = min(len(text), begin + TRAIN_WIDTH)
        i = bisect_left(unclear, begin - TRAIN_WIDTH)
        if i < len(unclear) and unclear[i] < end:
            continue
        inside = [(k, s - begin, e - begin) for k, s, e in spans if s < end and e > begin]
        if all(s >= 0 and e <= end - begin for _, s, e in inside):
            windows.append((text[begin:end], inside, bool(inside)))
    held = [w for w in windows if w[2]]
    return held[:most] + [w for w in windows if not w[2]][: max(1, most // 4)]


def tagged(windows: list[tuple[str, list[Span]]]) -> tuple[np.ndarray, np.ndarray]:
    """Character classes and tags (0 outside, 2k+1 first of a span of kind k, 2k+2 further)."""
    ids = np.zeros((len(windows), TRAIN_WIDTH), np.uint8)
    tags = np.zeros((len(windows), TRAIN_WIDTH), np.int8)
    for i, (text, spans) in enumerate(windows):
        ids[i, : len(text)] = tagger.classes_of(text)[:TRAIN_WIDTH]
        for kind, start, end in spans:
            tags[i, start:end] = 2 * kind + 2
            tags[i, start : start + 1] = 2 * kind + 1
    return ids, tags


def side_by_side(windows: list[tuple[str, list[Span], bool]], seed: int) -> list[tuple[str, list[Span]]]:
    """Windows in which two or three labelled spans stand next to each other.

    The rules read such neighbours as one failing match, so their labels never
    show them; spans and surroundings are those of labelled windows.
    """
    draw = np.random.default_rng(seed)
    pool: dict[int, list[str]] = {}
    for text, spans, _ in windows:
        for kind, start, end in spans:
            pool.setdefault(kind, []).append(text[start:end])
    kinds, composed = sorted(pool), []
    for text, spans, held in windows:
        if not held:
            continue
        start, end = spans[0][1], spans[0][2]
        built, found = text[:start], []
        for _ in range(int(draw.integers(2, 4))):
            kind = int(draw.choice(kinds))
            span = pool[kind][int(draw.integers(len(pool[kind])))]
            if len(built) + len(span) > TRAIN_WIDTH:
                break
            found.append((kind, len(built), len(built) + len(span)))
            built += span + (" ", " ", ", ", "\n", "  ", "; ")[int(draw.integers(6))]
        rest = text[end : (spans[1][1] if len(spans) > 1 else len(text))]
        if found:
            composed.append(((built + rest.lstrip(" "))[:TRAIN_WIDTH], found))
    return composed


def learn_tagger(docs: DataFrame) -> tagger.Tagger | None:
    """Fit on windows around rule spans of a bounded sample; None if there are no spans.

    ``docs`` has ``text``. The sample is taken by a hash of the text, equal
    texts count once, so a run elsewhere or on other partitions fits the same.
    """
    # Only what has a digit or an @ can hold a span; equal texts have one hash.
    key = F.xxhash64("text")
    candidates = docs.filter(F.col("text").rlike("[0-9@]")).select("text", key.alias("key"))
    chosen = bounded_sample(candidates.select("key").distinct(), "key", SAMPLE_DOCS)
    share = 4

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                found += [(key, w, [x for s in spans for x in s]) for w, spans, _ in training_windows(text, share)]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.string(), pa.list_(pa.int32())))],
                    names=["key", "window", "spans"],
                )

    cut = candidates.join(chosen, "key", "left_semi").select("key", "text")
    rows = cut.mapInArrow(windows, "key long, window string, spans array<int>").distinct()
    # The bound holds whatever the texts are like: by hash, not by arrival.
    rows = rows.orderBy(F.xxhash64("key", "window"), "window").limit(SAMPLE_WINDOWS).collect()
    found = [(w, [tuple(s[i : i + 3]) for i in range(0, len(s), 3)], bool(s)) for _, w, s in rows]
    if not any(held for _, _, held in found):
        return None
    ids, tags = tagged([w[:2] for w in found] + side_by_side(found, 1))
    return tagger.trained(ids, tags, 2 * len(KINDS) + 1, STATES, STEPS)


class Finder:
    """Finds the spans of many texts with a fitted tagger."""

    def __init__(self, model: tagger.Tagger):
        self.scorer, self.moves = tagger.Scorer(model), model.moves.astype(np.float32)
        self.margins = tagger.certain_margins(model.moves).astype(np.float32)

    def uncertain(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, place and tag scores of each place where a span is possible, in order.

        Texts are scored in overlapping windows, and a place takes its scores
        from the window in which it lies furthest from an end. Where 'outside'
        leads by more than moves can gain, it is in the best path of the whole
        text, so only the other places are kept.
        """
        step = WIDTH - 2 * HALO
        windows: dict[int, list[tuple[int, int, int, int]]] = {}
        for i, ids in enumerate(texts):
            for begin in range(0, max(1, len(ids) - 2 * HALO), step):
                end = min(begin + WIDTH, len(ids))
                if end > begin:
                    first = begin + HALO if begin else 0
                    last = end if end == len(ids) else end - HALO
                    length = -(-(end - begin) // 64) * 64
                    windows.setdefault(length, []).append((i, begin, first, last))
        kept = []
        for length, rows in sorted(windows.items()):
            for at in range(0, len(rows), WINDOWS_AT_ONCE):
                which, begin, first, last = np.array(rows[at : at + WINDOWS_AT_ONCE]).T
                ids = np.zeros((len(which), length), np.uint8)
                for row, i, b in zip(ids, which, begin):
                    piece = texts[i][b : b + length]
                    row[: len(piece)] = piece
                emitted = self.scorer(np.ascontiguousarray(ids.T))
                lead = (emitted[:, 1:] + self.margins[:, None]).max(1) - emitted[:, 0]
                t, w = np.nonzero(lead >= 0)
                place = begin[w] + t
                own = (place >= first[w]) & (place < last[w])
                t, w, place = t[own], w[own], place[own]
                kept.append((which[w], place, emitted[t, :, w]))
        if not kept:
            return np.zeros(0, int), np.zeros(0, int), np.zeros((0, 2 * len(KINDS) + 1), np.float32)
        which, place, scores = (np.concatenate(c) for c in zip(*kept))
        order = np.lexsort((place, which))
        return which[order], place[order], scores[order]

    def __call__(self, texts: list[str]) -> list[list[Span]]:
        """Decoded spans of each text, by the best path over the whole of it.

        Between runs of places that are left, the path is outside, so each run
        is decoded by itself; runs of one length together.
        """
        found: list[list[Span]] = [[] for _ in texts]
        which, place, scores = self.uncertain([tagger.classes_of(t) for t in texts])
        new = np.r_[True, (np.diff(which) != 0) | (np.diff(place) != 1)][: len(which)]
        starts = np.flatnonzero(new)
        lengths = np.diff(np.r_[starts, len(which)])
        outside = np.full(2 * len(KINDS) + 1, -1e9, np.float32)
        outside[0] = 0
        for length in np.unique(lengths):
            first = starts[lengths == length]
            emitted = np.empty((len(first), length + 2, len(outside)), np.float32)
            emitted[:, 0] = emitted[:, -1] = outside
            emitted[:, 1:-1] = scores[first[:, None] + np.arange(length)]
            tags = tagger.best_paths(emitted, self.moves)[:, 1:-1]
            for row in np.flatnonzero(tags.any(1)):
                at = first[row]
                found[which[at]] += spans_of(tags[row], int(place[at]))
        return found


def spans_of(tags: np.ndarray, begin: int) -> list[Span]:
    """Runs of one kind; a first tag begins a new one."""
    spans: list[Span] = []
    last = 0
    for at, tag in enumerate(tags.tolist(), begin):
        kind = (tag - 1) // 2
        if tag:
            if tag % 2 or last == 0 or (last - 1) // 2 != kind:
                spans.append((kind, at, at + 1))
            else:
                spans[-1] = (kind, spans[-1][1], at + 1)
        last = tag
    return spans


def all_spans(texts: list[str], finder: Finder | None) -> list[list[tuple[int, int, int, bool]]]:
    """(kind, start, end, by rule) of each text, by kind and start.

    A decoded span counts where the rule of its kind takes it as a whole once
    its ends are trimmed, and where it meets no span of a rule.
    """
    decoded = finder(texts) if finder else [[] for _ in texts]
    result = []
    for text, more in zip(texts, decoded):
        base = base_spans(text)
        rows = [(*s, True) for s in base]
        taken = sorted((s, e) for _, s, e in base)
        starts = [s for s, _ in taken]
        # The furthest end of the rule spans up to each, as those of different kinds can overlap.
        reach = list(accumulate((e for _, e in taken), max))
        for kind, start, end in more:
            start, end = trimmed(kind, text, start, end)
            before = bisect_left(starts, end)
            if start < end and not (before and reach[before - 1] > start) and whole(kind, text[start:end]):
                rows.append((kind, start, end, False))
        result.append(sorted(rows))
    return result


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its spans of personal data: doc_id, spans.

    ``spans`` is an array of (kind, start, end, by_rule), by kind (email, ip,
    card, phone) and start; places count code points, the end is exclusive.
    Rules find the clear cases. A bidirectional LSTM with CRF transitions,
    trained from a bounded sample of what the rules found, reads every
    character of every text in overlapping windows, whose scores become one
    sequence for each text and are decoded over the whole of it. What it finds
    beyond the rules counts if the rule of its kind accepts it when it stands
    alone and no rule span overlaps it: neighbours, say, that the rules read
    as one failing match.

    A NULL or empty text has no spans; repeated rows and NULL ids have a row
    each; further columns are left out. Without a span by rule in the sample
    there is nothing to learn from, and the rules' spans are returned. An
    empty table gives an empty one.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    model = learn_tagger(rows)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model) if model else None
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("by_rule", pa.bool_())])

        def records(ids: list, texts: list[str]) -> pa.RecordBatch:
            spans = [
                [{"kind": KINDS[k], "start": s, "end": e, "by_rule": rule} for k, s, e, rule in found]
                for found in all_spans(texts, finder)
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(spans, pa.list_(kind))], names=["doc_id", "spans"]
            )

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if size >= CHARS_AT_ONCE:
                    yield records(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield records(ids, texts)

    id_type = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(
        find, f"doc_id {id_type}, spans array<struct<kind:string,start:int,end:int,by_rule:boolean>>"
    )
