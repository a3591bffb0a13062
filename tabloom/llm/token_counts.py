"""Token counts of whole texts by byte-pair merging, without making identifiers."""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import pick

SPACE = "▁"
#: Segments up to this length are remembered, so many of them per worker.
LONGEST_KEPT = 48
MOST_KEPT = 400_000


class PieceCounter(dict):
    """Counts the tokens of a text under a byte-pair model with byte fallback.

    Symbols sit in a linked list; a heap gives the adjacent pair that the model
    ranks lowest (the leftmost of equals), which is merged until no adjacent
    pair is a piece. What is left over is counted: one for each symbol that is
    a piece, and the UTF-8 bytes of each that is not.

    A text is first cut where no piece spans the cut, which changes no merge.
    The dictionary remembers counts of short segments.
    """

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.rank = {}
        self.pairs = set()
        spans = False
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
                continue
            if model.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
            piece = model.id_to_piece(i)
            self.rank[piece] = -model.get_score(i)
            self.pairs.update(map("".join, zip(piece, piece[1:])))
            spans = spans or bool(re.search(f"[^{SPACE}]{SPACE}", piece))
        if not any(model.is_byte(i) for i in range(model.get_piece_size())):
            raise ValueError("the model has no byte pieces to fall back on")
        probe = model.encode("  Ａ  b", out_type=str)
        if "".join(p for p in probe if p[0] != "<") != SPACE * 5 + "b":
            raise ValueError("models that normalise text are not supported")
        # A segment is a run of spaces and what follows it, or the whole text
        # if some piece goes on over a space.
        self.segments = re.compile("(?s).+" if spans else " +[^ ]*")

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        segments = self.segments.findall(" " + text.replace(SPACE, " "))
        if len(self) > MOST_KEPT:
            self.clear()
        return sum(map(self.__getitem__, segments))

    def __missing__(self, segment: str) -> int:
        symbols = segment.replace(" ", SPACE)
        found, start = 0, 0
        for i in range(1, len(symbols)):
            if symbols[i - 1 : i + 1] not in self.pairs:
                found += self.merged(symbols[start:i])
                start = i
        found += self.merged(symbols[start:])
        if len(segment) <= LONGEST_KEPT:
            self[segment] = found
        return found

    def merged(self, symbols: str) -> int:
        rank = self.rank
        if symbols in rank and len(symbols) == 1:
            return 1
        parts, n = list(symbols), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if (r := rank.get(parts[i] + parts[i + 1])) is not None:
                heap.append((r, i, 2))
        heapify(heap)
        while heap:
            _, i, size = heappop(heap)
            left, j = parts[i], after[i]
            if not left or j >= n or len(left) + len(parts[j]) != size:
                continue  # one of the two has been merged with another since
            parts[i] = merged = left + parts[j]
            parts[j] = ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get(merged + parts[k])) is not None:
                    heappush(heap, (r, i, len(merged) + len(parts[k])))
            if (h := before[i]) >= 0:
                if (r := rank.get(parts[h] + merged)) is not None:
                    heappush(heap, (r, h, len(parts[h]) + len(merged)))
        return sum(1 if p in rank else len(p.encode()) for p in parts if p)


@lru_cache(maxsize=2)
def counter(model_file: str) -> PieceCounter:
    """One counter per worker and model."""
    return PieceCounter(model_file)


def token_counts(
    docs: DataFrame, model_file: str, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Texts are counted whole. A NULL or empty text has 0 bytes and 0 tokens; a
    NULL id stays NULL; repeated rows each give a row; an empty table gives an
    empty one. Further columns are left out. ``model_file`` must exist at the
    same place on every executor.
    """

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        one = counter(model_file).count
        return pa.array([one(t.as_py()) for t in texts], pa.int64())

    rows = pick(docs, doc_id=id_col, text=text_col)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return rows.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), count(text).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
