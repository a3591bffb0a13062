"""Packing token sequences into windows by minimum bin slack."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabloom.llm.common import pick
from tabloom.session import materialise

#: About so many pieces of one length are numbered in one task.
BUCKET_ROWS = 20_000


class Encoder:
    """Identifiers of a byte-level BPE tokenizer file of the ``tokenizers`` library.

    The file's vocabulary and merges are run by tiktoken, which gives the same
    identifiers several times faster. ``tokenizers`` itself takes over for a
    file of another kind, and for a text that tiktoken refuses.
    """

    def __init__(self, tokenizer_file: str):
        import json

        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(tokenizer_file)
        with open(tokenizer_file, encoding="utf-8") as file:
            parts = json.load(file)
        self.fast = None
        before, model = parts.get("pre_tokenizer") or {}, parts["model"]
        if (
            before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and parts.get("normalizer") is None
            and model.get("type") == "BPE"
            and not model.get("dropout")
            and not model.get("ignore_merges")
        ):
            self.fast = self._fast(parts, model)

    @staticmethod
    def _fast(parts: dict, model: dict):
        import tiktoken

        # The byte-level alphabet: printable bytes stand for themselves, the
        # others for the characters from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        to_byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        added = {t["content"]: t["id"] for t in parts.get("added_tokens", [])}
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in parts.get("added_tokens", [])):
            return None
        ranks = {
            bytes(to_byte[c] for c in piece): i for piece, i in model["vocab"].items() if piece not in added
        }
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        order = [ranks[bytes(to_byte[c] for c in a + b)] for a, b in merges]
        if order != sorted(order):
            return None  # merges in another order than the identifiers
        pattern = (
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        )
        return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

    def ids(self, text: str) -> list[int]:
        if self.fast is not None:
            try:
                return self.fast.encode(text, allowed_special="all")
            except (ValueError, RuntimeError):
                pass
        return self.exact.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def encoder(tokenizer_file: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(tokenizer_file)


def cut_pieces(docs: DataFrame, tokenizer_file: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of each document's identifiers: all full ones and what remains."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, serial = encoder(tokenizer_file).ids, 0
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                serial += 1
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    rows.append(
                        (doc_id.as_py(), start, len(piece), zlib.crc32(piece), len(ids), serial & 0xFFFF)
                    )
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind)]
                + [pa.array(c, pa.int64()) for c in columns[1:]],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "serial"],
            )

    kind = {"int": pa.int32(), "string": pa.string()}.get(dict(docs.dtypes)["doc_id"], pa.int64())
    name = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        cut, f"doc_id {name}, start long, length long, ids_crc32 long, doc_tokens long, serial long"
    )


def padding(total: int, capacity: int) -> int:
    """Identifiers of padding that a sequence needs; none at a power of two."""
    return 0 if total & (total - 1) == 0 else capacity - total


def best_fill(counts: np.ndarray, most: int, reserved: int, capacity: int) -> dict[int, int]:
    """The multiset of lengths that fits ``most`` with least slack.

    Bitset dynamic programming: bit s of the state says that some of the
    lengths seen so far add up to s. Lengths come in falling order, each as
    often as it is there (in binary portions). It ends early once ``most`` is
    reached; the portions are then read back from the states.
    """
    states, portions = [1], []
    full, keep = 1 << most, (1 << (most + 1)) - 1
    for length in range(most, 0, -1):
        left = min(int(counts[length]), most // length)
        take = 1
        while left > 0 and not states[-1] & full:
            take_now = min(take, left)
            portions.append((length, take_now))
            states.append((states[-1] | states[-1] << length * take_now) & keep)
            left, take = left - take_now, take * 2
        if states[-1] & full:
            break
    reached = states[-1]
    sums = [s for s in (reached.bit_length() - 1, *(1 << k for k in range(capacity.bit_length()))) if s >= 0]
    sums = [s for s in [sums[0], *(x - reserved for x in sums[1:])] if 0 <= s <= most and reached >> s & 1]
    total = min(sums, key=lambda s: (padding(reserved + s, capacity), -s))
    found: dict[int, int] = {}
    for state, (length, taken) in zip(reversed(states[:-1]), reversed(portions)):
        if not state >> total & 1:
            found[length] = found.get(length, 0) + taken
            total -= length * taken
    return found


def plan_windows(counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (length -> how often) and how many windows take each.

    The longest length that is left opens a window, the fill of least slack
    closes it, and the pattern repeats as often as the counts allow. So the
    plan's size and cost follow the number of lengths, not that of pieces.
    """
    counts, plan = counts.copy(), []
    while counts.any():
        longest = int(counts.nonzero()[0][-1])
        counts[longest] -= 1
        pattern = best_fill(counts, capacity - longest, longest, capacity)
        counts[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(int(counts[length]) // n for length, n in pattern.items())
        for length, n in pattern.items():
            counts[length] -= n * times
        plan.append((pattern, times))
    return plan


def placement(plan: list[tuple[dict[int, int], int]], counts: np.ndarray) -> dict[str, np.ndarray]:
    """Where pieces go: ranges of the numbers that the pieces of a length have.

    Piece i of length L has the global number base[L] + i. Range r starts at
    global number first[r]; ``n`` of its pieces share a window, whose sequence
    numbers start at sequence[r], and stand there from offset[r] on.
    """
    base = np.concatenate([[0], np.cumsum(counts)[:-1]])
    used, rows, sequence = np.zeros(len(counts), np.int64), [], 0
    for pattern, times in plan:
        offset = 0
        for length in sorted(pattern, reverse=True):
            n = pattern[length]
            rows.append((base[length] + used[length], n, sequence, offset, length))
            used[length] += n * times
            offset += n * length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"base": base} | dict(zip(("first", "n", "sequence", "offset", "length"), table.T))


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` identifiers.

    Per piece: doc_id, start (its document's identifiers before it), length,
    ids_crc32 (of the identifiers as little-endian unsigned 32-bit numbers),
    doc_tokens, sequence_id, offset. A document is its identifiers and then
    ``end_id``. Full pieces fill a sequence each; the rests are put together by
    minimum bin slack over the counts of their lengths, at most ``capacity`` of
    them, which is all that the driver sees. Within a length pieces are
    numbered by id, start and content, in buckets that bound a task's rows.

    A NULL or empty text is a document of ``end_id`` alone. A NULL id stays.
    Repeated rows are documents of their own. An empty table gives an empty
    one. Further columns are left out.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    pieces = materialise(cut_pieces(rows, tokenizer_file, capacity, end_id))
    found = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in found:
        counts[row["length"]] = row["n"]
    sent = spark.sparkContext.broadcast(placement(plan_windows(counts, capacity), counts))

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def place(lengths: pa.Array, numbers: pa.Array) -> pa.Array:
        at, length = sent.value, lengths.to_numpy()
        number = at["base"][length] + numbers.to_numpy()
        r = np.searchsorted(at["first"], number, "right") - 1
        within = number - at["first"][r]
        sequence = at["sequence"][r] + within // at["n"][r]
        offset = at["offset"][r] + within % at["n"][r] * length
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    buckets = max(1, int(counts.max() // BUCKET_ROWS) + 1)
    keyed = pieces.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "serial"), F.lit(buckets))
    )
    sizes = keyed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("size"))
    earlier = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select(
        "length", "bucket", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before")
    )
    order = W.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "serial")
    return (
        keyed.withColumn("nth", F.row_number().over(order) - 1)
        .join(before, ["length", "bucket"])
        .withColumn("at", place("length", F.col("before") + F.col("nth")))
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "at.sequence_id", "at.offset")
    )
