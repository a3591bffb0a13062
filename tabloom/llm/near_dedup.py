"""Near-duplicate documents by MinHash bands, odd sketches and exact comparison."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import pick
from tabloom.llm.components import smallest_reachable
from tabloom.llm.shingles import hash_words, mix, shingle_hashes
from tabloom.session import materialise

#: 25 bands of 5 MinHash samples miss a pair of similarity 0.85 once in two
#: million; lower similarities get more bands (``band_count``). The odd sketch
#: folds all samples.
BANDS, ROWS = 25, 5
SAMPLES = 2 * BANDS * ROWS
SKETCH_WORDS = 16
#: Members of a bucket, and shingles of theirs, that one piece of work compares.
BLOCK, BLOCK_SHINGLES = 1024, 1_000_000
#: Buckets of more members bring their sets along and are compared at once.
CROWDED = 64

_seeds = mix(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64))
_FACTORS = (_seeds[:SAMPLES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (_seeds[SAMPLES:] >> np.uint64(32)).astype(np.uint32)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of a whole text's shingles, A-Z taken as a-z.

    Words are what ASCII white space divides.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.unique(shingle_hashes(hash_words(words), size))


def min_hashes(found: np.ndarray) -> np.ndarray:
    short = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(short), 1024):
        values = np.multiply.outer(_FACTORS, short[start : start + 1024])
        values += _SHIFTS[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least


def band_count(similarity: float) -> int:
    """Bands that miss a pair of this similarity at most once in two million.

    From 0.75 down that takes more than all samples give, so all are used.
    """
    count = BANDS
    while (1 - similarity**ROWS) ** count > 5e-7 and (count + 1) * ROWS <= SAMPLES:
        count += 1
    return count


def band_keys(samples: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit key for each band of samples; equal bands have equal keys."""
    values = samples[: bands * ROWS].reshape(bands, ROWS).astype(np.uint64)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, i])
    return keys.view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parities of how many samples fall on each bit of the sketch."""
    number = (np.arange(len(samples), dtype=np.uint64) << np.uint64(32)) | samples
    at = (mix(number) % np.uint64(64 * SKETCH_WORDS)).astype(np.int64)
    odd = np.bincount(at, minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def most_different_bits(similarity: float) -> int:
    """Bits in which sketches of sets of this similarity differ at most.

    Each sample that differs flips two bits. Taken is the number of differing
    samples five standard deviations above its mean, the bits that so many are
    expected to leave, and three deviations of those.
    """
    bits, miss = 64 * SKETCH_WORDS, 1 - similarity
    differing = SAMPLES * miss + 5 * np.sqrt(SAMPLES * miss * similarity)
    expected = bits / 2 * (1 - np.exp(-4 * differing / bits))
    return int(min(2 * differing, expected + 3 * np.sqrt(expected * expected / bits) + 4))


def signatures(docs: DataFrame, size: int, bands: int) -> DataFrame:
    """doc_id, n, digest (of the set), bands, sketch; of each row of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                found = shingle_set(text.as_py(), size)
                samples = min_hashes(found)
                rows.append(
                    (
                        len(found),
                        hashlib.blake2b(found.tobytes(), digest_size=16).digest(),
                        band_keys(samples, bands) if len(found) else np.zeros(0, np.int64),
                        odd_sketch(samples),
                    )
                )
            n, digest, keys, sketch = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(digest, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(sketch, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "digest", "bands", "sketch"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n long, digest binary, bands array<long>, sketch array<long>")


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that end between runs of rows that agree in the first ``keys`` columns, of sorted batches.

    With the places where runs start, and the table's end.
    """
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        if not rest.num_rows:
            continue
        columns = [rest.column(i).to_numpy() for i in range(keys)]
        new = np.zeros(rest.num_rows, bool)
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        cuts = np.r_[0, np.flatnonzero(new)]
        if len(cuts) > 1:
            yield rest.slice(0, cuts[-1]), cuts
        rest = rest.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest, np.array([0, rest.num_rows])


def groups(batches: Iterator[pa.RecordBatch], keys: int, least: int = 1) -> Iterator[pa.Table]:
    """Runs of at least ``least`` rows that agree in the first ``keys`` columns, of sorted batches."""
    for table, cuts in whole_runs(batches, keys):
        for start, end in zip(cuts, cuts[1:]):
            if end - start >= least:
                yield table.slice(start, end - start)


def close_pairs(similarity: float, exact: bool):
    """For mapInArrow: pairs of one block of a bucket that can be, or are, similar.

    Rows are bucket, i, j, role (0: to be linked, 1: any member), node,
    component, n, sketch, bands and, if ``exact``, found (the set). A pair in
    different components passes if its sizes and sketches allow the similarity
    and the bucket is the first that it shares, so it passes once in all. If
    ``exact``, sets are compared here, the closest sketches first, and members
    that this has put into one component are not compared any more.
    """
    most, hundredths = most_different_bits(similarity), round(100 * similarity)
    width = band_count(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, 3):
            bucket, role = group["bucket"][0].as_py(), group["role"].to_numpy()
            node, n = group["node"].to_numpy(), group["n"].to_numpy()
            # Components by number within the group; merged ones take one number.
            part = np.unique(group["component"].to_numpy(), return_inverse=True)[1]
            sketch = group["sketch"].combine_chunks().flatten().to_numpy().view(np.uint64)
            sketch = sketch.reshape(-1, SKETCH_WORDS)
            bands = group["bands"].combine_chunks().flatten().to_numpy().reshape(-1, width)
            sets = group["found"].combine_chunks() if exact else None
            (left,), (right,) = np.nonzero(role == 0), np.nonzero(role == 1)
            found_a, found_b = [], []
            for x in left:
                fits = right[
                    (part[right] != part[x])
                    & (np.minimum(n[right], n[x]) >= (similarity - 1e-9) * np.maximum(n[right], n[x]))
                ]
                bits = np.bitwise_count(sketch[fits] ^ sketch[x]).sum(axis=1, dtype=np.int64)
                fits, bits = fits[bits <= most], bits[bits <= most]
                first = (bands[fits] == bands[x]).argmax(axis=1)
                here = bands[x][first] == bucket
                fits, bits = fits[here], bits[here]
                if not exact:
                    found_a.append(np.full(len(fits), node[x]))
                    found_b.append(node[fits])
                    continue
                own = np.frombuffer(sets[int(x)].as_py(), np.uint64)
                for y in fits[np.argsort(bits, kind="stable")]:
                    if part[y] == part[x]:
                        continue
                    both = np.concatenate([own, np.frombuffer(sets[int(y)].as_py(), np.uint64)])
                    both.sort()
                    common = int((both[1:] == both[:-1]).sum())
                    if 100 * common >= hundredths * (len(both) - common):
                        found_a.append(node[x : x + 1])
                        found_b.append(node[y : y + 1])
                        part[part == part[y]] = part[x]
            if found_a and sum(map(len, found_a)):
                a, b = np.concatenate(found_a), np.concatenate(found_b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
                )

    return run


def text_sets(size: int):
    """For mapInArrow: node, found (its set's bytes) of (node, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), size).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "found"])

    return run


def similar_enough(size: int, similarity: float):
    """For mapInArrow: the pairs (a, b, text_a, text_b) whose full sets are similar enough."""
    hundredths = round(100 * similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = None, None
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            kept = np.zeros(len(a), bool)
            for i in range(len(a)):
                if known != a[i]:
                    known, own = a[i], shingle_set(batch.column(2)[i].as_py(), size)
                other = shingle_set(batch.column(3)[i].as_py(), size)
                both = np.concatenate([own, other])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                kept[i] = 100 * common >= hundredths * (len(both) - common)
            yield pa.RecordBatch.from_arrays([pa.array(a[kept]), pa.array(b[kept])], names=["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame,
    size: int = 3,
    similarity: float = 0.85,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    A text's set has its distinct runs of ``size`` words; of fewer words, all of
    them as one. Texts whose sets have a Jaccard similarity of at least
    ``similarity`` (in whole hundredths) are linked; component_id is the
    smallest doc_id reachable, kept marks that document.

    Equal sets form a class that its smallest id stands for. MinHash bands put
    classes into buckets. In each bucket all members are first compared with
    the smallest; then members of buckets that fall into several components
    with the nearest others, and in the end with all others, of other
    components, as far as sizes and odd sketches allow the similarity. So no
    link between components is left out, while pairs inside a component that is
    already connected are not made. Large buckets are compared in blocks. All
    links are confirmed on full sets of 64-bit shingle hashes.

    NULL, empty and wordless texts have no set and are linked with nothing. A
    row without id keeps a NULL component_id and is kept. Rows of one id are
    one document for links, whatever their texts; each gives a row. An empty
    table gives an empty one; further columns are left out. Ids are whole
    numbers.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    signed = materialise(signatures(rows, size, band_count(similarity)))
    present = signed.filter("n > 0 and doc_id is not null")
    classes = present.groupBy("digest").agg(F.min("doc_id").alias("node"))
    member = materialise(
        present.select("doc_id", "digest").distinct().join(classes, "digest").select("doc_id", "node", "digest")
    )
    nodes = materialise(
        present.join(
            member.filter("doc_id = node").select("doc_id", "digest"), ["doc_id", "digest"], "left_semi"
        )
        .dropDuplicates(["doc_id", "digest"])
        .select(F.col("doc_id").alias("node"), "digest", "n", "bands", "sketch")
    )
    buckets = nodes.select("node", F.explode("bands").alias("bucket")).distinct()
    crowded = buckets.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    buckets = materialise(
        buckets.join(crowded.filter("first <> last").drop("last"), "bucket").select("bucket", "node", "first")
    )
    busy = buckets.select("node").distinct()
    # An id with several texts has several sets; the pair takes the closest.
    sketches = nodes.join(busy, "node", "left_semi").select("node", "n", "sketch")
    texts = materialise(
        rows.join(busy, F.col("doc_id") == F.col("node"), "left_semi").select(F.col("doc_id").alias("node"), "text")
    )
    most = most_different_bits(similarity)

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
        return both.select("a", "b", "text_a", "text_b").mapInArrow(
            similar_enough(size, similarity), "a long, b long"
        )

    differing = F.aggregate(
        F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, x: total + x,
    )
    first = (
        buckets.filter("node <> first")
        .select(F.col("first").alias("a"), F.col("node").alias("b"))
        .distinct()
        .join(sketches.toDF("b", "n_b", "sketch_b"), "b")
        .join(sketches.toDF("a", "n_a", "sketch_a"), "a")
        .filter(F.least("n_a", "n_b") >= (similarity - 1e-9) * F.greatest("n_a", "n_b"))
        .filter(differing <= most)
        .select("a", "b")
        .distinct()
    )
    # All rows of an id hang together, also where its texts differ.
    own = member.filter("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    tested = materialise(first)
    links = materialise(verified(tested).union(own))
    parts = smallest_reachable(links)
    placed = materialise(
        buckets.select("bucket", "node")
        .join(parts, "node", "left")
        .join(nodes.select("node", "n"), "node")
        .withColumn("component", F.coalesce("component", "node"))
    )
    by_part = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n"))
    mixed = materialise(
        by_part.groupBy("bucket")
        .agg(
            F.sum("size").alias("members"),
            F.sum("n").alias("shingles"),
            F.max("size").alias("largest"),
            F.max_by("component", "size").alias("main"),
            F.count(F.lit(1)).alias("parts"),
        )
        .filter("parts > 1")
        .select(
            "bucket",
            "main",
            "members",
            F.ceil((F.col("members") - F.col("largest")) / BLOCK).cast("int").alias("rows"),
            F.ceil(F.greatest(F.col("members") / BLOCK, F.col("shingles") / BLOCK_SHINGLES))
            .cast("int")
            .alias("columns"),
        )
    )
    details = nodes.join(busy, "node", "left_semi").select("node", "sketch", "bands")
    spread = F.xxhash64("node")

    def compared(kind: str, exact: bool) -> DataFrame:
        held = placed.join(mixed.filter(kind), "bucket").join(details, "node")
        if exact:
            wanted = held.select("node").distinct()
            sets = texts.join(wanted, "node", "left_semi").select("node", "text")
            held = held.join(sets.mapInArrow(text_sets(size), "node long, found binary"), "node")
        columns = ["node", "component", "n", "sketch", "bands", *["found"] * exact]
        outsiders = held.filter("component <> main").select(
            "bucket",
            F.pmod(spread, "rows").cast("int").alias("i"),
            F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"),
            F.lit(0).alias("role"),
            *columns,
        )
        everyone = held.select(
            "bucket",
            F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"),
            F.pmod(spread, "columns").cast("int").alias("j"),
            F.lit(1).alias("role"),
            *columns,
        )
        blocks = outsiders.union(everyone).repartition("bucket", "i", "j")
        return (
            blocks.sortWithinPartitions("bucket", "i", "j")
            .mapInArrow(close_pairs(similarity, exact), "a long, b long")
            .distinct()
        )

    pairs = compared(f"members <= {CROWDED}", False).join(tested, ["a", "b"], "left_anti")
    known = parts.select(F.col("component").alias("a"), F.col("node").alias("b"))
    links = materialise(
        verified(materialise(pairs)).union(compared(f"members > {CROWDED}", True)).union(known)
    )
    parts = smallest_reachable(links).toDF("doc_id", "reached")
    return (
        signed.select("doc_id", F.col("n").alias("n_shingles"))
        .join(parts, "doc_id", "left")
        .withColumn("component_id", F.coalesce("reached", "doc_id"))
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )
