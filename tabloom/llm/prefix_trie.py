"""The trie of rebuilt conversations, by fingerprints that combine without rebuilding texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabloom.llm.common import pick
from tabloom.session import materialise

#: Fingerprints are numbers modulo this prime.
PRIME = 2**61 - 1
MASK = 2**32 - 1
#: Bases of the fingerprint; the next one is taken if two sequences collide.
BASES = (0x1B873593CC9E2D51 % PRIME, 0x165667B19E3779F9 % PRIME, 0x27D4EB2F85EBCA6B % PRIME)
#: Conversations share the first turns of one in so many, up to LONGEST_HEAD turns.
FAMILY, LONGEST_HEAD = 5, 8
#: Depths of one conversation are summed in blocks of so many.
DEPTHS = 65_536
#: Characters of a chunk of a list of ids.
CHUNK = 65_536
#: A parent with at least this share of all nodes as children meets them by broadcast.
HEAVY = 1 / 1024


def identified(turns: DataFrame, digest: Column) -> DataFrame:
    """``turns`` with ``h`` and ``k``: equal only where role and text are equal.

    ``h`` is a hash; the distinct texts of a hash are numbered ``k`` from 0,
    which is 0 but for collisions.
    """
    turns = turns.withColumn("h", digest)
    texts = turns.select("h", "role", "text").distinct()
    twice = materialise(texts.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h"))
    if twice.isEmpty():
        return turns.withColumn("k", F.lit(0))
    order = W.partitionBy("h").orderBy("role", "text")
    clashes = materialise(texts.join(twice, "h").withColumn("k", F.row_number().over(order) - 1).filter("k > 0"))
    return turns.join(clashes, ["h", "role", "text"], "left").withColumn("k", F.coalesce("k", F.lit(0)))


def scanned(base: int):
    """For mapInArrow over sorted turns: place and fingerprints within the task's part of each conversation.

    A sequence t1..tn is the pair (q^n, G) with G the sum of q^i * ti; pairs
    combine as (a, G)(b, H) = (ab, G + aH), so parts can be put together later.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        conv, pos, power, total = None, 0, 1, 0
        for batch in batches:
            ids, hashes, ks = (batch.column(c).to_pylist() for c in ("conv_id", "h", "k"))
            places, powers, before, after = [], [], [], []
            for c, h, k in zip(ids, hashes, ks):
                if c != conv:
                    conv, pos, power, total = c, 0, 1, 0
                pos, power = pos + 1, power * base % PRIME
                before.append(total)
                # Two identities have this in common for few bases only.
                turn = (h & MASK) + (h >> 32) * base + k * base * base + 1
                total = (total + power * turn) % PRIME
                places.append(pos)
                powers.append(power)
                after.append(total)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([block] * len(ids), pa.int32()),
                    "conv_id": batch.column("conv_id"),
                    "h": batch.column("h"),
                    "k": batch.column("k"),
                    "bytes": batch.column("bytes"),
                    "pos": pa.array(places, pa.int64()),
                    "power": pa.array(powers, pa.int64()),
                    "before": pa.array(before, pa.int64()),
                    "g": pa.array(after, pa.int64()),
                }
            )

    return run


SCANNED = "block int, conv_id long, h long, k int, bytes long, pos long, power long, before long, g long"


def placed(turns: DataFrame, base: int) -> DataFrame:
    """Turns numbered from 1 within their conversation, with prefix fingerprints ``before`` and ``g``.

    Turns are dealt out by ranges of (conversation, turn), so one long
    conversation fills many tasks; each scans its part. Only conversations
    that lie in several parts need more: the products of their parts, of which
    there are at most two for each part of the table, are combined on the
    driver and broadcast. ``hot`` marks those conversations.
    """
    # Keys are short, as ranges are drawn from a sample of them; equal rows are told apart.
    tie = [F.substring("role", 1, 64), F.substring("text", 1, 64), F.col("h"), F.col("k")]
    keyed = turns.select(
        "conv_id", "turn", "h", "k", "bytes", F.struct(*tie).alias("tie"), F.monotonically_increasing_id().alias("row")
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("tie"), F.col("row")]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialise(dealt.select("conv_id", "h", "k", "bytes").mapInArrow(scanned(base), SCANNED))
    ends = rows.groupBy("conv_id", "block").agg(F.max(F.struct("pos", "power", "g")).alias("last"))
    several = ends.groupBy("conv_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("conv_id")
    offsets, at = [], {}
    for conv, block, last in ends.join(several, "conv_id", "left_semi").orderBy("conv_id", "block").collect():
        pos, power, total = at.get(conv, (0, 1, 0))
        offsets.append((conv, block, pos, power, total))
        at[conv] = (pos + last.pos, power * last.power % PRIME, (total + power * last.g) % PRIME)
    schema = "conv_id long, block int, pos0 long, power0 long, g0 long"
    offset = F.broadcast(rows.sparkSession.createDataFrame(offsets, schema))
    rows = rows.join(offset, ["conv_id", "block"], "left")

    def shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.to_pydict()
            hot = [g is not None for g in part["g0"]]
            for i, known in enumerate(hot):
                if known:
                    power, total = part["power0"][i], part["g0"][i]
                    part["pos"][i] += part["pos0"][i]
                    part["before"][i] = (total + power * part["before"][i]) % PRIME
                    part["g"][i] = (total + power * part["g"][i]) % PRIME
            part["hot"] = hot
            yield pa.RecordBatch.from_pydict({c.name: pa.array(part[c.name], c.type) for c in PLACED})

    return materialise(
        rows.mapInArrow(shifted, "conv_id long, pos long, h long, k int, bytes long, before long, g long, hot boolean")
    )


PLACED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("pos", pa.int64()),
        ("h", pa.int64()),
        ("k", pa.int32()),
        ("bytes", pa.int64()),
        ("before", pa.int64()),
        ("g", pa.int64()),
        ("hot", pa.bool_()),
    ]
)


def by_conversation(rows: DataFrame, facts: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with the facts of their conversation; the few long ones meet theirs by broadcast.

    ``rows.hot`` marks the rows of the conversations in ``hot``.
    """
    long = F.broadcast(facts.join(F.broadcast(hot), "conv_id", "left_semi"))
    return (
        rows.filter("NOT hot")
        .join(facts, "conv_id")
        .unionByName(rows.filter("hot").join(long, "conv_id"))
    )


def rebuilt(rows: DataFrame, base: int) -> tuple[DataFrame, DataFrame]:
    """Every prefix of every rebuilt conversation, and the conversations of many rows.

    Returns (conv_id, depth, f, parent, h, k, bytes, last, hot): fingerprint f
    of the first ``depth`` rebuilt turns, of all but the last of them, and the
    identity and size of that one; ``last`` where the conversation ends there.
    Texts are not rebuilt: a turn stays where it is stored, and f combines the
    base's head with the own suffix.
    """
    own = rows.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sort_array(
            F.collect_list(F.when(F.col("pos") <= LONGEST_HEAD, F.struct("pos", "h", "k", "bytes", "before", "g")))
        ).alias("head"),
    )
    own = materialise(
        own.withColumn("h_len", (F.crc32(F.col("conv_id").cast("string")) % (LONGEST_HEAD + 1)).cast("int")).withColumn(
            "base", F.col("conv_id") - F.col("conv_id") % FAMILY
        )
    )
    heads = own.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    facts = own.join(heads, "base", "left").select(
        "conv_id",
        "n",
        "h_len",
        F.slice(F.coalesce("base_head", F.array()), F.lit(1), F.col("h_len")).alias("shared"),
        # The own turns that the head replaces.
        F.slice("head", F.lit(1), F.col("h_len")).alias("left_out"),
    )
    length = F.size("shared") + F.greatest(F.col("n") - F.col("h_len"), F.lit(0))
    facts = materialise(
        facts.select(
            "conv_id",
            "h_len",
            "shared",
            F.size("shared").alias("m"),
            F.coalesce(F.try_element_at("shared", F.lit(-1))["g"], F.lit(0)).alias("head_g"),
            F.coalesce(F.try_element_at("left_out", F.lit(-1))["g"], F.lit(0)).alias("out_g"),
            length.cast("long").alias("length"),
        )
    )
    hot = materialise(rows.filter("hot").select("conv_id").distinct())
    root = facts.select(
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("f"),
        F.lit(None).cast("long").alias("parent"),
        F.lit(None).cast("long").alias("h"),
        F.lit(None).cast("int").alias("k"),
        F.lit(0).cast("long").alias("bytes"),
        (F.col("length") == 0).alias("last"),
    )
    shared = facts.select("conv_id", "length", F.explode("shared").alias("t")).select(
        "conv_id",
        F.col("t.pos").alias("depth"),
        F.col("t.g").alias("f"),
        F.col("t.before").alias("parent"),
        "t.h",
        "t.k",
        "t.bytes",
        (F.col("t.pos") == F.col("length")).alias("last"),
    )
    needed = facts.select("conv_id", "h_len", "m", "head_g", "out_g", "length")
    # A suffix moves to the left by what the head has fewer turns than were left out.
    back = [pow(base, -i, PRIME) for i in range(LONGEST_HEAD + 1)]

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.to_pydict()
            moved = zip(part["before"], part["g"], part["head_g"], part["out_g"], part["h_len"], part["m"])
            f, parent = [], []
            for before, g, head, out, h_len, m in moved:
                step = back[h_len - m]
                parent.append((head + step * (before - out)) % PRIME)
                f.append((head + step * (g - out)) % PRIME)
            depth = [m + pos - h for pos, h, m in zip(part["pos"], part["h_len"], part["m"])]
            yield pa.RecordBatch.from_pydict(
                {
                    "conv_id": batch.column("conv_id"),
                    "depth": pa.array(depth, pa.int64()),
                    "f": pa.array(f, pa.int64()),
                    "parent": pa.array(parent, pa.int64()),
                    "h": batch.column("h"),
                    "k": batch.column("k"),
                    "bytes": batch.column("bytes"),
                    "last": pa.array([d == n for d, n in zip(depth, part["length"])]),
                }
            )

    suffix = by_conversation(rows, needed, hot).filter("pos > h_len")
    suffix = suffix.select(
        "conv_id", "pos", "h", "k", "bytes", "before", "g", "head_g", "out_g", "h_len", "m", "length"
    ).mapInArrow(
        combined, "conv_id long, depth long, f long, parent long, h long, k int, bytes long, last boolean"
    )
    return materialise(root.unionByName(shared).unionByName(suffix)), hot


def digests(ends: DataFrame) -> DataFrame:
    """Per node (depth, f): SHA-256 of its ids, ascending and comma-joined.

    Ids are dealt out by ranges of (node, id) and written as text in chunks,
    so a node where very many conversations end fills many tasks. The digest
    itself is sequential by its definition: one task reads the node's chunks
    in order, holding one at a time.
    """
    order = ["depth", "f", "conv_id"]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size = None, [], 0
        out: list[tuple] = []

        def close():
            if ids:
                out.append((*node, ids[0], ",".join(map(str, ids))))

        for batch in batches:
            for depth, f, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (depth, f) != node or size > CHUNK:
                    close()
                    node, ids, size = (depth, f), [], 0
                ids.append(conv)
                size += 20
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*order, "ids"])
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*order, "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for batch in batches:
            for depth, f, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (depth, f) == node:
                    state.update(b",")
                else:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = (depth, f), hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["depth", "f", "sha"])
                out = []
        if node:
            out.append((*node, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["depth", "f", "sha"])

    dealt = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    written = dealt.mapInArrow(chunks, "depth long, f long, conv_id long, ids string")
    ordered = written.repartition("depth", "f").sortWithinPartitions(*order)
    return ordered.select("depth", "f", "ids").mapInArrow(digest, "depth long, f long, sha string")


def nodes_of(prefixes: DataFrame) -> DataFrame | None:
    """One row per distinct prefix; None if two different ones have a fingerprint in common.

    The rows of a node must agree on the identity of their last turn and on
    their parent, which then holds for all turns before it in turn.
    """
    same = [F.min(c).eqNullSafe(F.max(c)) for c in ("parent", "h", "k")]
    nodes = materialise(
        prefixes.groupBy("depth", "f").agg(
            F.count(F.lit(1)).alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            F.max("parent").alias("parent"),
            F.max("bytes").alias("bytes"),
            (same[0] & same[1] & same[2]).alias("same"),
        )
    )
    return nodes if nodes.filter("NOT same").isEmpty() else None


def prefix_trie(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    digest: Column | None = None,
) -> DataFrame:
    """Per distinct prefix of the rebuilt conversations, its place in their trie.

    A conversation c is rebuilt from the first h turns of the conversation
    c - c % 5 and its own turns after its first h, where h = crc32(c) % 9.
    Returns, all long but the last: conv_id (smallest member), depth,
    parent_conv_id (the parent's conv_id, NULL for the root), n_convs
    (members), n_children, n_leaves (nodes without children in its subtree,
    itself included), saved_tokens (over its subtree, the sum of n_convs - 1
    times the UTF-8 bytes of the last text), ends_sha256 (of the ids of the
    members that end there, ascending and comma-joined).

    Sums over subtrees need no walk: every node of a subtree belongs to one
    owner, its smallest member, and a conversation owns the end of its path.
    A node's sum is its owner's from its depth on, plus all that its other
    members own.

    NULL turns come first; turns of equal number by role and text (64
    characters of each, then a hash), so repeated rows stay as further turns.
    A NULL role or text counts as empty. Rows without a conversation id take
    no part. A conversation with fewer turns than h lends all it has, one that
    does not occur lends none; what has no turns left is a member of the root
    alone. An empty table gives an empty one, without a root. Further columns
    are left out. ``digest`` replaces the hash of a turn, a LONG from the
    columns role and text; equal digests are told apart by the texts.
    """
    turns = pick(conversations, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    turns = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("bytes"),
    )
    turns = identified(turns, F.xxhash64("role", "text") if digest is None else digest)
    for base in BASES:
        prefixes, hot = rebuilt(placed(turns, base), base)
        nodes = nodes_of(prefixes)
        if nodes is not None:
            break
    else:
        raise RuntimeError("fingerprints of different prefixes collide for every base")
    return described(nodes, prefixes, hot)


def described(nodes: DataFrame, prefixes: DataFrame, hot: DataFrame) -> DataFrame:
    """The result for the nodes of ``nodes_of`` and the prefixes of ``rebuilt``."""
    children = (
        nodes.filter("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("f"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    ends = digests(prefixes.filter("last"))
    nodes = materialise(
        nodes.join(children, ["depth", "f"], "left")
        .join(ends, ["depth", "f"], "left")
        .select(
            "conv_id",
            "depth",
            "f",
            "parent",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
            F.col("n_children").isNull().cast("long").alias("leaf"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        )
    )

    # What each conversation owns: in all, and from a depth on. Blocks of
    # depths keep a long conversation's windows short.
    block = F.floor(F.col("depth") / DEPTHS)
    blocks = nodes.groupBy("conv_id", block.alias("block")).agg(F.sum("leaf").alias("l"), F.sum("saved").alias("s"))
    later = W.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    beyond = blocks.select(
        "conv_id",
        "block",
        F.coalesce(F.sum("l").over(later), F.lit(0)).alias("l1"),
        F.coalesce(F.sum("s").over(later), F.lit(0)).alias("s1"),
    ).filter("l1 > 0 OR s1 > 0")
    within = W.partitionBy("conv_id", "block").orderBy(F.desc("depth"))
    owned = nodes.withColumn("block", block).withColumns(
        {"l0": F.sum("leaf").over(within), "s0": F.sum("saved").over(within)}
    )
    owned = owned.join(beyond, ["conv_id", "block"], "left").withColumns(
        {"l0": F.col("l0") + F.coalesce("l1", F.lit(0)), "s0": F.col("s0") + F.coalesce("s1", F.lit(0))}
    )

    # What the other members of a node own is all they own. Conversations own
    # their deepest nodes, so those they do not own end above ``first``.
    totals = nodes.groupBy("conv_id").agg(
        F.sum("leaf").alias("l"), F.sum("saved").alias("s"), F.min(F.struct("depth", "parent")).alias("top")
    )
    members = prefixes.select("conv_id", "depth", "f").join(
        F.broadcast(hot.withColumn("hot", F.lit(True))), "conv_id", "left"
    )
    members = members.withColumn("hot", F.coalesce("hot", F.lit(False)))
    others = (
        by_conversation(members, totals, hot)
        .filter("depth < top.depth")
        .groupBy("depth", "f")
        .agg(F.sum("l").alias("l2"), F.sum("s").alias("s2"))
    )

    # A node's parent has the same owner, but for the first node that one owns.
    tops = totals.filter("top.depth > 0").select(
        "conv_id", "top.depth", (F.col("top.depth") - 1).alias("up"), F.col("top.parent").alias("at")
    )
    keys = nodes.select(
        F.col("depth").alias("up"), F.col("f").alias("at"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    least = max(1.0, nodes.count() * HEAVY)
    heavy = F.broadcast(keys.filter(F.col("n_children") >= least).withColumn("heavy", F.lit(True)))
    met = tops.join(heavy.drop("n_children"), ["up", "at"], "left")
    rest = met.filter("heavy IS NULL").drop("parent_conv_id", "heavy")
    light = keys.filter(F.col("n_children") < least).drop("n_children")
    parents = met.filter("heavy").select("conv_id", "depth", "parent_conv_id").union(
        rest.join(light, ["up", "at"]).select("conv_id", "depth", "parent_conv_id")
    )
    return (
        owned.join(others, ["depth", "f"], "left")
        .join(parents, ["conv_id", "depth"], "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id"),
            "n_convs",
            "n_children",
            (F.col("l0") + F.coalesce("l2", F.lit(0))).alias("n_leaves"),
            (F.col("s0") + F.coalesce("s2", F.lit(0))).alias("saved_tokens"),
            "ends_sha256",
        )
    )
