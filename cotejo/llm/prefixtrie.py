"""Trie of conversation prefixes, its subtree totals rolled up by bands of depth."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cotejo.llm.common import record_batch, stage

# Conversations whose first turns the next ones take over, and turns taken over at most, plus one.
FAMILY, TAKEN = 5, 9
# Ids written into one row on the way to a digest.
IDS_A_ROW = 1024
NODE = ["depth", "x", "y"]


def ranked(turns: DataFrame) -> DataFrame:
    """(conv_id, rank, digest, n_bytes) of each turn: its place in its conversation, from 0, and
    the SHA-256 of its role and text.

    Turns are ordered by turn (null first), then by their digest. Rows are dealt by range over
    (conv_id, turn, digest), so a long conversation spreads over tasks; the number of a row in
    its task, and the rows that its conversation has in tasks before, give its rank. Rows
    without conv_id belong to no conversation and are left out.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("digest")]
    dealt = (
        turns.filter("conv_id is not null")
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.unhex(F.sha2(whole, 256)).alias("digest"),
            F.octet_length(text).cast("long").alias("n_bytes"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "digest", "n_bytes", F.monotonically_increasing_id().alias("at"))
    )
    placed = stage(dealt).withColumn("part", F.shiftright("at", 33))
    # A row for each conversation and task that holds turns of it.
    pieces = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first_at"), F.count("*").alias("n_here"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("conv_id", "part", "first_at", F.coalesce(F.sum("n_here").over(before), F.lit(0)).alias("n_before"))
    return placed.join(pieces, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") - F.col("first_at") + F.col("n_before")).alias("rank"), "digest", "n_bytes"
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, n_turns) and their turns (conv_id, place, digest, n_bytes).

    Conversation c begins with the first h turns of conversation c - c % FAMILY and goes on with
    its own after its first h, where h is the CRC-32 of c's decimal, modulo TAKEN.
    """
    placed = stage(ranked(turns))
    sizes = placed.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % TAKEN
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY).cast("long"))
    sizes = sizes.select("conv_id", "n_own", h.alias("h"), base.alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    sizes = (
        sizes.join(bases, "base", "left")
        .withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
        .withColumn("n_turns", F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
    )
    sizes = stage(sizes)
    own = placed.join(sizes.select("conv_id", "h", "taken"), "conv_id").filter("rank >= h")
    own = own.select("conv_id", (F.col("rank") - F.col("h") + F.col("taken")).alias("place"), "digest", "n_bytes")
    # At most TAKEN - 1 turns of a base go to at most FAMILY conversations.
    heads = placed.filter((F.col("rank") < TAKEN - 1) & (F.pmod("conv_id", F.lit(FAMILY).cast("long")) == 0))
    heads = heads.withColumnRenamed("conv_id", "base").join(sizes.select("conv_id", "base", "taken"), "base")
    heads = heads.filter("rank < taken").select("conv_id", F.col("rank").alias("place"), "digest", "n_bytes")
    return sizes.select("conv_id", "n_turns"), own.unionByName(heads)


def prefixes(turns: DataFrame, height: int) -> DataFrame:
    """One row per turn: its conversation, the node it leads to (depth, x, y) and that node's
    parent, the ``above`` nodes of its band from the band's top to itself, the ``entry`` node over
    the band, and the bytes of its text.

    A node is known by its depth and two 64-bit exclusive ors of hashes of (place, turn) along
    the prefix. Such sums can be cut anywhere: a conversation is grouped by bands of ``height``
    turns, and the bands' own sums, one row each, carry the prefix over them. Two nodes out of n
    are taken for one with a probability of about n * n / 2**129.
    """
    x = F.xxhash64(F.lit("x"), F.col("place"), F.col("digest"))
    y = F.xxhash64(F.col("digest"), F.col("place"), F.lit("y"))
    bands = (
        turns.select("conv_id", "place", F.expr(f"place div {height}").alias("band"), x.alias("x"), y.alias("y"), "n_bytes")
        .groupBy("conv_id", "band")
        .agg(
            F.sort_array(F.collect_list(F.struct("place", "x", "y", "n_bytes"))).alias("turns"),
            F.bit_xor("x").alias("x"),
            F.bit_xor("y").alias("y"),
        )
    )
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.withColumns(
        {c: F.coalesce(F.bit_xor(c).over(before), F.lit(0).cast("long")) for c in ("x", "y")}
    )
    # Prefix sums within the band; its length is bounded by the height.
    path = F.expr(
        """transform(sequence(1, size(turns)), i -> aggregate(slice(turns, 1, i),
             named_struct('depth', band * {height}, 'x', x, 'y', y),
             (a, t) -> named_struct('depth', t.place + 1, 'x', a.x ^ t.x, 'y', a.y ^ t.y)))""".format(height=height)
    )
    entry = F.struct((F.col("band") * height).alias("depth"), "x", "y").alias("entry")
    at = bands.select("conv_id", "band", "turns", entry, path.alias("path")).select(
        "conv_id", "band", "entry", "path", F.posexplode("turns").alias("i", "turn")
    )
    return at.select(
        "conv_id",
        "band",
        "entry",
        F.expr("if(i = 0, entry, path[i - 1])").alias("parent"),
        F.expr("slice(path, 1, i + 1)").alias("above"),
        F.expr("path[i].depth").alias("depth"),
        F.expr("path[i].x").alias("x"),
        F.expr("path[i].y").alias("y"),
        F.col("turn.n_bytes").alias("n_bytes"),
    )


def list_digests(ids: DataFrame, keys: list[str]) -> DataFrame:
    """SHA-256 of the decimal ids of each key, ascending, joined by commas: keys, ``ends_sha256``.

    ``ids`` are dealt by range over (keys, conv_id), so that a key with many ids spreads; tasks
    write IDS_A_ROW ids into a row. Then a key's rows meet in order in one task, which feeds them
    to the hash one by one and holds none.
    """
    kinds = {f.name: f.dataType.simpleString() for f in ids.schema.fields}
    head = ", ".join(f"{k} {kinds[k]}" for k in keys)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*keys, "first", "listed"]
        types = [pa.int64()] * len(keys) + [pa.int64(), pa.string()]
        for batch in batches:
            rows, last, held = [], None, []
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (*keys, "conv_id")]
            for *key, value in zip(*columns):
                if held and (key != last or len(held) >= IDS_A_ROW):
                    rows.append((*last, held[0], ",".join(map(str, held))))
                    held = []
                last = key
                held.append(value)
            if held:
                rows.append((*last, held[0], ",".join(map(str, held))))
            if rows:
                yield record_batch(pa.schema(list(zip(names, types))), zip(*rows))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(k, pa.int64()) for k in keys] + [("ends_sha256", pa.string())])
        last, state = None, None
        for batch in batches:
            rows = []
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (*keys, "listed")]
            for *key, text in zip(*columns):
                if key == last:
                    state.update(b"," + text.encode())
                    continue
                if last is not None:
                    rows.append((*last, state.hexdigest()))
                last, state = key, hashlib.sha256(text.encode())
            if rows:
                yield record_batch(schema, zip(*rows))
        if last is not None:
            yield record_batch(schema, zip((*last, state.hexdigest())))

    order = [*keys, "conv_id"]
    listed = (
        ids.select(*[F.col(k).cast("long").alias(k) for k in keys], "conv_id")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(write, f"{head}, first long, listed string")
    )
    return (
        listed.repartition(*keys)
        .sortWithinPartitions(*keys, "first")
        .select(*keys, "listed")
        .mapInArrow(digest, f"{head}, ends_sha256 string")
    )


def trie(turns: DataFrame, height: int | None = None) -> DataFrame:
    """Nodes of the trie of rebuilt conversations: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, turn, role, text; other columns are not read. Null roles and texts
    are empty; turns of one number are ordered by a digest of role and text, repeated rows are
    turns of their own; rows without conv_id are left out; no conversations, no nodes.

    Depths are cut into bands of ``height`` (by default the root of the greatest depth, so that
    neither the rounds nor the ancestors of a node in its band outgrow it). A round, from the
    deepest band up, joins to the nodes of its band what the bands below gave to them, and sums
    all for the node over the band: one row per node over a band goes on to the next round. In
    the end each node, with what it got from below, is exploded to its ancestors in its band, and
    these sums are the totals of all subtrees. Hot nodes are summed in the tasks first.
    """
    sizes, places = rebuilt(turns)
    sizes = stage(sizes)
    most, smallest, n_convs = sizes.agg(F.max("n_turns"), F.min("conv_id"), F.count("*")).first()
    if height is None:
        height = max(4, math.isqrt(most or 0) + 1)
    paths = prefixes(places, height)
    nodes = paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("n_bytes").alias("n_bytes"),
        F.max("band").alias("band"),
        F.min(F.struct("parent", "entry", "above")).alias("place"),
    )
    nodes = nodes.select(*NODE, "conv_id", "n_convs", "band", "place.*", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    root = turns.sparkSession.createDataFrame(
        [(0, 0, 0, smallest, n_convs)] if n_convs else [], "depth long, x long, y long, conv_id long, n_convs long"
    )
    none = F.struct(F.lit(-1).cast("long").alias("depth"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))
    root = root.select(
        "*",
        F.lit(-1).cast("long").alias("band"),
        none.alias("parent"),
        none.alias("entry"),
        F.array(F.struct(*NODE)).alias("above"),
        F.lit(0).cast("long").alias("saved"),
    )
    nodes = nodes.unionByName(root)
    children = nodes.groupBy("parent").agg(F.count("*").alias("n_children")).select("parent.*", "n_children")
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = stage(nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long")))

    def with_below(part: DataFrame, below: DataFrame | None) -> DataFrame:
        if below is None:
            return part.withColumns({"all_saved": F.col("saved"), "all_leaves": F.col("leaves")})
        return part.join(below, NODE, "left").withColumns(
            {
                "all_saved": F.col("saved") + F.coalesce("below_saved", F.lit(0).cast("long")),
                "all_leaves": F.col("leaves") + F.coalesce("below_leaves", F.lit(0).cast("long")),
            }
        )

    given, below = [], None
    for band in range(((most or 0) - 1) // height, -1, -1):
        sums = with_below(nodes.filter(F.col("band") == band), below)
        below = stage(
            sums.groupBy("entry")
            .agg(F.sum("all_saved").alias("below_saved"), F.sum("all_leaves").alias("below_leaves"))
            .select("entry.*", "below_saved", "below_leaves")
        )
        given.append(below)
    every = None
    for part in given:
        every = part if every is None else every.unionByName(part)
    totals = (
        with_below(nodes, every)
        .select(F.explode("above").alias("n"), "all_saved", "all_leaves")
        .groupBy("n")
        .agg(F.sum("all_saved").alias("saved_tokens"), F.sum("all_leaves").alias("n_leaves"))
        .select("n.*", "saved_tokens", "n_leaves")
    )
    last = paths.select("conv_id", *NODE).join(sizes.filter("n_turns > 0"), "conv_id").filter("depth = n_turns")
    turnless = sizes.filter("n_turns = 0").select("conv_id", *[F.lit(0).cast("long").alias(c) for c in NODE])
    ends = list_digests(last.select("conv_id", *NODE).unionByName(turnless), NODE)
    # The root is the parent of the nodes at depth 1; all others look theirs up.
    parents = nodes.filter("depth > 0").select(F.struct(*NODE).alias("parent"), F.col("conv_id").alias("found_conv_id"))
    return (
        nodes.join(totals, NODE)
        .join(ends, NODE, "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") == 1, F.lit(smallest).cast("long")).otherwise(F.col("found_conv_id")).alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
