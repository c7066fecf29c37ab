"""Jaccard join on word shingles by grouped prefixes.

Shingles have one global order: rare before frequent, then by hash. Two sets with enough overlap
share a shingle of their prefixes. Documents with the same prefix and set size form one group;
groups meet on prefix shingles, pairs of groups are filtered by size and position, then expanded
to their members and verified on the whole sets.

Only connections matter, so pairs are verified in two steps. First every group with its next two
in each shingle's list, and every member with its group's head. Then, with the components found,
every remaining pair that passes the filters and would join two components: short lists pair by
pair, long ones, which only large groups of near copies have, in blocks. No pair is left out but
those already connected, so the components are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cotejo.llm.common import components, digest, keep_ids, record_batch, shingle_set, small_batches, stage, texts_of

# Documents in which a shingle may lie and still count as rare. Any value gives the same result.
RARE = 32
# Bits of the table of frequent shingles, 2 MB at any input size; a full table only means that
# more shingles count as frequent.
TABLE_BITS = 24
# Rows in an output batch of a task.
FLUSH = 200_000

SETS = "doc_id long, s long, n int, g long, prefix array<long>"


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _reach(n: int, percent: int) -> int:
    """Shingles of a set that are counted: its prefix and half as many more."""
    return min(n, prefix_length(n, percent) * 3 // 2 + 1)


def frequent_shingles(docs: DataFrame, percent: int, size: int, rounds: int = 2) -> np.ndarray:
    """Bit table of the shingles that lie in the first parts of more than ``RARE`` sets.

    Where frequent shingles leave a prefix, others move up into it; each further round counts
    those and no others. The table only orders shingles. Its 2**18 words are all that reaches
    the driver.
    """
    words = 1 << (TABLE_BITS - 6)
    table = np.zeros(words, np.uint64)
    for turn in range(rounds):
        found = _counted(docs, percent, size, table if turn else None)
        table[found["word"].to_numpy()] |= found["bits"].to_numpy().view(np.uint64)
    return table


def _counted(docs: DataFrame, percent: int, size: int, known: np.ndarray | None) -> pa.Table:
    """Words of the bit table of shingles found frequent, beyond those of the table ``known``."""
    table = None if known is None else docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        parts: list[np.ndarray] = []
        schema = pa.schema([("h", pa.int64()), ("c", pa.int64())])
        frequent = None if table is None else table.value

        def flush():
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            parts.clear()
            return record_batch(schema, [keys.view(np.int64), counts])

        held = 0
        for batch in batches:
            for raw in texts_of(batch):
                keys = shingle_set(raw, size)
                if not len(keys) or (s := digest(keys)) in seen:
                    continue
                seen.add(s)
                reach = _reach(len(keys), percent)
                if frequent is None:
                    first = keys[:reach]
                else:
                    common = is_frequent(frequent, keys)
                    moved = int(common[:reach].sum())
                    first = keys[reach:][~common[reach:]][:moved]
                if len(first):
                    parts.append(first)
                    held += len(first)
                if held > FLUSH:
                    yield flush()
                    held = 0
        if parts:
            yield flush()

    mask = (1 << (TABLE_BITS - 6)) - 1
    words = (
        docs.select("text")
        .mapInArrow(run, "h long, c long")
        .groupBy("h")
        .agg(F.sum("c").alias("c"))
        .filter(F.col("c") > RARE)
        .select(F.expr(f"cast(shiftrightunsigned(h, 6) & {mask}L as int)").alias("word"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    with small_batches(docs.sparkSession):
        return words.toArrow()


def is_frequent(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys >> np.uint64(6)) & np.uint64(len(table) - 1)
    return (table[at] >> (keys & np.uint64(63))) & np.uint64(1) == 1


def document_sets(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """doc_id, set digest s, set size n, group g and the group's prefix, which a task gives once."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, percent, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("s", pa.int64()), ("n", pa.int32()), ("g", pa.int64()), ("prefix", pa.list_(pa.int64()))])
        seen: set[int] = set()
        frequent = table.value
        for batch in batches:
            rows, held = [], 0
            for doc, raw in zip(batch.column(0).to_pylist(), texts_of(batch)):
                keys = shingle_set(raw, size)
                n = len(keys)
                if not n:
                    rows.append((doc, None, 0, None, None))
                    continue
                common = is_frequent(frequent, keys)
                prefix = np.concatenate([keys[~common], keys[common]])[: prefix_length(n, percent)]
                g = digest(prefix, seed=n)
                # Rows without an id link to nothing, so the prefix goes out with one that has an id.
                new = doc is not None and g not in seen
                rows.append((doc, digest(keys), n, g, prefix.view(np.int64) if new else None))
                if new:
                    held += len(prefix)
                    seen.add(g)
                if held > FLUSH:
                    yield record_batch(schema, zip(*rows))
                    rows, held = [], 0
            if rows:
                yield record_batch(schema, zip(*rows))

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SETS)


def _compatible(percent: int, n: str, pos: str, m: str, qos: str):
    """Size and position filters of two groups that share a shingle at these positions."""
    return F.expr(
        f"100L * least({n}, {m}) >= {percent}L * greatest({n}, {m}) and "
        f"{100 + percent}L * least({n} - {pos}, {m} - {qos}) >= {percent}L * ({n} + {m})"
    )


def _buckets(sets: DataFrame, percent: int) -> DataFrame:
    """Prefix shingles of two groups or more, each group with its next two that are compatible."""
    tokens = sets.filter("prefix is not null").select("g", "n", F.posexplode("prefix").alias("pos", "h"))
    order = Window.partitionBy("h").orderBy("n", "g")
    rows = tokens.withColumn("before", F.lag("g").over(order)).filter("before is null or before <> g").drop("before")
    for i in (1, 2):
        for name in ("g", "n", "pos"):
            rows = rows.withColumn(f"{name}{i}", F.lead(name, i).over(order))
    rows = rows.withColumn("lone", F.lag("g").over(order).isNull() & F.col("g1").isNull()).filter("not lone")
    for i in (1, 2):
        rows = rows.withColumn(f"g{i}", F.when(_compatible(percent, "n", "pos", f"n{i}", f"pos{i}"), F.col(f"g{i}")))
    return rows.select("h", "g", "n", "pos", "g1", "g2")


def _verify(docs: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int, size: int) -> DataFrame:
    """Pairs (a, b) of ids whose whole sets are similar enough."""
    ids = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    wanted = stage(sets.join(ids, "rep", "left_semi").select("rep", "s"))
    rows = docs.selectExpr("cast(doc_id as long) rep", "text")
    texts = keep_ids(rows, wanted, "rep").join(wanted, "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        last: tuple = (None, None)
        for batch in batches:
            good = []
            ids = zip(*(batch.column(i).to_pylist() for i in range(4)))
            for (a, b, sa, sb), left, right in zip(ids, texts_of(batch, "ta"), texts_of(batch, "tb")):
                if last[0] != (b, sb):
                    last = ((b, sb), shingle_set(right, size))
                x, y = shingle_set(left, size), last[1]
                if digest(x) != sa or digest(y) != sb:  # another row of the same id
                    continue
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    good.append((a, b))
            if good:
                yield record_batch(schema, zip(*good))

    left = texts.select(F.col("rep").alias("a"), F.col("s").alias("sa"), F.col("text").alias("ta"))
    right = texts.select(F.col("rep").alias("b"), F.col("s").alias("sb"), F.col("text").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb", "ta", "tb").mapInArrow(run, "a long, b long").distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def similar(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """Component of every row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Documents link when 100 * shared >= percent * union of their shingle sets. Null or empty
    texts have no shingles and stand alone, also beside each other. Rows with one doc_id count
    as one document; a null doc_id links to nothing and has a null component. Repeated rows are
    returned each. Other columns are not read.
    """
    rows = stage(document_sets(docs, percent, size))
    sets = stage(
        rows.filter("n > 0 and doc_id is not null").groupBy("s").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("g").alias("g"))
    )
    groups = sets.groupBy("g").agg(F.min("rep").alias("head"))
    buckets = stage(_buckets(rows.filter("doc_id is not null"), percent))
    met = (
        buckets.select("g", F.explode(F.array("g1", "g2")).alias("o"))
        .filter("o is not null and o <> g")
        .select(F.least("g", "o").alias("g"), F.greatest("g", "o").alias("o"))
        .distinct()
        .join(groups.withColumnRenamed("head", "a"), "g")
        .join(groups.select(F.col("g").alias("o"), F.col("head").alias("b")), "o")
        .select("a", "b")
    )
    heads = sets.join(groups, "g").filter("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b"))
    tried = stage(_ordered(met.unionByName(heads)))
    same = rows.filter("doc_id is not null and n > 0").select("doc_id", "s").join(sets.select("s", "rep"), "s")
    # Rows with one id and different texts are one document: link their sets' representatives.
    repeated = same.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high")
    own = same.join(repeated, "doc_id").select(F.col("low").alias("a"), F.col("rep").alias("b"))
    first = components(_verify(docs, tried, sets, percent, size).unionByName(own))
    more = stage(_across(docs, buckets, sets, tried, first, percent, size))
    final = first
    if not more.isEmpty():
        final = components(more.unionByName(first.select(F.col("component").alias("a"), F.col("v").alias("b"))))
    found = sets.join(final, sets["rep"] == final["v"], "left").select("s", F.coalesce("component", "rep").alias("component_id"))
    return rows.join(found, "s", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.least(F.coalesce("component_id", "doc_id"), "doc_id")).alias("component_id"),
    )


def _across(docs: DataFrame, buckets: DataFrame, sets: DataFrame, tried: DataFrame, first: DataFrame, percent: int, size: int) -> DataFrame:
    """Links (a, b) between different components: of short lists pair by pair, of long ones in
    blocks. A group with several sets is a list of its own."""
    members = stage(
        sets.join(first, sets["rep"] == first["v"], "left").select("g", "n", "rep", "s", F.coalesce("component", "rep").alias("k"))
    )
    kinds = members.groupBy("g", "k").agg(F.count(F.lit(1)).alias("m"), F.first("n").alias("n"))
    alone = kinds.groupBy("g").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("g")
    alone = alone.join(kinds, "g").select(F.col("g").alias("h"), "g", "n", F.lit(0).alias("pos"), "k", "m")
    listed = buckets.select("h", "g", "n", "pos").join(kinds.drop("n"), "g").select("h", "g", "n", "pos", "k", "m").unionByName(alone)
    totals = listed.groupBy("h").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.sum("m").alias("total"))
    listed = stage(listed.join(totals.filter("low <> high").select("h", "total"), "h"))
    # Each part is staged by itself: the driver holds the plan of a job, and draws it anew after every shuffle.
    pairs = stage(_short_lists(listed.filter(F.col("total") <= RARE), members, percent).join(tried, ["a", "b"], "left_anti"))
    short = stage(_verify(docs, pairs, sets, percent, size))
    return short.unionByName(_long_lists(docs, listed.filter(F.col("total") > RARE), members, percent, size))


def _short_lists(listed: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of different components whose groups pass the filters; a list of ``RARE``
    members at most gives a bounded number."""
    other = listed.select("h", *(F.col(c).alias(f"{c}_o") for c in ("g", "n", "pos", "k")))
    return _ordered(
        listed.join(other, "h")
        .filter("k < k_o")
        .filter(_compatible(percent, "n", "pos", "n_o", "pos_o"))
        .select("g", "k", "g_o", "k_o")
        .distinct()
        .join(members.select("g", "k", F.col("rep").alias("a")), ["g", "k"])
        .join(members.select(F.col("g").alias("g_o"), F.col("k").alias("k_o"), F.col("rep").alias("b")), ["g_o", "k_o"])
        .select("a", "b")
    )


# Documents of a block; a task compares two blocks.
BLOCK = 256


def _long_lists(docs: DataFrame, listed: DataFrame, members: DataFrame, percent: int, size: int) -> DataFrame:
    """Links between components among documents that share long lists.

    Such lists are left only where documents consist of frequent shingles, as large groups of
    near copies do; the lists of one group have the same members. Lists with common members make
    a cluster, a cluster is dealt into blocks, and every two blocks meet in one task, which sends
    on only links that join components.
    """
    heads = listed.groupBy("h").agg(F.min("g").alias("b"))
    cluster = components(listed.select("h", F.col("g").alias("a")).join(heads, "h").select("a", "b"))
    single = heads.select(F.col("b").alias("v"), F.col("b").alias("component")).join(cluster, "v", "left_anti")
    cluster = cluster.unionByName(single.distinct())
    dealt = members.join(cluster, members["g"] == cluster["v"]).select("rep", "s", "k", F.col("component").alias("c"))
    counts = dealt.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = stage(dealt.join(counts, "c").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")))
    texts = keep_ids(docs.selectExpr("cast(doc_id as long) rep", "text"), dealt, "rep").join(dealt, "rep")
    met = texts.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "rep", "s", "k", "text", "c", F.least("block", "o").alias("lo"), F.greatest("block", "o").alias("hi"), "block"
    )

    def run(table: pa.Table) -> pa.Table:
        sets, ids, labels, blocks = [], [], [], []
        rows = zip(*(table[c].to_pylist() for c in ("rep", "s", "k", "block")), (v.as_py() for v in table["text"].cast(pa.binary())))
        seen = set()
        for rep, s, k, block, raw in rows:
            keys = shingle_set(raw, size)
            if (rep, s) not in seen and len(keys) and digest(keys) == s:
                seen.add((rep, s))
                sets.append(keys)
                ids.append(rep)
                labels.append(k)
                blocks.append(block)
        links = _joining(sets, labels, percent)
        return pa.table({"a": pa.array([ids[i] for i, _ in links], pa.int64()), "b": pa.array([ids[j] for _, j in links], pa.int64())})

    return met.groupBy("c", "lo", "hi").applyInArrow(run, "a long, b long")


def _joining(sets: list[np.ndarray], labels: list[int], percent: int) -> list[tuple[int, int]]:
    """Pairs of similar sets of different labels, but none whose labels are joined already."""
    if len(set(labels)) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[token] > 1
    owner, token = owner[shared], np.unique(token[shared], return_inverse=True)[1]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    edges = np.searchsorted(token, np.arange(0, (token[-1] if len(token) else 0) + width + 1, width))
    for at, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        part = np.zeros((len(sets), width), np.float32)
        part[owner[lo:hi], token[lo:hi] - at * width] = 1
        common += part @ part.T
    names = {k: i for i, k in enumerate(dict.fromkeys(labels))}
    label = np.array([names[k] for k in labels])
    union = sizes[:, None] + sizes[None, :] - common
    good = np.triu(100 * common >= percent * union, 1) & (label[:, None] != label[None, :])
    parent = list(range(len(names)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i, j in np.argwhere(good).tolist():
        a, b = root(label[i]), root(label[j])
        if a != b:
            parent[a] = b
            links.append((i, j))
    return links


def keep_one(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """Rows of ``docs``, all columns, but those of a document that is not the smallest of its
    component. Of rows with one doc_id and equal texts one stays. Documents without shingles stay,
    as do rows with a null doc_id."""
    from cotejo.llm.common import drop_ids, keep_ids

    found = stage(similar(docs, percent, size))
    repeated = found.filter("doc_id is not null and n_shingles > 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("doc_id")
    kept = drop_ids(docs, found.filter("component_id < doc_id").select("doc_id"))
    repeated = stage(repeated)
    # Only rows of repeated ids are dealt by id and text.
    copies = keep_ids(kept, repeated).dropDuplicates(["doc_id", "text"])
    return drop_ids(kept, repeated).unionByName(copies)
