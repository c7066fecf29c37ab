"""Shards with equal row counts by balanced label propagation.

Documents that share a key (equal texts, unless other links are given) are linked. Labels spread
along the keys: every document wants the shard in which most of its key lies, and a shard takes
no more moves than it has room for. At the end the labels are cut to exact quotas by ranks, whole
keys side by side, so that few links cross shards.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import stage

ROUNDS = 6


def identified(docs: DataFrame) -> DataFrame:
    """Number of each row, doc_id, size in bytes and one, CRC-32 and key of the text."""
    raw = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.md5(raw).alias("key"),
    )


def spread(links: DataFrame, shards: int, room: int) -> tuple[DataFrame | None, list[int]]:
    """Labels (row, label) of keys with more rows than a shard has, and the rows they take of
    each shard. Such a key is dealt over as few neighbouring shards as hold it. There are at most
    as many of these keys as shards times keys of a row, so their counts may go to the driver."""
    large = sorted(links.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > room).collect(), key=lambda r: (-r.c, r.key))
    taken, start, label = [0] * shards, 0, None
    for r in large:
        width = min(shards, -(-r.c // room))
        here = F.pmod(F.pmod(F.xxhash64("row"), F.lit(width)) + start, F.lit(shards)).cast("int")
        label = F.when(F.col("key") == r.key, here) if label is None else label.when(F.col("key") == r.key, here)
        for s in range(width):
            taken[(start + s) % shards] += -(-r.c // width)
        start = (start + width) % shards
    if label is None:
        return None, taken
    return stage(links.withColumn("label", label).filter("label is not null").groupBy("row").agg(F.min("label").alias("label"))), taken


def propagate(links: DataFrame, shards: int, room: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Labels (row, label) of the rows of ``links`` (row, key) after some rounds of moves; a
    shard has room for ``room`` rows.

    Only counts by shard reach the driver. Votes of a key are summed before they are sent, so a
    key of any size costs as many rows as it has labels.
    """
    # Rows start by hash where there is room.
    place, start, label = F.pmod(F.xxhash64("row"), F.lit(max(1, sum(max(0, r) for r in room)))), 0, F.lit(0)
    for s in range(shards):
        if room[s] > 0:
            label = F.when(place >= start, F.lit(s)).otherwise(label)
            start += room[s]
    labels = stage(links.select("row").distinct().select("row", label.cast("int").alias("label")))
    for turn in range(rounds):
        votes = links.join(labels, "row").groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
        # Ties go to the shard that the key names, so that not all ties want the same one.
        tie = F.xxhash64("key", "label")
        wanted = votes.groupBy("key").agg(F.max(F.struct("c", tie.alias("t"), "label")).alias("top"))
        wish = links.join(wanted, "key").groupBy("row").agg(F.max("top").alias("top")).select("row", F.col("top.label").alias("wish"))
        asked = stage(labels.join(wish, "row"))
        flows = asked.groupBy("label", "wish").agg(F.count(F.lit(1)).alias("c")).collect()
        here, asking, leaving = [0] * shards, [0] * shards, [0] * shards
        for f in flows:
            here[f.label] += f.c
            if f.label != f.wish:
                asking[f.wish] += f.c
                leaving[f.label] += f.c
        if not any(asking):
            break
        share = [min(1.0, max(0, room[s] - here[s] + leaving[s]) / asking[s]) if asking[s] else 0.0 for s in range(shards)]
        luck = F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(1 << 20)) / float(1 << 20)
        goes = luck < F.element_at(F.array(*map(F.lit, share)), F.col("wish") + 1)
        labels = stage(asked.select("row", F.when(goes, F.col("wish")).otherwise(F.col("label")).alias("label")))
    return labels


def ranked(df: DataFrame) -> DataFrame:
    """Replace ``at``, a monotonically increasing id, by gapless ranks in its order.

    One count for each partition is summed up; the rows stay where they are.
    """
    df = df.withColumn("part", F.shiftright("at", 33))
    counts = {r.part: r.c for r in df.groupBy("part").agg(F.count(F.lit(1)).alias("c")).collect()}
    starts, total = {}, 0
    for part in sorted(counts):
        starts[part], total = total, total + counts[part]
    table = df.sparkSession.createDataFrame([(p, s) for p, s in starts.items()], "part long, start long")
    return df.join(F.broadcast(table), "part").withColumn("rank", F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("part", "start", "at")


def shard(docs: DataFrame, shards: int = 16, links: DataFrame | None = None) -> DataFrame:
    """Shard and slot of every row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law,
    shard, slot, grown_shard.

    Law ``rows``: the shards' row counts differ by one at most. ``links`` (doc_id, key) may link
    documents by other keys than equal texts. A null text counts as empty; empty texts are equal
    texts. A group larger than a shard fills whole shards one after the other. Repeated rows and
    null ids are rows like others; other columns are not read; an empty table gives no rows.
    """
    rows = stage(identified(docs))
    if links is None:
        several = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
        member = rows.join(several, "key", "left_semi").select("row", "key")
    else:
        member = rows.drop("key").join(links.select("doc_id", F.col("key").cast("string").alias("key")), "doc_id").select("row", "key")
    member = stage(member)
    total = rows.count()
    # Shards 0 .. total % shards - 1 hold one row more.
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    room = math.ceil(total / shards)
    large, taken = spread(member, shards, max(room, 1))
    rest = member if large is None else stage(member.join(large, "row", "left_anti"))
    labels = propagate(rest, shards, [room - t for t in taken])
    if large is not None:
        labels = stage(labels.unionByName(large))
    first_key = member.groupBy("row").agg(F.min("key").alias("key"))
    linked = stage(
        labels.join(first_key, "row").orderBy("label", "key", "row").withColumn("at", F.monotonically_increasing_id())
    )
    held = [0] * shards
    for r in linked.groupBy("label").agg(F.count(F.lit(1)).alias("c")).collect():
        held[r.label] = r.c
    lone = stage(rows.join(labels, "row", "left_anti").select("row").withColumn("at", F.monotonically_increasing_id()))
    placed = _cut(ranked(linked.drop("key")), ranked(lone), held, quota)
    return rows.join(placed, "row").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _cut(linked: DataFrame, lone: DataFrame, held: list[int], quota: list[int]) -> DataFrame:
    """Rows (row, shard, slot): what a label holds beyond its quota, and then the rows without
    links, fill the free slots of all shards in order. Arithmetic on ranks only."""
    n = len(quota)
    pick = lambda values, at: F.element_at(F.array(*(F.lit(int(v)) for v in values)), at.cast("int") + 1)
    starts = [sum(held[:s]) for s in range(n)]
    over = [max(0, held[s] - quota[s]) for s in range(n)]
    free = [max(0, quota[s] - held[s]) for s in range(n)]
    before_over, before_free = [sum(over[:s]) for s in range(n)], [sum(free[:s]) for s in range(n)]
    place = F.col("rank") - pick(starts, F.col("label"))
    excess = place - pick(quota, F.col("label"))
    linked = linked.select("row", "label", place.alias("place"), excess.alias("excess"))
    stay = linked.filter("excess < 0").select("row", F.col("label").alias("shard"), F.col("place").alias("slot"))
    moved = linked.filter("excess >= 0").select("row", (F.col("excess") + pick(before_over, F.col("label"))).alias("i"))
    pool = moved.unionByName(lone.select("row", (F.col("rank") + sum(over)).alias("i")))
    # The shard of pool place i is the last one with free slots that starts at or before it.
    target = F.lit(0)
    for s in range(n):
        if free[s]:
            target = F.when(F.col("i") >= before_free[s], F.lit(s)).otherwise(target)
    pool = pool.withColumn("shard", target)
    begin = [held[s] - before_free[s] for s in range(n)]
    filled = pool.select("row", F.col("shard").cast("int").alias("shard"), (F.col("i") + pick(begin, F.col("shard"))).alias("slot"))
    kinds = {"row": "long", "shard": "int", "slot": "long"}
    cast = lambda df: df.select(*(F.col(c).cast(k).alias(c) for c, k in kinds.items()))
    return cast(stay).unionByName(cast(filled))
