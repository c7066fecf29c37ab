"""Helpers shared by the operators: staged tables, bounded id filters, word hashes, components."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotejo.session import ensure_checkpoint_dir

# Words are runs without ASCII white space; the same class in Java and in ``bytes.split``.
SPACE = "[\\x20\\x09-\\x0D]+"
# Bits of the id filter; as a table of 64-bit words it has 2**18 rows, 4 MB, at any input size.
FILTER_BITS = 24


# Rows that a Python worker gets at a time in staged work: texts may be long.
BATCH_ROWS = 512


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS):
    """Within, jobs that start hand Python workers ``rows`` rows at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stage(df: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage ends here, a lost
    executor costs nothing, and later joins know the size of the table."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cotejo-llm/{uuid.uuid4().hex}"
    with small_batches(spark, rows):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slot_word(key):
    return F.shiftrightunsigned(key, 6).bitwiseAND(F.lit((1 << (FILTER_BITS - 6)) - 1)).cast("int")


def id_filter(ids: DataFrame, column: str) -> DataFrame:
    """Bits of the hashed ids as (word, bits): at most 2**18 rows however many ids there are."""
    key = F.xxhash64(F.col(column).cast("long"))
    return (
        ids.filter(F.col(column).isNotNull())
        .select(key.alias("h"))
        .select(slot_word(F.col("h")).alias("__word"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("__bit"))
        .groupBy("__word")
        .agg(F.bit_or("__bit").alias("__bits"))
    )


def mark_possible(df: DataFrame, column: str, bits: DataFrame, flag: str) -> DataFrame:
    """Add ``flag``: false where the id is surely not in the filter. The table broadcast here has
    at most 2**18 rows by construction. A full filter lets every row pass, which is still right."""
    key = F.xxhash64(F.col(column).cast("long"))
    return (
        df.withColumn("__h", key)
        .withColumn("__word", slot_word(F.col("__h")))
        .join(F.broadcast(bits), "__word", "left")
        .withColumn(flag, F.coalesce(F.expr("(shiftrightunsigned(__bits, cast(__h & 63 as int)) & 1L) = 1L"), F.lit(False)))
        .drop("__h", "__word", "__bits")
    )


def keep_ids(df: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose id is in ``ids``; only rows that pass the bounded filter are shuffled."""
    ids = ids.select(F.col(column)).distinct()
    possible = mark_possible(df, column, id_filter(ids, column), "__possible").filter("__possible").drop("__possible")
    return possible.join(ids, column, "left_semi").select(*df.columns)


def drop_ids(df: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose id is not in ``ids`` (null ids stay). Rows that the bounded filter
    excludes pass straight through; only the others, mostly those to go, are shuffled."""
    ids = ids.select(F.col(column)).distinct()
    marked = mark_possible(df, column, id_filter(ids, column), "__possible")
    sure = marked.filter("not __possible").select(*df.columns)
    return sure.unionByName(marked.filter("__possible").join(ids, column, "left_anti").select(*df.columns))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes | None]:
    """UTF-8 bytes of a string column, one value at a time."""
    return (v.as_py() for v in batch.column(batch.schema.get_field_index(column)).cast(pa.binary()))


def mix(keys: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash (fixed multipliers of a public finalizer)."""
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


# Odd multiplier of the word hash, and of the places in a shingle.
MULTIPLIER, PLACES = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
# Bytes of text that are hashed at a time; a longer word is hashed whole.
HASHED = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(b" \t\n\x0b\x0c\r")] = True
# Value of each byte, A-Z as a-z.
_VALUE = np.arange(1, 257, dtype=np.uint64)
_VALUE[65:91] += np.uint64(32)
_powers: dict[int, np.ndarray] = {}


def _power_table(factor: int, n: int) -> np.ndarray:
    """Powers of an odd number modulo 2**64, at least ``n``; kept for the next call."""
    held = _powers.get(factor)
    if held is None or len(held) < n:
        held, size = np.ones(1, np.uint64), max(1 << 16, 1 << (n - 1).bit_length())
        while len(held) < size:
            held = np.concatenate([held, held * np.uint64(pow(factor, len(held), 1 << 64))])
        _powers[factor] = held
    return held


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of each word of a text, ASCII lower case: the polynomial of its bytes, taken
    from running sums over the text, and finished."""
    data = np.frombuffer(raw, np.uint8)
    found, start = [], 0
    while start < len(data):
        end = min(start + HASHED, len(data))
        if end < len(data):
            spaces = np.flatnonzero(_IS_SPACE[data[start:end]])
            if len(spaces):
                end = start + int(spaces[-1]) + 1
            else:
                later = np.flatnonzero(_IS_SPACE[data[end:]])
                end = end + int(later[0]) if len(later) else len(data)
        found.append(_hashed(data[start:end]))
        start = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _hashed(data: np.ndarray) -> np.ndarray:
    n = len(data)
    outside = np.ones(n + 2, np.int8)
    outside[1:-1] = _IS_SPACE[data]
    borders = np.diff(outside)
    starts, ends = np.flatnonzero(borders == -1), np.flatnonzero(borders == 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * _power_table(MULTIPLIER, n)[:n], out=sums[1:])
    inverse = _power_table(pow(MULTIPLIER, -1, 1 << 64), n)
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def shingle_set(raw: bytes | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles of a text, ASCII lower case.

    Fewer words make one shingle of the whole sequence; no words make an empty set. Two shingles
    out of n share a hash with a probability of about n * n / 2**65.
    """
    hashes = word_hashes(raw) if raw else np.empty(0, np.uint64)
    if not len(hashes):
        return hashes
    if len(hashes) < size:
        from xxhash import xxh3_64_intdigest

        return np.array([xxh3_64_intdigest(b" ".join(raw.lower().split()), seed=1)], np.uint64)
    last = len(hashes) - size + 1
    keys = np.zeros(last, np.uint64)
    for i in range(size):
        keys += hashes[i : i + last] * np.uint64(pow(PLACES, i + 1, 1 << 64))
    return sorted_distinct(mix(keys))


def sorted_distinct(keys: np.ndarray) -> np.ndarray:
    """``np.unique`` of 64-bit keys, which hashes them before it sorts and takes several times as long."""
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return keys[new]


def digest(values: np.ndarray, seed: int = 0) -> int:
    """Signed 64-bit digest of an array."""
    from xxhash import xxh3_64_intdigest

    value = xxh3_64_intdigest(values.tobytes(), seed=seed)
    return value - (1 << 64) if value >> 63 else value


def record_batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)


# Links that a task joins at a time, about 50 MB of arrays.
CHUNK = 1 << 20


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same connections as links from each vertex to the smallest one it reaches here."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    up, (u, v) = np.arange(len(ids)), at.reshape(2, -1)
    while True:
        u, v = up[u], up[v]
        open_ = u != v
        if not open_.any():
            break
        u, v = u[open_], v[open_]
        np.minimum.at(up, np.maximum(u, v), np.minimum(u, v))
        while (up != up[up]).any():
            up = up[up]
    moved = up != np.arange(len(ids))
    return ids[moved], ids[up[moved]]


def _joined_locally(e: DataFrame, chunk: int) -> DataFrame:
    """Links (a, b), those of every ``chunk`` links of a task replaced by stars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def flush():
            return record_batch(schema, stars(*(np.concatenate(p) for p in zip(*parts))))

        for batch in batches:
            for start in range(0, batch.num_rows, chunk):
                piece = batch.slice(start, chunk)
                parts.append((piece.column(0).to_numpy(), piece.column(1).to_numpy()))
                held += piece.num_rows
                if held >= chunk:
                    yield flush()
                    parts.clear()
                    held = 0
        if parts:
            yield flush()

    return e.mapInArrow(run, "a long, b long")


def _settled(e: DataFrame) -> bool:
    """Whether the links are stars: one vertex up for each, and none up for what it leads to."""
    ends = e.select(F.col("a").alias("v"), F.col("b").alias("up"), F.lit(False).alias("led_to")).unionByName(
        e.select(F.col("b").alias("v"), F.lit(None).cast("long").alias("up"), F.lit(True).alias("led_to"))
    )
    seen = ends.groupBy("v").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.max("led_to").alias("led_to"))
    return seen.filter("low <> high or (low is not null and led_to)").isEmpty()


def components(edges: DataFrame, most_rounds: int = 60, chunk: int = CHUNK) -> DataFrame:
    """Connected components of (a, b) links as (v, component), component the smallest id.

    Tasks of ``chunk`` links replace the links they read by stars; once one task holds all that
    is left, these are the components. Between two such passes more links are contracted by
    alternating stars: a round is two aggregations and two joins on ids, and the number of rounds
    grows with the logarithm of a component's size. Every step keeps the connections, so links
    that are stars are the components. Links never leave Spark.
    """
    e = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    )
    for _ in range(most_rounds):
        tasks = 2
        for _ in range(2):
            # A shuffle of few links in many partitions costs the driver more than the links do.
            if tasks > 1:
                tasks = max(1, -(-e.count() // chunk))
                e = stage(_joined_locally(e.coalesce(tasks), chunk), rows=1 << 16)
        if tasks == 1 or _settled(e):
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # The star of each vertex keeps its own link to the smallest vertex.
        own = low.filter("a <> m").select("a", F.col("m").alias("b"))
        large = large.unionByName(own).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .filter("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        e = stage(small)
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("v"), F.col("b").alias("component"))
    return e.select(F.col("a").alias("v"), F.col("b").alias("component")).unionByName(roots).distinct()


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
