"""Document fingerprints by context-triggered piecewise hashing, compared by edit distance."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import record_batch, stage

# Bytes that the rolling hash sees, pieces of a signature at most, and signatures of a fingerprint:
# the last at four times the block size of the first.
WINDOW, PIECES, LEVELS = 8, 64, 3
SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

MULTIPLIER = 0x01000193


def rolling(raw: bytes) -> np.ndarray:
    """32-bit hash of the WINDOW bytes that end at each byte; missing ones count as nothing."""
    h = np.frombuffer(raw, np.uint8).astype(np.uint32) + np.uint32(1)
    width, factor = 1, MULTIPLIER
    while width < WINDOW:
        longer = h.copy()
        longer[width:] += h[:-width] * np.uint32(factor)
        h, width, factor = longer, 2 * width, factor * factor & 0xFFFFFFFF
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(12)
    h *= np.uint32(0x297A2D39)
    return h ^ (h >> np.uint32(15))


def _symbol(piece: bytes) -> str:
    value = zlib.crc32(piece)
    return SIGNS[value & 63] + SIGNS[value >> 6 & 63]


def fingerprint(raw: bytes) -> str:
    """``level:signature:signature:signature`` of a text's bytes.

    A piece ends at each byte whose rolling hash is under 2**(32 - level). The level is the
    least that leaves PIECES - 1 such bytes or fewer, so no signature is longer than PIECES
    and nothing is cut off; the two levels above follow. A piece is two signs, 12 bits.
    """
    if not raw:
        return "0" + ":" * LEVELS
    hashes = rolling(raw)
    level = 0
    if len(raw) >= PIECES:
        level = 33 - int(np.partition(hashes, PIECES - 1)[PIECES - 1]).bit_length()
    signatures = []
    places = None
    for k in range(level, level + LEVELS):
        limit = (1 << 32 - k) - 1 if k <= 32 else -1
        places = np.flatnonzero(hashes <= limit) if places is None else places[hashes[places] <= limit]
        cuts = [0, *(places + 1).tolist()]
        if cuts[-1] < len(raw):
            cuts.append(len(raw))
        signatures.append("".join(_symbol(raw[s:e]) for s, e in zip(cuts, cuts[1:])))
    return ":".join([str(level), *signatures])


def edit_distance(a: list[str], b: list[str]) -> int:
    """Insertions, deletions and replacements from ``a`` to ``b``, a column of bits at a time."""
    if not a or not b:
        return len(a) + len(b)
    places: dict[str, int] = {}
    for i, sign in enumerate(a):
        places[sign] = places.get(sign, 0) | 1 << i
    every, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, distance = every, 0, len(a)
    for sign in b:
        same = places.get(sign, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        grows = down | ~(diagonal | up) & every
        falls = up & diagonal
        distance += bool(grows & top) - bool(falls & top)
        grows = grows << 1 | 1
        up = (falls << 1 | ~(diagonal | grows)) & every
        down = grows & diagonal & every
    return distance


def likeness(a: str, b: str) -> float:
    """1 less the edit distance of two fingerprints' signatures as a share of the longer one,
    at the smallest block size that both have; 0 if they have none in common, 1 if equal."""
    if a == b:
        return 1.0
    level_a, *left = a.split(":")
    level_b, *right = b.split(":")
    k = max(int(level_a), int(level_b))
    i, j = k - int(level_a), k - int(level_b)
    if max(i, j) >= LEVELS:
        return 0.0
    x, y = left[i], right[j]
    x, y = ([s[n : n + 2] for n in range(0, len(s), 2)] for s in (x, y))
    return 1.0 - edit_distance(x, y) / max(len(x), len(y), 1)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every row of ``docs`` (doc_id, text): doc_id, fingerprint. Null texts are
    empty texts; repeated rows get a row each; nothing is shuffled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])
        for batch in batches:
            raws = batch.column(1).cast(pa.binary())
            yield record_batch(schema, (batch.column(0), [fingerprint(raw.as_py()) for raw in raws]))

    return docs.selectExpr("cast(doc_id as long) doc_id", "coalesce(text, '') text").mapInArrow(
        work, "doc_id long, fingerprint string"
    )


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(doc: int | None, text: str, own: str, following: str, following_own: str) -> tuple:
    half = len(text) // 2
    edited = (text[: len(text) - half] + following[:half]).encode()
    changed = fingerprint(edited)
    return (
        doc,
        len(text),
        hashlib.sha256(edited).hexdigest(),
        own,
        changed,
        likeness(own, changed),
        likeness(own, following_own),
    )


def edited_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text), of its text edited with the start
    of the next document's, and their likeness, by ``RESULT``.

    The next document is that of the next smaller doc_id; after the last comes the first. Rows
    without doc_id come last; rows with one doc_id are ordered by a hash of their texts, equal
    ones follow each other. A single row is its own next. Null texts are empty texts; other
    columns are not read.

    Texts are shuffled once, dealt by range over (doc_id, hash, place read), so that no doc_id
    fills a task. A task streams its rows in order and holds two texts. Its first and last text
    are written aside, and the last one meets the first of the next task with rows in a join
    over one row a task.
    """
    order = [F.desc_nulls_last("doc_id"), F.asc("__hash"), F.asc("__read")]
    dealt = (
        docs.selectExpr("cast(doc_id as long) doc_id", "coalesce(text, '') text")
        .withColumns({"__hash": F.xxhash64("text"), "__read": F.monotonically_increasing_id()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    kinds = "kind int, part long, text string, "

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        schema = pa.schema(
            [("kind", pa.int32()), ("part", pa.int64()), ("text", pa.string()), ("doc_id", pa.int64()), ("n_chars", pa.int64())]
            + [(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
            + [(c, pa.float64()) for c in ("near_edited", "near_next")]
        )
        held = None
        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py()
                own = fingerprint(text.encode())
                if held is None:
                    rows.append((1, part, text, None, None, None, own, None, None, None))
                else:
                    rows.append((0, None, None, *_compared(*held, text, own)))
                held = (doc, text, own)
            if rows:
                yield record_batch(schema, zip(*rows))
        if held:
            doc, text, own = held
            yield record_batch(schema, zip((2, part, text, doc, None, None, own, None, None, None)))

    found = stage(dealt.mapInArrow(work, kinds + RESULT))
    heads = found.filter("kind = 1").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    # One number a task.
    parts = sorted(r[0] for r in found.filter("kind = 1").select("part").collect())
    follows = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part long, next_part long")
    last = (
        found.filter("kind = 2")
        .select("part", "doc_id", "text", "fingerprint")
        .join(follows, "part")
        .join(heads, "next_part")
        .select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")
    )

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n_chars", pa.int64())]
            + [(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
            + [(c, pa.float64()) for c in ("near_edited", "near_next")]
        )
        for batch in batches:
            rows = [_compared(*(c[i].as_py() for c in batch.columns)) for i in range(batch.num_rows)]
            if rows:
                yield record_batch(schema, zip(*rows))

    names = [c.split()[0] for c in RESULT.split(", ")]
    return found.filter("kind = 0").select(*names).unionByName(last.mapInArrow(close, RESULT))
