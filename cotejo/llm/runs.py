"""Periodic runs of words: segments split at words too rare in them, the rest scanned for lags."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import texts_of

# A run has at least LEAST words and at least TIMES periods.
LEAST, TIMES = 6, 4
# Words of the documents that are searched together, about 100 MB; a longer text is alone.
CHUNK_WORDS = 1 << 19
# Rounds of splitting. The scan is exact on any segment, so words that are left here cost time only.
ROUNDS = 64

RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _spans(at: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Number, for each place of ``at``, of its stretch of neighbouring places of one owner."""
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (owner[1:] != owner[:-1])
    return np.cumsum(new) - 1


def surviving(codes: np.ndarray, owner: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Places that may lie in runs, in order, and the segment of each.

    Each word of a run stands in it TIMES times or more. A word that stands less often in its
    segment splits it; what is left is counted again, until nothing changes.
    """
    at, done, done_owner = np.arange(len(codes)), [], []
    segment = _spans(at, owner)
    for _ in range(rounds):
        if not len(at):
            break
        _, which, counts = np.unique(segment * (int(codes.max()) + 1) + codes[at], return_inverse=True, return_counts=True)
        common = counts[which] >= TIMES
        common &= np.bincount(segment)[segment] >= LEAST
        split = np.zeros(int(segment[-1]) + 1, bool)
        split[segment[~common]] = True
        stable = ~split[segment]
        done.append(at[stable])
        at = at[~stable & common]
        segment = _spans(at, owner[at])
    done.append(at)
    at = np.sort(np.concatenate(done))
    return at, _spans(at, owner[at])


def scan(codes: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, length and smallest period of every run within the segments.

    For w = 1, 2, 4, ... the lag from each window of w words to its next occurrence is taken.
    Inside a run with smallest period p a window of w >= p words recurs after just p words, at
    every place from the run's start on whose second window is still inside. So a stretch of
    places with one lag p, w / 2 < p <= w, is a run of that period from its first place to the
    end of the last second window. Segments shorter than TIMES periods leave; all is O(n log n).
    """
    n = len(codes)
    ends = np.searchsorted(segment, segment, side="right") if n else np.empty(0, np.int64)
    sizes = np.bincount(segment)[segment] if n else np.empty(0, np.int64)
    ids = np.unique(segment * (int(codes.max(initial=0)) + 1) + codes, return_inverse=True)[1].astype(np.int64)
    places, w = np.arange(n), 1
    starts, lengths, periods = [], [], []
    while True:
        places = places[sizes[places] >= max(LEAST, TIMES * (w // 2 + 1))]
        if not len(places):
            break
        order = places[np.argsort(ids[places], kind="stable")]
        again = ids[order[1:]] == ids[order[:-1]]
        lag = np.zeros(n, np.int64)
        lag[order[:-1][again]] = (order[1:] - order[:-1])[again]
        found = np.flatnonzero((lag > w // 2) & (lag <= w))
        if len(found):
            p = lag[found]
            new = np.ones(len(found), bool)
            new[1:] = (np.diff(found) != 1) | (p[1:] != p[:-1]) | (np.diff(segment[found]) != 0)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(found)) - 1
            length = found[last] + w + p[first] - found[first]
            run = length >= np.maximum(LEAST, TIMES * p[first])
            starts.append(found[first][run])
            lengths.append(length[run])
            periods.append(p[first][run])
        # Windows of 2w words, only where both halves stand in their segment more than once.
        common = np.zeros(n, bool)
        common[order[:-1][again]] = True
        common[order[1:][again]] = True
        places = places[common[places]]
        places = places[places + 2 * w <= ends[places]]
        places = places[common[places + w]]
        longer = np.full(n, -1, np.int64)
        if len(places):
            longer[places] = np.unique(ids[places] * n + ids[places + w], return_inverse=True)[1]
        ids, w = longer, 2 * w
    if not starts:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(starts), np.concatenate(lengths), np.concatenate(periods)


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each word sequence, by start, then period."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not sizes.sum():
        return found
    known: dict[bytes, int] = {}
    codes = np.fromiter((known.setdefault(w, len(known)) for words in texts for w in words), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), sizes)
    offsets = np.cumsum(sizes) - sizes
    at, segment = surviving(codes, owner)
    for s, length, p in zip(*scan(codes[at], segment)):
        place = at[s]
        document = owner[place]
        found[document].append((int(place - offsets[document]), int(length), int(p)))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def find_runs(docs: DataFrame, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Periodic runs of every row of ``docs`` (doc_id, text), by ``RUNS``.

    Words are runs without ASCII white space; ``rewrite`` may change a document's words first.
    A run is a stretch of words with smallest period q and max(6, 4 q) words or more that no
    neighbour extends. ``runs`` holds all by start, then period; ``collapsed`` is the text with
    one period left of each, joined by a space. Null, empty and blank texts have no words, no
    runs and an empty ``collapsed``; repeated rows get a row each; a null doc_id stays null;
    other columns are not read. Nothing is shuffled; a task holds one text or CHUNK_WORDS words.
    """

    def rows_of(ids: list[int | None], texts: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_of(texts)
        left = [b" ".join(collapsed(words, runs)) for words, runs in zip(texts, found)]
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        listed = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(words) for words in texts], pa.int64()),
                pa.array(listed, pa.list_(run)),
                pa.array(left, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: list[int | None] = []
            texts: list[list[bytes]] = []
            held = 0
            for doc, raw in zip(batch.column(0).to_pylist(), texts_of(batch)):
                words = raw.split() if raw else []
                if rewrite:
                    words = rewrite(doc, words)
                if texts and held + len(words) > CHUNK_WORDS:
                    yield rows_of(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc)
                texts.append(words)
                held += len(words)
            if texts:
                yield rows_of(ids, texts)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(work, RUNS)


def plant(doc: int | None, words: list[bytes]) -> list[bytes]:
    """The words, for one document in ten repeated from some place on with some period."""
    n = len(words)
    if doc is None or not n:
        return words
    g, rest = divmod(zlib.crc32(str(doc).encode()), 10)
    if rest:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * ((n - a) // p + 1))[: n - a]


def run_report(docs: DataFrame) -> DataFrame:
    """Number of runs, the longest run and digests of all runs and of the collapsed text, of
    every row of ``docs`` after ``plant``. No run: four nulls. A null doc_id plants nothing."""
    longest = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return (
        find_runs(docs, plant)
        .withColumn("longest", longest)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            (-F.col("longest.start")).alias("start"),
            F.col("longest.length").alias("length"),
            (-F.col("longest.period")).alias("period"),
            F.expr("longest.length * 1000 div -longest.period").alias("exponent_milli"),
            F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
            "n_words",
        )
    )
