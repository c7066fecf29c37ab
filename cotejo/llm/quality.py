"""Quality rules by compression bands.

A text is compressed whole and in fixed chunks. Repetitive text compresses too well, random
text hardly at all; what is normal depends on the length, so each band of lengths has limits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import record_batch, texts_of

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\r\x0b\x0c"


@dataclass(frozen=True)
class Bands:
    """Limits of raw / compressed size.

    ``limits``: (bytes from, least, most) in rising order, whole texts; ``chunk`` bytes make a
    chunk, rests under half of it are left out; ``share`` of the chunks outside
    ``chunk_least`` .. ``chunk_most`` that a text may have.

    Text compresses the better the longer it is, so bands are a factor of two wide. ``most`` lies
    0.03 to 0.1 over the largest ratio found in each band among 30,000 texts labelled good, and
    ``least`` under the smallest. Text with signs strewn between its words has a small alphabet
    of fillers and compresses better than any good text of its length from about 2 KB on.
    """

    level: int = 3
    limits: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 1.9),
        (128, 0.8, 1.95),
        (256, 1.15, 2.0),
        (512, 1.3, 2.08),
        (1024, 1.45, 2.22),
        (2048, 1.6, 2.28),
        (4096, 1.75, 2.38),
        (8192, 1.8, 2.46),
        (16384, 1.8, 2.56),
        (32768, 1.8, 2.62),
        (65536, 1.8, 2.7),
        (131072, 1.8, 2.8),
        (262144, 1.8, 3.0),
    )
    chunk: int = 2048
    chunk_least: float = 1.45
    chunk_most: float = 2.7
    share: float = 0.34


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in WHITE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen: set[bytes] = set()
    copies = 0
    if b"\n" in raw:
        for line in raw.split(b"\n"):
            if line.strip():
                if line in seen:
                    copies += 1
                else:
                    seen.add(line)
    return n, chars, symbols, copies, repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    places: dict[bytes, int] = {}
    ids = np.fromiter((places.setdefault(w, len(places)) for w in words), np.int64, n)
    pairs, width = ids[:-1] * len(places) + ids[1:], len(places)
    if width > 2_000_000:  # three of them would not fit 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * width + ids[2:]
    _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
    again = count[place] > 1
    marked = np.zeros(n, bool)
    for i in range(3):
        marked[i : i + n - 2] |= again
    return int(marked.sum())


def band_verdict(raw: bytes, bands: Bands, press) -> tuple[float, int, int, bool]:
    """Whole ratio, chunks, chunks outside the limits, and whether the text is kept."""
    if not raw:
        return 0.0, 0, 0, False
    ratio = len(raw) / len(press(raw))
    least, most = next((low, high) for start, low, high in reversed(bands.limits) if len(raw) >= start)
    chunks = outside = 0
    if len(raw) > bands.chunk:
        view = memoryview(raw)
        for i in range(0, len(raw), bands.chunk):
            part = view[i : i + bands.chunk]
            if 2 * len(part) >= bands.chunk:
                chunks += 1
                outside += not bands.chunk_least <= len(part) / len(press(part)) <= bands.chunk_most
    return ratio, chunks, outside, least <= ratio <= most and outside <= bands.share * chunks


def judge(text: str | None, bands: Bands, press) -> tuple:
    """The five counts, base_failed, kept, ratio, chunks, chunks outside."""
    text = text or ""
    n, chars, symbols, copies, repeated = base_counts(text)
    failed = n < 50 or 100 * repeated > 50 * n
    ratio, chunks, outside, good = band_verdict(text.encode("utf-8", "surrogatepass"), bands, press)
    return n, chars, symbols, copies, repeated, failed, good and not failed, ratio, chunks, outside


VERDICT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long, n_chunks_outside long"
)


def quality(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Counts, compression ratios and verdict of every row of ``docs`` (doc_id, text).

    Null and empty texts have zero counts, base_failed true and kept false. Repeated rows get
    a verdict each; a null doc_id stays null; other columns are not read. No shuffle.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(VERDICT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=bands.level).compress
        for batch in batches:
            rows = [judge(raw.decode("utf-8", "surrogatepass") if raw else "", bands, press) for raw in texts_of(batch)]
            if rows:
                yield record_batch(schema, [batch.column(0), *zip(*rows)])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, VERDICT)


def keep_good(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Rows of ``docs``, all columns, whose text is kept. Nothing is shuffled, and only texts go to
    the Python workers, which send back a verdict each."""

    def verdicts(texts: pa.Array) -> pa.Array:
        import zstandard

        press = zstandard.ZstdCompressor(level=bands.level).compress
        return pa.array([judge(v.as_py(), bands, press)[6] for v in texts], pa.bool_())

    # Type hints are objects here, as the function is sent to workers by value.
    verdicts.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return docs.filter(F.arrow_udf(verdicts, "boolean")("text"))
