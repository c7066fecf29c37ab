"""Best-fit packing of token sequences, hierarchical.

Pieces are dealt evenly over partitions of about ``PART`` pieces; every partition packs its own
best-fit, and its nearly full sequences are done. The pieces of the underfull ones are items of
the next round, which has fewer partitions, until one is left or nothing more fits together.
Only (id, length, place) rows travel, never tokens.
"""

from __future__ import annotations

import bisect
import contextlib
import ctypes
import os
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import record_batch, stage

CAPACITY = 4096
# Free tokens up to which a sequence counts as nearly full.
SLACK = 24
# Pieces that a partition packs at a time, about 5 MB.
PART = 1 << 16
# Share of the pieces that a round has to finish for another round to be worth while.
WORTH = 0.05
# Parts of words whose ids a worker remembers, about 30 MB.
REMEMBERED = 700_000
# Bytes of text whose words are looked up together; the arrays made for them are ten times as large.
TEXT_BYTES = 4 << 20
# Words in one text for the tokenizer.
TOGETHER = 1024
# ASCII signs that a word may end with.
SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
# Last of the Latin letters, among which case does not depend on neighbours.
LATIN = "\u024f"
LATIN_ONLY = r"^[\x00-\x{24f}]*$"
LETTER_LAST = r"[\p{L}0-9]$"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", row long, bin long, offset long, open boolean"


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, longest first, each into the fullest bin that holds it."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    waiting: dict[int, list[int]] = {}
    free: list[int] = []
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        at = bisect.bisect_left(free, need)
        if at == len(free):
            room, chosen, made = capacity, made, made + 1
        else:
            room = free[at]
            chosen = waiting[room].pop()
            if not waiting[room]:
                del waiting[room], free[at]
        bins[i], offsets[i] = chosen, capacity - room
        room -= need
        if room:
            if room not in waiting:
                waiting[room] = []
                bisect.insort(free, room)
            waiting[room].append(chosen)
    return bins, offsets


def base_parts(words: pa.StringArray) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Stems and signs of words, which have the words' ids one after the other, and which words the
    signs are from.

    The tokenizer ignores case, and a run of ASCII signs at the end of a word is split off after a
    letter or digit. Words with a special token's signs stay whole, and so do those with
    characters beyond Latin, where case and composition may depend on neighbours."""
    plain = pc.and_not(pc.match_substring_regex(words, LATIN_ONLY), pc.match_substring(words, "<|"))
    low = pc.if_else(plain, pc.ascii_lower(words), words)
    stems = pc.ascii_rtrim(low, characters=SIGNS)
    ends = pc.and_(plain, pc.less(pc.binary_length(stems), pc.binary_length(low)))
    at = np.flatnonzero(ends.to_numpy(zero_copy_only=False))
    at = at[pc.match_substring_regex(stems.take(at), LETTER_LAST).to_numpy(zero_copy_only=False)]
    split = np.zeros(len(words), bool)
    split[at] = True
    kept = pc.binary_length(stems.take(at)).to_pylist()
    signs = [w[n:] for w, n in zip(low.take(at).cast(pa.binary()).to_pylist(), kept)]
    return pc.if_else(pa.array(split), stems, low), pa.array(signs, pa.binary()).view(pa.string()), at


def laid_out(pool: np.ndarray, starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``at`` of a pool one after the other, and where each begins; entry i of the pool
    lies from ``starts[i]`` to ``starts[i + 1]``."""
    begins = starts[at]
    lengths = starts[at + 1] - begins
    borders = np.zeros(len(at) + 1, np.int64)
    np.cumsum(lengths, out=borders[1:])
    kind = np.int32 if max(len(pool), borders[-1]) < 1 << 31 else np.int64
    places = np.repeat((begins - borders[:-1]).astype(kind), lengths)
    places += np.arange(borders[-1], dtype=kind)
    return pool[places], borders


class WordIds:
    """Token ids of texts as little-endian 32-bit numbers, through a bounded memory of words.

    White space never joins tokens here, so the ids of a text are those of its words in order.
    Arrow numbers the different words of neighbouring texts and finds their parts among those
    remembered; numpy lays out their ids.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # Tokens that end a run of letters.
        self.ends = np.zeros(size, bool)
        for token, at in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.ends[at] = token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        # Parts of words that are known; the ids of part i lie in ``pool`` from ``starts[i]`` on.
        self.known, self.pool, self.starts = pa.array([], pa.string()), np.empty(0, "<u4"), np.zeros(1, np.int64)

    def learn(self, parts: pa.StringArray) -> np.ndarray:
        """Places of different parts among the known ones; new ones are looked up."""
        at = pc.index_in(parts, value_set=self.known)
        if not at.null_count:
            return at.to_numpy()
        new = parts.filter(at.is_null())
        if len(self.known) + len(new) > REMEMBERED and len(self.known):
            self._forget()
            return self.learn(parts)
        found = self._encode(new.cast(pa.binary()).to_pylist())
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        places = at.fill_null(-1).to_numpy().copy()
        places[places < 0] = np.arange(len(self.known), len(self.known) + len(new))
        self.known = pa.concat_arrays([self.known, new])
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(found), "<u4")])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        return places

    def _encode(self, raws: list[bytes]) -> list[bytes]:
        """Ids of each part; runs of letters are looked up together."""
        found: list[bytes] = [b""] * len(raws)
        letters, others = [], []
        parts = b"\n".join(raws).decode("utf-8", "replace").split("\n")
        for i, p in enumerate(parts):
            (letters if p.isalpha() and (p.isascii() or max(p) <= LATIN) else others).append(i)
        for start in range(0, len(letters), TOGETHER):
            some = letters[start : start + TOGETHER]
            # A run of letters ends with a token of its own, so the ids of many can be told apart.
            text = " ".join([parts[i] for i in some])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            borders = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(borders) != len(some):
                others += some
                continue
            whole = ids.tobytes()
            for i, a, b in zip(some, [0, *borders], borders):
                found[i] = whole[a:b]
        for start in range(0, len(others), TOGETHER):
            some = others[start : start + TOGETHER]
            for i, encoding in zip(some, self.tokenizer.encode_batch_fast([parts[i] for i in some], add_special_tokens=False)):
                found[i] = np.array(encoding.ids, "<u4").tobytes()
        return found

    def lay_out(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, and where each text's begin."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten().dictionary_encode()
        stems, signs, at = base_parts(words.dictionary)
        parts = pa.concat_arrays([stems, signs]).dictionary_encode()
        places = self.learn(parts.dictionary)[parts.indices.to_numpy()]
        # Each word's stem, and after it its signs if it has any.
        count = len(stems)
        in_order = np.insert(places[:count], at + 1, places[count:])
        first = np.arange(count + 1) + np.concatenate([[0], np.cumsum(np.bincount(at, minlength=count))])
        pool, borders = laid_out(self.pool, self.starts, in_order)
        ids, borders = laid_out(pool, borders[first], words.indices.to_numpy())
        offsets = lists.offsets.to_numpy()
        return ids, borders[offsets - offsets[0]]

    def __call__(self, raw: bytes | None) -> bytes:
        return next(self.of_texts([raw]))

    def of_texts(self, raws: list[bytes | None]) -> Iterator[bytes]:
        """Ids of each text; words of neighbouring texts are looked up together."""
        start = 0
        while start < len(raws):
            end, size = start, 0
            while end < len(raws) and (end == start or size + len(raws[end] or b"") <= TEXT_BYTES):
                size += len(raws[end] or b"")
                end += 1
            ids, borders = self.lay_out(pa.array(raws[start:end], pa.binary()).view(pa.string()))
            yield from (ids[a:b].tobytes() for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()))
            start = end


def word_ids(file: str) -> WordIds:
    """The memory of words of this worker process, which its tasks share one after the other."""
    place = sys.modules.setdefault("cotejo_llm_memory", types.ModuleType("cotejo_llm_memory"))
    held = place.__dict__.get("words")
    if held is None or held[0] != file:
        held = place.__dict__["words"] = (file, WordIds(file))
    return held[1]


def give_back() -> None:
    """Return memory that is free to the system; a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes."""
    held, total = [], 0
    for batch in batches:
        if held and total + batch.nbytes > size:
            yield pa.concat_batches(held)
            held, total = [], 0
        held.append(batch)
        total += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def pieces_of(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """piece, start, length and CRC-32 of each piece of a document's ids."""
    total = len(ids) // 4
    if total <= capacity:
        yield 0, 0, total, zlib.crc32(ids)
        return
    for piece, start in enumerate(range(0, total, capacity)):
        end = min(start + capacity, total)
        yield piece, start, end - start, zlib.crc32(ids[4 * start : 4 * end])


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, slack: int = SLACK, end_id: int = 1, part: int = PART, lean: bool = False) -> DataFrame:
    """Pack the tokens of every row of ``docs`` (doc_id, text) into sequences of ``capacity``.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or empty text is
    the end id alone. Repeated rows are packed each. Other columns are not read. An empty table
    gives no sequences. Which rows share a sequence depends on the partitioning, what is
    returned for a piece besides does not. With ``lean`` workers give free memory back while they
    read, which takes more time and a third less memory.
    """
    tail = np.array([end_id], "<u4").tobytes()

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(tokenizer_file)
        fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        for batch in gathered(batches, TEXT_BYTES):
            ids, borders = encode.lay_out(batch.column(1).cast(pa.string()))
            texts = (ids[a:b].tobytes() for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()))
            found = [(doc, *piece) for doc, own in zip(batch.column(0).to_pylist(), texts) for piece in pieces_of(own + tail, capacity)]
            if found:
                yield record_batch(pa.schema(fields), zip(*found))
            if lean:
                del ids, borders, texts, found
                give_back()
        give_back()

    pieces = stage(docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(tokenize, PIECES))
    return pack_pieces(pieces, capacity, slack, part)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, part: int = PART) -> DataFrame:
    """Pack rows by their ``length``: the columns of ``PIECES`` beside sequence_id and offset.

    A round deals its pieces by a hash of their place over partitions of about ``part`` pieces, so
    that each has short and long ones as the whole table has, however they lie in the input, and
    takes the nearly full sequences of each. The rest goes to the next round. Rounds end with one
    partition, or when one finishes less than ``WORTH`` of its pieces: then nothing is left that
    would fill the open sequences, and they stay as they are. No number of pieces or sequences
    is bounded by this.
    """
    rows = pieces.withColumn("row", F.monotonically_increasing_id())
    left, level, finished = rows.count(), 0, []
    while left > part:
        groups = -(-left // part)
        packed = stage(_round(rows, level, groups, capacity, slack))
        still_open = packed.filter("open").count()
        if still_open > (1 - WORTH) * left:
            finished.append(packed)
            left = 0
            break
        finished.append(packed.filter("not open"))
        rows, left, level = packed.filter("open").drop("bin", "offset", "open"), still_open, level + 1
    if left or not finished:
        finished.append(_round(rows, level, 1, capacity, slack))
    out = finished[0]
    for done in finished[1:]:
        out = out.unionByName(done)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")


def _round(rows: DataFrame, level: int, groups: int, capacity: int, slack: int) -> DataFrame:
    """Best fit in each of ``groups`` partitions: bin, offset, and whether the bin is underfull."""
    group = F.pmod(F.xxhash64("row", F.lit(level)), F.lit(groups).cast("long"))

    def fit(table: pa.Table) -> pa.Table:
        number = table["__group"][0].as_py()
        table = table.drop_columns(["__group"]).sort_by("row")
        lengths = table["length"].to_numpy()
        bins, offsets = best_fit(lengths, capacity)
        fills = np.bincount(bins, weights=lengths).astype(np.int64)
        added = {
            "bin": pa.array((level << 56) + (number << 28) + bins, pa.int64()),
            "offset": pa.array(offsets, pa.int64()),
            "open": pa.array((capacity - fills > slack)[bins], pa.bool_()),
        }
        for name, values in added.items():
            table = table.append_column(name, values)
        return table

    return rows.withColumn("__group", group).groupBy("__group").applyInArrow(fit, PACKED)
