"""Numbers of word pieces by a linear longest-match automaton.

A trie of the vocabulary has failure links: where no child fits, the automaton follows the link
and adds the number of pieces that greedy longest match would have taken up to there. Each
character is read once and no piece is built.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from cotejo.llm.common import record_batch, texts_of

# Words whose counts a task remembers.
REMEMBERED = 500_000


class Automaton:
    """Piece counts for a vocabulary of pieces that begin a word and pieces that go on with it.

    An empty piece in ``initial`` is the mark of a word's beginning as a piece of its own: it is
    taken where no longer piece begins the word.
    """

    def __init__(self, initial: Iterable[str], following: Iterable[str]):
        # Node 0 is the start of a word, node 1 the start of a following piece.
        self.next: list[dict[str, int]] = [{}, {}]
        self.fail: list[int] = [-1, -1]
        self.pops: list[int] = [0, 0]
        ends: set[int] = set()
        initial = list(initial)
        if "" in initial:
            self.fail[0], self.pops[0] = 1, 1
        for root, pieces in ((0, initial), (1, following)):
            for piece in pieces:
                node = root
                for c in piece:
                    if c not in self.next[node]:
                        self.next[node][c] = len(self.next)
                        self.next.append({})
                        self.fail.append(-1)
                        self.pops.append(0)
                    node = self.next[node][c]
                if piece:
                    ends.add(node)
        self._link(ends)

    def _link(self, ends: set[int]) -> None:
        """Failure links, by depth: a piece that ends here is taken; else the parent's pieces
        are, and the rest is followed from there."""
        level = [(root, c, v) for root in (0, 1) for c, v in self.next[root].items()]
        while level:
            deeper = []
            for parent, c, v in level:
                if v in ends:
                    self.fail[v], self.pops[v] = 1, 1
                else:
                    z, taken = self.fail[parent], self.pops[parent]
                    while z >= 0 and c not in self.next[z]:
                        taken, z = taken + self.pops[z], self.fail[z]
                    if z >= 0:
                        self.fail[v], self.pops[v] = self.next[z][c], taken
                deeper += [(v, d, w) for d, w in self.next[v].items()]
            level = deeper

    def count(self, word: str) -> int:
        """Pieces of greedy longest match, 0 when the word can't be covered."""
        node, taken = 0, 0
        for c in word:
            while c not in self.next[node]:
                if self.fail[node] < 0:
                    return 0
                taken, node = taken + self.pops[node], self.fail[node]
            node = self.next[node][c]
        while node != 1:
            if self.fail[node] < 0:
                return 0
            taken, node = taken + self.pops[node], self.fail[node]
        return taken


def sentencepiece_vocabulary(file: str) -> tuple[list[str], list[str]]:
    """Pieces that begin a word (without their mark) and pieces that go on, in id order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=file)
    initial, following = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i)
        (initial if piece.startswith("▁") else following).append(piece.lstrip("▁"))
    return [p for p in initial if p], [p for p in following if p]


def whole_vocabulary(file: str) -> tuple[list[str], list[str]]:
    """All pieces, for words that a mark precedes: those that begin with it, without this one
    mark (the bare mark is an empty piece), and all, which may go on, in id order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=file)
    special = (model.is_control, model.is_unknown, model.is_byte)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not any(f(i) for f in special)]
    return [p[1:] for p in pieces if p.startswith("▁")], pieces


COUNTS = "doc_id long, n_words long, n_tokens long, n_unknown long"


def token_counts(docs: DataFrame, initial: list[str], following: list[str]) -> DataFrame:
    """Word pieces of every row of ``docs`` (doc_id, text): doc_id, n_words, n_tokens, n_unknown.

    Words are runs without ASCII white space. A word that the vocabulary can't cover is one
    unknown token. Null and empty texts have none; repeated rows get a row each; a null doc_id
    stays null; other columns are not read. The vocabulary, whose size is fixed, is broadcast;
    nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast((initial, following))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(*shared.value)
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64()), ("n_unknown", pa.int64())])
        known: dict[bytes, int] = {}
        for batch in batches:
            rows = []
            for doc, raw in zip(batch.column(0).to_pylist(), texts_of(batch)):
                words = raw.split() if raw else []
                new = [w for w in set(words) if w not in known]
                if len(known) + len(new) > REMEMBERED:
                    known.clear()
                    new = list(set(words))
                for word in new:
                    known[word] = automaton.count(word.decode("utf-8", "replace"))
                counts = list(map(known.__getitem__, words))
                unknown = counts.count(0)
                rows.append((doc, len(words), sum(counts) + unknown, unknown))
            if rows:
                yield record_batch(schema, zip(*rows))

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, COUNTS)
