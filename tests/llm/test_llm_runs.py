"""Runs, fingerprints and the prefix trie against brute force, and their corner cases."""

from __future__ import annotations

import collections
import hashlib
import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cotejo.llm import fuzzyhash, prefixtrie, runs
from cotejo.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TURNS = "conv_id long, turn long, role string, text string"
FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
CLASHING = ("runs", "start", "kind", "part", "x", "y", "place", "band", "depth", "n_convs", "__hash", "rank", "longest")


def docs_of(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """With columns that have the names of results and of steps."""
    return df.withColumns({c: F.lit(1) for c in CLASHING})


# Runs


def brute_runs(words):
    """Every lag, every maximal stretch; its smallest period by trying all."""
    found, n = [], len(words)
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j - i + p if j > i else 0
            stretch = words[i : i + length]
            if length >= max(6, 4 * p) and not any(
                all(stretch[k] == stretch[k + q] for k in range(length - q)) for q in range(1, p)
            ):
                found.append((i, length, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def run_row(doc, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc is not None and n:
        h = zlib.crc32(str(doc).encode()) & 0xFFFFFFFF
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    dropped = {k for s, length, p in found for k in range(s + p, s + length)}
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    return (
        doc,
        len(found),
        *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(left.encode()).hexdigest(),
    )


RUN_COLUMNS = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()


def key(row):
    return tuple((v is not None, v) if v is None or not isinstance(v, str) else (True, v) for v in row)


def same_rows(got, want):
    text = lambda rows: sorted(map(repr, rows))
    assert text(got) == text(want)


def run_words(seed, n, alphabet):
    """Words that repeat with changing periods, with noise between."""
    rng, words = np.random.default_rng(seed), []
    while len(words) < n:
        kind = rng.integers(4)
        if kind == 0:
            words += list(rng.choice(alphabet, rng.integers(1, 30)))
        else:
            period = list(rng.choice(alphabet, rng.integers(1, 7)))
            words += (period * 9)[: rng.integers(2, 9 * len(period))]
    return words[:n]


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_few_words(seed):
    rng = np.random.default_rng(seed)
    alphabet = [bytes([97 + i]) for i in range(rng.integers(1, 6))]
    texts = [run_words(seed * 100 + i, int(rng.integers(0, 150)), alphabet) for i in range(12)]
    assert runs.runs_of(texts) == [brute_runs(w) for w in texts]


def test_runs_of_one_word_and_nested_periods():
    a = [b"a"]
    nested = ([b"x", b"x", b"x", b"x", b"x", b"x", b"y"] * 5)[:-2]
    texts = [a * 5, a * 6, a * 400, [b"a", b"b"] * 3, [b"a", b"b"] * 4, nested, [], [b"a", b"b", b"c"] * 1000]
    assert runs.runs_of(texts) == [brute_runs(w) for w in texts]
    assert runs.runs_of(texts)[5][:2] == [(0, 6, 1), (0, 33, 7)]


def test_splitting_may_stop_early_without_loss():
    """A chain in which each removed word makes the next one rare; the scan gives the same."""
    words = []
    for i in range(200):
        words += [i + 1, i]
    words = (words + [500, 501, 502] * 4) * 3
    codes = np.array(words)
    owner = np.zeros(len(codes), np.int64)
    whole = runs.scan(codes, owner)
    for rounds in (0, 1, 64):
        at, segment = runs.surviving(codes, owner, rounds)
        start, length, period = runs.scan(codes[at], segment)
        assert sorted(zip(at[start], length, period)) == sorted(zip(*whole))


def test_long_run_is_found_without_trying_lags():
    period = [str(i).encode() for i in range(5000)]
    found = runs.runs_of([period * 5 + [b"end"], (period + [b"x"]) * 4])
    assert found == [[(0, 25000, 5000)], [(0, 20004, 5001)]]


def run_docs(spark):
    texts = [None, "", " \t\n", "one", "same " * 40, "a b\x1cc " * 30, "x\r\ny\x0bz " * 9, "é ü 漢字 " * 30, "w " * 5 + "v"]
    texts += [" ".join(w.decode() for w in run_words(i, 200, [b"p", b"q", b"r", b"s"])) for i in range(40)]
    df = docs_of(spark, texts)
    more = spark.createDataFrame([(None, "k l " * 9, None, None, None), (4, "same " * 40, None, None, 1), (-7, "m n " * 50, None, None, 1)], DOCS)
    return df.unionByName(more)


def test_run_report_equals_brute_force(spark):
    df = run_docs(spark)
    got = [tuple(r) for r in runs.run_report(clashing(df)).select(*RUN_COLUMNS).collect()]
    same_rows(got, [run_row(r.doc_id, r.text) for r in df.collect()])
    assert runs.run_report(spark.createDataFrame([], DOCS)).count() == 0


@needs_data
def test_run_report_on_table(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("length(text) < 9000")
    got = [tuple(r) for r in runs.run_report(df).select(*RUN_COLUMNS).collect()]
    want = [run_row(r.doc_id, r.text) for r in df.collect()]
    assert sum(w[1] for w in want) > 10
    same_rows(got, want)


# Fingerprints


def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


@pytest.mark.parametrize("seed", range(40))
def test_edit_distance(seed):
    rng = np.random.default_rng(seed)
    a, b = (list(rng.choice(list("abcd"), rng.integers(0, 90))) for _ in range(2))
    assert fuzzyhash.edit_distance(a, b) == brute_distance(a, b)


def brute_fingerprint(raw):
    """Hash of each window by its definition, pieces by walking through the bytes."""
    if not raw:
        return "0:::"
    mask, hashes = 0xFFFFFFFF, []
    for i in range(len(raw)):
        h = 0
        for j in range(min(8, i + 1)):
            h = (h + (raw[i - j] + 1) * pow(fuzzyhash.MULTIPLIER, j, 1 << 32)) & mask
        for shift, factor in ((15, 0x2C1B3C6D), (12, 0x297A2D39)):
            h = ((h ^ h >> shift) * factor) & mask
        hashes.append(h ^ h >> 15)
    level = 0
    while sum(h < 1 << 32 - level if level <= 32 else False for h in hashes) > 63:
        level += 1
    parts = [str(level)]
    for k in range(level, level + 3):
        text, start = "", 0
        for i, h in enumerate(hashes):
            if (k <= 32 and h < 1 << 32 - k) or i == len(raw) - 1:
                value, start = zlib.crc32(raw[start : i + 1]), i + 1
                text += fuzzyhash.SIGNS[value & 63] + fuzzyhash.SIGNS[value >> 6 & 63]
        parts.append(text)
    return ":".join(parts)


def fingerprint_texts():
    rng = np.random.default_rng(5)
    long = " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(4000))
    return [None, "", "a", "ab" * 500, "a" * 5000, "é漢字 " * 20, long[:63], long[:64], long[:65], long[:700], long, long + " end", long[:900] + "X" + long[901:2000], "漢" * 101]


def test_fingerprint_by_its_definition():
    for text in fingerprint_texts():
        raw = (text or "").encode()
        assert fuzzyhash.fingerprint(raw) == brute_fingerprint(raw)
        assert max(map(len, fuzzyhash.fingerprint(raw).split(":")[1:])) <= 2 * fuzzyhash.PIECES


def test_likeness_follows_the_share_kept():
    """One changed word moves a text little, half of it about half, another text wholly."""
    rng = np.random.default_rng(6)
    make = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n))
    near, half, other = [], [], []
    for n in (60, 200, 1000, 5000):
        for _ in range(20):
            a, b = make(n), make(n)
            own = fuzzyhash.fingerprint(a.encode())
            like = lambda t: fuzzyhash.likeness(own, fuzzyhash.fingerprint(t.encode()))
            near.append(like(a[: len(a) // 3] + "Z" + a[len(a) // 3 + 1 :]))
            half.append(like(a[: len(a) - len(a) // 2] + b[: len(a) // 2]))
            other.append(like(b))
            assert like(a) == 1.0
    assert min(near) > 0.8 and np.mean(near) > 0.93
    assert min(half) > 0.2 and 0.4 < np.mean(half) < 0.6
    assert max(other) < 0.1
    assert fuzzyhash.likeness("0:::", fuzzyhash.fingerprint(b"some text")) == 0.0


def edited_rows(rows):
    """By the contract; ``rows`` have distinct ids."""
    ordered = sorted(rows, key=lambda r: -r[0])
    out = []
    for (doc, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, other = (fuzzyhash.fingerprint(t.encode()) for t in (text, edited, following))
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, changed, fuzzyhash.likeness(own, changed), fuzzyhash.likeness(own, other)))
    return out


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_edited_report(spark, partitions):
    df = docs_of(spark, fingerprint_texts(), -3)
    got = [tuple(r) for r in fuzzyhash.edited_report(clashing(df.repartition(partitions))).collect()]
    same_rows(got, edited_rows([(r.doc_id, r.text) for r in df.collect()]))


def test_edited_report_of_odd_rows(spark):
    rows = [(None, "no id " * 30), (None, "other " * 50), (3, "copy " * 70), (3, "copy " * 70), (3, "third " * 60), (2, None)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    a, b = (sorted(map(repr, fuzzyhash.edited_report(df.repartition(n)).collect())) for n in (1, 5))
    assert a == b and len(a) == len(rows)
    assert fuzzyhash.edited_report(spark.createDataFrame([], DOCS)).count() == 0
    (one,) = fuzzyhash.edited_report(docs_of(spark, ["single " * 40])).collect()
    assert one.near_next == 1.0 and one.n_chars == 280


def test_fingerprints_of_copies(spark):
    df = docs_of(spark, [*fingerprint_texts(), *fingerprint_texts()])
    got = fuzzyhash.fingerprints(df).collect()
    n = len(fingerprint_texts())
    by_id = {r.doc_id: r.fingerprint for r in got}
    assert all(by_id[i] == by_id[i + n] for i in range(n))


@needs_data
def test_edited_report_on_table(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op12_piecewise_fingerprints"](spark, FOLDER).collect()]
    same_rows(got, edited_rows([(r.doc_id, r.text) for r in df.collect()]))


# Trie


def brute_trie(rows):
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            order = (t is not None, t or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest())
            turns[c].append((order, (role, text)))
    own = {c: [v for _, v in sorted(ts, key=lambda x: x[0])] for c, ts in turns.items()}
    built = {}
    for c in own:
        h = (zlib.crc32(str(c).encode()) & 0xFFFFFFFF) % 9
        built[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members = collections.defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))
        parent = min(members[k[:-1]]) if k else None
        out.append((min(m), len(k), parent, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def odd_turns():
    """Null ids, turns, roles and texts, ties, repeated rows, a long conversation, many copies."""
    rng = np.random.default_rng(9)
    rows = [(None, 0, "user", "lost"), (1, None, "user", "first"), (1, 0, None, None), (1, 0, "", ""), (1, 1, "user", "é漢")]
    rows += [(2, 3, "user", "tie a"), (2, 3, "user", "tie b"), (2, 3, "user", "tie b"), (-4, 0, "user", "below zero"), (999, 0, "user", "no base")]
    for c in range(10, 60):
        for t in range(int(rng.integers(1, 8))):
            rows.append((c, t, ("user", "assistant")[t % 2], f"text {rng.integers(3)}"))
    for c in range(100, 400):
        rows += [(c, t, "user", f"copy {t}") for t in range(3)]
    rows += [(70, t, "user", f"long {t % 5} " * 3) for t in range(300)]
    return rows


@pytest.mark.parametrize("height", [None, 1, 5, 1000])
def test_trie_equals_brute_force(spark, height):
    rows = odd_turns() if height is None else [r for r in odd_turns() if r[0] != 70]
    df = spark.createDataFrame(rows, TURNS)
    got = [tuple(r) for r in prefixtrie.trie(clashing(df).repartition(11), height).collect()]
    same_rows(got, brute_trie(rows))


def test_trie_of_nothing_and_of_turnless(spark):
    assert prefixtrie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefixtrie.trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).count() == 0
    empty = next(c for c in range(1, 500, 5) if zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(empty, 0, "user", "gone")]
    got = [tuple(r) for r in prefixtrie.trie(spark.createDataFrame(rows, TURNS)).collect()]
    assert got == brute_trie(rows) and len(got) == 1 and got[0][4:7] == (0, 1, 0)


def test_list_digests_over_row_and_task_borders(spark):
    ids = [(k, i) for k, n in ((1, 5000), (2, 1), (3, 1024), (4, 1025)) for i in range(n)]
    df = spark.createDataFrame(ids, "k long, conv_id long").repartition(9)
    want = {k: hashlib.sha256(",".join(str(i) for i in sorted(i for j, i in ids if j == k)).encode()).hexdigest() for k in (1, 2, 3, 4)}
    got = prefixtrie.list_digests(df, ["k"]).collect()
    assert {r.k: r.ends_sha256 for r in got} == want and len(got) == 4


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    import oracle

    found = oracle.compare(QUERIES[name](spark, FOLDER), ORACLES[name], oracle.connect(FOLDER))
    assert found == []
