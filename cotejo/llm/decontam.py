"""Benchmark decontamination by spaced seeds, DataFrame functions only.

A mask reads some of the next words and ignores the others, so one replaced word breaks only
those masks that read it. Hashes of benchmark and training texts meet in a join; around each hit
the benchmark item is laid over the document and the words that agree are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import SPACE, drop_ids, keep_ids, stage

# Places that each mask reads, of a span of 11 and 10 words: six words each, two masks with
# different gaps.
MASKS: tuple[tuple[int, ...], ...] = ((0, 1, 4, 6, 9, 10), (0, 2, 3, 5, 8, 9))
# Further masks for items of fewer than ``CLOSE_WORDS`` words, in which two long masks have few
# places: of any five words one may differ. Where a quarter of the words of an item of at least
# ``LEAST_WORDS`` differ, some five words in a row are hit at most once, so no such item is missed.
CLOSE_MASKS: tuple[tuple[int, ...], ...] = ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4))
CLOSE_WORDS = 30
# Items with fewer words than this are found only as whole texts; longer ones anywhere in a text.
PHRASE_WORDS = 3
# Benchmark hashes up to which the join broadcasts them (24 bytes each); beyond, it shuffles.
BROADCAST_HASHES = 1_000_000
# Words that must agree in the best aligned stretch; an item with fewer has to agree as a whole.
LEAST_WORDS = 10
# Percent of the words of a whole item that must agree where no stretch is long enough.
PERCENT = 75
# What a word that differs takes off the stretch.
PENALTY = 2


def words_of(text: str) -> Column:
    """Words in lower case without the signs around them."""
    bare = F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}\\x20\\x09-\\x0D]+", "")
    return F.filter(F.split(bare, SPACE), lambda w: w != "")


def _hashed(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.transform(words_of("text"), lambda w: F.xxhash64(w)).alias("h"))


def _seeds(df: DataFrame, keys: list[str], masks) -> DataFrame:
    """One row for each place and mask: keys, place i, seed hash k, which depends on the mask.

    Shifted copies of the word hashes are zipped, so that the hash of a place is a plain
    expression over columns.
    """
    places = sorted({p for mask in masks for p in mask})
    shifted = [F.when(F.size("h") > p, F.slice("h", p + 1, F.size("h") - p)).otherwise(F.array().cast("array<long>")).alias(f"w{p}") for p in places]
    rows = df.filter(F.size("h") >= min(max(mask) for mask in masks) + 1).select(*keys, F.posexplode(F.arrays_zip(*shifted)).alias("i", "z"))

    def seed(mask):
        there = F.col(f"z.w{max(mask)}").isNotNull()
        return F.when(there, F.xxhash64(F.lit(",".join(map(str, mask))), *(F.col(f"z.w{p}") for p in mask)))

    return rows.select(*keys, "i", F.explode(F.array(*map(seed, masks))).alias("k")).filter("k is not null")


def _whole(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Texts too short for a mask, by the hash of all their words."""
    return df.filter((F.size("h") > 0) & (F.size("h") <= most)).select(*keys, F.lit(0).alias("i"), F.xxhash64(F.lit(-1), "h").alias("k"))


def contaminated(docs: DataFrame, benchmark: DataFrame, masks=MASKS, least: int = LEAST_WORDS, broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """Benchmark items found in ``docs`` (doc_id, text): a row for each document and item.

    Returns doc_id, item_id, n_item_words, n_words (words that agree in the best stretch),
    n_span (length of that stretch), doc_start, item_start (places of its first word). A stretch
    counts when at least ``least`` words agree after ``PENALTY`` for each that differs; so does an
    item of ``least`` words or more of which ``PERCENT`` agree. Shorter items have to agree in
    every word, and those of fewer than ``PHRASE_WORDS`` are found only as whole texts. Null or empty texts on either side match
    nothing; null ids on either side are left out; repeated rows give one row; other columns are
    not read. Words of more than one script or case agree in lower case without signs.
    """
    shortest = min(max(mask) for mask in masks)
    train = _hashed(docs.selectExpr("cast(doc_id as long) doc_id", "text").filter("doc_id is not null and text is not null"), "doc_id")
    tests = stage(
        _hashed(benchmark.select("item_id", "text").filter("item_id is not null and text is not null"), "item_id").filter(F.size("h") > 0)
    )
    # Lengths of items that need masks of their own: one mask of all words for each short length.
    lengths = [n for (n,) in tests.select(F.size("h").alias("n")).filter(F.col("n") < CLOSE_WORDS).distinct().collect()]
    close = CLOSE_MASKS if any(n >= least for n in lengths) else ()
    phrases = [tuple(range(n)) for n in sorted(lengths) if PHRASE_WORDS <= n < least]
    items = _seeds(tests, ["item_id"], masks).unionByName(_whole(tests, ["item_id"], shortest))
    if close:
        items = items.unionByName(_seeds(tests.filter((F.size("h") >= least) & (F.size("h") < CLOSE_WORDS)), ["item_id"], close))
    for phrase in phrases:
        items = items.unionByName(_seeds(tests.filter(F.size("h") == len(phrase)), ["item_id"], [phrase]))
    keys = stage(
        items.select("item_id", F.col("i").alias("j"), "k").distinct()
    )
    distinct = keys.select("k").distinct()
    if keys.count() <= broadcast_hashes:
        distinct = F.broadcast(distinct)
    # Hits first by hash alone, once for each document and hash place; then with their items.
    seeds = _seeds(train, ["doc_id"], [*masks, *close, *phrases]).unionByName(_whole(train, ["doc_id"], shortest))
    hits = seeds.join(distinct, "k", "left_semi")
    # A diagonal of a document and an item is the same alignment whichever hash found it.
    diagonals = stage(
        hits.join(keys, "k").select("doc_id", "item_id", (F.col("i") - F.col("j")).alias("shift")).groupBy("doc_id", "item_id", "shift").agg(F.count(F.lit(1)).alias("n_hits"))
    )
    found = _verified(docs, tests, diagonals, least)
    best = F.struct("n_words", -F.col("n_span"), -F.col("doc_start"), -F.col("item_start"), "n_item_words")
    return (
        found.groupBy("doc_id", "item_id")
        .agg(F.max(best).alias("b"))
        .select(
            "doc_id", "item_id",
            F.col("b.n_item_words").cast("long").alias("n_item_words"), F.col("b.n_words").cast("long").alias("n_words"),
            (-F.col("b.col2")).cast("long").alias("n_span"), (-F.col("b.col3")).cast("long").alias("doc_start"), (-F.col("b.col4")).cast("long").alias("item_start"),
        )
    )


def _verified(docs: DataFrame, tests: DataFrame, diagonals: DataFrame, least: int) -> DataFrame:
    """Lay the item over the document at each shift and take the best stretch.

    Best stretch: the run of places with the largest (words that agree) - PENALTY * (others).
    Words that agree outside it count for the share of the whole item.
    """
    ids = diagonals.select("doc_id")
    texts = keep_ids(docs.selectExpr("cast(doc_id as long) doc_id", "text").filter("text is not null"), ids)
    rows = (
        diagonals.join(_hashed(texts, "doc_id"), "doc_id")
        .join(tests.select("item_id", F.col("h").alias("t")), "item_id")
        # Only the words under the item go on.
        .select(
            "doc_id", "item_id", "shift", "t",
            F.greatest(-F.col("shift"), F.lit(0)).alias("from"),
            F.slice("h", F.greatest(F.col("shift"), F.lit(0)) + 1, F.size("t") - F.greatest(-F.col("shift"), F.lit(0))).alias("d"),
        )
    )
    agree = F.zip_with("d", F.expr("slice(t, from + 1, size(d))"), lambda a, b: a == b)

    def step(s, same):
        score = F.when(same, s["now"] + 1).otherwise(s["now"] - PENALTY)
        fresh = score < 0
        now, words = F.when(fresh, 0).otherwise(score), F.when(fresh, 0).otherwise(s["words"] + same.cast("int"))
        start = F.when(fresh, s["at"] + 1).otherwise(s["start"])
        better = now > s["best"]
        pick = lambda a, b: F.when(better, a).otherwise(b)
        return F.struct(
            (s["at"] + 1).alias("at"), (s["all"] + same.cast("int")).alias("all"), now.alias("now"), words.alias("words"), start.alias("start"),
            pick(now, s["best"]).alias("best"), pick(words, s["best_words"]).alias("best_words"),
            pick(start, s["best_start"]).alias("best_start"), pick(s["at"] + 1, s["best_end"]).alias("best_end"),
        )

    zero = F.struct(*(F.lit(0).alias(n) for n in ("at", "all", "now", "words", "start", "best", "best_words", "best_start", "best_end")))
    b = F.col("b")
    return (
        rows.select("doc_id", "item_id", "shift", "from", F.size("t").alias("n_item_words"), F.aggregate(agree, zero, step).alias("b"))
        .filter((b["best"] >= F.least(F.lit(least), F.col("n_item_words"))) | ((F.col("n_item_words") >= least) & (100 * b["all"] >= PERCENT * F.col("n_item_words"))))
        .select(
            "doc_id", "item_id", "n_item_words", b["best_words"].alias("n_words"), (b["best_end"] - b["best_start"]).alias("n_span"),
            (F.greatest("shift", F.lit(0)) + b["best_start"]).alias("doc_start"), (F.col("from") + b["best_start"]).alias("item_start"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs``, all columns, in which no benchmark item was found."""
    return drop_ids(docs, stage(contaminated(docs, benchmark, **options).select("doc_id").distinct()))
