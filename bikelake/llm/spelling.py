"""Spelling variants by a variable-length gram index.

A word is cut into grams of two or three code points: at every place the longest gram of a
dictionary, unless the gram before covers it.  The dictionary holds the three-point grams
whose list of words would be long, so it is bounded by a share of all grams and fits every
task.  For each word a bound says how many grams one edit can touch, wherever it falls: those
that contain the place, those before it that the dictionary could lengthen across it, those
after it that a gram across it could cover.  So near words share, in place, the first a and
the last c grams of each other with a + c at least the bound's rest, and lists are merged
on exactly such heads and tails.  What shares a list is verified by its edit distance.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikelake.llm.common import batch_of, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT, FORM_FACTOR, DAMAGE = 7, 2, 10, 31
QMIN, QMAX = 2, 3
#: A longer gram is kept if at least one in so many grams of the words is it: at most
#: (QMAX - QMIN) times as many grams are kept, whatever the input.
GRAM_SHARE = 4096
LEVELS = (1, 2, 3, 4, 6, 8, 12, 16)  # numbers of shared grams that lists are merged on


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of whole texts: letter runs, A-Z lower-cased, one code point removed where
    ``DAMAGE`` divides crc32(``id:run``); null ids count as empty, null texts hold nothing.

    A run that is too short before the removal is too short after it, so only long ones
    are taken.  Counts are combined before they are shuffled.
    """
    run, h = F.col("run"), F.col("h")
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate(text_col, UPPER, LOWER),
                                       F.lit(f"[a-zÀ-ÿ]{{{min_length},}}"), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), run).cast("binary")).alias("h"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return (hashed.select(F.when(h % DAMAGE == 0, cut).otherwise(run).alias("word"))
            .filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= min_count))


def gram_dictionary(words: DataFrame, qmin: int = QMIN, qmax: int = QMAX, share: int = GRAM_SHARE) -> list[str]:
    """Grams of more than ``qmin`` points that hold one in ``share`` of all grams of their
    length, over all words; at most ``share`` per length."""
    q = F.explode(F.sequence(F.lit(qmin + 1), F.lit(qmax))).alias("q")
    grams = (words.select("word", q).filter(F.length("word") >= F.col("q"))
             .select("q", F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - F.col("q") + 1),
                                                lambda i: F.substring("word", i, F.col("q")))).alias("g"))
             .groupBy("q", "g").agg(F.count("*").alias("c")))
    least = grams.groupBy("q").agg((F.sum("c") / share).alias("least"))
    return sorted(r.g for r in grams.join(F.broadcast(least), "q").filter("c >= least").select("g").collect())


class GramIndex:
    """Cuts words into grams of the dictionary and bounds what one edit can touch."""

    def __init__(self, dictionary: Iterable[str], qmin: int = QMIN, qmax: int = QMAX):
        self.grams, self.qmin, self.qmax = set(dictionary), qmin, qmax
        self.heads = {g[:k] for g in self.grams for k in range(1, len(g))}
        self.tails = {g[k:] for g in self.grams for k in range(1, len(g))}

    def cut(self, word: str) -> list[tuple[int, int]]:
        """Spans (start, end) of the word's grams; starts and ends both ascend."""
        spans, reach = [], 0
        for p in range(len(word) - self.qmin + 1):
            e = p + self.qmin
            for q in range(min(self.qmax, len(word) - p), self.qmin, -1):
                if word[p:p + q] in self.grams:
                    e = p + q
                    break
            if e > reach:
                spans.append((p, e))
                reach = e
        return spans

    def touched(self, word: str, spans: list[tuple[int, int]]) -> int:
        """The most grams that one inserted, deleted or replaced code point can change."""
        most, first, q, n = 0, 0, self.qmax, len(spans)
        for i in range(len(word) + 1):          # the edit: before i, or at i
            while first < n and spans[first][0] < i - q:
                first += 1
            insert = replace = 0
            for p, e in spans[first:first + 2 * q + 2]:
                if p < i < e or e <= i < p + q and word[p:i] in self.heads or p >= i > e - q and word[i:e] in self.tails:
                    insert += 1
                if p <= i < e or e <= i < p + q and word[p:i] in self.heads \
                        or p > i >= e - q and word[i + 1:e] in self.tails:
                    replace += 1
            most = max(most, insert, replace)
        return most

    def shared(self, word: str, spans: list[tuple[int, int]]) -> int:
        """How many grams a near word shares at least: first a and last c, a + c so many."""
        return len(spans) - self.touched(word, spans)


def list_keys(index: GramIndex, word: str) -> list[tuple[int, str]]:
    """``(own, list)`` of a word: its lists at its own level, the largest number of LEVELS that
    it shares with every near word, and at higher levels, where only words that own them
    look for it."""
    spans = index.cut(word)
    bound = index.shared(word, spans)
    if bound < 1:
        raise ValueError(f"{word!r} is too short for grams of {index.qmax}")
    own = max(level for level in LEVELS if level <= bound)
    keys = []
    for level in LEVELS:
        if own <= level <= len(spans):
            for a in range(level + 1):
                head = word[:spans[a - 1][1]] if a else ""
                tail = word[spans[a - level][0]:] if a < level else ""
                keys.append((int(level == own), f"{level}.{a} {head} {tail}"))
    return keys


def near_pairs(spark: SparkSession, words: DataFrame, *, min_length: int = MIN_LENGTH) -> DataFrame:
    """``a, na, b, nb``: every pair of words (``word, n``, distinct, at least ``min_length``
    code points) that one edit turns into each other, once, a before b.

    A pair is served at the larger of its words' levels, by the word that owns it; lists
    shrink with the level's grams, and a common one is split by the adaptive skew join.
    """
    if min_length < 2 * QMAX - 1:
        raise ValueError(f"words must have {2 * QMAX - 1} code points or more")
    dictionary = gram_dictionary(words)
    schema = pa.schema([("list", pa.int64()), ("own", pa.int8()), ("word", pa.string()), ("n", pa.int64())])

    def lists(batches):
        import xxhash
        index = GramIndex(dictionary)
        for batch in batches:
            for k in range(0, batch.num_rows, 2_000):
                keys, owns, at = [], [], []
                part = batch.slice(k, 2_000)
                for j, word in enumerate(part.column(0).to_pylist()):
                    for own, key in list_keys(index, word):
                        keys.append(xxhash.xxh64_intdigest(key))
                        owns.append(own)
                        at.append(j)
                if keys:
                    yield batch_of(schema, [np.array(keys, np.uint64).view(np.int64), owns,
                                            part.column(0).take(pa.array(at)), part.column(1).take(pa.array(at))])

    out = "list long, own byte, word string, n long"
    # words are few bytes and much work: dealt to a stated number of tasks, not by size
    dealt = words.select("word", "n").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
    entries = written(spark, dealt.mapInArrow(lists, out), "gram-lists")
    a, b = entries.alias("a"), entries.alias("b")
    near = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    lengths = F.abs(F.length("a.word") - F.length("b.word")) <= 1
    met = a.filter("own = 1").join(b, (F.col("a.list") == F.col("b.list")) & lengths & near)
    first = F.col("a.word") < F.col("b.word")
    return (met.filter((F.col("b.own") == 0) | first)
            .select(F.least("a.word", "b.word").alias("a"), F.when(first, F.col("a.n")).otherwise(F.col("b.n")).alias("na"),
                    F.greatest("a.word", "b.word").alias("b"), F.when(first, F.col("b.n")).otherwise(F.col("a.n")).alias("nb"))
            .distinct())


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``word, root`` of words that have a form: the last word on the way of forms.

    Every step follows twice as many forms as the one before.  A form is at least
    FORM_FACTOR times as frequent as its word, so there are no circles and few steps.
    """
    reached = written(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = reached.join(step, "root", "left")
        moved = written(spark, further.select("word", F.coalesce("next", "root").alias("root"),
                                              F.col("next").isNotNull().alias("moved")), "roots")
        reached = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return reached


def spelling_variants(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the words of all documents.

    Near words differ by one code point inserted, deleted or replaced.  A word's form is its
    near word of largest n (ties: the smallest), where that n is at least FORM_FACTOR times
    its own; its root is the last word on the way of forms, itself where it has none.  Repeated
    rows count as often as they occur; null and empty texts hold no word; an empty table
    gives no row; other columns are not read.
    """
    words = written(spark, word_counts(docs, id_col=id_col, text_col=text_col), "words")
    pairs = written(spark, near_pairs(spark, words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("na").alias("n"), F.col("b").alias("near"), F.col("nb").alias("m")) \
        .unionByName(pairs.select(F.col("b").alias("word"), F.col("nb").alias("n"), F.col("a").alias("near"), F.col("na").alias("m")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    frequent = -F.col("best.m") >= FORM_FACTOR * F.col("n")
    found = written(spark, words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.m")).alias("form_n")), "forms")
    roots = _roots(spark, found.filter("form IS NOT NULL"))
    return (found.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
