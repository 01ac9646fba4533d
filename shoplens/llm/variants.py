"""Grouping of spelling variants by permuterm rotations.

A word with a terminator, ``word$``, has one rotation per place it can be cut at.
Two words that differ by one replaced character have rotations that agree in all but
the last character (cut behind the edited place); a word and the same word with one
character less have rotations of which one is the other without its last character.
So each rotation enters under two prefixes: under itself (``last`` empty: the whole
word) and under all but its last character (``last``: the skipped one). Rotations
sorted by prefix then put all neighbours side by side, in prefix ranges that skip the
edited character, and every range is scanned once.

A range holds at most one whole word and one word per character of the alphabet, so
its size is bounded by the alphabet (91 here) whatever the corpus. No pair is ever
written: a member counts the others of its range and takes the best of them. A
replacement pair meets in exactly one range. A deletion pair meets in one range per
character of the run that the deleted one is in; only the first of the run counts.

``n_near`` counts the words at one edit, ``form`` is the near word with the most
occurrences if it has at least ``ratio`` times as many, and ``root`` is where the
forms lead. Occurrences at least double along forms, so there are no cycles, and the
pointers are doubled in rounds until all end at a root.

Defined results: null and empty texts have no words; a null doc_id counts as an empty
one in the check sums; repeated rows count as often as they are there. Without any
word the result is empty.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shoplens.llm.tables import texts, written

RUN = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
SLIP_EVERY = 97
END = "$"  # no character of a word
# different words that a task holds before it hands on its counts
HELD_WORDS = 500_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _slipped(word: str, start: int) -> str:
    """``word`` without one character where the check sum of its place says so. ``start``:
    check sum of the text before the word."""
    h = zlib.crc32(word.encode(), start)
    if h % SLIP_EVERY:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def _count_batches(min_length: int, slips: bool):
    run_of = re.compile(RUN)

    def run(batches):
        held: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                lowered = text.as_py().encode().translate(_LOWER).decode()
                found = Counter(map(itemgetter(0), run_of.finditer(lowered)))
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in found.items():
                    if slips:
                        word = _slipped(word, start)
                    if len(word) >= min_length:
                        held[word] += n
            if len(held) >= HELD_WORDS:
                yield rows()
                held.clear()
        if held:
            yield rows()
    return run


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slips: bool = True) -> DataFrame:
    """(word, n): occurrences of the lower-cased words over all documents. With ``slips``
    one run in ``SLIP_EVERY`` loses a character first, chosen by its document and word."""
    counted = texts(docs).mapInArrow(_count_batches(min_length, slips), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, last, word, n): each rotation under itself and under all but its last character."""
    marked = F.concat("word", F.lit(END))
    cut = F.explode(F.sequence(F.lit(1), F.length("word") + 1))
    turned = words.select("word", "n", marked.alias("m"), cut.alias("i")).select(
        "word", "n", F.expr("concat(substr(m, i), substr(m, 1, i - 1))").alias("rotation"), F.col("i"))
    whole = F.struct(F.col("rotation").alias("prefix"), F.lit("").alias("last"))
    skipped = F.struct(F.expr("left(rotation, length(rotation) - 1)").alias("prefix"), F.expr("right(rotation, 1)").alias("last"))
    # uncut, the last character is the terminator, which can't be edited
    both = F.when(F.col("i") == 1, F.array(whole)).otherwise(F.array(whole, skipped))
    return turned.select("word", "n", F.inline(both)).select("prefix", "last", "word", "n")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best: struct of the near word with most occurrences) of all words
    that have one. ``words``: (word, n), each word once."""
    group = Window.partitionBy("prefix")
    ranked = group.orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of_run = F.expr("right(prefix, 1)") == F.col("last")  # deleted from within a run of its character
    whole = F.col("last") == ""
    item = F.struct((-F.col("n")).alias("minus_n"), F.col("word").alias("near"))
    scanned = rotations(words).withColumn("first_of_run", ~whole & ~of_run).select(
        "word", "last", "first_of_run",
        F.count("*").over(ranked).alias("size"), F.sum(whole.cast("int")).over(ranked).alias("wholes"),
        F.sum(F.col("first_of_run").cast("int")).over(ranked).alias("longer"),
        F.first(item).over(ranked).alias("top"), F.nth_value(item, 2).over(ranked).alias("second"))
    others = scanned.where(F.col("size") > 1).select(
        "word",
        F.when(F.col("last") == "", F.col("longer"))
        .otherwise(F.col("size") - F.col("wholes") - 1 + F.when(F.col("first_of_run"), F.col("wholes")).otherwise(0)).alias("n_near"),
        F.when(F.col("top.near") == F.col("word"), F.col("second")).otherwise(F.col("top")).alias("best"))
    return others.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form), which have no cycles: every round doubles
    how far a pointer reaches."""
    at = written(forms.select("word", F.col("form").alias("root")), "variants", "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        at = written(at.join(step, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "variants", "roots")
        if not at.where("moved").limit(1).count():
            return at.select("word", "root")
        at = at.select("word", "root")


def group_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                   ratio: int = RATIO, slips: bool = True) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = written(word_counts(docs, min_length, min_count, slips), "variants", "words")
    near = near_words(words)
    enough = -F.col("best.minus_n") >= ratio * F.col("n")
    joined = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.minus_n")).alias("form_n")),
        "variants", "near")
    found = roots(joined.where(F.col("form").isNotNull()))
    return joined.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
