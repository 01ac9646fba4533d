"""Quality rules: counts per document and a suffix-array repetition rule.

Repetition is measured on words. The suffix array of a batch of documents is built
by prefix doubling, ever only on suffixes whose prefix still occurs twice; words
are numbered per document, so suffixes of different documents never match. The
longest common prefixes of neighbours in the array give, for each position, the
length of the longest substring that starts there and occurs again: the intervals
of equal prefix are the maximal repeats. Spans of repeats of at least
``min_repeat`` words are united, and the rule limits

* the fraction of the words' characters that lies in repeats (``MAX_COVERED``),
* the longest repeat, as a fraction of the words (``MAX_LONGEST``).

Both limits lie a third below the base rule (a repeat of 10 % of the words that is
held twice covers 20 %; the base rule starts at 30 %) and count only where more than
``LONG_WORDS`` words are repeated, or the longest repeat has more than that: a short
text that says one sentence twice is left to the base rule, a long one that holds a
whole passage twice goes.

Defined results: null and empty texts have no words and fail the base rule. Rows
with a null or repeated doc_id are judged like any other. Memory grows with the
batch (``BATCH_WORDS``) or the longest single text. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shoplens.llm.tables import prepare, texts

MIN_REPEAT = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_COVERED = 0.20
MAX_LONGEST = 0.10
LONG_WORDS = 50
BATCH_WORDS = 400_000
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"


def repeat_lengths(words: np.ndarray) -> np.ndarray:
    """For each position of ``words`` (ints), the length of the longest substring that
    starts there and also starts elsewhere; substrings don't run past the end, nor
    over a value that occurs once."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    sa = np.argsort(words, kind="stable")
    ordered = words[sa]
    # rank: first slot of the suffix's group in the array; levels[k]: ranks by 2^k words
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    rank = np.empty(n + 1, np.int64)
    rank[sa] = np.repeat(starts, np.diff(np.append(starts, n)))
    rank[n] = n  # past the end: shared by no suffix of the same length
    levels = [rank.astype(np.int32)]
    slots = np.arange(n)
    h = 1
    while True:
        group = rank[sa[slots]]
        same = np.concatenate([[False], group[1:] == group[:-1]])
        shared = same | np.append(same[1:], False)
        slots = slots[shared]
        if not len(slots):
            break
        pos = sa[slots]
        after = rank[np.minimum(pos + h, n)]
        own = rank[pos]
        order = np.argsort(own * (n + 1) + after, kind="stable")
        pos, own, after = pos[order], own[order], after[order]
        sa[slots] = pos
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (after[1:] != after[:-1])])
        first = np.maximum.accumulate(np.where(new, slots, 0))
        rank[pos] = first
        levels.append(rank.astype(np.int32))
        h *= 2
    # longest common prefix of neighbours, from the highest level down
    a, b = sa[:-1], sa[1:]
    live = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b, lcp = a[live].copy(), b[live].copy(), np.zeros(len(live), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = np.minimum(a + lcp, n), np.minimum(b + lcp, n)
        lcp += np.where((levels[k][x] == levels[k][y]) & (x < n) & (y < n), 1 << k, 0)
    best = np.zeros(n, np.int64)
    np.maximum.at(best, a, lcp)
    np.maximum.at(best, b, lcp)
    return best


def covered(lengths: np.ndarray, at_least: int) -> np.ndarray:
    """Mask of the positions in the united spans of repeats of ``at_least`` or more."""
    n = len(lengths)
    starts = np.flatnonzero(lengths >= at_least)
    reach = np.zeros(n, np.int64)
    reach[starts] = starts + lengths[starts]
    return np.maximum.accumulate(reach) > np.arange(n) if n else np.zeros(0, bool)


def _measure(split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: words in repeats, characters of those words as a fraction, longest repeat."""
    number = defaultdict(count().__next__)
    ids = np.fromiter((number[w] for words in split for w in words), np.int64)
    sizes = np.array([len(w) for w in split], np.int64)
    doc = np.repeat(np.arange(len(split)), sizes)
    lengths = repeat_lengths(doc * (len(number) + 1) + ids)
    ends = np.cumsum(sizes)[doc] if len(doc) else np.zeros(0, np.int64)
    lengths = np.minimum(lengths, ends - np.arange(len(doc)))
    inside = covered(lengths, MIN_REPEAT)
    chars = np.fromiter((len(w) for words in split for w in words), np.int64, len(doc))
    n = len(split)
    total = np.bincount(doc, weights=chars, minlength=n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, doc, lengths)
    return (np.bincount(doc, weights=inside, minlength=n).astype(np.int64),
            np.bincount(doc, weights=inside * chars, minlength=n) / np.maximum(total, 1), longest)


def judge(texts_: list[str | None]) -> dict[str, list]:
    """The columns of ``measure`` for a list of texts."""
    out = defaultdict(list)
    held, size = [], 0

    def flush():
        repeat, fraction, longest = _measure(held)
        out["n_repeat_words"] += repeat.tolist()
        out["repeat_char_fraction"] += fraction.tolist()
        out["longest_repeat"] += longest.tolist()
        held.clear()

    for text in texts_:
        text = text or ""
        words = text.encode().split()
        lines = [x for x in text.split("\n") if x.strip(WHITE)]
        out["n_words"].append(len(words))
        out["word_chars"].append(len(text) - sum(map(text.count, WHITE)))
        out["n_symbols"].append(sum(map(text.count, SYMBOLS)))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        held.append(words)
        size += len(words)
        if size >= BATCH_WORDS:
            flush()
            size = 0
    if held:
        flush()
    for n, rep, frac, longest in zip(out["n_words"], out["n_repeat_words"], out["repeat_char_fraction"], out["longest_repeat"]):
        base = n < MIN_WORDS or 100 * rep > MAX_REPEAT_PERCENT * n
        repetitive = (rep > LONG_WORDS and frac > MAX_COVERED) or (longest > LONG_WORDS and longest > MAX_LONGEST * n)
        out["base_failed"].append(base)
        out["kept"].append(not base and not repetitive)
    return out


_COLUMNS = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
            "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(),
            "repeat_char_fraction": pa.float64(), "longest_repeat": pa.int64()}


def _measure_batches(batches):
    for b in batches:
        got = judge(b.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(got[c], t) for c, t in _COLUMNS.items())],
                                         names=["doc_id", *_COLUMNS])


def measure(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, repeat_char_fraction, longest_repeat."""
    return texts(docs).mapInArrow(
        _measure_batches, "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean, repeat_char_fraction double, longest_repeat bigint")


def _keep_batches(text_col: str):
    def run(batches):
        for b in batches:
            at = b.schema.get_field_index(text_col)
            yield b.filter(pa.array(judge(b.column(at).to_pylist())["kept"], pa.bool_()))
    return run


def passing_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns, unchanged) that the rules keep."""
    prepare(docs.sparkSession)
    return docs.mapInArrow(_keep_batches(text_col), docs.schema)
