"""Removal of repeated byte strings with a distributed sparse suffix array.

Every byte covered by a ``length``-byte string that also starts elsewhere goes.
Suffixes are sorted at anchors only: of each ``length - ANCHOR + 1`` successive
``ANCHOR``-grams the one of least hash (the leftmost of equal ones) is an anchor,
so two equal strings of ``length`` bytes hold an anchor at the same place. Steps:

1. Texts that occur more than once are repeated as a whole; one of them goes on.
2. Anchors whose gram hash occurs once are dropped.
3. An anchor's context is what the strings that hold it can reach: ``length -
   ANCHOR`` bytes before it and ``length`` bytes from it on, less at a text's ends.
   Equal contexts (by a 128-bit hash) are one; those held twice are covered whole.
4. Anchors with one hash and several contexts form a bucket. Its suffixes (from the
   anchor on) and its reversed prefixes are put in order by deep-shallow sorting;
   intervals of common prefixes are merged from the longest down, and of each new
   pair of neighbours in prefix order that agree on ``length`` bytes or more in all,
   the agreement covers both. No list of all pairs is made.
5. Buckets of more than ``BUCKET`` contexts are refined: the strings of a context are
   split by where they start into classes, each with the bytes that all its
   strings share as its new hash; refined twice, a class is one string and all its
   contexts are equal. So no task holds a bucket of unbounded size.
6. Covered stretches are united per text and cut out.

Defined results: null texts equal empty ones; texts shorter than ``length`` lose
nothing; rows with equal texts get equal results, whatever their doc_id (null or
repeated too). An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shoplens.llm.deep_shallow import common_prefix, sort_strings
from shoplens.llm.tables import prepare, written

LENGTH = 400
ANCHOR = 64
BUCKET = 20_000
CLASSES = 19
BLOCK = 1 << 20
NULL_KEY = -(1 << 63)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


# ---- anchors -------------------------------------------------------------------
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_STEP, BLOCK + 2 * LENGTH), _powers(_BACK, BLOCK + 2 * LENGTH)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes at each position; equal bytes, equal hash."""
    n = len(data) - size + 1
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _UP[:len(data)])])
        h = (sums[size:] - sums[:-size]) * _DOWN[:n]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def anchors(text: bytes, length: int = LENGTH, size: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors; none in a text shorter than ``length``."""
    window, spots, hashes = length - size + 1, [], []
    for start in range(0, len(text) - length + 1, BLOCK):
        data = np.frombuffer(text, np.uint8, min(len(text), start + BLOCK + length - 1) - start, start)
        h = gram_hashes(data, size)
        bits = np.uint64(21)
        key = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)  # ties: the leftmost
        rows = -(-len(key) // window)
        padded = np.full(rows * window, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[:len(key)] = key
        grid = padded.reshape(rows, window)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(key) - window + 1
        least = np.minimum(behind[:n], ahead[window - 1:window - 1 + n]) & ((np.uint64(1) << bits) - np.uint64(1))
        least = least.astype(np.int64)
        least = least[np.concatenate([[True], least[1:] != least[:-1]])]
        spots.append(least + start)
        hashes.append(h[least])
    if not spots:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, first = np.unique(np.concatenate(spots), return_index=True)
    return at, np.concatenate(hashes)[first]


def _scan(length: int, size: int):
    """Texts to (key, n_bytes, sha256, anchors)."""
    reach = length - size
    item = pa.struct([("h", pa.int64()), ("context", pa.binary()), ("pos", pa.int64())])

    def run(batches):
        for b in batches:
            n_bytes, sha, found = [], [], []
            for text in b.column("text").to_pylist():
                raw = (text or "").encode()
                at, h = anchors(raw, length, size)
                n_bytes.append(len(raw))
                sha.append(hashlib.sha256(raw).digest())
                # the ends of a text are part of its context: how far it reaches must agree
                found.append([
                    {"h": x, "pos": p, "context": xxhash.xxh3_128_digest(raw[max(0, p - reach):p + length], seed=min(p, reach))}
                    for x, p in zip(h.view(np.int64).tolist(), at.tolist())])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(sha, pa.binary()), pa.array(found, pa.list_(item))],
                names=["doc_id", "n_bytes", "sha", "anchors"])
    return run


# ---- buckets -------------------------------------------------------------------
def agreements(befores: list[bytes], afters: list[bytes], length: int) -> list[tuple[int, int]]:
    """For each context (bytes before the anchor, bytes from it on) how far it agrees to
    the left and to the right with contexts that it shares ``length`` bytes or more
    with, anchor included; (0, 0) if with none."""
    flipped = [s[::-1] for s in befores]
    left_order, _ = sort_strings(flipped)
    rank = [0] * len(befores)
    for r, i in enumerate(left_order):
        rank[i] = r
    order, lcp = sort_strings(afters)
    best = [(0, 0)] * len(befores)

    def meet(r, s, right):
        x, y = left_order[r], left_order[s]
        left = common_prefix(flipped[x], flipped[y])
        if left + right >= length:
            best[x] = max(best[x][0], left), max(best[x][1], right)
            best[y] = max(best[y][0], left), max(best[y][1], right)

    group = list(range(len(order)))  # slot -> group; groups are runs of slots
    members = {g: [rank[i]] for g, i in enumerate(order)}

    def find(g):
        while group[g] != g:
            group[g] = group[group[g]]
            g = group[g]
        return g

    longest_before = max(map(len, befores), default=0)
    for slot in sorted(range(1, len(order)), key=lambda k: -lcp[k]):
        right = lcp[slot]
        if right + longest_before < length:
            break
        a, b = find(slot - 1), find(slot)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        into = members[a]
        for r in members.pop(b):
            at = bisect_left(into, r)
            if at:
                meet(into[at - 1], r, right)
            if at < len(into):
                meet(r, into[at], right)
            insort(into, r)
        group[b] = a
    return best


def _solve(length: int):
    """Rows sorted by bucket to (bucket, context, before, after) reach."""
    def rows(batches):
        for b in batches:
            yield from zip(*(b.column(c).to_pylist() for c in ("bucket", "context", "before", "after")))

    def run(batches):
        out = []
        for bucket, group in groupby(rows(batches), key=lambda r: r[0]):
            group = list(group)
            reach = agreements([r[2] for r in group], [r[3] for r in group], length)
            out += [(bucket, r[1], x, y) for r, (x, y) in zip(group, reach) if x + y]
            if len(out) >= 4096:
                yield _reach_batch(out)
                out = []
        if out:
            yield _reach_batch(out)
    return run


_REACH_DDL = "bucket binary, context binary, left bigint, right bigint"


def _reach_batch(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.binary(), pa.int64(), pa.int64()))],
        names=["bucket", "context", "left", "right"])


def _contexts(length: int, size: int):
    """Texts with their wanted anchors to (bucket, context, before, after)."""
    def run(batches):
        for b in batches:
            for text, wanted in zip(b.column("text").to_pylist(), b.column("wanted").to_pylist()):
                raw = (text or "").encode()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w["bucket"] for w in wanted], pa.binary()), pa.array([w["context"] for w in wanted], pa.binary()),
                     pa.array([raw[max(0, w["pos"] - length + size):w["pos"]] for w in wanted], pa.binary()),
                     pa.array([raw[w["pos"]:w["pos"] + length] for w in wanted], pa.binary())],
                    names=["bucket", "context", "before", "after"])
    return run


_CONTEXT_DDL = "bucket binary, context binary, before binary, after binary"


def _refine(length: int, step: int):
    """Contexts to the contexts of their classes: of the strings that start between
    ``low`` and ``high`` bytes before the anchor, ``step`` starts to a class."""
    def run(batches):
        for b in batches:
            out = []
            for bucket, context, lo0, hi0, before, after in zip(*(b.column(c).to_pylist() for c in (
                    "bucket", "context", "low", "high", "before", "after"))):
                for lo in range(lo0, hi0 + 1, step):
                    hi = min(hi0, lo + step - 1)
                    if len(before) < lo or len(after) < length - hi:
                        continue
                    core = before[len(before) - lo:] + after[:length - hi]
                    sub_before, sub_after = before[max(0, len(before) - hi):], after[:length - lo]
                    new = hashlib.blake2b(core + bucket + lo.to_bytes(4, "big"), digest_size=16).digest()
                    sub = xxhash.xxh3_128_digest(sub_before + sub_after, seed=len(sub_before))
                    out.append((bucket, context, new, sub, lo, hi, sub_before, sub_after))
            kinds = (pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            cols = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[
                "old_bucket", "old_context", "bucket", "context", "low", "high", "before", "after"])
    return run


_REFINE_DDL = ("old_bucket binary, old_context binary, bucket binary, context binary, low bigint, high bigint, "
               "before binary, after binary")


def _crowded(contexts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(bucket) of those with two or more contexts, up to ``most`` and above. Written, so
    that a join with them is between two plain shuffles, whose large partitions Spark splits."""
    sizes = written(contexts.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "bucket_sizes")
    return sizes.where(F.col("n") <= most).select("bucket"), sizes.where(F.col("n") > most).select("bucket")


def _sorted_reach(contexts: DataFrame, length: int) -> DataFrame:
    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (contexts.select("bucket", "context", "before", "after").repartition(parts, "bucket")
            .sortWithinPartitions("bucket").mapInArrow(_solve(length), _REACH_DDL))


def context_reach(contexts: DataFrame, length: int = LENGTH, size: int = ANCHOR, bucket: int = BUCKET) -> DataFrame:
    """(bucket, context, left, right) of the distinct contexts (bucket, context, before,
    after) that agree with another one of their bucket on ``length`` bytes or more."""
    width = length - size + 1
    level = contexts.withColumns({"low": F.lit(0).cast("bigint"), "high": F.lit(width - 1).cast("bigint")})
    original, whole, reach = None, None, None  # original: context of this level -> context given
    while True:
        small, large = _crowded(level, bucket)
        found = _sorted_reach(level.join(small, "bucket"), length)
        if original is not None:
            found = found.unionByName(whole).withColumnsRenamed({"bucket": "b", "context": "c"}).join(
                original, ["b", "c"]).select("bucket", "context", "left", "right")
        found = written(found.groupBy("bucket", "context").agg(F.max("left").alias("left"), F.max("right").alias("right")), "reach")
        reach = found if reach is None else reach.unionByName(found)
        rest = written(level.join(large, "bucket"), "crowded")
        if rest.isEmpty():
            return reach.groupBy("bucket", "context").agg(F.max("left").alias("left"), F.max("right").alias("right"))
        width = -(-width // CLASSES)
        classes = written(rest.mapInArrow(_refine(length, width), _REFINE_DDL), "classes")
        level = written(classes.groupBy("bucket", "context").agg(
            F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("low", "high", "before", "after")]), "class_contexts")
        whole = level.where("n > 1").select(
            "bucket", "context", F.octet_length("before").cast("bigint").alias("left"),
            F.octet_length("after").cast("bigint").alias("right")).where(F.col("left") + F.col("right") >= length)
        step = classes.select(F.col("bucket").alias("b"), F.col("context").alias("c"), "old_bucket", "old_context")
        original = (step.withColumnsRenamed({"old_bucket": "bucket", "old_context": "context"}) if original is None else
                    step.join(original.withColumnsRenamed({"b": "old_bucket", "c": "old_context"}), ["old_bucket", "old_context"])
                    .select("b", "c", "bucket", "context"))


# ---- whole tables --------------------------------------------------------------
def _covered(docs: DataFrame, length: int, size: int, bucket: int):
    """(scan, spans): scan has (doc_id, key, n_bytes, sha, copies); spans has the
    stretches [start, end) of the texts that occur once, by (key, sha)."""
    prepare(docs.sparkSession)
    reach = length - size
    scan = written(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _scan(length, size), "doc_id bigint, n_bytes bigint, sha binary, "
        "anchors array<struct<h:bigint,context:binary,pos:bigint>>"), "anchors")
    scan = scan.withColumn("key", F.coalesce("doc_id", F.lit(NULL_KEY)))
    firsts = written(scan.groupBy("sha").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("copies")), "text_groups")
    lone = firsts.select("sha", "key", (F.col("copies") == 1).alias("lone"))
    # of repeated texts the first row's anchors go on (once, even if that row is repeated)
    repeated = scan.join(lone.where("not lone"), ["sha", "key"]).dropDuplicates(["sha"])
    single = scan.join(lone.where("lone"), ["sha", "key"])
    live = single.select("key", "sha", "lone", "n_bytes", "anchors").unionByName(
        repeated.select("key", "sha", "lone", "n_bytes", "anchors"))
    marks = live.select("key", "sha", "lone", "n_bytes", F.explode("anchors").alias("a")).select(
        "key", "sha", "lone", "n_bytes", F.col("a.h").alias("h"), F.col("a.context").alias("context"), F.col("a.pos").alias("pos"))
    shared = written(live.select(F.explode("anchors.h").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
                     .where("n > 1").select("h"), "shared_hashes")
    marks = written(marks.join(shared, "h", "left_semi").withColumn("bucket", F.expr("unhex(lpad(hex(h), 16, '0'))")).drop("h"),
                    "marks")
    contexts = written(marks.groupBy("bucket", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "sha", "pos", "lone")).alias("at")), "contexts")
    contested = written(contexts.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"), "contested")
    wanted = (contexts.join(contested, "bucket").groupBy(F.col("at.key").alias("key"), F.col("at.sha").alias("sha"))
              .agg(F.collect_list(F.struct("bucket", "context", F.col("at.pos").alias("pos"))).alias("wanted")))
    found = written(_keyed(docs).join(written(wanted, "wanted"), ["key", "sha"]).dropDuplicates(["key", "sha"])
                    .select("text", "wanted").mapInArrow(_contexts(length, size), _CONTEXT_DDL), "context_bytes")
    solved = context_reach(found, length, size, bucket)
    left, right = F.least(F.col("pos"), F.lit(reach)), F.least(F.col("n_bytes") - F.col("pos"), F.lit(length))
    many = contexts.where("n > 1").select("bucket", "context")
    whole = marks.where("lone").join(many, ["bucket", "context"], "left_semi").where(left + right >= length).select(
        "key", "sha", (F.col("pos") - left).alias("start"), (F.col("pos") + right).alias("end"))
    # a context held twice is covered whole; for the others the one place they are at is known
    once = contexts.where("n = 1 and at.lone").join(solved, ["bucket", "context"])
    part = once.select(F.col("at.key").alias("key"), F.col("at.sha").alias("sha"),
                       (F.col("at.pos") - F.col("left")).alias("start"), (F.col("at.pos") + F.col("right")).alias("end"))
    spans = whole.unionByName(part).groupBy("key", "sha").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    scan = scan.drop("anchors").join(firsts.select("sha", "copies"), "sha")
    return scan, written(spans, "spans")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_KEY)).alias("key"),
                       F.unhex(F.sha2(text, 256)).alias("sha"), text.alias("text"))


def _runs(spans) -> list[tuple[int, int]]:
    """The spans united to maximal runs [start, end)."""
    runs: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans):
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], b))
        else:
            runs.append((a, b))
    return runs


_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def _passage(raw: bytes, a: int, b: int, min_words: int, sure: int) -> tuple[int, int] | None:
    """What goes of a run: its whole words and the white space behind them if they are
    ``min_words`` or more, else all of it if it has ``sure`` bytes."""
    whole = [(m.start(), m.end()) for m in _WORDS.finditer(raw, a, b)]
    if whole and a and whole[0][0] == a and _WORDS.match(raw, a - 1):
        whole = whole[1:]  # the end of a word that begins before the run
    if whole and whole[-1][1] == b and _WORDS.match(raw, b):
        whole = whole[:-1]
    if len(whole) >= min_words:
        return whole[0][0], b if whole[-1][1] == b else min(b, whole[-1][1] + 1)
    # white space before it stays, so that the words around it don't become one
    return (a + len(raw[a:b]) - len(raw[a:b].lstrip()), b) if b - a >= sure else None


def _cut(raw: bytes, spans, min_words: int = 0, sure: int = 0) -> tuple[bytes, int]:
    """(remaining bytes, number of maximal runs removed); with ``min_words``, of passages."""
    kept, end, n = [], 0, 0
    for a, b in _runs(spans):
        if min_words:
            found = _passage(raw, a, b, min_words, sure)
            if found is None:
                continue
            a, b = found
        kept.append(raw[end:a])
        end = b
        n += 1
    kept.append(raw[end:])
    return b"".join(kept), n


def _cut_digests(batches):
    for b in batches:
        got = [_cut(t.encode(), s) for t, s in zip(b.column("text").to_pylist(), b.column("spans").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [b.column("key"), b.column("sha"), pa.array([len(k) for k, _ in got], pa.int64()),
             pa.array([n for _, n in got], pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k, _ in got])],
            names=["key", "sha", "n_kept", "n_runs", "digest"])


def removed_repeats(docs: DataFrame, length: int = LENGTH, size: int = ANCHOR, bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept
    (bytes that remain), changed (whether any were removed)."""
    scan, spans = _covered(docs, length, size, bucket)
    cut = written(_keyed(docs).join(spans, ["key", "sha"]).select("key", "sha", "text", "spans").mapInArrow(
        _cut_digests, "key bigint, sha binary, n_kept bigint, n_runs bigint, digest string"), "cut")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    zero = F.lit(0).cast("bigint")
    removed = F.when(gone, F.col("n_bytes")).otherwise(F.coalesce(F.col("n_bytes") - F.col("n_kept"), zero))
    return scan.join(cut, ["key", "sha"], "left").select(
        "doc_id", "n_bytes", removed.alias("n_removed"),
        F.when(gone, F.lit(1).cast("bigint")).otherwise(F.coalesce("n_runs", zero)).alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.coalesce("digest", F.lower(F.hex("sha")))).alias("kept_sha256"),
        (F.col("n_bytes") - removed).alias("n_kept"), (removed > 0).alias("changed"))


def _cut_texts(names: list[str], text_col: str, count_col: str | None, min_words: int, sure: int):
    def run(batches):
        for b in batches:
            texts = []
            for t, spans, gone in zip(b.column(text_col).to_pylist(), b.column("__spans").to_pylist(), b.column("__gone").to_pylist()):
                if gone or spans:
                    raw = t.encode()
                    whole = [{"start": 0, "end": len(raw)}]
                    t = _cut(raw, whole if gone else spans, min_words, sure)[0].decode("utf-8", "ignore")
                texts.append(t)
            cols = {c: b.column(c) for c in names}
            cols[text_col] = pa.array(texts, b.schema.field(text_col).type)
            if count_col in cols:
                kind = b.schema.field(count_col).type
                cols[count_col] = pa.array([n if t is None else len(t) for n, t in zip(cols[count_col].to_pylist(), texts)], kind)
            yield pa.RecordBatch.from_arrays([cols[c] for c in names], names=names)
    return run


def without_repeats(docs: DataFrame, length: int = LENGTH, size: int = ANCHOR, bucket: int = BUCKET,
                    min_words: int = 0, sure: int = 0) -> DataFrame:
    """``docs`` (all columns, all rows) with the repeated bytes cut out of ``text``;
    ``n_chars``, if there, follows. Characters cut in the middle are dropped. With
    ``min_words`` a run of covered bytes goes if it holds that many whole words (words cut
    by its ends stay), or ``sure`` bytes (scripts without spaces); other runs stay."""
    scan, spans = _covered(docs, length, size, bucket)
    gone = written(scan.where((F.col("copies") > 1) & (F.col("n_bytes") >= length)).select(
        F.col("key").alias("__key"), F.col("sha").alias("__sha")).distinct(), "gone")
    keyed = docs.withColumns({
        "__key": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_KEY)),
        "__sha": F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))})
    changes = spans.select(F.col("key").alias("__key"), F.col("sha").alias("__sha"), F.col("spans").alias("__spans"),
                           F.lit(False).alias("__gone")).unionByName(
        gone.withColumns({"__spans": F.lit(None).cast("array<struct<start:bigint,end:bigint>>"), "__gone": F.lit(True)}))
    marked = keyed.join(changes, ["__key", "__sha"], "left").withColumn("__gone", F.coalesce("__gone", F.lit(False)))
    count_col = "n_chars" if "n_chars" in docs.columns else None
    return marked.select(*[F.col(f"`{c}`") for c in docs.columns], "__spans", "__gone").mapInArrow(
        _cut_texts(docs.columns, "text", count_col, min_words, sure), docs.schema)
