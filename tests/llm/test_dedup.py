"""Exact, near and substring dedup against brute force."""

import glob
import hashlib
import random
import re
import tempfile
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from shoplens.llm import deep_shallow, exact_dedup, simhash, suffix_dedup
from shoplens.llm.tables import CLEANUP, written
from tests.llm.conftest import ODD_TEXTS, table, words


# ---- exact ---------------------------------------------------------------------
def test_exact_groups(spark):
    texts = ODD_TEXTS + ["a b c", "a\n\nb c", "", None] + ["hot text"] * 40
    rnd = random.Random(1)
    ids = rnd.sample(range(1000), len(texts))
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in zip(ids, texts)}
    got = {r.doc_id: r for r in exact_dedup.dedup(table(spark, texts, ids)).collect()}
    for i, t in norm.items():
        same = [j for j, u in norm.items() if u == t]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (min(same), len(same), min(same) == i)
        assert got[i].text_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_hot_digests_go_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 3)
    df = table(spark, ["x"] * 10 + ["y"] * 2 + ["z"])
    got = sorted((r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.dedup(df).collect())
    assert got == [(i, 0, 10) for i in range(10)] + [(10, 10, 2), (11, 10, 2), (12, 12, 1)]


def test_index_persists_and_appends_only_new(spark):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    first = exact_dedup.dedup(table(spark, ["a", "b", "a"], [10, 11, 12]), index).collect()
    assert sorted((r.doc_id, r.keep_id) for r in first) == [(10, 10), (11, 11), (12, 10)]
    again = exact_dedup.DigestIndex(spark, path=index.path, buckets=4)
    second = exact_dedup.dedup(table(spark, ["b", "c", "c"], [1, 2, 3]), again).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in second) == [(1, 11, False), (2, 2, True), (3, 2, False)]
    assert again.table().count() == 3


def test_anti_join_reads_the_index_unshuffled(spark):
    index = exact_dedup.DigestIndex(spark)
    rows = table(spark, ["a", "b"]).select("doc_id", exact_dedup.digest(F.col("text")).alias("digest"))
    index.ingest(rows)
    new = written(rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id")), "new")
    plan = new.join(index.table().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan"):]
    assert "SortMergeJoin" in physical and physical.count("Exchange hashpartitioning") == 1


def test_exact_rows_that_stay(spark):
    df = table(spark, ["a", "a", "a", "b", None, "", "c", "c"], [3, 3, 5, None, 7, 8, None, None])
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in exact_dedup.distinct_documents(df).collect())
    assert got == [(-1, "b"), (-1, "c"), (3, "a"), (7, "")]
    assert exact_dedup.distinct_documents(df).columns == df.columns
    assert exact_dedup.dedup(df.limit(0)).count() == 0


# ---- SimHash -------------------------------------------------------------------
def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values):
    label = {v: v for v in values}

    def root(v):
        while label[v] != v:
            v = label[v]
        return v
    distinct = list(values)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                label[root(b)] = root(a)
    return {v: root(v) for v in distinct}


def test_fingerprints_and_components(spark):
    rnd = random.Random(4)
    base = [words(rnd, 60) for _ in range(15)]
    texts = ODD_TEXTS + base + [b + " x" for b in base] + [" ".join(b.split()[:-1]) for b in base] + base[:3]
    got = {r.doc_id: r for r in simhash.near_duplicates(table(spark, texts)).collect()}
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == fps
    assert all(len(r.fingerprint) == 16 for r in got.values())
    root = brute_components(sorted(set(fps.values())))
    for i, fp in fps.items():
        assert got[i].component_id == min(j for j, f in fps.items() if root[f] == root[fp])


@pytest.mark.parametrize("key_rows", [16, 1, 10_000])
def test_links_connect_all_close_fingerprints(spark, monkeypatch, key_rows):
    monkeypatch.setattr(simhash, "KEY_ROWS", key_rows)
    rnd = random.Random(9)
    values = set()
    for _ in range(12):  # chains, stars and pairs at 0 to 4 bits
        centre = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 40)):
            v = centre
            for b in rnd.sample(range(64), rnd.randint(0, 4)):
                v ^= 1 << b
            values.add(v)
            if rnd.random() < 0.3:
                centre = v
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    edges = simhash.links(spark.createDataFrame(signed, "fp bigint"))
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in edges.collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    labels = {r.node % (1 << 64): r.label for r in simhash.components(edges).collect()}
    got, exp = {}, {}
    for v, r in brute_components(sorted(values)).items():
        got.setdefault(labels.get(v, ("alone", v)), set()).add(v)
        exp.setdefault(r, set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, exp.values()))


def test_golay_keys_meet_within_two_bits():
    patterns, used = simhash.error_patterns()
    assert set(used.tolist()) == {1, 6} and (used == 6).sum() == 1771
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 3), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    ra, ka = simhash.keys(a)
    rb, kb = simhash.keys(b)
    met = {r for r, _ in set(zip(ra.tolist(), ka.tolist())) & set(zip(rb.tolist(), kb.tolist()))}
    assert len(met) == len(a)


def test_near_duplicate_rows_that_stay(spark):
    text = words(random.Random(2), 80)
    df = table(spark, [text, text, text, None, "", "other words here", "other words here"], [4, 4, 6, 1, 2, None, None])
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in simhash.representatives(df).collect())
    assert got == [(-1, "other words here"), (1, ""), (4, text)]
    assert simhash.representatives(df).columns == df.columns
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_unrelated_rows_of_one_id_all_stay(spark):
    rnd = random.Random(5)
    a, b, c, d, e = (words(rnd, 80) for _ in range(5))
    assert len(set(brute_components([brute_fingerprint(x) for x in (a, b, c, d, e)]).values())) == 5
    #                        null ids       one id   ``e`` stays as row 3, not as row 5
    df = table(spark, [a, a, b, c, d, e, e], [None, None, None, 5, 5, 3, 5])
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in simhash.representatives(df).collect())
    assert got == sorted([(-1, a), (-1, b), (5, c), (5, d), (3, e)])
    one = sorted((r.doc_id, r.text) for r in simhash.representatives(table(spark, [c, e, e], [5, 3, 5])).collect())
    assert one == [(3, e), (5, c)]


# ---- substrings ----------------------------------------------------------------
def brute_cut(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in raw for i in range(len(d) - length + 1))
    out = []
    for d in raw:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(d, gone) if not y)
        runs = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    return out


def passages(seed, n=120):
    rnd = random.Random(seed)
    parts = ["".join(rnd.choice("abcde é") for _ in range(rnd.randint(25, 90))) for _ in range(6)] + ["a" * 70, "ab" * 40]
    texts = ["".join(rnd.choice(parts) if rnd.random() < 0.4 else "".join(rnd.choice("abcde é") for _ in range(rnd.randint(0, 60)))
                     for _ in range(rnd.randint(0, 5))) for _ in range(n)]
    for _ in range(20):
        t = list(rnd.choice(texts))
        for _ in range(rnd.randint(0, 3) if t else 0):
            t[rnd.randrange(len(t))] = "x"
        texts.append("".join(t))
    return texts + ODD_TEXTS + [texts[3], texts[3], None]


@pytest.mark.parametrize("seed,bucket", [(1, 20_000), (2, 2), (3, 1)])
def test_cut_equals_brute_force(spark, seed, bucket):
    texts = passages(seed)
    got = sorted(tuple(r) for r in suffix_dedup.removed_repeats(table(spark, texts), 30, 8, bucket).collect())
    assert got == [(i, *x[:4], x[0] - x[1], x[1] > 0) for i, x in enumerate(brute_cut(texts, 30))]


def test_cut_texts_null_and_repeated_ids(spark):
    texts = passages(5, 40)
    ids = [None if i % 7 == 0 else i // 2 for i in range(len(texts))]
    df = table(spark, texts, ids)
    exp = [x[4].decode("utf-8", "ignore") for x in brute_cut(texts, 30)]
    got = suffix_dedup.without_repeats(df, 30, 8).collect()
    key = lambda p: (p[0] is None, p[0] or 0, p[1])
    assert sorted(((r.doc_id, r.text or "") for r in got), key=key) == sorted(zip(ids, exp), key=key)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
    assert suffix_dedup.without_repeats(df, 30, 8).columns == df.columns
    assert suffix_dedup.removed_repeats(df.limit(0)).count() == 0


def test_pipeline_stage_cuts_passages_of_over_fifty_words(spark):
    """Planted passages of 51 to 60 words (300 to 400 bytes, one of short words) go from
    all documents; shorter shared ones and clean documents stay as they are."""
    rnd = random.Random(12)
    letters = "abcdefghijklmnopqrst"

    def of(n, size):
        return " ".join("".join(rnd.choice(letters) for _ in range(size)) for _ in range(n))
    planted = [of(51, 5), of(60, 5), of(55, 6), of(51, 3)]
    short = of(40, 6)
    assert all(200 <= len(p) < 400 for p in planted) and 200 < len(short) < 400
    solid = "".join(chr(rnd.randrange(0x4E00, 0x9FFF)) for _ in range(150))  # 450 bytes, no spaces
    texts, want = [], []
    for p in [*planted, short, solid]:
        for _ in range(3):
            a, b = of(80, 5), of(80, 5)
            texts.append(f"{a} {p} {b}")
            want.append(texts[-1] if p == short else f"{a} {b}")
    texts += [of(120, 5) for _ in range(5)] + [None, "", "short"]
    want += texts[len(want):]
    got = {r.doc_id: r for r in corpus_pipeline.repeated_passages(spark, table(spark, texts), "").collect()}
    for i, (text, exp) in enumerate(zip(texts, want)):
        if exp is None:
            assert got[i].text is None
        else:
            assert got[i].text.split() == exp.split(), i


def test_whole_texts_held_twice(spark):
    """Equal texts go as a whole if they have the words or the bytes."""
    rnd = random.Random(13)
    few, many = "x" * 250 + " few words", words(rnd, 90, "abcdefgh")
    df = table(spark, [few, few, many, many, "z" * 500, "z" * 500])
    got = sorted((r.doc_id, r.text) for r in suffix_dedup.without_repeats(df, 200, 32, min_words=50, sure=400).collect())
    assert got == [(0, few), (1, few), (2, ""), (3, ""), (4, ""), (5, "")]


def test_no_shuffle_files_of_the_steps_stay(spark):
    """The shuffle files of each written step go with it, whenever the driver collects garbage."""
    def files():
        return set(glob.glob(f"{spark.conf.get('spark.local.dir', tempfile.gettempdir())}/blockmgr-*/*/shuffle_*.data"))
    df = table(spark, passages(6, 60))
    df.groupBy("lang").count().collect()  # an ordinary query's files stay: they are seen here
    seen = files()
    assert seen
    set_before = spark.conf.get(CLEANUP, None)
    got = suffix_dedup.removed_repeats(df, 30, 8)
    until = time.time() + 20  # they are deleted in the background
    while (left := files() - seen) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(CLEANUP, None) == set_before
    assert got.count() == df.count()


def test_exact_groups_of_very_long_texts(spark):
    long = words(random.Random(14), 400_000)
    got = sorted((r.doc_id, r.keep_id) for r in exact_dedup.dedup(table(spark, [long + " a", long + "  a", long + " b"])).collect())
    assert got == [(0, 0), (1, 0), (2, 2)]


def test_fingerprint_of_a_very_long_text(spark):
    long = words(random.Random(15), 60_000)
    r = simhash.near_duplicates(table(spark, [long])).first()
    assert int(r.fingerprint, 16) == brute_fingerprint(long) and r.component_id == 0


def test_anchors_across_blocks(monkeypatch):
    rnd = random.Random(1)
    text = bytes(rnd.choice(b"abc") for _ in range(3000)) + b"a" * 500
    whole = suffix_dedup.anchors(text, 60, 16)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 256)
    parts = suffix_dedup.anchors(text, 60, 16)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()
    spots = whole[0].tolist()
    assert all(any(i <= p <= i + 44 for p in spots) for i in range(0, len(text) - 59, 7))


def test_deep_shallow_order():
    rnd = random.Random(3)
    for _ in range(300):
        xs = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 14))) for _ in range(rnd.randint(0, 30))]
        order, lcp = deep_shallow.sort_strings(xs, shallow=2)
        assert [xs[i] for i in order] == sorted(xs) and sorted(order) == list(range(len(xs)))
        for k in range(1, len(order)):
            a, b = xs[order[k - 1]], xs[order[k]]
            assert lcp[k] == next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
