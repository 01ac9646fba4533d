"""Importance resampling against a plain computation with dictionaries."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from shoplens.llm import importance
from shoplens.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD_TEXTS, table, words


def plain_features(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain(rows, target, percent=5, min_words=20, m=10_000):
    """rows: (doc_id, text) -> sorted (doc_id, n_features, weight, score, rank)."""
    def bucket(f):
        return zlib.crc32(f.encode()) % m
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, plain_features(text)[1]))
    for text in target:
        t.update(map(bucket, plain_features(text)[1]))
    ns, nt = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in rows:
        n, f = plain_features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (ns + m) / ((s[b] + 1) * (nt + m)))) for b in map(bucket, f))
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1]))
    for i, r in enumerate(able[:len(able) * percent // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_query_equals_plain_computation(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("text").collect()]
    df = QUERIES["op11_importance_resampling"](spark, SF_SMALL)
    assert df.dtypes == [(c, "bigint") for c in COLUMNS]
    assert got(df) == plain(docs, target)


def test_odd_texts_ties_nulls_and_clashing_columns(spark):
    rnd = random.Random(3)
    texts = ODD_TEXTS + [words(rnd, 30) for _ in range(40)] + ["same words " * 15] * 30
    ids = [None if i % 9 == 4 else i // 2 for i in range(len(texts))]  # repeated and null ids
    df = table(spark, texts, ids)
    target = table(spark, ["same words here", None, ""])
    want = plain(list(zip(ids, texts)), ["same words here", "", None], percent=40)
    assert got(importance.resample(df, target, percent=40)) == want
    assert sum(r[4] is not None for r in want) > 20


def test_all_rows_equal(spark):
    """One score and one id for all rows: still ranked 1, 2, 3..."""
    df = table(spark, ["word " * 25] * 200, [7] * 200)
    ranks = sorted(r["rank"] for r in importance.resample(df, table(spark, ["x"]), percent=50).where("rank is not null").collect())
    assert ranks == list(range(1, 101))


def test_very_long_text(spark):
    rnd = random.Random(5)
    long = words(rnd, 200_000, "abcdefgh")
    rows = [(1, long), (2, words(rnd, 50))]
    assert got(importance.resample(table(spark, [t for _, t in rows], [1, 2]), table(spark, ["abc"]))) == plain(rows, ["abc"])


@pytest.mark.parametrize("texts", [[], [None], ["", " "]])
def test_empty_tables(spark, texts):
    out = got(importance.resample(table(spark, texts), table(spark, [])))
    assert [r[1:3] for r in out] == [(0, 0)] * len(texts) and all(r[4] is None for r in out)


def test_drawn_documents_keep_all_columns(spark):
    rnd = random.Random(8)
    texts = [words(rnd, 30) for _ in range(50)] + [None]
    df = table(spark, texts, [*range(50), None])
    target = table(spark, texts[:3])
    drawn = importance.drawn_documents(df, target, percent=10)
    ranked = importance.resample(df, target, percent=10).where("rank is not null")
    assert drawn.columns == df.columns
    assert {r["doc_id"] for r in drawn.collect()} == {r["doc_id"] for r in ranked.collect()} and drawn.count() == 5
