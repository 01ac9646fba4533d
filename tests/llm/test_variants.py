"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from shoplens.llm import variants
from shoplens.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD_TEXTS, table


def one_edit(a, b):
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_counts(rows, slips=True):
    c = Counter()
    for doc_id, text in rows:
        low = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for w in re.findall("[A-Za-z\u00C0-\u00FF]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if slips and h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            c[w] += 1
    return {w: n for w, n in c.items() if len(w) >= 5 and n >= 3}


def plain(counts):
    """All rows, by trying every other word of a similar length."""
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    rows = {}
    for w, n in counts.items():
        near = [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        rows[w] = [form, n, len(near), counts[form] if form else None]
    out = set()
    for w, (form, n, near, form_n) in rows.items():
        root = w
        while rows[root][0]:
            root = rows[root][0]
        out.add((w, form, root, n, near, form_n))
    return out


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def got(df):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_all_pairs(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    df = QUERIES["op12_spelling_variants"](spark, SF_SMALL)
    assert df.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"),
                         ("n_near", "bigint"), ("form_n", "bigint")]
    assert got(df) == plain(plain_counts(docs))


@pytest.mark.parametrize("seed", range(3))
def test_crowded_words(spark, seed):
    """Few letters, so that runs of one letter, long chains and ties are common."""
    rnd = random.Random(seed)
    counts = Counter()
    while len(counts) < 400:
        counts["".join(rnd.choice("abé") for _ in range(rnd.randint(5, 8)))] += rnd.choice([3, 3, 4, 6, 12, 24, 50, 100])
    text = " ".join(w for w, n in counts.items() for _ in range(n)).split()
    rnd.shuffle(text)
    df = table(spark, [" ".join(text[i::7]) for i in range(7)])
    assert got(variants.group_variants(df, slips=False)) == plain(dict(counts))


def test_chain_of_forms(spark):
    chain = ["aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb"]
    text = " ".join(w for i, w in enumerate(chain) for _ in range(3 * 2 ** i))
    rows = {r["word"]: r for r in variants.group_variants(table(spark, [text]), slips=False).collect()}
    assert [rows[w]["form"] for w in chain] == [*chain[1:], None]
    assert {rows[w]["root"] for w in chain} == {"abbbbb"}


def test_odd_texts_null_ids_and_repeated_rows(spark):
    texts = ODD_TEXTS * 4 + ["Straße straße STRASSE Strasse strasse", "strase strase strase", "×÷×÷× ×÷×÷× ×÷×÷×"] * 5
    ids = [None if i % 5 == 0 else i % 7 for i in range(len(texts))]
    assert got(variants.group_variants(table(spark, texts, ids))) == plain(plain_counts(list(zip(ids, texts))))


def test_very_long_text_and_word(spark):
    rnd = random.Random(1)
    long = " ".join("".join(rnd.choice("abc") for _ in range(6)) for _ in range(200_000)) + " " + ("x" * 900 + " ") * 3
    assert got(variants.group_variants(table(spark, [long]))) == plain(plain_counts([(0, long)]))


@pytest.mark.parametrize("texts", [[], [None, ""], ["1 2 3 abcd"]])
def test_no_words(spark, texts):
    assert variants.group_variants(table(spark, texts)).collect() == []
