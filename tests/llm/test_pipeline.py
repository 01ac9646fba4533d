"""The whole pipeline against plain Python over a small table: the rows that each stage keeps,
their texts, and what is packed."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from shoplens.llm import packing
from shoplens.llm.tables import written
from tests.llm.conftest import ODD_TEXTS, table, words
from tests.llm.test_dedup import brute_components, brute_fingerprint
from tests.llm.test_models import brute_repeats

WORD = r"[^\x20\x09-\x0D]+"


def brute_quality(rows):
    out = []
    for i, t in rows:
        w = re.findall(WORD, t or "")
        if len(w) < 20:
            continue
        lengths = brute_repeats(w)
        inside = {k for a, n in enumerate(lengths) if n >= 8 for k in range(a, a + n)}
        share = sum(len(w[k]) for k in inside) / sum(map(len, w))
        if 100 * len(inside) > 30 * len(w):
            continue
        if (len(inside) > 50 and share > 0.20) or (max(lengths) > 50 and max(lengths) > 0.10 * len(w)):
            continue
        out.append((i, t))
    return out


def brute_exact(rows):
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), (i, t))
    return list(first.values())


def brute_near(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = brute_components(sorted(set(fps)))
    first = {}
    for (i, t), fp in sorted(zip(rows, fps), key=lambda r: (r[0][0] is None, r[0][0])):
        first.setdefault(root[fp], (i, t))
    return list(first.values())


def brute_passages(rows, length=200, min_words=50, sure=400):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(d[k:k + length] for d in raw for k in range(len(d) - length + 1))
    out = []
    for (i, t), d in zip(rows, raw):
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if seen[d[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        spans = [m.span() for m in re.finditer(WORD.encode(), d)]
        kept, end = b"", 0
        for run in re.finditer(b"\1+", bytes(gone)):
            a, b = run.span()
            whole = [s for s in spans if a <= s[0] and s[1] <= b]
            if len(whole) >= min_words:
                a, b = whole[0][0], min(b, whole[-1][1] + 1)
            elif b - a >= sure:
                a += len(d[a:b]) - len(d[a:b].lstrip())
            else:
                continue
            kept, end = kept + d[end:a], b
        out.append((i, t if t is None else (kept + d[end:]).decode("utf-8", "ignore")))
    return out


def corpus(seed):
    """Clean texts of the ids 100 on, and what each stage acts on."""
    rnd = random.Random(seed)

    def of(n):
        return words(rnd, n, "abcdefghijklmnop")
    clean = [of(rnd.randint(60, 160)) for _ in range(12)]
    long = [of(500) for _ in range(4)]
    passage, other, short = of(70), of(90), of(35)
    texts = [*clean, *long]
    texts += [clean[0].replace(" ", " \n", 3)] * 20 + [clean[1], clean[1].replace(" ", "\t")]  # equal but for white space
    for t in long:  # near copies, most of them within two bits
        w = t.split()
        texts += [" ".join(w[:k] + ["x" * k] + w[k + 1:]) for k in (3, 250, 499)] + [t.upper()]
    texts += [f"{of(40)} {p} {of(60)}" for p in (passage, passage, other, other, other, short, short)]
    texts += [f"{passage} {of(90)}", f"{of(90)}\n{passage}", f"{of(30)} {other[1:]} {of(30)}"]  # at the ends; a cut first word
    texts += [f"{of(9)} {passage} {of(9)} {passage}", "again " * 100, f"{passage} {of(300)} {passage}"]  # repetitive
    ids = [*range(100, 100 + len(clean)), *range(1, 1 + len(texts) - len(clean))]
    return [*zip(ids, texts), (None, of(70)), *((1000 + k, t) for k, t in enumerate(ODD_TEXTS))]


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


@pytest.mark.parametrize("seed", [21])
def test_stages_equal_plain_python(spark, seed):
    rows = corpus(seed)
    random.Random(seed).shuffle(rows)
    df = table(spark, [t for _, t in rows], [i for i, _ in rows])
    columns, sizes = df.columns, [len(rows)]
    brute = [brute_quality, brute_exact, brute_near, brute_passages]
    for (name, stage), plain in zip(corpus_pipeline.STAGES, brute):
        before, rows = dict.fromkeys(rows), plain(rows)
        df = written(stage(spark, df, ""), "test_pipeline", "stage")
        assert df.columns == columns
        assert kept(df) == sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")), name
        assert set(rows) != set(before), name  # the stage had something to do
        assert all(r["n_chars"] == len(r["text"]) for r in df.select("n_chars", "text").where("text is not null").collect())
        sizes.append(len(rows))
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4]

    packed = corpus_pipeline.packed_sequences(spark, df, "").toPandas()
    want = Counter()
    for i, t in rows:
        n = len(re.findall(WORD, t or "")) + 1  # and the end token
        want.update((i, at, min(4096, n - at)) for at in range(0, n, 4096))
    got = Counter((None if r.doc_id != r.doc_id else int(r.doc_id), r.first_token, r.n_tokens) for r in packed.itertuples())
    assert got == want
    lengths = packed.sort_values(["doc_id", "piece", "copy"], na_position="first")["n_tokens"].tolist()
    _, _, capacities = packing.pack(lengths)  # one group: all pieces are packed together
    bins = packed.groupby(["pack_group", "bin"])
    assert (bins.n_tokens.sum() == bins.bin_used.first()).all() and (bins.bin_used.first() <= bins.bin_capacity.first()).all()
    assert sorted(bins.bin_capacity.first()) == sorted(capacities.tolist())
