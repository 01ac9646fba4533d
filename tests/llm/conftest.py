"""Helpers of the operator tests: small tables with nulls, ties and clashing names."""

import random

# ends of texts, white space, case, other scripts, special strings, long runs
ODD_TEXTS = [
    None, "", " ", "\n\t \x0b\x0c\r", "a", "A  b\tc", "a b c", "a  b\nc", "Straße ÉCOLE Σίσυφος", "你好 世界", "é é",
    "<|endoftext|> x<|endoftext|>y <|startoftext|>", "don't I'll we've  'tis", "1234 5 6.7", "x" * 3000, " x" * 400,
    "word " * 50, "\x1c\x85\xa0 z\x1cz", "😀😀 ok", "end.\nStart\n\nStart\n",
]


def words(rnd: random.Random, n: int, alphabet: str = "abcdeé") -> str:
    return " ".join("".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 6))) for _ in range(n))


def table(spark, texts, ids=None, langs=None):
    """documents with further columns whose names clash with outputs and helpers."""
    ids = list(range(len(texts))) if ids is None else ids
    langs = [None] * len(texts) if langs is None else langs
    rows = [(i, t, lang, "s", None if t is None else len(t), "kept", 1, "fp", b"k")
            for i, t, lang in zip(ids, texts, langs)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, "
        "n_tokens int, fp string, key binary").repartition(3)
