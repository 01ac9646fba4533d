"""Token counts with overlap resynchronisation for huge documents.

Documents of at most ``chunk_chars`` characters are encoded word by word (a word
is a run without ASCII white space), with the library's result for each word
remembered. Longer ones are cut into chunks of that size that overlap by
``overlap`` characters; the chunks are spread over the cluster, each is encoded
with offsets, and neighbours are spliced at a common boundary of their overlap.

A boundary p is proven stable where the character before p is ASCII white space,
the one at p is not, and a token starts at p in both encodings: the vocabulary's
normaliser (NFC, white-space folding, lower case) maps characters on either side
of white space independently, its splitting pattern matches no white space, and
no special string holds any, so the tokens from p on depend on the text from p on
alone and those before p on the text before it alone. A document with a pair of
chunks without a common boundary is encoded again with twice the overlap, until
every pair has one or one chunk holds the whole text.

Defined results: null and empty texts have no tokens; special strings in a text
become special tokens (the library's default); rows with null or repeated doc_id
are counted like any other. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shoplens.llm.tables import texts, written
from shoplens.llm.tokenizer_memo import WordMemo, library_tokenizer

CHUNK_CHARS = 32_768
OVERLAP = 512
_SPACE = frozenset(" \t\n\x0b\x0c\r")
_MEMOS: dict = {}


# The splitting pattern of the vocabulary on lower-case printable ASCII, with white
# space (which it drops) left out.
ASCII_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"
MEMO_WORDS = 1_500_000  # about 150 MB a worker at most


def _memo(path: str) -> WordMemo:
    if path not in _MEMOS:
        _MEMOS[path] = WordMemo(path, ASCII_PIECES, pack=len, fold=str.lower, limit=MEMO_WORDS)
    return _MEMOS[path]


def _count_short(path: str):
    def run(batches):
        memo = _memo(path)
        for b in batches:
            words, ends = [], []
            for t in b.column("text").to_pylist():
                words += t.encode().split()
                ends.append(len(words))
            counts = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
            sums = np.concatenate([[0], np.cumsum(counts)])
            at = np.array([0, *ends])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), pa.array(sums[at[1:]] - sums[at[:-1]], pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])
    return run


def _cut(chunk_chars: int):
    """Rows (row_key, overlap, text) to chunks; a chunk is at least four overlaps long."""
    def run(batches):
        for b in batches:
            for key, overlap, text in zip(*(b.column(c).to_pylist() for c in ("row_key", "overlap", "text"))):
                size = max(chunk_chars, 4 * overlap)
                start = no = 0
                while True:
                    end = min(len(text), start + size)
                    yield pa.RecordBatch.from_pydict(
                        {"row_key": [key], "no": [no], "start": [start], "overlap": [overlap],
                         "last": [end == len(text)], "text": [text[start:end]]},
                        schema=_CHUNK)
                    if end == len(text):
                        break
                    start, no = end - overlap, no + 1
    return run


_CHUNK = pa.schema([("row_key", pa.string()), ("no", pa.int64()), ("start", pa.int64()),
                    ("overlap", pa.int64()), ("last", pa.bool_()), ("text", pa.string())])
_CHUNK_DDL = "row_key string, no bigint, start bigint, overlap bigint, last boolean, text string"
_CODED_DDL = ("row_key string, no bigint, overlap bigint, last boolean, n_tokens bigint, "
              "head map<bigint,bigint>, tail map<bigint,bigint>")


def _boundaries(text, start, starts, lo, hi):
    """[(position in the document, tokens before it)] of the stable boundaries in
    text[lo:hi] at which a token starts."""
    out = []
    for p in range(max(lo, 1), hi):
        if text[p - 1] in _SPACE and text[p] not in _SPACE:
            k = int(np.searchsorted(starts, p))
            if k < len(starts) and starts[k] == p:
                out.append((start + p, k))
    return out


def _encode_chunks(path: str):
    def run(batches):
        tok = library_tokenizer(path)
        kind = pa.map_(pa.int64(), pa.int64())
        for b in batches:
            rows = b.to_pylist()
            heads, tails, counts = [], [], []
            for r in rows:
                text, ov = r["text"], r["overlap"]
                code = tok.encode(text, add_special_tokens=False)
                starts = np.array([a for a, _ in code.offsets], np.int64)
                counts.append(len(starts))
                heads.append(_boundaries(text, r["start"], starts, 0, min(ov, len(text))) if r["no"] else [])
                tails.append([] if r["last"] else
                             _boundaries(text, r["start"], starts, len(text) - ov, len(text)))
            yield pa.RecordBatch.from_arrays(
                [b.column("row_key"), b.column("no"), b.column("overlap"), b.column("last"),
                 pa.array(counts, pa.int64()), pa.array(heads, kind), pa.array(tails, kind)],
                names=["row_key", "no", "overlap", "last", "n_tokens", "head", "tail"])
    return run


def _splice(coded: DataFrame) -> DataFrame:
    """(row_key, overlap, n_tokens, failed): the last chunk's tokens, plus for each
    pair what the left chunk has before the common boundary less what the right
    one has before it."""
    left = coded.where(~F.col("last")).select("row_key", F.col("no").alias("l_no"), "tail", "overlap")
    right = coded.where("no > 0").select("row_key", (F.col("no") - 1).alias("l_no"), "head")
    pair = left.join(right, ["row_key", "l_no"]).withColumn(
        "p", F.array_min(F.array_intersect(F.map_keys("tail"), F.map_keys("head"))))
    part = pair.select("row_key", "overlap", F.expr("tail[p] - head[p]").alias("n"), F.col("p").isNull().alias("failed"))
    last = coded.where("last").select("row_key", "overlap", F.col("n_tokens").alias("n"), F.lit(False).alias("failed"))
    return part.unionByName(last).groupBy("row_key", "overlap").agg(
        F.sum("n").alias("n_tokens"), F.max("failed").alias("failed"))


def _count_long(long: DataFrame, path: str, chunk_chars: int, overlap: int) -> DataFrame:
    """(row_key, n_tokens) of documents that are longer than a chunk."""
    spark = long.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    todo, done = long.withColumn("overlap", F.lit(overlap).cast("bigint")), None
    while True:
        chunks = todo.select("row_key", "overlap", "text").mapInArrow(_cut(chunk_chars), _CHUNK_DDL)
        coded = chunks.repartition(parts, "row_key", "no").mapInArrow(_encode_chunks(path), _CODED_DDL)
        spliced = written(_splice(written(coded, "chunks")), "spliced")
        good = spliced.where(~F.col("failed")).select("row_key", "n_tokens")
        done = good if done is None else done.unionByName(good)
        again = spliced.where("failed").select("row_key", (F.col("overlap") * 2).alias("overlap"))
        if again.isEmpty():
            return done
        todo = long.join(again, "row_key")


def count_tokens(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048,
                 chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``max_tokens``)."""
    # rows with the same id and text share a count, so this key is enough to bring counts back
    rows = texts(docs).withColumn("row_key", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                                         F.hex(F.xxhash64("text")), F.length("text").cast("string")))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    is_long = F.length("text") > chunk_chars
    short = rows.where(~is_long).select("doc_id", "n_bytes", "text").mapInArrow(
        _count_short(tokenizer_path), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    long = rows.where(is_long)
    once = long.select("row_key", "text").dropDuplicates(["row_key"])
    spliced = _count_long(once, tokenizer_path, chunk_chars, overlap)
    longs = long.select("row_key", "doc_id", "n_bytes").join(spliced, "row_key").select("doc_id", "n_bytes", "n_tokens")
    return short.unionByName(longs).withColumn("over_limit", F.col("n_tokens") > max_tokens)
