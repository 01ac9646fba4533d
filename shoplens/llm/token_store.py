"""Token-id shards with a minimal perfect hash index.

File format: a Parquet table, one row per shard (so Spark's committer, any file
system and lost executors are covered), sorted by document key inside a shard:

    part        group of keys the shard belongs to (a range of keys)
    no          number of the shard in its part
    min_key, max_key, n_docs, n_ids
    first_copy  how many documents of min_key earlier shards of the part hold
    keys        the document keys in order, little-endian int64, to list a shard
    payload     ids of all documents, one after another, little-endian unsigned,
                2 bytes an id where the vocabulary allows it, else 4 (``width``)
    seeds       displacement of each hash bucket, little-endian int32
    slots       one 16-byte record per document at its perfect-hash slot:
                offset (uint64), length (uint32), fingerprint (uint32)

A key is looked up in constant time: hash -> bucket -> displacement -> slot ->
fingerprint check -> slice of the payload. A foreign key is refused by its
fingerprint but for 1 in 2^32.

Key ranges come from quantiles of the ids, so documents are tokenised once and
shuffled once; a task holds one shard at a time (``shard_ids`` ids or one document).
A key that several quantiles fall on has as many parts, and its rows go to them in turn.
Documents of one key are told apart by their number in the part; key and number
together are hashed.

Defined results: null and empty texts hold the end id only. Every row is a document of
its own, also where rows share a doc_id; ``lookup`` gives the documents of one doc_id
as one entry, their ids one after another. Rows with a null doc_id are kept under the
null key. An empty table gives an empty store.
"""

from __future__ import annotations

import gc
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from shoplens.llm.tables import texts, written
from shoplens.llm.tokenizer_memo import WordMemo, library_tokenizer

SHARD_IDS = 1 << 20
PART_DOCS = 500
PARTS_TO_A_TASK = 4
MAX_PARTS = 20_000  # beyond that parts grow; a task still holds one shard at a time
NULL_KEY = -(1 << 63)
_U64 = (1 << 64) - 1
_SLOT = np.dtype([("offset", "<u8"), ("length", "<u4"), ("mark", "<u4")])


# ---- minimal perfect hash ------------------------------------------------------
def mix(keys: np.ndarray, seed) -> np.ndarray:
    """64-bit finaliser (xor, shift, multiply) of keys under a seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + (np.asarray(seed).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def build_seeds(keys: np.ndarray) -> np.ndarray:
    """Displacements for distinct ``keys``: buckets of about four keys, largest first,
    try displacements 1, 2, ... until all keys of the bucket hit free slots; buckets
    of one key take a free slot directly, written as -(slot + 1)."""
    n = len(keys)
    n_buckets = max(1, n // 4)
    bucket = (mix(keys, np.uint64(0)) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=n_buckets)
    first = np.concatenate([[0], np.cumsum(sizes)])
    taken = np.zeros(n, bool)
    seeds = np.zeros(n_buckets, "<i4")
    by_size = np.argsort(-sizes, kind="stable")
    tries = np.arange(1, 65, dtype=np.uint64)
    for b in by_size[sizes[by_size] > 1]:
        own = keys[order[first[b]:first[b + 1]]]
        base = 0
        while True:
            slots = (mix(own[None, :], (tries + np.uint64(base))[:, None]) % np.uint64(n)).astype(np.int64)
            ordered = np.sort(slots, axis=1)
            good = ~taken[slots].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if good.any():
                at = int(np.argmax(good))
                seeds[b] = base + at + 1
                taken[slots[at]] = True
                break
            base += len(tries)
    seeds[by_size[sizes[by_size] == 1]] = -1 - np.flatnonzero(~taken)[:int((sizes == 1).sum())]
    return seeds


def slots_of(keys: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    d = seeds[(mix(keys, np.uint64(0)) % np.uint64(len(seeds))).astype(np.int64)].astype(np.int64)
    spread = (mix(keys, np.maximum(d, 0).astype(np.uint64)) % np.uint64(n)).astype(np.int64)
    return np.where(d < 0, -1 - d, spread)


def marks_of(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, np.uint64(0xFFFFFFFF)) >> np.uint64(32)).astype("<u4")


def build_index(keys: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """(seeds, slots) of documents laid one after another."""
    raw = keys.astype(np.int64).view(np.uint64)
    seeds = build_seeds(raw)
    at = slots_of(raw, seeds, len(raw))
    slots = np.zeros(len(raw), _SLOT)
    slots["offset"][at] = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    slots["length"][at] = lengths
    slots["mark"][at] = marks_of(raw)
    return seeds.tobytes(), slots.tobytes()


def hash_keys(keys: np.ndarray, first_copy: int) -> np.ndarray:
    """The keys to hash, of sorted ``keys``: the key itself for the first document of a key
    in its part, key and number mixed for the others."""
    keys = np.asarray(keys, np.int64)
    copy = np.arange(len(keys)) - np.searchsorted(keys, keys)
    copy[keys == keys[0]] += first_copy
    return np.where(copy > 0, mix(keys.view(np.uint64), copy.astype(np.uint64) << np.uint64(33)), keys.view(np.uint64)).view(np.int64)


def combined_crc(first: int, second: int, size: int) -> int:
    """CRC-32 of two byte strings in a row, from theirs and the size of the second."""
    column = [0xEDB88320, *(1 << k for k in range(31))]  # one zero bit
    times = lambda m, x: sum_xor(m[k] for k in range(32) if x >> k & 1)
    bits = size * 8
    while bits:
        if bits & 1:
            first = times(column, first)
        column = [times(column, x) for x in column]
        bits >>= 1
    return first ^ second


def sum_xor(values) -> int:
    out = 0
    for x in values:
        out ^= x
    return out


class Shard:
    """Keyed access to one shard row."""

    def __init__(self, payload: bytes, seeds: bytes, slots: bytes, width: int):
        self.payload, self.width = payload, width
        self.seeds, self.slots = np.frombuffer(seeds, "<i4"), np.frombuffer(slots, _SLOT)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, offset, length) of each key."""
        raw = np.asarray(keys, np.int64).view(np.uint64)
        got = self.slots[slots_of(raw, self.seeds, len(self.slots))]
        return got["mark"] == marks_of(raw), got["offset"].astype(np.int64), got["length"].astype(np.int64)

    def ids(self, offset: int, length: int) -> np.ndarray:
        w = self.width
        return np.frombuffer(self.payload, f"<u{w}", length, offset * w).astype("<u4")


# ---- encoding ------------------------------------------------------------------
# The splitting pattern of byte-level BPE on printable ASCII after at most one space.
ASCII_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+"
MEMO_WORDS = 2_000_000  # about 300 MB a worker at most
_WORKER: dict = {}


class TextCoder:
    """Ids of whole texts, packed. A text is cut before each single space and around
    each single line feed that stand between two characters other than white
    space: the splitting pattern of byte-level BPE starts a piece there whatever
    surrounds it, so what lies between is encoded on its own, and remembered."""

    # Other white space than single spaces and line feeds inside the text; beyond ASCII,
    # by leading bytes.
    SINGLE = (b"\t", b"\x0b", b"\x0c", b"\r")
    WIDE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80\x80")

    def __init__(self, path: str, width: int):
        letter = {2: "H", 4: "I"}[width]
        packers = [struct.Struct(f"<{n}{letter}").pack for n in range(64)]  # by number of ids
        pack = lambda ids: packers[len(ids)](*ids) if len(ids) < 64 else struct.pack(f"<{len(ids)}{letter}", *ids)
        self.first = WordMemo(path, ASCII_PIECES, pack, limit=MEMO_WORDS // 10)
        self.after_space = WordMemo(path, ASCII_PIECES, pack, before=b" ", limit=MEMO_WORDS)
        self.line_feed = pack(library_tokenizer(path).encode("\n", add_special_tokens=False).ids)

    def _odd(self, text: bytes) -> bool:
        return (text[:1].isspace() or text[-1:].isspace() or any(x in text for x in self.SINGLE)
                or b"  " in text.replace(b"\n", b" ") or (not text.isascii() and any(x in text for x in self.WIDE)))

    def encode(self, text: bytes) -> bytes:
        after_space = self.after_space.__getitem__
        if self._odd(text):
            first, *rest = units(text)
            return self.first[first] + b"".join(map(after_space, rest))
        lines = []
        for line in text.split(b"\n"):
            words = line.split(b" ")
            words[1:] = map(after_space, words[1:])
            words[0] = self.first[words[0]]
            lines.append(b"".join(words))
        return self.line_feed.join(lines)


def units(text: bytes) -> list[bytes]:
    """``text`` cut at each single space between two characters other than white space
    (of any script), without those spaces; other white space stays inside the units."""
    head, *parts = text.decode().split(" ")
    out = [head]
    for part in parts:
        if part and out[-1] and not part[0].isspace() and not out[-1][-1].isspace():
            out.append(part)
        else:
            out[-1] += " " + part
    return [u.encode() for u in out]


def _coder(path: str, width: int) -> TextCoder:
    if (path, width) not in _WORKER:
        _WORKER[path, width] = TextCoder(path, width)
        gc.collect()
        gc.freeze()  # a worker collects after each task: the memos' words are no garbage to look for
    return _WORKER[path, width]


def _tokenise(path: str, end_id: int, width: int, bounds: np.ndarray):
    def run(batches):
        coder, end = _coder(path, width), np.array([end_id], f"<u{width}").tobytes()
        turn = TaskContext.get().partitionId()
        for b in batches:
            codes = [coder.encode(t) + end for t in b.column("text").to_pylist()]
            first, last = _parts(bounds, b.column("key"))
            part = first + (turn + np.arange(len(codes))) % (last - first + 1)
            turn += len(codes)
            yield pa.RecordBatch.from_arrays([pa.array(part), b.column("key"), pa.array(codes, pa.binary())],
                                             names=["part", "key", "ids"])
    return run


def _parts(bounds: np.ndarray, keys) -> tuple[np.ndarray, np.ndarray]:
    """First and last part of the key range that each key lies in."""
    keys = keys.to_numpy(zero_copy_only=False)
    last = np.searchsorted(bounds, keys, side="right").astype(np.int64)
    return np.minimum(np.searchsorted(bounds, keys, side="left") + 1, last), last


def _route(bounds: np.ndarray):
    """Each key with all its parts."""
    def run(batches):
        for b in batches:
            first, last = _parts(bounds, b.column("key"))
            n = last - first + 1
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(first, n) + nth), b.column("key").take(
                pa.array(np.repeat(np.arange(len(n)), n)))], names=["part", "key"])
    return run


_SHARD_DDL = ("part bigint, no bigint, min_key bigint, max_key bigint, first_copy bigint, n_docs bigint, n_ids bigint, width int, "
              "keys binary, payload binary, seeds binary, slots binary")


def _shards(width: int, shard_ids: int):
    """Rows sorted by (part, key) to shard rows; one shard is held at a time."""
    def close(part, no, keys, first_copy, lengths, blobs):
        hashed = hash_keys(np.array(keys, np.int64), first_copy)
        if len(np.unique(hashed)) < len(hashed):  # by chance, 1 in 2^64 for any two
            return None
        seeds, slots = build_index(hashed, np.array(lengths, np.int64))
        return pa.RecordBatch.from_pydict(
            {"part": [part], "no": [no], "min_key": [keys[0]], "max_key": [keys[-1]], "first_copy": [first_copy],
             "n_docs": [len(keys)], "n_ids": [sum(lengths)], "width": pa.array([width], pa.int32()),
             "keys": pa.array([np.array(keys, "<i8").tobytes()], pa.binary()), "payload": pa.array([b"".join(blobs)], pa.binary()),
             "seeds": pa.array([seeds], pa.binary()), "slots": pa.array([slots], pa.binary())})

    def cut(part, no, keys, first_copy, lengths, blobs):
        whole = close(part, no, keys, first_copy, lengths, blobs)
        if whole is not None:
            return [whole]
        half = len(keys) // 2
        out = cut(part, no, keys[:half], first_copy, lengths[:half], blobs[:half])
        before = keys[:half].count(keys[half]) + (first_copy if keys[half] == keys[0] else 0)
        return out + cut(part, no + len(out), keys[half:], before, lengths[half:], blobs[half:])

    def run(batches):
        part, no, keys, lengths, blobs, held = None, 0, [], [], [], 0
        first_copy, copy = 0, 0  # of the shard's first key; of the last key
        for b in batches:
            for p, key, ids in zip(*(b.column(c).to_pylist() for c in ("part", "key", "ids"))):
                n = len(ids) // width
                copy = copy + 1 if keys and p == part and key == keys[-1] else 0
                if keys and (p != part or held + n > shard_ids):
                    done = cut(part, no, keys, first_copy, lengths, blobs)
                    yield from done
                    keys, lengths, blobs, held, no = [], [], [], 0, no + len(done)
                if p != part:
                    part, no = p, 0
                if not keys:
                    first_copy = copy
                keys.append(key)
                lengths.append(n)
                blobs.append(ids)
                held += n
        if keys:
            yield from cut(part, no, keys, first_copy, lengths, blobs)
    return run


class TokenStore:
    """A written store: ``shards`` (the files), and the bounds of its key ranges."""

    def __init__(self, shards: DataFrame, bounds: list[int]):
        self.shards, self.bounds = shards, np.array(bounds, np.int64)

    def starts(self) -> DataFrame:
        """(part, no, min_key, max_key, start): ids of all shards before each. Sums run
        inside blocks of 1024 parts, then over the blocks."""
        rows = self.shards.select("part", "no", "min_key", "max_key", "n_ids",
                                  F.floor(F.col("part") / 1024).alias("block"))
        inside = Window.partitionBy("block").orderBy("part", "no")
        per_block = rows.groupBy("block").agg(F.sum("n_ids").alias("block_ids"))
        over = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        before = per_block.select("block", F.coalesce(F.sum("block_ids").over(over), F.lit(0)).alias("before"))
        return (rows.withColumn("within", F.sum("n_ids").over(inside) - F.col("n_ids"))
                .join(before, "block").select("part", "no", "min_key", "max_key",
                                              (F.col("before") + F.col("within")).alias("start")))

    def _placed(self, found: DataFrame) -> DataFrame:
        starts = self.starts().select("part", "no", "start")
        doc_id = F.when(F.col("key") != NULL_KEY, F.col("key"))
        return found.join(starts, ["part", "no"]).select(
            doc_id.alias("doc_id"), (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")

    def read_all(self) -> DataFrame:
        """(doc_id, start, n_tokens, ids_crc32) of every document, each found by its key in
        its shard; ``start`` counts the ids of all documents before it. No payload is
        shuffled."""
        return self._placed(self.shards.select(*_SHARD_READ).mapInArrow(_read_shards, _FOUND_DDL))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The same for each distinct ``doc_id`` of ``keys`` that the store holds, all its
        documents together."""
        wanted = (keys.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_KEY)).alias("key")).distinct()
                  .mapInArrow(_route(self.bounds), "part bigint, key bigint"))
        routed = wanted.join(self.starts(), "part").where("key between min_key and max_key").select("part", "no", "key")
        shards = self.shards.select(F.col("part").alias("s_part"), F.col("no").alias("s_no"),
                                    "first_copy", "width", "keys", "payload", "seeds", "slots")
        found = self._placed(routed.groupBy("part", "no").cogroup(shards.groupBy("s_part", "s_no"))
                             .applyInPandas(_read_keys, _FOUND_DDL))
        pieces = F.array_sort(F.collect_list(F.struct("start", "n_tokens", "ids_crc32")))  # one a shard
        return found.groupBy("doc_id").agg(F.min("start").alias("start"), F.sum("n_tokens").alias("n_tokens"), pieces.alias(
            "pieces")).mapInArrow(_joined, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


_FOUND_DDL = "part bigint, no bigint, key bigint, offset bigint, n_tokens bigint, ids_crc32 bigint"
_SHARD_READ = ("part", "no", "first_copy", "width", "keys", "payload", "seeds", "slots")


def _joined(batches):
    for b in batches:
        crc = []
        for pieces in b.column("pieces").to_pylist():
            crc.append(pieces[0]["ids_crc32"])
            for x in pieces[1:]:
                crc[-1] = combined_crc(crc[-1], x["ids_crc32"], 4 * x["n_tokens"])
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(crc, pa.int64())],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _found(part: int, no: int, keys: np.ndarray, offset: np.ndarray, length: np.ndarray, shard: Shard) -> dict:
    crc = [zlib.crc32(shard.ids(o, n).tobytes()) for o, n in zip(offset.tolist(), length.tolist())]
    return {"part": np.full(len(keys), part), "no": np.full(len(keys), no), "key": keys, "offset": offset,
            "n_tokens": length, "ids_crc32": np.array(crc, np.int64)}


def _read_shards(batches):
    for b in batches:
        for r in zip(*(b.column(c) for c in _SHARD_READ)):
            part, no, first_copy, width, keys, payload, seeds, slots = (x.as_py() for x in r)
            shard, keys = Shard(payload, seeds, slots, width), np.frombuffer(keys, "<i8")
            _, offset, length = shard.find(hash_keys(keys, first_copy))
            yield pa.RecordBatch.from_pydict(_found(part, no, keys, offset, length, shard))


def _read_keys(keys: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
    if keys.empty or shard.empty:
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("part", "no", "key", "offset", "n_tokens", "ids_crc32")})
    row, at = shard.iloc[0], keys.iloc[0]
    data, held = Shard(row.payload, row.seeds, row.slots, int(row.width)), np.frombuffer(row["keys"], "<i8")
    wanted = np.sort(keys["key"].to_numpy())
    a, b = np.searchsorted(held, wanted, side="left"), np.searchsorted(held, wanted, side="right")
    wanted, a, b = wanted[b > a], a[b > a], b[b > a]
    if not len(wanted):
        return _read_keys(keys.iloc[:0], shard)
    # a key's documents lie one after another: from the first one's offset to the last one's end
    hashed = hash_keys(held, int(row.first_copy))
    _, offset, _ = data.find(hashed[a])
    _, last, length = data.find(hashed[b - 1])
    return pd.DataFrame(_found(at.part, at.no, wanted, offset, last + length - offset, data))


def write_store(docs: DataFrame, tokenizer_path: str, end_id: int, shard_ids: int = SHARD_IDS,
                part_docs: int = PART_DOCS) -> TokenStore:
    """Tokenise ``docs`` (doc_id, text), append ``end_id`` to each and write the shards."""
    width = 2 if max(library_tokenizer(tokenizer_path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    rows = texts(docs).select(F.coalesce("doc_id", F.lit(NULL_KEY)).alias("key"), F.col("text").cast("binary").alias("text"))
    parts = min(MAX_PARTS, max(1, -(-rows.count() // part_docs)))
    bounds = sorted(int(x) for x in rows.approxQuantile(
        "key", [k / parts for k in range(1, parts)], 0.1 / parts)) if parts > 1 else []
    ids = rows.mapInArrow(_tokenise(tokenizer_path, end_id, width, np.array(bounds, np.int64)),
                          "part bigint, key bigint, ids binary")
    dealt = ids.repartition(-(-parts // PARTS_TO_A_TASK), "part").sortWithinPartitions("part", "key", "ids")
    return TokenStore(written(dealt.mapInArrow(_shards(width, shard_ids), _SHARD_DDL), "token_store"), bounds)
