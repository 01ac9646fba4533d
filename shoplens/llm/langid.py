"""Language identification with interpolated Kneser-Ney character models.

A model per language is trained on a bounded sample of labelled documents:
``SAMPLE_DOCS`` of each language (smallest hash of doc_id) of at most ``SAMPLE_CHARS``
characters; a language with fewer of them also learns from its longer documents,
shortest first, whole, up to the one that reaches ``LONG_CHARS`` characters, so every
labelled language with a letter is learned. Of rows that share doc_id and language, the
one with the shortest text is taken. A fifth is held back for calibration. Texts
are lower-cased and every run of characters other than letters becomes one space.
Orders below the highest use continuation counts; each order has an absolute
discount estimated from its counts of ones and twos. Log-probabilities of seen
n-grams and log back-off weights of seen contexts are kept in sorted arrays of
64-bit hashes. A text gets the language of lowest cross-entropy per character.
The score is a softmax over the negative cross-entropies, whose sharpness is
fitted to the calibration documents; ``rejected`` marks texts whose
cross-entropy is above nearly all calibration documents of the predicted language.

Defined results: null texts and texts without a letter are ``und`` with score 0,
as is every text when no labelled document exists; ties go to the first language
by name. Rows with a null doc_id are predicted and never learned from. An empty
table gives an empty result. The broadcast models are bounded by the sample.
"""

from __future__ import annotations

import math
import uuid
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shoplens.llm.tables import prepare, written

ORDER = 4
SAMPLE_DOCS = 500
SAMPLE_CHARS = 200_000
LONG_CHARS = 10_000_000
CALIBRATE_EACH = 5
HASH_RANGE = 1 << 40
THINNING = 4
REJECT_QUANTILE = 0.995
BLOCK_CHARS = 1_000_000
MEMO_GRAMS = 600_000
UNKNOWN = "und"
_STEP = np.uint64(0x9E3779B97F4A7C15)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def normalised(text: str) -> np.ndarray:
    """Code points: letters in lower case, one space for each run of anything else."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return np.where(letter, codes, 32)[keep].astype(np.uint64)


def _joined(arrays: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes with order - 1 zeros before each text, positions of the texts' characters)."""
    pad = np.zeros(order - 1, np.uint64)
    codes = np.concatenate([x for a in arrays for x in (pad, a)])
    sizes = np.array([len(a) for a in arrays])
    starts = np.cumsum(sizes + order - 1) - sizes
    at = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return codes, at


def gram_hash(codes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` characters that end at each position."""
    h = np.full(len(at), size, np.uint64)
    with np.errstate(over="ignore"):
        for back in range(size - 1, -1, -1):
            h = (h + codes[at - back] + np.uint64(1)) * _STEP
            h ^= h >> np.uint64(29)
    return h


def train(arrays: list[np.ndarray], order: int = ORDER) -> list[tuple[np.ndarray, ...]]:
    """Per order 1..n: (sorted gram hashes, log p, sorted context hashes, log weight);
    first of all the log-probability of an unseen character."""
    codes, at = _joined(arrays, order)
    seen = [np.unique(gram_hash(codes, at, k), return_index=True, return_counts=True) for k in range(1, order + 1)]
    base = 1.0 / (len(seen[0][0]) + 1)
    below, below_p, out = None, None, [(np.array([math.log(base)]),)]
    for k in range(1, order + 1):
        grams, first, counts = seen[k - 1]
        first = at[first]
        if k < order:  # how many characters precede the gram
            longer = at[seen[k][1]]
            where = np.searchsorted(grams, gram_hash(codes, longer, k))
            counts = np.bincount(where, minlength=len(grams))
        ones, twos = (counts == 1).sum(), (counts == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        context, of = np.unique(gram_hash(codes, first - 1, k - 1), return_inverse=True)
        total = np.bincount(of, weights=counts)
        weight = discount * np.bincount(of, weights=counts > 0) / total
        lower = base if k == 1 else below_p[np.searchsorted(below, gram_hash(codes, first, k - 1))]
        p = np.maximum(counts - discount, 0) / total[of] + weight[of] * lower
        out.append((grams, np.log(p), context, np.log(weight)))
        below, below_p = grams, p
    return out


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


class Scorer:
    """Cross-entropies of texts under all languages; log-probabilities of n-grams met
    before are kept in a sorted array of at most ``MEMO_GRAMS``."""

    def __init__(self, models: dict[str, list], order: int = ORDER):
        self.languages, self.order = sorted(models), order
        self.models = [models[x] for x in self.languages]
        self._reset()

    def _reset(self):
        self.known, self.values = np.zeros(0, np.uint64), np.zeros((0, len(self.models)))

    def _compute(self, codes, at) -> np.ndarray:
        out = np.empty((len(at), len(self.models)))
        hashes = [gram_hash(codes, at, k) for k in range(self.order + 1)]
        contexts = [gram_hash(codes, at - 1, k) for k in range(self.order)]
        for m, model in enumerate(self.models):
            p = np.full(len(at), model[0][0][0])
            for k in range(1, self.order + 1):
                grams, log_p, context, weight = model[k]
                where, found = _find(grams, hashes[k])
                c_at, c_found = _find(context, contexts[k - 1])
                p = np.where(found, log_p[where], p + np.where(c_found, weight[c_at], 0.0))
            out[:, m] = p
        return out

    def log_probs(self, codes, at) -> tuple[np.ndarray, np.ndarray]:
        """(values of the distinct n-grams, which of them each position has)."""
        grams, first, back = np.unique(gram_hash(codes, at, self.order), return_index=True, return_inverse=True)
        if len(self.known) > MEMO_GRAMS:
            self._reset()
        if len(self.known):
            where, found = _find(self.known, grams)
        else:
            where, found = np.zeros(len(grams), np.int64), np.zeros(len(grams), bool)
        values = np.empty((len(grams), len(self.models)))
        values[found] = self.values[where[found]]
        values[~found] = new = self._compute(codes, at[first[~found]])
        spot = np.searchsorted(self.known, grams[~found])
        self.known = np.insert(self.known, spot, grams[~found])
        self.values = np.insert(self.values, spot, new, axis=0)
        return values, back

    def cross_entropies(self, arrays: list[np.ndarray]) -> np.ndarray:
        """[text, language] nats per character; texts must have characters."""
        out, block, size, done = np.empty((len(arrays), len(self.models))), [], 0, 0
        for i, a in enumerate(arrays):
            block.append(a)
            size += len(a)
            if size >= BLOCK_CHARS or i == len(arrays) - 1:
                codes, at = _joined(block, self.order)
                values, back = self.log_probs(codes, at)
                sizes = np.array([len(x) for x in block])
                starts = np.cumsum(sizes) - sizes
                for m in range(len(self.models)):
                    out[done:i + 1, m] = -np.add.reduceat(values[back, m], starts) / sizes
                block, size, done = [], 0, i + 1
        return out


# ---- Spark ---------------------------------------------------------------------
_MODEL_DDL = "lang string, k int, kind string, hashes array<bigint>, logs array<double>"


def _train_group(order: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        model = train([normalised(t) for t in pdf.sort_values("doc_id")["text"]], order)
        rows = [(0, "base", [], model[0][0])]
        for k in range(1, order + 1):
            grams, log_p, context, weight = model[k]
            rows += [(k, "gram", grams.view(np.int64), log_p), (k, "context", context.view(np.int64), weight)]
        out = pd.DataFrame(rows, columns=["k", "kind", "hashes", "logs"])
        out.insert(0, "lang", pdf["lang"].iloc[0])
        return out
    return run


def _models(rows) -> dict[str, list]:
    parts: dict = {}
    for r in rows:
        parts.setdefault(r["lang"], {})[r["k"], r["kind"]] = (
            np.array(r["hashes"], np.int64).view(np.uint64), np.array(r["logs"], np.float64))
    return {lang: [(p[0, "base"][1],), *((*p[k, "gram"], *p[k, "context"]) for k in range(1, max(p)[0] + 1))]
            for lang, p in parts.items()}


_SCORERS: dict = {}


class _Models:
    """A broadcast of the model rows, with a name under which workers keep the scorer."""

    def __init__(self, broadcast):
        self.broadcast, self.name = broadcast, uuid.uuid4().hex


def _scorer(models: _Models) -> Scorer:
    if models.name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[models.name] = Scorer(_models(models.broadcast.value))
    return _SCORERS[models.name]


def _predict(models, sharpness: float, limits: dict[str, float]):
    def run(batches):
        scorer = _scorer(models)
        for b in batches:
            arrays = [normalised(t) if t else np.zeros(0, np.uint64) for t in b.column("text").to_pylist()]
            some = [i for i, a in enumerate(arrays) if len(a)]
            lang, score, entropy = [UNKNOWN] * len(arrays), [0.0] * len(arrays), [None] * len(arrays)
            rejected = [True] * len(arrays)
            if some:
                h = scorer.cross_entropies([arrays[i] for i in some])
                best = h.argmin(axis=1)
                odds = np.exp(-sharpness * (h - h.min(axis=1, keepdims=True)))
                top = 1.0 / odds.sum(axis=1)
                for j, i in enumerate(some):
                    name = scorer.languages[best[j]]
                    lang[i], score[i], entropy[i] = name, float(top[j]), float(h[j, best[j]])
                    rejected[i] = entropy[i] > limits.get(name, math.inf)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(lang), pa.array(score, pa.float64()),
                 pa.array(entropy, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected"])
    return run


def _calibration(models):
    def run(batches):
        scorer = _scorer(models)
        for b in batches:
            rows = [(l, normalised(t)) for l, t in zip(b.column("lang").to_pylist(), b.column("text").to_pylist())]
            h = scorer.cross_entropies([a for _, a in rows])
            yield pa.RecordBatch.from_arrays([pa.array([l for l, _ in rows]), pa.array(h.tolist(), pa.list_(pa.float64()))],
                                             names=["lang", "h"])
    return run


def _fit(rows, languages: list[str]) -> tuple[float, dict[str, float]]:
    """Sharpness of least log-loss, and per language the cross-entropy limit."""
    if not rows:
        return 20.0, {}
    h = np.array([r["h"] for r in rows])
    truth = np.array([languages.index(r["lang"]) for r in rows])
    gap = h - h.min(axis=1, keepdims=True)

    def loss(s):
        return (s * gap[np.arange(len(h)), truth] + np.log(np.exp(-s * gap).sum(axis=1))).mean()

    limits = {lang: float(np.quantile(h[truth == i, i], REJECT_QUANTILE)) + 0.25
              for i, lang in enumerate(languages) if (truth == i).any()}
    return float(min(np.geomspace(0.5, 200, 60), key=loss)), limits


def _chosen(ids: DataFrame, sample_docs: int) -> DataFrame:
    """(doc_id, lang, shape, nth) of the documents to learn from, of the distinct ``ids``."""
    short = ids.where(F.col("shape.chars") <= SAMPLE_CHARS).withColumn(
        "order", F.pmod(F.xxhash64("doc_id"), F.lit(HASH_RANGE)))
    # a language's smallest hashes lie far below THINNING * sample_docs / (its documents) of the
    # hash range, so that the ranking gets few rows however large the language is; the sizes,
    # one row a language, are broadcast, so that rows are thinned before they are shuffled
    sizes = written(short.groupBy("lang").agg(F.count(F.lit(1)).alias("size")), "language_sizes")
    sized = short.join(F.broadcast(sizes), "lang")
    thinned = sized.where(F.col("order") < F.lit(float(HASH_RANGE) * THINNING * sample_docs) / F.col("size"))
    enough = written(thinned.groupBy("lang", "size").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= F.least(F.lit(sample_docs), F.col("size"))).select("lang"), "thinned_languages")
    few = thinned.join(F.broadcast(enough), "lang", "left_semi").unionByName(
        sized.join(F.broadcast(enough), "lang", "left_anti"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))
    some = few.withColumn("nth", nth).where(F.col("nth") <= sample_docs).select("doc_id", "lang", "shape", "nth")
    by_size = Window.partitionBy("lang").orderBy("shape", "doc_id")
    long = (ids.where(F.col("shape.chars") > SAMPLE_CHARS).join(F.broadcast(sizes), "lang", "left")
            .withColumn("size", F.coalesce("size", F.lit(0))).where(F.col("size") < sample_docs)
            .withColumn("rank", F.row_number().over(by_size)).where(F.col("rank") <= LONG_CHARS // SAMPLE_CHARS + 1)
            .withColumn("before", F.sum("shape.chars").over(by_size.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("nth", (F.col("size") + F.col("rank")).cast("int"))
            .where((F.coalesce("before", F.lit(0)) < LONG_CHARS) & (F.col("nth") <= sample_docs)))
    return some.unionByName(long.select("doc_id", "lang", "shape", "nth"))


def predict_languages(docs: DataFrame, order: int = ORDER, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text, lang): doc_id, held_out,
    lang_pred, score, cross_entropy, rejected."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    rows = rows.withColumn("held_out", F.coalesce(fold == 2, F.lit(False)))
    labelled = rows.where(F.col("doc_id").isNotNull() & (fold != 2) & F.col("lang").isNotNull())
    usable = labelled.where(F.col("text").rlike(r"\p{L}")).withColumn(
        "shape", F.struct(F.length("text").alias("chars"), F.xxhash64("text").alias("hash")))
    ids = written(usable.groupBy("lang", "doc_id").agg(F.min("shape").alias("shape")), "language_ids")
    chosen = _chosen(ids, sample_docs)
    sample = written(usable.join(F.broadcast(chosen), ["doc_id", "lang", "shape"]).select("doc_id", "text", "lang", "nth")
                     .dropDuplicates(["doc_id", "lang"]), "language_sample")
    learn = (F.col("nth") % CALIBRATE_EACH) != 0
    model_rows = sample.where(learn).groupBy("lang").applyInPandas(_train_group(order), _MODEL_DDL).collect()
    if not model_rows:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
    plain = [r.asDict() for r in model_rows]
    models = _Models(spark.sparkContext.broadcast(plain))
    languages = sorted({r["lang"] for r in plain})
    calibration = (sample.where(~learn).where(F.col("lang").isin(languages)).select("lang", "text")
                   .mapInArrow(_calibration(models), "lang string, h array<double>").collect())
    sharpness, limits = _fit(calibration, languages)
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        _predict(models, sharpness, limits), "doc_id bigint, held_out boolean, lang_pred string, score double, "
        "cross_entropy double, rejected boolean")
