"""Scoring by a log-bilinear neural language model.

The score of word w after context h is s(w, h) = (sum_i c_i * r[h_i]) . q[w] + b[w]
with a vector r per context word, a diagonal weight c_i per position and q, b per
predicted word. It is trained in numpy by noise-contrastive estimation (the noise
is the smoothed unigram distribution, one draw of noise words per batch): every
partition of the training documents goes once through all its tokens from common
initial values; each row of the parameters is averaged over the partitions that met it,
by their token counts, so what is shuffled follows the tokens. For scoring, the
scores of all choices after a context come from batched matrix products and are
normalised exactly.

Model vocabulary: every word that the training documents hold ``own_count`` times or
more, and the ``words`` most frequent ones in any case, has its own vectors, as context
and as predicted word; the number of rows follows the corpus. The prediction is a tree
of choices: first the end token, one of the ``words`` most frequent words, or one of 256
classes by last byte; in a class, one of about sqrt(n) groups of its n words; in a group,
the word. Each level is trained by noise-contrastive estimation on its own noise and
normalised among the choices of one parent, so a token costs some sqrt(n) products. A
class's words below ``own_count`` are one choice of it, and each of them has that
choice's probability times (c + 0.1) / (N_rest + 0.1 * (V_rest + 1)), so every word of
any text has a probability. Counts cover all training documents; those of the words with
own vectors, and of the most frequent words up to ``frequent``, are broadcast, all other
words meet their counts in a join.

Defined results: null and empty texts have the end token only. Rows with a null
doc_id are scored, not held out and never learned from; rows that repeat are scored
one by one. Without training documents N and V are 0 and the model is uniform. An
empty table gives an empty result.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shoplens.llm.tables import texts, written

END = b""
WORDS = 767
OWN_COUNT = 100
FREQUENT = 200_000
CONTEXT = 2
DIM = 24
NOISE = 32
BATCH = 2048
RATE = 0.05
SEED = 7
# bytes of words that are counted at once
COUNT_BYTES = 16 << 20
BLOCK_TOKENS = 200_000
# words looked up at once: each lookup indexes the vocabulary anew
LOOKED_UP = 1_000_000
# rows of a table that are averaged together
PIECE = 256
# contexts whose first level is summed up at once
CACHED = 256
# contexts of two of so many first rows may come from one table; what is kept of the others
SQUARE = 3072
KEPT = 1_000_000
# what the squared gradients begin with
START = np.float32(1e-8)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_LOWER).split()


def split_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, as ``words_of`` gives them, one after another; number of words of each)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    words, sizes = lists.flatten(), np.diff(lists.offsets.to_numpy()).astype(np.int64)
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # white space at an end of a text leaves an empty one
    if not full.all():
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[full], minlength=len(sizes))
        words = words.filter(pa.array(full))
    return words, sizes


def _last_bytes(words: pa.Array) -> np.ndarray:
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32)[words.offset + 1:words.offset + len(words) + 1]
    return np.frombuffer(data, np.uint8)[ends - 1].astype(np.int64)


# ---- model ---------------------------------------------------------------------
class Parameters:
    """r: [context rows, dim]; q: [choices, dim]; c: [context, dim]; b: [choices]."""

    def __init__(self, r, q, c, b):
        self.r, self.q, self.c, self.b = r, q, c, b

    @classmethod
    def initial(cls, unigram: np.ndarray, dim: int = DIM, context: int = CONTEXT, context_rows: int | None = None):
        rng = np.random.default_rng(SEED)
        n, m = len(unigram), context_rows or len(unigram)
        return cls(rng.normal(0, 0.1, (m, dim)).astype(np.float32), rng.normal(0, 0.1, (n, dim)).astype(np.float32),
                   np.ones((context, dim), np.float32), np.log(unigram).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.r, self.q, self.c, self.b)])

    def like(self, flat: np.ndarray) -> "Parameters":
        out, at = [], 0
        for x in (self.r, self.q, self.c, self.b):
            out.append(flat[at:at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return Parameters(*out)


def histories(ids: np.ndarray, starts: np.ndarray, context: int = CONTEXT) -> np.ndarray:
    """[token, context]: the ids before each token of its document, nearest first; the
    end token's id (0) stands before a document."""
    n = len(ids)
    offset = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    out = np.zeros((n, context), np.int64)
    for i in range(context):
        out[i + 1:, i] = np.where(offset[i + 1:] > i, ids[:n - i - 1], 0)
    return out


class Tree:
    """The choices that lead to a word: ``paths`` [context row, level] has the choice
    of each level or -1; ``levels`` the first choice of each level and the end; the
    choices of one parent are ``first`` to ``last`` (exclusive) of any of them."""

    def __init__(self, paths: np.ndarray, levels: list[int], first: np.ndarray, last: np.ndarray):
        self.paths, self.levels, self.first, self.last = paths, levels, first, last

    @classmethod
    def flat(cls, rows: int) -> "Tree":
        return cls(np.arange(rows)[:, None], [0, rows], np.zeros(rows, np.int64), np.full(rows, rows))


def _rows(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``x[at]`` of a contiguous ``x``; ``at`` is in range. With ``clip`` numpy copies whole
    rows without a check of each, several times as fast."""
    return x.take(at, axis=0, mode="clip")


def _sorted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stable order, ``ids`` in it) by a sort of id and place in one number, which is quicker
    than a sort of places."""
    bits = len(ids).bit_length()
    ordered = (ids << bits) | np.arange(len(ids))
    ordered.sort()
    return ordered & ((1 << bits) - 1), ordered >> bits


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct ``codes``, the first place of each, the place of each code in them)."""
    if not len(codes) or int(codes.max()).bit_length() + len(codes).bit_length() > 63:
        return np.unique(codes, return_index=True, return_inverse=True)
    order, ordered = _sorted(codes)
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    back = np.empty(len(codes), np.int64)
    back[order] = np.cumsum(new) - 1
    return ordered[new], order[new], back


def _summed(ids: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ids, sums of their ``grads``)."""
    order, ordered = _sorted(ids)
    edges = np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]).nonzero()[0]
    first, size = edges[:-1], edges[1:] - edges[:-1]
    sums = _rows(grads, order[first])
    for k in range(1, 4):  # most ids come only a few times; a segment costs more than some additions
        more = (size > k).nonzero()[0]
        sums[more] += _rows(grads, order[first[more] + k])
    more = (size > 4).nonzero()[0]
    if len(more):
        rest = np.repeat(size > 4, size)
        rest[first] = rest[first + np.minimum(1, size - 1)] = False
        rest[first + np.minimum(2, size - 1)] = rest[first + np.minimum(3, size - 1)] = False
        left = size[more] - 4
        sums[more] += np.add.reduceat(_rows(grads, order[rest]), np.cumsum(left) - left, axis=0)
    return ordered[first], sums


def _levels(paths: np.ndarray, v: np.ndarray):
    """(level, tokens whose path reaches it, their rows of ``v``) for the levels below the first."""
    at = np.arange(len(paths))
    for level in range(1, paths.shape[1]):
        on = (paths[at, level] >= 0).nonzero()[0]
        if len(on) < len(at):  # a path that ends goes no deeper
            at, v = at[on], _rows(v, on)
        if len(at):
            yield level, at, v


class Trainer:
    """Noise-contrastive estimation with Adagrad steps on the rows that a batch meets."""

    def __init__(self, start: Parameters, unigram: np.ndarray, seed: int, tree: Tree | None = None):
        self.tree = tree or Tree.flat(len(unigram))
        self.log_noise = np.log(NOISE * unigram).astype(np.float32)
        self.cumulative = [np.cumsum(unigram[a:b]) for a, b in zip(self.tree.levels, self.tree.levels[1:])]
        self.rng = np.random.default_rng(seed)
        self.tables = [x.astype(np.float32) for x in _tables(start)]
        self.squares = [np.full_like(x, START) for x in self.tables]

    @property
    def p(self) -> Parameters:
        return _parameters(*self.tables)

    def _move(self, table: int, rows: np.ndarray, g: np.ndarray) -> None:
        x, s = self.tables[table], self.squares[table]
        squares = g * g
        squares += _rows(s, rows)
        s[rows] = squares
        g *= np.float32(RATE)
        g /= np.sqrt(squares, out=squares)
        x[rows] = np.subtract(_rows(x, rows), g, out=g)

    def touched(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Masks of the rows of ``_tables`` that a step has moved."""
        return (self.squares[0][:, 0] > START, self.squares[1][:, -1] > START, np.ones(len(self.tables[2]), bool))

    def _contrast(self, level: int, ids: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One level's choices against its noise; ``v`` has a 1 behind each context's vector, for
        b. Returns the gradient by ``v``, the choices met and the gradient of each."""
        cumulative = self.cumulative[level]
        noise = self.tree.levels[level] + np.minimum(
            np.searchsorted(cumulative, self.rng.random(NOISE) * cumulative[-1]), len(cumulative) - 1)
        q, q_noise = _rows(self.tables[1], ids), _rows(self.tables[1], noise)
        against = -q_noise
        against[:, -1] += self.log_noise[noise]
        with np.errstate(over="ignore"):  # 1 / (1 + inf) is 0
            g_true = -1.0 / (1.0 + np.exp(np.einsum("ij,ij->i", v, q) - self.log_noise[ids]))
            g_false = v @ against.T
            np.exp(g_false, out=g_false)
            g_false += 1.0
            np.reciprocal(g_false, out=g_false)
        q *= g_true[:, None]
        dv = g_false @ q_noise
        dv += q
        grads = np.empty((len(ids) + NOISE, v.shape[1]), np.float32)
        np.multiply(v, g_true[:, None], out=grads[:len(ids)])
        np.matmul(g_false.T, v, out=grads[len(ids):])
        return dv, np.concatenate([ids, noise]), grads

    def step(self, ids: np.ndarray, history: np.ndarray) -> None:
        n, (r, _, c) = len(ids), self.tables
        words = np.ascontiguousarray(history.T)
        parts = [_rows(r, x) for x in words]
        v = np.ones((n, c.shape[1] + 1), np.float32)
        np.multiply(parts[0], c[0], out=v[:, :-1])
        for x, weight in zip(parts[1:], c[1:]):
            v[:, :-1] += x * weight
        paths = _rows(self.tree.paths, ids)
        dv, *met = self._contrast(0, paths[:, 0], v)
        choices, moves = [met[0]], [met[1]]
        for level, at, below in _levels(paths, v):
            more, met, g = self._contrast(level, paths[at, level], below)
            dv[at] += more
            choices.append(met)
            moves.append(g)
        rows, g = _summed(np.concatenate(choices), np.concatenate(moves))  # no two levels share a choice
        g /= np.float32(n)
        self._move(1, rows, g)
        dv = dv[:, :-1]
        grads = np.empty((len(c), *dv.shape), np.float32)
        for weight, out in zip(c, grads):
            np.multiply(dv, weight, out=out)
        rows, g = _summed(words.ravel(), grads.reshape(-1, dv.shape[1]))
        g /= np.float32(n)
        dc = np.stack([np.einsum("ij,ij->j", dv, x) for x in parts])
        self._move(0, rows, g)
        self._move(2, np.arange(len(c)), (dc / n).astype(np.float32))

    def run(self, ids: np.ndarray, starts: np.ndarray) -> None:
        """One pass over all tokens; batches take tokens far apart."""
        history = histories(ids, starts)
        batches = -(-len(ids) // BATCH)
        for k in range(batches):
            self.step(ids[k::batches], history[k::batches])


def _log_sums(s: np.ndarray) -> np.ndarray:
    top = s.max(axis=1, keepdims=True)
    return np.log(np.exp(s - top).sum(axis=1, dtype=np.float64)) + top[:, 0]


class Scorer:
    """Normalised log-probabilities of the tokens of documents."""

    def __init__(self, p: Parameters, tree: Tree | None = None):
        self.r, self.c, self.tree = p.r, p.c, tree or Tree.flat(len(p.b))
        self.qb = _tables(p)[1]
        self.codes, self.norms = np.zeros(0, np.int64), np.zeros(0)
        self.square, self.in_square = None, 0

    def _vectors(self, history: np.ndarray) -> np.ndarray:
        """The contexts' vectors with a 1 behind each, for b."""
        out = np.ones((len(history), self.qb.shape[1]), np.float32)
        np.multiply(_rows(self.r, history[:, 0]), self.c[0], out=out[:, :-1])
        for i in range(1, history.shape[1]):
            out[:, :-1] += _rows(self.r, history[:, i]) * self.c[i]
        return out

    def _log_norms(self, v: np.ndarray, bounds: list[tuple[int, int, int, int]]) -> np.ndarray:
        """For each (a, b, first, last), which follow one another: the logs of the sums of the
        exponentials of the choices first to last after the contexts v[a:b]. Scores are small,
        so their exponentials are summed as they are; where that fails, from the largest on."""
        sums = np.empty(len(v), np.float32)
        ones = np.ones(max((last - first for _, _, first, last in bounds), default=0), np.float32)
        with np.errstate(over="ignore"):
            for a, b, first, last in bounds:
                s = v[a:b] @ self.qb[first:last].T
                np.exp(s, out=s)
                np.matmul(s, ones[:last - first], out=sums[a:b])
            bad = ~((sums > 1e-20) & (sums < 1e30))
            out = np.log(sums, dtype=np.float64, where=~bad, out=np.zeros(len(v)))
        if bad.any():
            for a, b, first, last in bounds:
                rows = a + np.flatnonzero(bad[a:b])
                if len(rows):
                    out[rows] = _log_sums(v[rows] @ self.qb[first:last].T)
        return out

    def _normalisers(self, history: np.ndarray, v: np.ndarray | None = None) -> np.ndarray:
        """Log of the sum of the first level's exponentials after each context (``v``: their
        vectors, if there); as many contexts at once as keep their scores in the cache."""
        n, roots = len(history), self.tree.levels[1]
        v = self._vectors(history) if v is None else v
        return self._log_norms(v, [(at, min(n, at + CACHED), 0, roots) for at in range(0, n, CACHED)])

    def _make_square(self) -> None:
        """``_normalisers`` of all pairs of the first SQUARE rows: an exponential of a sum is a product
        of exponentials, so all the sums are one matrix product. Left out where factors could vanish."""
        roots, rows = self.qb[:self.tree.levels[1]], self.r[:SQUARE]
        near = (rows * self.c[0]) @ roots[:, :-1].T + roots[:, -1]
        far = (rows * self.c[1]) @ roots[:, :-1].T
        if all(x.max() < 35 and x.min() > -35 for x in (near, far)):
            square = np.exp(near, out=near) @ np.exp(far, out=far).T
            self.square = np.log(square, out=square)

    def _norms_of(self, codes: np.ndarray, history: np.ndarray, v: np.ndarray) -> np.ndarray:
        """``_normalisers`` of contexts (sorted ``codes``, vectors ``v``), kept for those that come
        again. Those of frequent words come from a table once as many were met as it costs."""
        out = np.empty(len(codes), np.float64)
        inner = (history < SQUARE).all(axis=1) if history.shape[1] == 2 else np.zeros(len(codes), bool)
        if self.square is not None:
            out[inner] = self.square[history[inner, 0], history[inner, 1]]
            rest = (~inner).nonzero()[0]
            codes = codes[rest]
        else:
            rest = np.arange(len(codes))
        if len(self.codes) > KEPT:
            self.codes, self.norms = self.codes[:0], self.norms[:0]
        at = np.searchsorted(self.codes, codes)
        known = np.zeros(len(codes), bool)
        inside = at < len(self.codes)
        known[inside] = self.codes[at[inside]] == codes[inside]
        out[rest[known]] = self.norms[at[known]]
        new = (~known).nonzero()[0]
        found = self._normalisers(_rows(history, rest[new]), _rows(v, rest[new]))
        out[rest[new]] = found
        self.codes = np.insert(self.codes, at[new], codes[new])
        self.norms = np.insert(self.norms, at[new], found)
        if self.square is None:
            before, self.in_square = self.in_square, self.in_square + int(inner[rest[new]].sum())
            # a pair of the product costs about a fiftieth of a context by itself; tried once
            if before <= min(SQUARE, len(self.r)) ** 2 // 50 < self.in_square:
                self._make_square()
        return out

    def _below(self, choice: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Log-probability of each choice among those of its parent, after contexts ``v``."""
        order, parent = _sorted(self.tree.first[choice])
        choice, v = choice[order], _rows(v, order)
        edges = np.flatnonzero(np.diff(parent, prepend=-1, append=-1))
        last = self.tree.last[choice[edges[:-1]]].tolist()
        bounds = [(at, min(b, at + 4096), first, end) for a, b, first, end in
                  zip(edges.tolist(), edges[1:].tolist(), parent[edges[:-1]].tolist(), last) for at in range(a, b, 4096)]
        out = np.empty(len(choice), np.float64)
        out[order] = np.einsum("ij,ij->i", v, _rows(self.qb, choice)) - self._log_norms(v, bounds)
        return out

    def log_probs(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        history = histories(ids, starts)
        rows = len(self.r)
        code = history[:, 0].copy()
        for i in range(1, history.shape[1]):
            code = code * rows + history[:, i]
        distinct, first, back = _distinct(code)
        history = _rows(history, first)
        vectors = self._vectors(history)
        norms = self._norms_of(distinct, history, vectors)
        paths = _rows(self.tree.paths, ids)
        out = np.empty(len(ids), np.float64)
        for at in range(0, len(ids), 1 << 14):
            part = slice(at, at + (1 << 14))
            out[part] = np.einsum("ij,ij->i", _rows(vectors, back[part]), _rows(self.qb, paths[part, 0]))
        out -= norms[back]
        if paths.shape[1] > 1:
            reach = (paths[:, 1] >= 0).nonzero()[0]
            for level, at, v in _levels(paths[reach], _rows(vectors, back[reach])):
                out[reach[at]] += self._below(paths[reach[at], level], v)
        return out


# ---- vocabulary ----------------------------------------------------------------
class Vocabulary:
    """Counts of the frequent words, the context rows (0 the end token, 1 to 256 the
    classes by last byte, then the ``own`` most frequent words) and the choices that lead
    to them. ``class_n`` and ``class_v`` count the words without a row of their own."""

    def __init__(self, frequent: list[tuple[bytes, int]], words: int, n: int, v: int, ends: int,
                 class_n: np.ndarray, class_v: np.ndarray, own: int | None = None):
        own = words if own is None else own
        self.words = pa.array([w.decode() for w, _ in frequent], pa.string())
        self.counts = np.array([c for _, c in frequent], np.float64)
        last = np.array([w[-1] for w, _ in frequent], np.int64)
        self.rows = np.where(np.arange(len(frequent)) < own, 257 + np.arange(len(frequent)), 1 + last)
        self.n, self.v, self.ends = n, v, ends
        self.log_class = np.log10(class_n + 0.1 * (class_v + 1))
        below = np.arange(words, max(words, min(own, len(frequent))))  # own words under a class
        in_classes = class_n + np.bincount(last[below], self.counts[below], 256)
        tops = np.concatenate([[ends], in_classes, self.counts[:words], np.zeros(max(0, words - len(frequent)))])
        paths = np.full((257 + words + len(below), 3), -1)
        paths[:257 + words, 0] = np.arange(257 + words)
        paths[257 + below, 0] = 1 + last[below]
        if not len(below):
            self.tree, levels = Tree.flat(len(tops)), [tops]
        else:
            # by class: its own words, most frequent first, then the choice of all others
            rest = np.unique(last[below])
            row = np.concatenate([257 + below, 1 + rest])
            of, count = np.concatenate([last[below], rest]), np.concatenate([self.counts[below], class_n[rest]])
            order = np.argsort(of, kind="stable")
            row, of, count = row[order], of[order], count[order]
            sizes = np.bincount(of, minlength=256)
            nth = np.arange(len(of)) - (np.cumsum(sizes) - sizes)[of]
            starts = (nth % np.ceil(np.sqrt(sizes)).astype(np.int64)[of]) == 0
            group = np.cumsum(starts) - 1
            group_first = np.flatnonzero(starts)
            group_last = np.append(group_first[1:], len(of))
            a, b = len(tops), len(tops) + group[-1] + 1
            paths[row, 1], paths[row, 2] = a + group, b + np.arange(len(of))
            parent = of[group_first]
            self.tree = Tree(paths, [0, a, b, b + len(of)], np.concatenate(
                [np.zeros(a, np.int64), a + np.searchsorted(parent, parent), b + group_first[group]]), np.concatenate(
                [np.full(a, a), a + np.searchsorted(parent, parent, side="right"), b + group_last[group]]))
            levels = [tops, np.bincount(group, count), count]
        self.unigram = np.concatenate([(x + 0.1) / (x + 0.1).sum() for x in levels])

    def initial(self) -> Parameters:
        return Parameters.initial(self.unigram, context_rows=len(self.tree.paths))

    def places(self, words: pa.Array) -> np.ndarray:
        """Place of each word in the frequent list, or -1."""
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def model_rows(self, words: pa.Array, at: np.ndarray) -> np.ndarray:
        out = self.rows[at] if len(self.rows) else np.zeros(len(at), np.int64)
        rare = np.flatnonzero(at < 0)
        if len(rare):
            out[rare] = 1 + _last_bytes(words)[rare]
        return out


class Tokens:
    """The tokens of a block of documents, an end token after each document's words:
    ``words`` has no ends; ``at`` (place in the frequent list), ``rows`` (of the model) and
    ``is_end`` have, with ``at`` -1 and row 0 there. ``columns``: the documents' other columns."""

    def __init__(self, columns: list[pa.Array], words: pa.Array, sizes: np.ndarray, places: np.ndarray, rows: np.ndarray):
        self.columns, self.words = columns, words
        ends = np.cumsum(sizes + 1)
        self.starts = ends - sizes - 1
        self.is_end = np.zeros(ends[-1], bool)
        self.is_end[ends - 1] = True
        self.inner = np.flatnonzero(~self.is_end)
        self.at, self.rows = np.full(len(self.is_end), -1), np.zeros(len(self.is_end), np.int64)
        self.at[self.inner], self.rows[self.inner] = places, rows


def _count_words(batches):
    held, size, ends = [], 0, 0

    def out():
        counts = pa.chunked_array(held, pa.string()).value_counts()
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array([END], pa.binary()), counts.field("values").cast(pa.binary())]),
             pa.concat_arrays([pa.array([ends], pa.int64()), counts.field("counts")])], names=["word", "n"])
    for b in batches:
        words, _ = split_texts(b.column("text"))
        held.append(words)
        size += words.nbytes
        ends += b.num_rows
        if size > COUNT_BYTES:
            yield out()
            held, size, ends = [], 0, 0
    if ends:
        yield out()


def _looked_up(batches, vocabulary: Vocabulary):
    """(other columns, words, number of words of each document, places, rows) of batches of
    documents, their texts in the last column; LOOKED_UP words or more at once."""
    held, n = [], 0

    def out():
        columns = [pa.concat_arrays(list(c)) for c in zip(*(x[0] for x in held))]
        words, sizes = pa.concat_arrays([x[1] for x in held]), np.concatenate([x[2] for x in held])
        held.clear()
        places = vocabulary.places(words)
        return columns, words, sizes, places, vocabulary.model_rows(words, places)

    for b in batches:
        words, sizes = split_texts(b.columns[-1])
        held.append((b.columns[:-1], words, sizes))
        n += len(words)
        if n >= LOOKED_UP:
            yield out()
            n = 0
    if held:
        yield out()


def _blocks(batches, vocabulary: Vocabulary):
    """Documents (their texts in the last column) in blocks of about BLOCK_TOKENS tokens."""
    held, size = [], 0

    def block():
        columns = [pa.concat_arrays(list(c)) for c in zip(*(x[0] for x in held))]
        return Tokens(columns, pa.concat_arrays([x[1] for x in held]), *(np.concatenate(x) for x in list(zip(*held))[2:]))

    for columns, words, sizes, places, rows in _looked_up(batches, vocabulary):
        ends, tokens = (np.concatenate([[0], np.cumsum(x)]) for x in (sizes, sizes + 1))
        at = 0
        while at < len(sizes):
            to = min(len(sizes), int(np.searchsorted(tokens, tokens[at] + BLOCK_TOKENS - size)))
            a, z = int(ends[at]), int(ends[to])
            held.append(([c.slice(at, to - at) for c in columns], words.slice(a, z - a), sizes[at:to], places[a:z], rows[a:z]))
            size += tokens[to] - tokens[at]
            at = to
            if size >= BLOCK_TOKENS:
                yield block()
                held, size = [], 0
    if held:
        yield block()


def _counted(words: pa.Array, docs: np.ndarray, n: int) -> pa.ListArray:
    """For each of ``n`` documents its distinct words with their counts; ``docs``: each word's."""
    found = words.cast(pa.binary()).dictionary_encode()
    kinds = max(1, len(found.dictionary))
    codes, _, back = _distinct(docs * kinds + found.indices.to_numpy())
    return pa.ListArray.from_arrays(
        pa.array(np.searchsorted(codes, np.arange(n + 1) * kinds), pa.int32()),
        pa.StructArray.from_arrays([found.dictionary.take(pa.array(codes % kinds)), pa.array(np.bincount(back, minlength=len(codes)))],
                                   names=["word", "n"]))


_WORKER: dict = {}


class Shared:
    """A broadcast value that workers keep by name, with what they make of it."""

    def __init__(self, spark, value):
        self.broadcast, self.name = spark.sparkContext.broadcast(value), uuid.uuid4().hex

    def made(self, make):
        if self.name not in _WORKER:
            _WORKER.clear()
            _WORKER[self.name] = make(*self.broadcast.value)
        return _WORKER[self.name]


def _train(shared: Shared):
    def run(batches):
        vocabulary, start = shared.made(_vocabulary_and_parameters)
        trainer, tokens = Trainer(start, vocabulary.unigram, SEED, vocabulary.tree), 0
        for block in _blocks(batches, vocabulary):
            trainer.run(block.rows, block.starts)
            tokens += len(block.rows)
        if tokens:
            for table, (values, touched) in enumerate(zip(trainer.tables, trainer.touched())):
                rows = np.flatnonzero(touched)
                for part in np.split(rows, np.flatnonzero(np.diff(rows // PIECE)) + 1):
                    if len(part):
                        yield _piece(table, part[0] // PIECE, tokens, part, values[part])
    return run


def _tables(p: Parameters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parameters as tables with a row per context word, choice and place."""
    return p.r, np.column_stack([p.q, p.b]), p.c


def _parameters(r: np.ndarray, qb: np.ndarray, c: np.ndarray) -> Parameters:
    return Parameters(r, np.ascontiguousarray(qb[:, :-1]), c, qb[:, -1].copy())


_PIECE_DDL = "table int, piece bigint, tokens bigint, rows binary, value binary"


def _piece(table: int, piece: int, tokens: int, rows: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([table], pa.int32()), pa.array([piece], pa.int64()), pa.array([tokens], pa.int64()),
         pa.array([rows.astype(np.int64).tobytes()], pa.binary()), pa.array([values.astype(np.float32).tobytes()], pa.binary())],
        names=["table", "piece", "tokens", "rows", "value"])


def _average(batches):
    """The mean of each row over the partitions that met it, weighted by their tokens. The
    input is sorted by (table, piece): one piece of rows is held at a time."""
    held, total, weight = None, None, None

    def mean():
        rows = np.flatnonzero(weight)
        return _piece(*held, 0, held[1] * PIECE + rows, total[rows] / weight[rows, None])

    for b in batches:
        for table, piece, tokens, rows, value in zip(*(b.column(c).to_pylist() for c in b.schema.names)):
            at = np.frombuffer(rows, np.int64) - piece * PIECE
            values = np.frombuffer(value, np.float32).reshape(len(at), -1)
            if held != (table, piece):
                if held is not None:
                    yield mean()
                held, total, weight = (table, piece), np.zeros((PIECE, values.shape[1])), np.zeros(PIECE)
            total[at] += values.astype(np.float64) * tokens
            weight[at] += tokens
    if held is not None:
        yield mean()


def _vocabulary_and_parameters(facts, learned):
    """``learned``: (table, rows, values) of the rows that any partition met; the others keep
    their initial values."""
    vocabulary = Vocabulary(*facts)
    p = vocabulary.initial()
    tables = _tables(p)
    for table, rows, value in learned or ():
        at = np.frombuffer(rows, np.int64)
        tables[table][at] = np.frombuffer(value, np.float32).reshape(len(at), -1)
    return vocabulary, _parameters(*tables)


_SCORE_DDL = ("uid bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, "
              "rare array<struct<word:binary,n:bigint>>")


def _score(shared: Shared):
    def make(facts, learned):
        vocabulary, p = _vocabulary_and_parameters(facts, learned)
        return vocabulary, Scorer(p, vocabulary.tree)

    def run(batches):
        vocabulary, scorer = shared.made(make)
        uid = TaskContext.get().partitionId() << 40
        denominator = np.log10(vocabulary.n + 0.1 * (vocabulary.v + 1))
        log_count = np.log10(vocabulary.counts + 0.1)
        for block in _blocks(batches, vocabulary):
            at, ids, is_end, starts = block.at, block.rows, block.is_end, block.starts
            sizes = np.diff(np.append(starts, len(ids)))
            found = at >= 0
            # what is known here of each token's log10(c + 0.1); rare words add theirs later
            own = np.zeros(len(ids))
            own[found] = log_count[at[found]]
            own[is_end] = np.log10(vocabulary.ends + 0.1)
            in_class = (ids >= 1) & (ids <= 256) & ~is_end
            model = scorer.log_probs(ids, starts) / np.log(10)
            model[in_class] += own[in_class] - vocabulary.log_class[ids[in_class] - 1]
            known = found | (is_end & (vocabulary.ends > 0))
            missing = np.flatnonzero(at[block.inner] < 0)  # places in block.words
            docs = np.searchsorted(starts - np.arange(len(starts)), missing, side="right") - 1
            rare = _counted(block.words.take(pa.array(missing)), docs, len(starts))
            uids = np.arange(uid, uid + len(starts))
            uid += len(starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids), *block.columns,
                 pa.array(sizes, pa.int64()), pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                 pa.array(np.add.reduceat(own, starts) - sizes * denominator), pa.array(np.add.reduceat(model, starts)),
                 rare],
                names=["uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"])
    return run


def _most_frequent(counts: DataFrame, limit: int, always: int) -> list[tuple[bytes, int]]:
    """The words with a count of at least m, by count, for the least m that at most
    ``limit`` words reach, or ``always`` if that is less. m comes from the numbers of words
    by size of their count (exact up to 1000, doubling beyond)."""
    size = F.when(F.col("n") <= 1000, F.col("n")).otherwise(1000 * F.pow(2, F.floor(F.log2(F.col("n") / 1000))).cast("bigint"))
    words, least = 0, None
    for r in counts.groupBy(size.cast("bigint").alias("size")).agg(F.count(F.lit(1)).alias("v")).orderBy(F.desc("size")).collect():
        words += r.v
        if words > limit:
            break
        least = r["size"]
    least = always if least is None else min(least, always)
    found = counts.where(F.col("n") >= least).select("word", "n").toArrow()
    return sorted(zip(found["word"].to_pylist(), found["n"].to_pylist()), key=lambda x: (-x[1], x[0]))


def score_documents(docs: DataFrame, words: int = WORDS, frequent: int = FREQUENT,
                    own_count: int = OWN_COUNT) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score."""
    spark = docs.sparkSession
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    rows = texts(docs).withColumn("held_out", F.coalesce(fold == 0, F.lit(False)))
    training = rows.where(F.col("doc_id").isNotNull() & ~F.col("held_out"))

    counts = written(training.select("text").mapInArrow(_count_words, "word binary, n bigint")
                     .groupBy("word").agg(F.sum("n").alias("n")), "word_counts")
    inner = counts.where(F.octet_length("word") > 0)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = counts.where(F.octet_length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    top = _most_frequent(inner, frequent, own_count)
    own = max(min(words, len(top)), sum(n >= own_count for _, n in top))
    class_n, class_v = np.zeros(256), np.zeros(256)
    for r in inner.groupBy(F.expr("cast(conv(hex(substring(word, -1, 1)), 16, 10) as int)").alias("last")).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        class_n[r["last"]], class_v[r["last"]] = r.n, r.v
    for w, n in top[:own]:
        class_n[w[-1]] -= n
        class_v[w[-1]] -= 1
    facts = (top, words, total.n, total.v, ends, class_n, class_v, own)

    mean = written(training.select("text").mapInArrow(_train(Shared(spark, (facts, None))), _PIECE_DDL)
                   .repartition("table", "piece").sortWithinPartitions("table", "piece").mapInArrow(_average, _PIECE_DDL), "parameters")
    found = mean.select("table", "rows", "value").toArrow()  # as many values as the model has parameters
    learned = list(zip(*(found[c].to_pylist() for c in ("table", "rows", "value"))))

    scored = written(rows.select("doc_id", "held_out", "text").mapInArrow(_score(Shared(spark, (facts, learned))), _SCORE_DDL), "scored")
    rare = scored.select("uid", F.explode("rare").alias("r")).select("uid", F.col("r.word").alias("word"), F.col("r.n").alias("k"))
    met = (rare.join(counts.hint("merge"), "word", "left").groupBy("uid").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("logs"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("found")))
    logs, found = F.coalesce("logs", F.lit(0.0)), F.coalesce("found", F.lit(0))
    return scored.drop("rare").join(met, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + found).alias("n_known"),
        F.lit(total.n).cast("bigint").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"), (F.col("score") + logs).alias("score"))
