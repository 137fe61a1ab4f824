"""A hashed maximum-entropy language model with a class-factored softmax.

Tokens are words (A-Z in lower case) and an end.  The probability of a token
after its history is P(class | history) * P(token | class, history).  Both
factors are softmaxes over weights summed from hashed features of the
history: the previous word, the previous two, and skips to the second and
third word back.  The most frequent words stand in head classes of ``WIDTH``
words each, cut by frequency; every other word belongs to one of ``REST``
classes by its ending.  The hot words of a rest class stand in a tree of
softmaxes, the frequent ones near its root: half of a node's places hold
words, half lead to nodes below, so the whole hot list is class-factored and
the tree grows with it.  One place of the root holds the words outside the hot
list, inside which a word's probability is its smoothed count over their mass.
With all weights at 0 the model is the unigram model.

Training goes over all training texts once, in ``ROUNDS`` rounds of another
share (half) of them each.  In a round the texts are dealt to shards of about
``SHARD_TOKENS`` tokens by a hash of id and text.  Each shard starts from the
broadcast weights, makes AdaGrad updates batch by batch over its texts, in
the order of the hash, and returns the weight rows that it touched; the rows
are averaged over the shards by a grouped aggregate, weighted by their
updates, in whole numbers, so that no order of addition matters.  The model
is therefore a function of the table: neither the files, the cores nor the
partitions of the session change a score by more than rounding.  The hot list and the weight tables grow with the training
texts (:func:`least_hot`, :func:`sizes`); counts of words outside the
broadcast hot list stay distributed and are joined.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrace.llm.common import shuffles_freed, whole_text, write_through

CLASSES = 32
REST = 8
WIDTH = 32
HEAD = (CLASSES - REST) * WIDTH
#: Words with at least 1/HOT_WORDS of all training tokens are broadcast; above
#: GROWS_FROM tokens the least count rises with their square root only, so the
#: list grows as the vocabulary does.
HOT_WORDS = 1_000_000
GROWS_FROM = 4_000_000
#: Least rows of the weight tables, as powers of two.
CLASS_BITS = 14
WORD_BITS = 15
ROUNDS = 2
RATE = 0.15
BATCH = 8192
SHARD_TOKENS = 1 << 23
#: Tokens that a task takes up at once, whatever batches they come in.
_PASS = 1 << 20
#: Weights travel as 16-bit numbers of this fraction, so up to 16 in size.
_FIXED = float(1 << 11)
_FIXED_MOST = float((1 << 15) - 1)
END = "\n"  # no word holds white space
#: Words that are counted at once, and bytes of text that are split at once.
_FLUSH = 1 << 21
_TEXT_BYTES = 1 << 23
_SHORT = 6
_SEEN = 16
_BLOCK = 1 << 12
#: Rows of weights that are summed at once; they and the room beside them stay in a core's cache.
_CACHED = 1 << 11
_FEATURES = 4
_LEAVES = WIDTH // 2  # places of a tree node that hold words
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def rest_class(word: str) -> int:
    """Number of the rest class of a word, by its last two characters."""
    return zlib.crc32(word[-2:].encode()) % REST


def _rest_class_sql(word: str) -> str:
    return f"cast(crc32(cast(right({word}, 2) as binary)) % {REST} as int)"


def split_texts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """Lower-case words of the texts, some texts at a time.

    Gives the number of the first text, how many words each has, and all words.
    """
    if not len(texts):
        return
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    share = (np.cumsum(sizes) - sizes) // _TEXT_BYTES
    edges = np.concatenate([[0], np.flatnonzero(np.diff(share)) + 1, [len(texts)]])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(a, b - a)))
        flat, ends = parts.flatten(), np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))
        real = pc.greater(pc.binary_length(flat), 0)  # white space at an end gives an empty one
        if not pc.all(real).as_py():
            kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
            flat, ends = flat.filter(real), kept[ends]
        yield a, np.diff(ends, prepend=0), flat


@dataclass(frozen=True)
class Vocabulary:
    """The hot words by descending count, and the masses that normalise."""

    hot: tuple[bytes, ...]
    counts: np.ndarray
    total: int  # training tokens, N
    distinct: int  # distinct training tokens, V
    masses: np.ndarray  # of the rest classes: counts + 0.5 each, + 0.5 for unknown words


def least_hot(total: int) -> float:
    """HOT_WORDS times the least count of a hot word among ``total`` tokens."""
    return float(min(total, (total * GROWS_FROM) ** 0.5))


def shards(total: int) -> int:
    """Learners of a round, by the training tokens alone."""
    return max(1, total // SHARD_TOKENS)


def sizes(v: Vocabulary) -> tuple[int, int]:
    """Rows of the class and the word table, by the counted hot words.

    Every hot word is a history of its own and a choice in some node.
    """
    return max(1 << CLASS_BITS, len(v.hot) // 4), max(1 << WORD_BITS, len(v.hot) // 2)


@dataclass(frozen=True)
class MaxEnt:
    vocabulary: Vocabulary
    by_class: np.ndarray  # feature rows x classes
    by_word: np.ndarray  # (feature, class) rows x places in the class

    @cached_property
    def tables(self) -> Tables:
        """Built once in each Python worker that holds the broadcast model."""
        return Tables(self.vocabulary)


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(word, c): how often each token occurs, the end once a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: list[pa.Array]) -> pa.RecordBatch:
            counted = pa.chunked_array(found, pa.string()).value_counts()
            return pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], names=["word", "c"])

        texts, held, found = 0, 0, []
        for batch in batches:
            texts += batch.num_rows
            for _, _, flat in split_texts(batch.column(0).cast(pa.string())):
                found.append(flat)
                held += len(flat)
                if held > _FLUSH:
                    yield rows(found)
                    held, found = 0, []
        yield rows(found)
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([texts], pa.int64())], names=["word", "c"])

    return (
        docs.select(text).mapInArrow(count, "word string, c long")
        .groupBy("word").agg(F.sum("c").alias("c"))
    )


def learn_vocabulary(counts: DataFrame) -> Vocabulary:
    """Hot words and masses from the whole count table; only hot words return."""
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    total, distinct = int(sums["n"] or 0), int(sums["v"])
    hot = (
        counts.where(F.col("c") * F.lit(HOT_WORDS) >= F.lit(least_hot(total)))
        .orderBy(F.desc("c"), "word").toArrow()
    )
    named = [w.encode() for w in hot["word"].to_pylist()]
    c = np.array(hot["c"].to_pylist(), dtype=np.float64)
    masses = np.full(REST, 0.5)
    for row in (
        counts.groupBy(F.expr(_rest_class_sql("word")).alias("j"))
        .agg(F.sum(F.col("c") + 0.5).alias("m")).collect()
    ):
        masses[row["j"]] += float(row["m"])
    for word, n in zip(named[:HEAD], c[:HEAD], strict=True):
        masses[rest_class(word.decode())] -= n + 0.5
    return Vocabulary(tuple(named), c, total, distinct, np.maximum(masses, 0.5))


def encode(docs: DataFrame, id_col: str, text_col: str, train: Column, vocabulary: Vocabulary) -> DataFrame:
    """One row per text: ids of its tokens, and its words outside the hot list.

    ``ids`` holds little-endian 32-bit numbers: a hot word's rank, or
    -1 - rest class.  ``tail`` lists the words behind the latter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.hot)
    rows = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"), train.alias("_train"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = pa.array(shared.value, pa.binary()).cast(pa.string())
        end = hot.index(END).as_py()
        if end < 0:
            end = -1 - rest_class(END)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, n, flat in split_texts(batch.column("_text").cast(pa.string())):
                ranks = pc.index_in(flat, hot).fill_null(-1).to_numpy(zero_copy_only=False)
                outside = np.flatnonzero(ranks < 0)
                ends = np.cumsum(n + 1)  # where the next text begins
                ids = np.full(ends[-1], end, dtype="<i4")
                is_word = np.ones(len(ids), dtype=bool)
                is_word[ends - 1] = False
                tail = flat.take(pa.array(outside)).dictionary_encode()
                named = tail.dictionary
                which = tail.indices.to_numpy(zero_copy_only=False)
                if len(outside):
                    ranks = ranks.copy()
                    ranks[outside] = -1 - np.array([rest_class(w) for w in named.to_pylist()])[which]
                ids[is_word] = ranks
                of = np.searchsorted(np.cumsum(n), outside, side="right")  # texts of the words outside
                if end < 0:
                    named = pa.concat_arrays([named, pa.array([END])])
                    of = np.append(of, np.arange(len(n)))
                    which = np.append(which, np.full(len(n), len(named) - 1))
                found, times = np.unique(of * len(named) + which, return_counts=True)
                bounds = np.searchsorted(found, np.arange(len(n) + 1) * len(named)).astype(np.int32)
                blobs = pa.BinaryArray.from_buffers(
                    pa.binary(), len(n), [None, pa.py_buffer((np.append(0, ends) * 4).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(n))), batch.column("_id").slice(a, len(n)),
                     batch.column("_train").slice(a, len(n)), blobs,
                     pa.ListArray.from_arrays(bounds, named.take(pa.array(found % max(len(named), 1)))),
                     pa.ListArray.from_arrays(bounds, pa.array(times, pa.int32()))],
                    names=["_row", "_id", "_train", "ids", "tail", "times"])
                row += len(n)

    kind = rows.schema["_id"].dataType.simpleString()
    return write_through(
        rows.mapInArrow(code, f"_row long, _id {kind}, _train boolean, ids binary, tail array<string>, times array<int>"),
        "encoded")


class Tables:
    """What scoring and training look up, derived from the vocabulary."""

    def __init__(self, v: Vocabulary) -> None:
        n = len(v.hot)
        head = min(n, HEAD)
        self.n_hot = n
        # class of every code: hot ranks, then the words outside by rest class
        self.cls = np.empty(n + REST, dtype=np.int64)
        self.cls[:head] = np.arange(head) // WIDTH
        rest = np.array([rest_class(w.decode()) for w in v.hot[head:]], dtype=np.int64)
        self.cls[head:n] = CLASSES - REST + rest
        self.cls[n:] = CLASSES - REST + np.arange(REST)
        z = v.total + 0.5 * (v.distinct + 1)
        smoothed = v.counts + 0.5
        self.base = np.zeros(n + REST)  # words outside the hot list are added by the join
        self.base[:n] = np.log10(smoothed / z)
        outside = np.maximum(v.masses - np.bincount(rest, smoothed[head:], REST), 0.5)
        self.inside = np.zeros(n + REST)  # so that the join's count / mass of the rest class ends the product
        self.inside[n:] = np.log(v.masses / outside)
        mass = np.zeros(CLASSES)
        np.add.at(mass, self.cls[:head], smoothed[:head])
        mass[CLASSES - REST :] = v.masses
        with np.errstate(divide="ignore"):
            self.class_bias = np.where(mass > 0, np.log(mass / mass.sum()), -1e9).astype(np.float32)
        # Nodes: the head classes, then each rest class's tree, numbered like a
        # heap: leaf i of a tree is in its node i // _LEAVES, node q > 0 hangs
        # on node (q - 1) // _LEAVES.  Leaf 0 holds the words outside.
        sizes = np.bincount(rest, minlength=REST)
        trees = sizes // _LEAVES + 1
        roots = CLASSES + np.concatenate([[0], np.cumsum(trees)])
        order = np.argsort(rest, kind="stable")
        leaf = np.empty(n - head, dtype=np.int64)
        leaf[order] = 1 + np.arange(n - head) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.node = np.concatenate([self.cls[:head], roots[rest] + leaf // _LEAVES, roots[:REST]])
        self.place = np.concatenate([np.arange(head) % WIDTH, leaf % _LEAVES, np.zeros(REST, dtype=np.int64)])
        self.parent = np.full(roots[-1], -1, dtype=np.int64)
        self.branch = np.zeros(roots[-1], dtype=np.int64)  # place in the parent
        masses = np.zeros((roots[-1], WIDTH))
        masses[self.node, self.place] = np.append(smoothed, outside)
        for root, size in zip(roots[:REST], trees, strict=True):
            below = np.arange(1, size)
            self.parent[root + below] = root + (below - 1) // _LEAVES
            self.branch[root + below] = _LEAVES + (below - 1) % _LEAVES
            for q in range(root + size - 1, root, -1):
                masses[self.parent[q], self.branch[q]] = masses[q].sum()
        with np.errstate(divide="ignore", invalid="ignore"):
            self.word_bias = _aligned(np.where(
                masses > 0, np.log(masses / masses.sum(axis=1, keepdims=True)), -1e9))
        # codes as history: hot ranks, rest classes, then the start of a text
        self.start = n + REST
        self.coarse = np.append(np.where(np.arange(n + REST) < head, np.arange(n + REST), HEAD + self.cls), HEAD + CLASSES)
        # small numbers, so that a core's cache holds more of them
        self.cls, self.place, self.deep = self.cls.astype(np.int8), self.place.astype(np.int8), self.parent[self.node] >= 0

    def steps(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(token, node, place) of every choice below the class, for all tokens."""
        node = self.node.take(code)
        found = [(np.arange(len(code)), node, self.place.take(code))]
        at = np.flatnonzero(self.deep.take(code))
        node = node.take(at)
        while len(at):
            place, node = self.branch.take(node), self.parent.take(node)
            found.append((at, node, place))
            on = np.flatnonzero(self.parent.take(node) >= 0)
            at, node = at.take(on), node.take(on)
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def codes(self, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all tokens and where each text begins."""
        ids = np.frombuffer(b"".join(blobs), dtype="<i4").astype(np.int64)
        sizes = np.array([len(b) // 4 for b in blobs])
        return np.where(ids >= 0, ids, self.n_hot - 1 - ids), np.concatenate([[0], np.cumsum(sizes)[:-1]])

    def history(self, codes: np.ndarray, begins: np.ndarray, a: int, b: int) -> np.ndarray:
        """Hashes of the history features of tokens a to b, one row per feature."""
        n = b - a
        fewer = min(a, 3)
        near = np.concatenate([np.full(3 - fewer, self.start), codes[a - fewer : b]])
        starts = begins[np.searchsorted(begins, a - 2) : np.searchsorted(begins, b)] - a
        back = []
        for d in (1, 2, 3):
            p = near[3 - d : 3 - d + n].copy()
            for i in range(d):  # the first d tokens of a text
                own = starts + i
                p[own[(own >= 0) & (own < n)]] = self.start
            back.append(p)
        one, two, three = back
        raw = np.empty((_FEATURES, n), dtype=np.uint64)
        raw[0], raw[2], raw[3] = one, two, three
        raw[1] = self.coarse.take(two) * 4096 + self.coarse.take(one)
        raw *= np.uint64(_FEATURES)
        raw += np.arange(1, _FEATURES + 1, dtype=np.uint64)[:, None]
        raw *= _MIX
        raw ^= raw >> np.uint64(31)
        raw *= _MIX2
        return raw

    @staticmethod
    def class_rows(h: np.ndarray, size: int) -> np.ndarray:
        return _dealt(h, size)

    @staticmethod
    def word_rows(h: np.ndarray, node: np.ndarray, size: int) -> np.ndarray:
        own = h + node.astype(np.uint64) * _MIX
        own *= _MIX2
        return _dealt(own, size)


def _dealt(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes as rows 0 to ``size`` - 1, by their upper half."""
    row = h >> np.uint64(32)
    row *= np.uint64(size)
    row >>= np.uint64(32)
    return row.view(np.intp)


def _empty(*shape: int) -> np.ndarray:
    """Room for numbers that begins with a cache line, so that no row lies across one more than it fills."""
    size = 4 * math.prod(shape)
    raw = np.empty(size + 64, dtype=np.uint8)
    start = -raw.ctypes.data % 64
    return raw[start : start + size].view(np.float32).reshape(shape)


def _aligned(table: np.ndarray) -> np.ndarray:
    """A copy in such room."""
    copied = _empty(*table.shape)
    copied[:] = table
    return copied


def _sums(
    weights: np.ndarray, rows: np.ndarray, bias: np.ndarray, node: np.ndarray | None
) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Summed weight rows and the bias (its rows by node), a cacheful of rows at a time.

    Gives which rows they are, the sums, and room of the same shape.  The
    arrays are used again for the next part.
    """
    n = rows.shape[1]
    sums, room = _empty(2, min(n, _CACHED), weights.shape[1])
    for a in range(0, n, _CACHED):
        own = slice(a, min(a + _CACHED, n))
        z, part = sums[: own.stop - a], room[: own.stop - a]
        if node is None:
            z[:] = bias
        else:
            bias.take(node[own], axis=0, out=z, mode="clip")  # "raise" copies once more
        for r in rows:
            z += weights.take(r[own], axis=0, out=part, mode="clip")
        yield own, z, part


def _exp(z: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray | float]:
    """Exponentials of ``z`` into ``out``; their sums by row, and what was taken off each row.

    The biases are log-probabilities and the weights small, so the range of
    the numbers nearly always suffices as they are; if a sum leaves it, the
    largest of each row is moved to 0.
    """
    np.exp(z, out=out)
    total = np.einsum("ij->i", out)
    if total.min() > 1e-30 and total.max() < 1e30:
        return total, 0.0
    top = z.max(axis=1, keepdims=True)
    np.exp(z - top, out=out)
    return np.einsum("ij->i", out), top[:, 0]


def _log_softmax(
    weights: np.ndarray, rows: np.ndarray, bias: np.ndarray, chosen: np.ndarray, node: np.ndarray | None = None
) -> np.ndarray:
    """Log-probabilities of the chosen places."""
    out = np.empty(rows.shape[1], dtype=np.float32)
    for own, z, room in _sums(weights, rows, bias, node):
        total, off = _exp(z, room)
        out[own] = z.ravel().take(_flat(chosen[own], z.shape[1])) - off - np.log(total)
    return out


def _slope(
    weights: np.ndarray, rows: np.ndarray, bias: np.ndarray, chosen: np.ndarray, node: np.ndarray | None = None
) -> np.ndarray:
    """Probabilities less 1 at the chosen places: the loss's slope by the sums."""
    slope = _empty(rows.shape[1], weights.shape[1])
    for own, z, _ in _sums(weights, rows, bias, node):
        e = slope[own]
        total, _ = _exp(z, e)
        e /= total[:, None]
    slope.ravel()[_flat(chosen, slope.shape[1])] -= 1
    return slope


def _flat(chosen: np.ndarray, width: int) -> np.ndarray:
    """The chosen place of each row, counted from the first row's first."""
    return np.arange(0, len(chosen) * width, width) + chosen


def _rows_of(table: np.ndarray) -> np.ndarray:
    """A view with one item a row, which numpy copies as a whole."""
    return table.view(np.dtype((np.void, table.itemsize * table.shape[1]))).ravel()


def _segment_sums(
    rows: np.ndarray, order: np.ndarray, first: np.ndarray, sizes: np.ndarray, out: np.ndarray
) -> np.ndarray:
    """Sums of the runs of ``rows[order]`` that begin at ``first``, without that copy.

    Runs of several rows are taken longest first, so those that go on are
    always the foremost.  ``np.add.reduceat`` takes long where most runs are
    short, so only runs of more than ``_SHORT`` rows go through it.
    """
    sums = rows.take(order.take(first), axis=0, out=out[: len(first)], mode="clip")
    several = np.flatnonzero(sizes > 1)
    if not len(several):
        return sums
    fewer = -sizes.take(several).astype(np.int16)  # 16 bits are sorted by radix
    by_size = np.argsort(fewer, kind="stable")
    several, fewer = several.take(by_size), fewer.take(by_size)
    starts = first.take(several)
    found = sums.take(several, axis=0)
    long, *on = np.searchsorted(fewer, -np.arange(_SHORT, 0, -1, dtype=np.int16)).tolist()
    if long:
        n = sizes.take(several[:long])
        ends = np.cumsum(n)
        at = np.repeat(starts[:long] - ends + n, n) + np.arange(ends[-1])
        found[:long] = np.add.reduceat(rows.take(order.take(at), axis=0), ends - n, axis=0)
    for k, last in enumerate(reversed(on), 1):  # the runs of more than k rows
        if last <= long:
            break
        found[long:last] += rows.take(order.take(starts[long:last] + k), axis=0)
    _rows_of(sums)[several] = _rows_of(found)
    return sums


@np.errstate(over="ignore")
def log_probs(codes: np.ndarray, begins: np.ndarray, t: Tables, by_class: np.ndarray, by_word: np.ndarray) -> np.ndarray:
    """Natural log-probability of every token; outside the hot list the word's
    smoothed count over the mass of its rest class is still to be added."""
    out = np.empty(len(codes))
    for a in range(0, len(codes), _BLOCK):
        code = codes[a : a + _BLOCK]
        part = t.history(codes, begins, a, a + len(code))
        cls = t.cls[code]
        value = _log_softmax(by_class, t.class_rows(part, len(by_class)), t.class_bias, cls) + t.inside[code]
        at, node, place = t.steps(code)
        for i in range(0, len(at), _BLOCK):
            own, of = node[i : i + _BLOCK], at[i : i + _BLOCK]
            rows = t.word_rows(part.take(of, axis=1), own, len(by_word))
            value += np.bincount(of, _log_softmax(by_word, rows, t.word_bias, place[i : i + _BLOCK], own), len(code))
        out[a : a + _BLOCK] = value
    return out


class Learner:
    """AdaGrad on one task's share, from given weights."""

    def __init__(self, t: Tables, by_class: np.ndarray, by_word: np.ndarray) -> None:
        self.t = t
        self.weights = [_aligned(by_class), _aligned(by_word)]
        self.squares = [np.full(len(w), 1.0, dtype=np.float32) for w in self.weights]  # a step size per row
        self.touched = [np.zeros(len(w), dtype=np.int64) for w in self.weights]
        self.seen: list[list[np.ndarray]] = [[], []]  # rows of the updates not yet in ``touched``
        self.sums = [_empty(BATCH, w.shape[1]) for w in self.weights]
        self.room = [_empty(_CACHED, w.shape[1]) for w in self.weights]

    def _count(self, k: int) -> None:
        """Adds the rows of the last updates to ``touched``, many at once."""
        if self.seen[k]:
            self.touched[k] += np.bincount(np.concatenate(self.seen[k]), minlength=len(self.touched[k]))
            self.seen[k] = []

    def _update(self, k: int, rows: np.ndarray, slope: np.ndarray) -> None:
        weights, squares = self.weights[k], self.squares[k]
        room = self.room[k]
        self.seen[k].append(rows.ravel())
        if len(self.seen[k]) == _SEEN:
            self._count(k)
        places = np.arange(len(slope))
        for r in rows:
            keyed = r << 32
            keyed |= places
            keyed.sort()  # faster than a stable argsort
            ranked, order = keyed >> 32, keyed & 0xFFFFFFFF
            edges = np.concatenate([[0], np.flatnonzero(ranked[1:] != ranked[:-1]) + 1, [len(r)]])
            first, sizes = edges[:-1], np.diff(edges)
            at = ranked.take(first)
            sums = _segment_sums(slope, order, first, sizes, self.sums[k])
            for a in range(0, len(at), _CACHED):
                own, g = at[a : a + _CACHED], sums[a : a + _CACHED]
                square = squares.take(own)
                square += np.einsum("ij,ij->i", g, g) / np.float32(WIDTH)
                squares[own] = square
                g *= (RATE / np.sqrt(square))[:, None]
                moved = weights.take(own, axis=0, out=room[: len(own)], mode="clip")
                moved -= g
                _rows_of(weights)[own] = _rows_of(moved)

    @np.errstate(over="ignore")
    def learn(self, codes: np.ndarray, begins: np.ndarray) -> None:
        t = self.t
        for a in range(0, len(codes), BATCH):
            code = codes[a : a + BATCH]
            part = t.history(codes, begins, a, a + len(code))
            cls = t.cls[code]
            rows = t.class_rows(part, len(self.weights[0]))
            self._update(0, rows, _slope(self.weights[0], rows, t.class_bias, cls))
            at, node, place = t.steps(code)
            for i in range(0, len(at), BATCH):
                own = node[i : i + BATCH]
                rows = t.word_rows(part.take(at[i : i + BATCH], axis=1), own, len(self.weights[1]))
                self._update(1, rows, _slope(self.weights[1], rows, t.word_bias, place[i : i + BATCH], own))
        for k in (0, 1):
            self._count(k)


def train(encoded: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> MaxEnt:
    """Fit the weights on all rows marked ``_train``, a share in each round."""
    spark = encoded.sparkSession
    by_class, by_word = sizes(vocabulary)
    model = MaxEnt(
        vocabulary, np.zeros((by_class, CLASSES), dtype=np.float32),
        np.zeros((by_word, WIDTH), dtype=np.float32))
    if not vocabulary.hot:
        return model
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            learner = Learner(m.tables, m.by_class, m.by_word)
            blobs, held = [], 0
            for batch in batches:
                for blob in batch.column(0).to_pylist():
                    blobs.append(blob)
                    held += len(blob) // 4
                    if held >= _PASS:
                        learner.learn(*learner.t.codes(blobs))
                        blobs, held = [], 0
            if blobs:
                learner.learn(*learner.t.codes(blobs))
            for k in (0, 1):
                at = np.flatnonzero(learner.touched[k])
                wide = np.zeros((len(at), max(CLASSES, WIDTH)), dtype=np.int16)
                fixed = np.rint(learner.weights[k][at] * np.float32(_FIXED))
                wide[:, : learner.weights[k].shape[1]] = np.clip(fixed, -_FIXED_MOST, _FIXED_MOST)
                ends = np.arange(0, wide.size + 1, wide.shape[1], dtype=np.int32)
                values = pa.ListArray.from_arrays(ends, pa.array(wide.ravel(), pa.int16()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), k), pa.int32()), pa.array(at, pa.int32()),
                     pa.array(learner.touched[k][at], pa.int64()), values],
                    names=["k", "row", "n", "w"])

        key = F.xxhash64("_id", "ids")
        share = encoded.where("_train").select("ids", key.alias("key")).where(
            F.pmod("key", F.lit(rounds)) == turn)
        n = shards(vocabulary.total)
        shard = F.pmod(F.shiftright("key", 8), F.lit(n)).cast("int")
        means = [
            (F.sum(F.col("w")[i] * F.col("n")) / F.sum("n") / F.lit(_FIXED)).cast("float")
            for i in range(max(CLASSES, WIDTH))
        ]
        with shuffles_freed(spark):  # a round leaves its texts and weight rows behind
            parts = (
                share.repartitionById(n, shard).sortWithinPartitions("key", "ids").select("ids")
                .mapInArrow(learn, "k int, row int, n long, w array<smallint>")
            )
            merged = parts.groupBy("k", "row").agg(F.array(*means).alias("w")).toArrow()
        weights = [model.by_class.copy(), model.by_word.copy()]
        k, row = (merged[c].to_numpy().astype(np.int64) for c in ("k", "row"))
        values = merged["w"].combine_chunks().flatten().to_numpy().reshape(len(k), max(CLASSES, WIDTH))
        for i in (0, 1):
            weights[i][row[k == i]] = values[k == i, : weights[i].shape[1]]
        model = replace(model, by_class=weights[0], by_word=weights[1])
        shared.unpersist()
    return model


def score(encoded: DataFrame, counts: DataFrame, model: MaxEnt) -> DataFrame:
    """(_id, _train, n_tokens, n_known, base_score, score), a row per text."""
    v = model.vocabulary
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        t, by_class, by_word = m.tables, _aligned(m.by_class), _aligned(m.by_word)
        for blobs in batches:
            tokens = np.cumsum(pc.binary_length(blobs).to_numpy(zero_copy_only=False).astype(np.int64) // 4)
            edges = [0, *(np.flatnonzero(np.diff(tokens // _PASS)) + 1).tolist(), len(blobs)]
            found = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                codes, begins = t.codes(blobs.slice(a, b - a).to_pylist())
                value = log_probs(codes, begins, t, by_class, by_word) / np.log(10)
                n = np.diff(np.append(begins, len(codes)))
                sums = [np.add.reduceat(x, begins) for x in (t.base[codes], value, (codes < t.n_hot).astype(np.int64))]
                found.append(pa.StructArray.from_arrays(
                    [pa.array(n, pa.int64()), *map(pa.array, sums)], ["n", "base", "model", "hot"]))
            if found:
                yield pa.concat_arrays(found)

    judged = F.arrow_udf(judge, "n long, base double, model double, hot long")
    head = encoded.select("_row", "_id", "_train", judged("ids").alias("s"))
    z = v.total + 0.5 * (v.distinct + 1)
    masses = F.array(*[F.lit(float(m)) for m in v.masses])
    tail = encoded.select("_row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select(
        "_row", F.col("t.tail").alias("word"), F.col("t.times").alias("m"))
    smoothed = F.coalesce("c", F.lit(0)) + F.lit(0.5)
    own_mass = F.element_at(masses, F.expr(_rest_class_sql("word")) + 1)
    rare = counts.where(F.col("c") * F.lit(HOT_WORDS) < F.lit(least_hot(v.total)))
    tail_sums = (
        tail.join(rare, "word", "left")
        .select("_row", "m", (F.col("m") * F.log10(smoothed / F.lit(z))).alias("base"),
                (F.col("m") * F.log10(smoothed / own_mass)).alias("model"),
                F.when(F.col("c") > 0, F.col("m")).otherwise(0).alias("known"))
        .groupBy("_row").agg(F.sum("base").alias("tb"), F.sum("model").alias("tm"), F.sum("known").alias("tk"))
    )
    zero = F.lit(0.0)
    return head.join(tail_sums, "_row", "left").select(
        "_id", "_train", F.col("s.n").alias("n_tokens"),
        (F.col("s.hot") + F.coalesce("tk", F.lit(0))).cast("long").alias("n_known"),
        (F.col("s.base") + F.coalesce("tb", zero)).alias("base_score"),
        (F.col("s.model") + F.coalesce("tm", zero)).alias("score"),
    )


def score_texts(docs: DataFrame, train_where: Column, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows ``train_where`` of ``docs`` and score all of them.

    Returns ``id_col``, ``held_out``, ``n_tokens`` (words and the end),
    ``n_known`` (tokens that occur in training), ``train_tokens``,
    ``base_score`` (log10 under the smoothed unigram model) and ``score``
    (log10 under the maximum-entropy model).

    Null and empty texts are the end alone.  A null ``train_where`` counts as
    false.  Repeated rows are each counted and scored; null ids stay null;
    other columns are ignored.  Without training rows each word costs
    log10(1) in the base.  An empty table gives an empty result.
    """
    where = F.coalesce(train_where, F.lit(False))
    training = docs.where(where).select(whole_text(text_col).alias("_text"))
    counts = write_through(count_words(training, "_text"), "word-counts")
    vocabulary = learn_vocabulary(counts)
    encoded = encode(docs, id_col, text_col, where, vocabulary)
    model = train(encoded, vocabulary)
    return score(encoded, counts, model).select(
        F.col("_id").alias(id_col), (~F.col("_train")).alias("held_out"), "n_tokens", "n_known",
        F.lit(vocabulary.total).cast("long").alias("train_tokens"), "base_score", "score",
    )
