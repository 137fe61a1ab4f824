"""Near duplicates by MinHash bands, odd sketches and exact confirmation.

A document's set holds its distinct shingles of ``k`` words.  Documents with
equal sets form a class, and only one of each class goes on.  A class has
``BANDS * ROWS`` MinHash samples; classes that agree in all samples of a
band are candidates.  Of ``BINS`` further MinHash samples (the smallest hash
in each bin of one permutation) an odd sketch is folded: a bitmap in which
each sample flips one bit, so the exclusive-or of two sketches holds what
their samples differ in, and its number of ones estimates high similarities
precisely (:func:`most_ones`).  Candidates whose sketches differ in more
bits than sets at the threshold do are dropped; the others are confirmed on
the full sets.

No group is expanded into all its pairs:

* First every member of a band bucket is compared with one leader of the
  bucket only (of ``ORDERS`` global orders, so a member meets few leaders).
  The components of the links found settle most buckets.
* The classes of buckets that still hold several components go through an
  exact prefix filter among themselves: of a set's shingles, rarest first,
  two similar sets share one of the first n - ceil(0.8 n) + 1.  Copies of
  one text that drifted apart share few of their rare shingles, so this
  parts the groups that bands cannot.
* Where a prefix shingle joins several components, its classes outside the
  largest component are compared with those of others: all when they are
  few, else a part of about ``STRAYS`` in each round until none is left.
  Keys with many comparisons are cut into blocks of members; a block counts
  what its sets share by matrix products and returns one link for each class
  and component, so no pairs are written out.

A pair at the threshold 0.8 shares no band with probability
``(1 - 0.8**5)**40``, about 1e-7; the sketch allows five standard deviations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrace.llm.common import key_bitmap, left_join_groups, mark_keys, split_by_keys, whole_text, write_through
from airtrace.llm.components import components

BANDS = 40
ROWS = 5
BIN_BITS = 10
BINS = 1 << BIN_BITS
SKETCH_BITS = 2048
#: Standard deviations that the sketches of a similar pair may be off.
SIGMAS = 5.0
ORDERS = 4
STRAYS = 512
#: Comparisons of one key that are made pair by pair; keys with more are
#: compared in blocks of about BLOCK_ROWS members.
PAIRS_OF_KEY = 2000
BLOCK_ROWS = 256
#: Counters of the shingle frequencies that order the prefix filter.
COUNTER_BITS = 20
BITMAP_BITS = 24
_CHUNK = 4096  # shingles hashed at once


def shingle_set(text: str, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``k`` words.

    Words are what stands between characters of [\\x20\\x09-\\x0D], with A-Z
    in lower case; of fewer than ``k`` words the whole sequence is the one
    shingle; without words the set is empty.
    """
    from xxhash import xxh3_64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.array([xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    width = min(k, len(words))
    n = len(hashes) - width + 1
    acc = np.full(n, width, dtype=np.uint64)
    for j in range(width):
        acc = (acc ^ hashes[j : n + j]) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(32)
    return np.unique(acc)


class Signer:
    """MinHash samples and band keys of shingle sets."""

    def __init__(self, seed: int = 29) -> None:
        rng = np.random.default_rng(seed)
        n = BANDS * ROWS
        self.a = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = rng.integers(0, 1 << 32, n, dtype=np.uint32)
    def samples(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
        low = np.full(len(self.a), 0xFFFFFFFF, dtype=np.uint32)
        for at in range(0, len(x), _CHUNK):
            hashed = self.a[:, None] * x[None, at : at + _CHUNK]
            hashed += self.b[:, None]
            np.minimum(low, hashed.min(axis=1), out=low)
        return low

    def bands(self, samples: np.ndarray) -> np.ndarray:
        cells = samples.astype(np.uint64).reshape(BANDS, ROWS)
        key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for j in range(ROWS):
            key = (key ^ cells[:, j]) * np.uint64(0xFF51AFD7ED558CCD)
            key ^= key >> np.uint64(33)
        return key.view(np.int64)


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity bitmap of the one-permutation samples, as 64-bit numbers.

    ``shingles`` are sorted, so the first of each bin (of the leading bits)
    is the bin's smallest hash.
    """
    bins = shingles >> np.uint64(64 - BIN_BITS)
    low = shingles[np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))]
    mixed = (low ^ (low >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    bit = (mixed >> np.uint64(65 - SKETCH_BITS.bit_length())).astype(np.int64)
    odd = (np.bincount(bit, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _occupied(n: Column | float) -> Column | float:
    """Bins that ``n`` shingles are expected to fill."""
    return BINS * (1 - F.exp(n / -BINS)) if isinstance(n, Column) else BINS * -np.expm1(-n / BINS)


def most_ones(na: Column | float, nb: Column | float, percent: int) -> Column | float:
    """Ones that the exclusive-or of two sketches holds at most, if the sets
    (of ``na`` and ``nb`` shingles) are as similar as ``percent``.

    At the threshold t the union has (na + nb) / (1 + t) shingles, which fill
    u bins, and the smallest of a bin is shared with the probability t; so
    the samples of the sets differ in d = u_a + u_b - 2 u t, each of which
    flips one of m bits: m / 2 (1 - exp(-2 d / m)) ones.  The spread is that
    of drawing the u smallest from the union without replacement, and of
    flips that meet in a bit.
    """
    t, m = percent / 100, SKETCH_BITS
    columns = isinstance(na, Column)
    exp, sqrt = (F.exp, F.sqrt) if columns else (np.exp, np.sqrt)
    union = (na + nb) / (1 + t)
    u = _occupied(union)
    d = _occupied(na) + _occupied(nb) - 2 * t * u
    slope = exp(-2 / m * d)
    drawn = 4 * t * (1 - t) * u * (union - u) / union
    met = m / 4 * (1 - slope * slope) - d * slope * slope
    spread = drawn * slope * slope + met
    floor = F.greatest(spread, F.lit(0.0)) if columns else max(spread, 0.0)
    return m / 2 * (1 - slope) + SIGMAS * sqrt(floor) + 2


def signatures(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(_id, n, _set, bands, sketch) of each row; the last three null if empty."""
    rows = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    schema = "n long, _set string, bands array<long>, sketch array<long>"

    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        signer = Signer()
        for texts in batches:
            out: list[list] = [[], [], [], []]
            for text in texts:
                shingles = shingle_set(text.as_py(), k)
                row = (0, None, None, None)
                if len(shingles):
                    samples = signer.samples(shingles)
                    key = hashlib.blake2b(shingles.tobytes(), digest_size=16).hexdigest()
                    row = (len(shingles), key, signer.bands(samples), odd_sketch(shingles))
                for col, value in zip(out, row, strict=True):
                    col.append(value)
            longs = pa.list_(pa.int64())
            yield pa.StructArray.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()),
                 pa.array(out[2], longs), pa.array(out[3], longs)],
                ["n", "_set", "bands", "sketch"])
        pa.default_memory_pool().release_unused()  # the worker lives on for other stages

    signed = F.arrow_udf(sign, schema)
    return rows.select("_id", signed("_text").alias("s")).select("_id", "s.*")


def _lengths_fit(percent: int) -> Column:
    """Sets so unlike in size cannot reach the similarity."""
    return 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")


class _Confirm:
    """Confirms candidate pairs: sketches first, then the full sets."""

    def __init__(self, docs: DataFrame, classes: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> None:
        self.texts = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
        self.sketches = classes.select("rep", "n", "sketch")
        self.k, self.percent = k, percent

    def fetch(self, ids: DataFrame) -> DataFrame:
        """(_id, _text) of the ids; the scan drops most others by a bitmap."""
        hashed = F.xxhash64("_id")
        wanted = key_bitmap(ids, hashed, BITMAP_BITS)
        near = mark_keys(self.texts, wanted, hashed, BITMAP_BITS, "_needed").where("_needed")
        return near.join(ids.distinct(), "_id", "left_semi").select("_id", "_text")

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets are similar, as edges (u, v)."""
        k, percent = self.k, self.percent
        ones = F.aggregate(
            F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0),
            lambda s, x: s + x.cast("int"))
        sa, sb = (
            self.sketches.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
            for x in "ab"
        )
        likely = write_through(
            pairs.join(sa, "a").join(sb, "b")
            .where(_lengths_fit(percent) & (ones <= most_ones(F.col("na"), F.col("nb"), percent)))
            .select("a", "b").distinct(),
            "likely-pairs")
        ids = likely.select(F.col("a").alias("_id")).unionByName(likely.select(F.col("b").alias("_id")))
        texts = self.fetch(ids)

        def similar(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            last: tuple[str | None, np.ndarray] = (None, np.zeros(0, dtype=np.uint64))
            for a, b in batches:
                out = []
                for x, y in zip(a, b, strict=True):
                    x = x.as_py()
                    if x != last[0]:
                        last = (x, shingle_set(x, k))
                    one, two = last[1], shingle_set(y.as_py(), k)
                    shared = len(np.intersect1d(one, two, assume_unique=True))
                    union = len(one) + len(two) - shared
                    out.append(bool(shared) and 100 * shared >= percent * union)
                yield pa.array(out, pa.bool_())

        confirmed = F.arrow_udf(similar, "boolean")
        ta = texts.select(F.col("_id").alias("a"), F.col("_text").alias("ta"))
        tb = texts.select(F.col("_id").alias("b"), F.col("_text").alias("tb"))
        return (
            likely.join(tb, "b").join(ta, "a").where(confirmed("ta", "tb"))
            .select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()
        )


def _block_links(rows: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (u, v) of the rows that ask with rows of other roots, by blocks.

    ``rows``: key, rep, root, _asks, _blocks.  Of a class that asks and a
    root, one link is returned from each block.
    """

    def links(block: pa.Table) -> pa.Table:
        sets = [shingle_set(t.as_py(), k) for t in block["_text"]]
        reps, roots = (np.array(block[c].to_pylist(), dtype=np.int64) for c in ("rep", "root"))
        asks = np.array(block["_asked"].to_pylist(), dtype=bool)
        ai, bi = np.flatnonzero(asks), np.flatnonzero(~asks)
        u, v = [], []
        if len(ai) and len(bi):
            def pool(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                return np.concatenate([sets[i] for i in at]), np.repeat(np.arange(len(at)), [len(sets[i]) for i in at])

            (ta, ra), (tb, rb) = pool(ai), pool(bi)
            common = np.intersect1d(ta, tb)
            shared = np.zeros((len(ai), len(bi)), dtype=np.float32)
            for c in range(0, len(common), _CHUNK):
                part = common[c : c + _CHUNK]
                sides = []
                for t, r, n in ((ta, ra, len(ai)), (tb, rb, len(bi))):
                    at = np.minimum(np.searchsorted(part, t), len(part) - 1)
                    hit = part[at] == t
                    side = np.zeros((n, len(part)), dtype=np.float32)
                    side[r[hit], at[hit]] = 1
                    sides.append(side)
                shared += sides[0] @ sides[1].T
            size = np.array([len(x) for x in sets], dtype=np.float64)
            union = size[ai][:, None] + size[bi][None, :] - shared
            linked = (shared > 0) & (100.0 * shared >= percent * union) & (roots[ai][:, None] != roots[bi][None, :])
            for i in np.flatnonzero(linked.any(axis=1)):
                found = np.flatnonzero(linked[i])
                _, first = np.unique(roots[bi[found]], return_index=True)
                u += [reps[ai[i]]] * len(first)
                v += reps[bi[found[first]]].tolist()
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    own = texts.select(F.col("_id").alias("rep"), "_text")
    block = F.pmod(F.xxhash64("rep"), F.col("_blocks"))
    told = rows.select("key", "rep", "root", block.alias("_block"), F.lit(False).alias("_asked"))
    asking = rows.where("_asks").select(
        "key", "rep", "root", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"),
        F.lit(True).alias("_asked"))
    return told.unionByName(asking).join(own, "rep").groupBy("key", "_block").applyInArrow(links, "u long, v long")


def _prefixes(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(key, rep): the shingles of each text's prefix, rarest first.

    The order is that of counters over hashes of the shingles (a table of
    fixed size, broadcast) and then of the hash: any one order is right, a
    collision only makes a shingle look more frequent.
    """
    slot_shift = np.uint64(64 - COUNTER_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
        for batch in batches:
            for text in batch.column("_text"):
                np.add.at(found, (shingle_set(text.as_py(), k) >> slot_shift).astype(np.int64), 1)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(found[at])], names=["slot", "n"])

    table = (
        texts.select("_text").mapInArrow(count, "slot long, n long")
        .groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    )
    frequency = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    frequency[table["slot"].to_numpy()] = table["n"].to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(frequency)

    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for text in batch:
                shingles = shingle_set(text.as_py(), k)
                n = len(shingles)
                order = np.lexsort((shingles, shared.value[(shingles >> slot_shift).astype(np.int64)]))
                out.append(shingles[order[: n - -(-n * percent // 100) + 1]].view(np.int64))
            yield pa.array(out, pa.list_(pa.int64()))

    cutter = F.arrow_udf(cut, "array<long>")
    return texts.select(F.col("_id").alias("rep"), F.explode(cutter("_text")).alias("key"))


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of two ids with a < b."""
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
) -> DataFrame:
    """One row per row of ``docs``: its near-duplicate component.

    Returns ``id_col``, ``n_shingles`` (size of its set), ``component_id``
    (the smallest id reachable over links, its own included), ``kept``
    (whether that is its own id) and ``class_size`` (rows with the same set).
    Two documents are linked when 100 * shared >= percent * union.

    Null, empty and blank texts have empty sets and are linked with nothing.
    An id is one document: rows that repeat it are linked, whatever their
    texts.  Rows with a null id are linked with nothing; their component is
    null and they are kept.  Other columns are ignored; an empty table gives
    an empty result.  Ids are integers.
    """
    signed = write_through(signatures(docs, k, id_col, text_col), "signatures")
    usable = signed.where("_id IS NOT NULL AND _set IS NOT NULL")
    classes = write_through(
        usable.groupBy("_set").agg(
            F.min("_id").alias("rep"), F.count("*").alias("class_size"), F.first("n").alias("n"),
            F.first("bands").alias("bands"), F.first("sketch").alias("sketch")),
        "classes")
    confirm = _Confirm(docs, classes, k, percent, id_col, text_col)
    exploded = classes.select("rep", "n", F.posexplode("bands").alias("band", "key"))
    stats = (
        exploded.groupBy("key")
        .agg(F.min(F.struct(
            F.xxhash64("rep", F.pmod("band", F.lit(ORDERS))).alias("o"), F.col("rep").alias("leader"),
            F.col("n").alias("nb"))).alias("first"), F.count("*").alias("size"))
        .where("size > 1")
    )
    buckets = write_through(
        exploded.join(stats, "key")
        .select("key", "rep", "n", F.col("first.leader").alias("leader"), F.col("first.nb").alias("nb"), "size"),
        "buckets")
    star = buckets.withColumn("na", F.col("n")).where(_lengths_fit(percent))
    edges = confirm(_ordered(star.select(F.col("rep").alias("a"), F.col("leader").alias("b"))))
    repeats = (
        signed.where("_id IS NOT NULL AND _set IS NOT NULL").groupBy("_id")
        .agg(F.min("_set").alias("one"), F.max("_set").alias("other")).where("one != other")
    )
    again = usable.join(repeats.select("_id"), "_id", "left_semi").join(classes.select("_set", "rep"), "_set")
    edges = edges.unionByName(again.select(F.col("_id").alias("u"), F.col("rep").alias("v")))
    roots = components(edges)

    # a bucket's leader has met all others; two members are settled with that
    def placed(rows: DataFrame) -> DataFrame:
        """Rows (key, rep) of the keys that still join several components."""
        own = rows.join(roots.select(F.col("u").alias("rep"), F.col("v").alias("root")), "rep", "left")
        own = own.withColumn("root", F.coalesce("root", "rep"))
        mixed = own.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
        return own.join(mixed.select("key"), "key", "left_semi")

    unsettled = write_through(
        placed(buckets.where("size > 2 AND rep != leader").select("key", "rep"))
        .select(F.col("rep").alias("_id")).distinct(), "unsettled")
    if not unsettled.isEmpty():
        texts = write_through(confirm.fetch(unsettled), "unsettled-texts")
        rest, turn = _prefixes(texts, k, percent), 0
        while True:
            open_ = write_through(placed(rest), "open-keys")
            if open_.isEmpty():
                break
            largest = (
                open_.groupBy("key", "root").agg(F.count("*").alias("c")).groupBy("key")
                .agg(F.max(F.struct("c", "root")).alias("top"), F.sum("c").alias("members"))
                .select("key", F.col("top.root").alias("top"), "members",
                        (F.col("members") - F.col("top.c")).alias("strays"))
            )
            chance = F.pmod(F.xxhash64(F.lit(turn), "rep", "key"), F.col("strays"))
            compared = F.least("strays", F.lit(STRAYS)) * F.col("members")
            tagged = write_through(
                open_.join(largest, "key").select(
                    "key", "rep", "root", ((F.col("root") != F.col("top")) & (chance < STRAYS)).alias("_asks"),
                    (compared > PAIRS_OF_KEY).alias("_hot"), F.ceil(F.col("members") / BLOCK_ROWS).alias("_blocks")),
                "asking")
            few, hot = tagged.where("NOT _hot"), tagged.where("_hot")
            asks = few.where("_asks").select("key", F.col("rep").alias("a"), F.col("root").alias("ra"))
            others = few.select("key", F.col("rep").alias("b"), F.col("root").alias("rb"))
            met = asks.join(others, "key").where("ra != rb")
            found = confirm(_ordered(met.select("a", "b")))
            if not hot.isEmpty():
                found = found.unionByName(_block_links(hot, texts, k, percent))
            roots = components(roots.unionByName(found))
            rest = tagged.where("NOT _asks").select("key", "rep")
            turn += 1

    named = roots.select(F.col("u").alias("rep"), F.col("v").alias("root"))
    groups = (
        classes.select("_set", "rep", "class_size").join(named, "rep", "left")
        .where("class_size > 1 OR root IS NOT NULL")
        .select("_set", "class_size", F.coalesce("root", "rep").alias("component"))
    )
    rows = signed.select("_id", "n", F.when(F.col("_id").isNotNull(), F.col("_set")).alias("_set"))
    joined = left_join_groups(rows, groups, "_set", "class_size", rows.count(), F.col("_id"))
    component = F.coalesce("component", "_id")
    return joined.select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("_id").isNotNull(), component).alias("component_id"),
        F.col("_id").eqNullSafe(F.when(F.col("_id").isNotNull(), component)).alias("kept"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
    )


def drop_near_copies(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
) -> DataFrame:
    """``docs`` without the rows whose id is not their component's smallest.

    All columns stay, of whatever name.  Rows that repeat the id that stays
    go as well, but one; rows without an id and texts without words stay.  Of
    ties the smallest id stays; an empty table gives an empty result.

    Only rows that go, repeat, or share a bit with one that does are joined;
    the texts of all others stay where they are.
    """
    flagged = write_through(
        near_groups(docs, id_col=id_col, text_col=text_col, k=k, percent=percent), "near-flags")
    gone = flagged.where("NOT kept").select(F.col(id_col).alias("_gone")).distinct()
    repeated = (
        flagged.where(F.col("kept") & F.col(id_col).isNotNull() & (F.col("n_shingles") > 0))
        .groupBy(F.col(id_col).alias("_again")).agg(F.count("*").alias("n")).where("n > 1").select("_again")
    )
    clear, near = split_by_keys(docs, id_col, gone.unionByName(repeated.withColumnRenamed("_again", "_gone")))
    named = near.withColumn("_key", F.col("_row")[id_col])
    stay = named.join(gone, F.col("_key") == F.col("_gone"), "left_anti")
    if not repeated.isEmpty():
        once = stay.join(repeated, F.col("_key") == F.col("_again"), "left_anti")
        again = stay.join(repeated, F.col("_key") == F.col("_again"), "left_semi")
        stay = once.unionByName(again.dropDuplicates(["_key"]))
    return clear.unionByName(stay.select("_row")).select("_row.*")
