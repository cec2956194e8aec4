"""Benchmark decontamination by SimHash over windows of an item's size.

A window of a document is as long as the item that it is held against; a document
that is shorter than the item is one window.  Only
windows that hold enough of the benchmark's word shingles can reach the wanted
similarity, by a bound that loses none.  Each gets a SimHash of 64 bits, in which a
shingle weighs as often as it stands; an index of its eight bytes, entered under all
bytes within the block radius, finds every item within the Hamming radius.  Those
candidates are verified by their exact weighted shingle similarity: a shingle of the
item weighs by how many documents of the whole corpus have it, any other 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import arrow_map
from .census import SLICE, partitions, texts
from .frames import dropped, saved, sized, table
from .textkit import Words, _ranges, data_of, mix, slices, words_of

#: Words of a shingle, least weighted similarity, and Hamming radius of 64 bits.
SHINGLE, SIMILARITY, RADIUS = 3, 0.6, 23
#: Shingles of items handled by one pass; a larger benchmark takes several passes.
ITEM_SHINGLES = 4_000_000
_BITS = np.arange(64, dtype=np.uint64)
_BLOCKS = 8


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingle at every word of every text, and how many each text has; a text of fewer words has one of all its words."""
    words = np.diff(w.bounds)
    grams, doc = w.grams(n)
    few = np.flatnonzero((words > 0) & (words < n))
    if len(few):
        at = w.bounds[few]
        grams = np.concatenate([grams, mix(_ranges(w.hash, at, at + words[few]) + words[few].astype(np.uint64))])
        doc = np.concatenate([doc, few])
        order = np.argsort(doc, kind="stable")
        grams, doc = grams[order], doc[order]
    return grams, np.bincount(doc, minlength=len(words))


def weights(counts: np.ndarray) -> np.ndarray:
    """Between 1 and 1.5; less for shingles that more documents have."""
    return 1 + 0.5 / (1 + np.log2(1 + counts))


def similarity(a: np.ndarray, b: np.ndarray, weigh) -> float:
    """Weighted Jaccard similarity of two multisets of shingles; what isn't in the second weighs 1."""
    x, cx = np.unique(a, return_counts=True)
    y, cy = np.unique(b, return_counts=True)
    every = np.union1d(x, y)
    p, q = np.zeros(len(every)), np.zeros(len(every))
    p[np.searchsorted(every, x)], q[np.searchsorted(every, y)] = cx, cy
    w = np.where(q > 0, weigh(every), 1.0)
    whole = (w * np.maximum(p, q)).sum()
    return float((w * np.minimum(p, q)).sum() / whole) if whole else 0.0


def signs(grams: np.ndarray) -> np.ndarray:
    """1 or -1 for each of 64 bits of each shingle."""
    return ((mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5))[:, None] >> _BITS & np.uint64(1)) * np.uint64(2)).astype(np.int32) - np.int32(1)


def simhash(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of 64 sums."""
    return np.packbits(sums > 0, axis=-1, bitorder="little").view("<u8")[..., 0]


class Items:
    """The items of a benchmark, their shingles' weights and the index of their fingerprints.

    The index holds, for each length in words and each of the eight blocks, the
    items that a block's value may belong to, as bits of 64-bit words.
    """

    def __init__(self, ids: list[int], words: list[int], sets: list[np.ndarray], known: np.ndarray, counts: np.ndarray, radius: int):
        self.ids, self.words, self.sets, self.known, self.radius = ids, words, sets, known, radius
        self.weight = weights(counts)
        self.whole = [float(self.weigh(s).sum()) for s in sets]
        self.prints = np.array([simhash(signs(s).sum(axis=0)) for s in sets], np.uint64)
        near = np.array([v for v in range(256) if v.bit_count() <= radius // _BLOCKS])
        self.by_size: dict[int, np.ndarray] = {}
        self.index: dict[int, np.ndarray] = {}
        self.member: dict[int, np.ndarray] = {}
        for n in sorted(set(words)):
            own = self.by_size[n] = np.array([k for k, w in enumerate(words) if w == n])
            index = self.index[n] = np.zeros((_BLOCKS, 256, -(-len(own) // 64)), np.uint64)
            for place, k in enumerate(own.tolist()):
                for b in range(_BLOCKS):
                    index[b, (int(self.prints[k]) >> 8 * b & 255) ^ near, place // 64] |= np.uint64(1 << place % 64)
            self.member[n] = np.isin(known, np.concatenate([sets[k] for k in own.tolist()]))

    def places(self, grams: np.ndarray) -> np.ndarray:
        """Where each gram is among the known ones, -1 for others."""
        at = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        return np.where(self.known[at] == grams, at, -1)

    def weigh(self, grams: np.ndarray) -> np.ndarray:
        """Shingles that no item has weigh 1."""
        at = self.places(grams)
        return np.where(at >= 0, self.weight[at], 1.0)

    def near(self, n: int, prints: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Each item of n words with the fingerprints, by their index, that lie within the radius of its own: all there are."""
        blocks = np.ascontiguousarray(prints.astype("<u8")).view(np.uint8).reshape(-1, _BLOCKS)
        index = self.index[n]
        found = index[0, blocks[:, 0]]
        for b in range(1, _BLOCKS):
            found = found | index[b, blocks[:, b]]
        some = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(found, axis=0).astype("<u8").view(np.uint8), bitorder="little"))
        out = []
        for place, k in zip(some.tolist(), self.by_size[n][some].tolist()):
            mine = np.flatnonzero(found[:, place // 64] & np.uint64(1 << place % 64))
            mine = mine[np.bitwise_count(prints[mine] ^ self.prints[k]) <= self.radius]
            if len(mine):
                out.append((k, mine))
        return out


_REGIONS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start_word", T.LongType()),
    T.StructField("whole", T.BooleanType()),
    T.StructField("grams", T.BinaryType()),
    T.StructField("counts", T.BinaryType()),
])
_REGIONS_ARROW = pa.schema([("doc_id", pa.int64()), ("start_word", pa.int64()), ("whole", pa.bool_()), ("grams", pa.binary()), ("counts", pa.binary())])
_MATCHES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("start_word", T.LongType()), T.StructField("n_words", T.LongType())])
_MATCHES_ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("start_word", pa.int64()), ("n_words", pa.int64())])


def need(n: np.ndarray | int, least: float):
    """The fewest shared shingles, of n, with which ``least`` can be reached: weights lie between 1 and 1.5."""
    return np.maximum(1, np.ceil(least * n / 1.5 - 1e-9)).astype(np.int64)


def windows(doc_hits: np.ndarray, n: int, least: float, whole: bool = True) -> np.ndarray:
    """Starts of windows of n shingles (one at least) that hold enough hits; fewer shingles are one window if they are a ``whole`` document."""
    if len(doc_hits) < n:
        return np.arange(int(whole and doc_hits.sum() >= need(n, least)))
    total = np.concatenate([[0], np.cumsum(doc_hits)])
    return np.flatnonzero(total[n:] - total[:-n] >= need(n, least))


def _regions(docs: DataFrame, known: np.ndarray, sizes: list[int], least: float) -> DataFrame:
    """Runs of shingles that windows with enough hits cover; and each slice's document counts of the items' shingles."""
    marked = np.zeros(1 << 22, bool)
    marked[(known & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
    shared = docs.sparkSession.sparkContext.broadcast((known, np.flatnonzero(marked), sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, set_bits, sizes = shared.value
        marked = np.zeros(1 << 22, bool)
        marked[set_bits] = True
        fewest = int(need(min(sizes), least))
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for part, raw, off in slices(batch, "text", SLICE):
                grams, counts = shingles(words_of(raw, off), SHINGLE)
                maybe = np.flatnonzero(marked[(grams & np.uint64((1 << 22) - 1)).astype(np.int64)])
                at = np.minimum(np.searchsorted(known, grams[maybe]), len(known) - 1)
                sure = known[at] == grams[maybe]
                place, which = maybe[sure], at[sure]
                bounds = np.concatenate([[0], np.cumsum(counts)])
                owner = np.searchsorted(bounds, place, "right") - 1
                both = np.unique(owner * len(known) + which)
                total += np.bincount(both % len(known), minlength=len(known))
                hits = np.bincount(owner, minlength=len(counts))
                rows = []
                for d in np.flatnonzero(hits >= fewest).tolist():
                    n = int(counts[d])
                    hit = np.zeros(n, np.int64)
                    hit[place[owner == d] - bounds[d]] = 1
                    cover = np.zeros(n + 1, np.int64)
                    for size in sizes:
                        start = windows(hit, size, least)
                        np.add.at(cover, start, 1)
                        np.add.at(cover, np.minimum(start + size, n), -1)
                    inside = np.concatenate([[0], (np.cumsum(cover[:-1]) > 0).astype(np.int64), [0]])
                    for i, j in zip(np.flatnonzero(np.diff(inside) == 1).tolist(), np.flatnonzero(np.diff(inside) == -1).tolist()):
                        rows.append((part.column(0)[d].as_py(), i, j - i == n, grams[bounds[d] + i : bounds[d] + j].tobytes(), None))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _REGIONS_ARROW)], schema=_REGIONS_ARROW)
        if total.any():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([None], pa.bool_()), pa.array([None], pa.binary()), pa.array([np.stack([some, total[some]]).tobytes()], pa.binary())], schema=_REGIONS_ARROW)

    return saved(arrow_map(texts(docs), run, _REGIONS))


_COUNTED = T.StructType([T.StructField("place", T.LongType()), T.StructField("n", T.LongType())])


def _counts(regions: DataFrame, size: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                place, n = np.frombuffer(blob, np.int64).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(n)], names=["place", "n"])

    found = arrow_map(regions.where("counts IS NOT NULL").select("counts"), run, _COUNTED).groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, np.int64)
    counts[found.column("place").to_numpy()] = found.column("n").to_numpy()
    return counts


def _matches(regions: DataFrame, items: Items, least: float) -> DataFrame:
    """The matches, saved; the items leave the executors with it."""
    shared = regions.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            rows = []
            for doc, first, whole, blob in zip(*(c.to_pylist() for c in batch.columns)):
                grams = np.frombuffer(blob, np.uint64)
                at = items.places(grams)
                w = np.where(at >= 0, items.weight[at], 1.0)
                sums = None
                for words in items.index:
                    n = max(1, words - SHINGLE + 1)
                    start = windows((at >= 0) & items.member[words][at], n, least, whole)
                    if not len(start):
                        continue
                    short = max(0, n - len(grams))
                    n -= short
                    if sums is None:
                        sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs(grams), axis=0, dtype=np.int32)])
                    for k, mine in items.near(words, simhash(sums[start + n] - sums[start])):
                        begin = start[mine]
                        # Shared weight is at most that of the window's shingles that the item has: the best bound is verified first.
                        has = np.isin(grams, items.sets[k])
                        held = np.concatenate([[0.0], np.cumsum(np.where(has, w, 0.0))])
                        rest = np.concatenate([[0], np.cumsum(~has)])
                        most = held[begin + n] - held[begin]
                        whole_window = most + rest[begin + n] - rest[begin]
                        most = np.minimum(most, items.whole[k])
                        bound = most / np.maximum(items.whole[k] + whole_window - most, 1e-12) + 1e-9
                        best, where = least - 1e-9, -1
                        for i in np.lexsort((begin, -np.round(bound, 6))).tolist():
                            if bound[i] + 1e-6 < best:
                                break
                            value = similarity(grams[begin[i] : begin[i] + n], items.sets[k], items.weigh)
                            if value > best + 1e-12 or (value > best - 1e-12 and 0 <= begin[i] < where):
                                best, where = value, int(begin[i])
                        if where >= 0:
                            rows.append((doc, items.ids[k], best, first + where, words - short))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MATCHES_ARROW)], schema=_MATCHES_ARROW)

    found = saved(arrow_map(regions.where("counts IS NULL").select("doc_id", "start_word", "whole", "grams").repartition(partitions(regions)), run, _MATCHES))
    shared.destroy()
    return found


def _within(docs: DataFrame, items: list[tuple[int, int, np.ndarray]]) -> DataFrame:
    """Matches of items of fewer words than a shingle, by shingles of their own length: only equal words match."""
    by_size = {n: sorted((int(grams[0]), i) for i, m, grams in items if m == n) for n in {m for _, m, _ in items}}
    shared = docs.sparkSession.sparkContext.broadcast(by_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, off in slices(batch, "text", SLICE):
                w = words_of(raw, off)
                rows = []
                for n, pairs in shared.value.items():
                    at = w.gram_starts(n)
                    grams, owner = w.gram_hash(at, n), w.doc[at]
                    own, ids = np.array([g for g, _ in pairs], np.uint64), [i for _, i in pairs]
                    hits = np.flatnonzero(np.isin(grams, own))
                    hits = hits[np.lexsort((hits, grams[hits], owner[hits]))]
                    g, d = grams[hits], owner[hits]
                    hits = hits[np.append(True, (g[1:] != g[:-1]) | (d[1:] != d[:-1]))[: len(hits)]]
                    low, high = np.searchsorted(own, grams[hits]), np.searchsorted(own, grams[hits], "right")
                    for h, i, j in zip(hits.tolist(), low.tolist(), high.tolist()):
                        doc = int(owner[h])
                        rows += [(part.column(0)[doc].as_py(), k, 1.0, int(at[h] - w.bounds[doc]), n) for k in ids[i:j]]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MATCHES_ARROW)], schema=_MATCHES_ARROW)

    return arrow_map(texts(docs), run, _MATCHES)


def _groups(rows: DataFrame, most: int, within: bool) -> Iterator[tuple[list, list]]:
    """Short items, and the others, of as many consecutive rows as have ``most`` shingles; one group is held at a time."""
    small, group, held = [], [], 0
    for row in rows.toLocalIterator():
        w = words_of(*data_of(pa.array([row["text"]], pa.string())))
        if len(w.hash):
            grams, _ = shingles(w, SHINGLE)
            if held and held + len(grams) > most:
                yield small, group
                small, group, held = [], [], 0
            (small if within and len(w.hash) < SHINGLE else group).append((row["item_id"], len(w.hash), grams))
            held += len(grams)
    if held:
        yield small, group


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS, item_shingles: int = ITEM_SHINGLES, within: bool = False) -> DataFrame:
    """``(doc_id, item_id, similarity, start_word, n_words)``: the best window of each document for each item that it reaches ``least`` for.

    Words are runs of letters and digits without regard to ASCII case, and single
    characters of scripts without spaces; a window has as many words as the item, or
    is the whole document where that has fewer.  Items of one or two words match
    documents of exactly those words, and with ``within`` all that hold them.  Windows more than
    ``radius`` bits of 64 from an item's fingerprint are not compared with it.
    Rows without an id or a text, and texts or items without a word, match
    nothing; equal similarities go to the earlier window; rows that repeat an id
    are one document; very long texts are taken whole, and other columns aren't read.
    An empty table or benchmark gives no rows.  The benchmark
    is read to the driver in parts of ``item_shingles`` shingles, one at a time, each
    with a pass over the documents of its own; results don't depend on the parts.
    """
    spark = docs.sparkSession
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").distinct().orderBy("item_id", "text")
    out = spark.createDataFrame([], _MATCHES)
    for small, group in _groups(rows, item_shingles, within):
        if small:
            out = out.unionByName(_within(docs, small))
        if group:
            ids, words, sets = (list(x) for x in zip(*group))
            known = np.unique(np.concatenate(sets))
            regions = _regions(docs, known, sorted({len(s) for s in sets}), least)
            out = out.unionByName(_matches(regions, Items(ids, words, sets, known, _counts(regions, len(known)), radius), least))
            dropped(regions)
    return out.groupBy("doc_id", "item_id").agg(F.min_by(F.struct("similarity", "start_word", "n_words"), F.struct(-F.col("similarity"), F.col("start_word"))).alias("m")).select("doc_id", "item_id", "m.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS, within: bool = False) -> DataFrame:
    """The rows of ``docs`` whose document matches no item, in the same columns; rows without an id stay."""
    found = sized(contaminated(docs, benchmark, least, radius, within=within).select(F.col("doc_id").alias("leak")).distinct())
    return docs.join(found, docs["doc_id"] == found["leak"], "left_anti")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best window of every document and benchmark item at a similarity of 0.6, short items included; edge cases as in ``contaminated``."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), within=True)
