"""N-gram Jaccard join through prefix trees.

Every document is the set of its word n-grams, under one global order: rarest
first, by their counts over all documents.  Two sets whose Jaccard similarity
reaches t share one of their first ``|x| - ceil(t |x|) + 1`` grams, so a document
whose prefix holds nobody else's grams is done.  Of equal sets one stands for all,
with their number.  The others are tied together by the prefix grams that they
share; what is tied makes a block, and every pair that reaches t lies within one.
A block's sets are stored in a trie.  One walk of the
trie carries the overlap of its path with all probes at once, so sets that begin
alike share that work, and a subtree is left as soon as the longest remainder in
it can't lift any probe to t.  The result is exact up to collisions of hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import arrow_map
from .census import SLICE, Columns, counted, head_parts, heads_of, partitions, runs, texts, trade
from .frames import saved, sized, table
from .graph import components, spanning
from .textkit import _ranges, mix, slices, words_of

N, THRESHOLD = 4, 0.5
#: Sets of a part of a block; larger blocks are joined part by part.
PART = 1024


def gram_sets(raw: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of each text, one text after the other, and how many each has.

    A text of fewer than n words, but one at least, has one gram: all its words.
    """
    w = words_of(raw, off)
    grams, doc = w.grams(n)
    words = np.diff(w.bounds)
    few = np.flatnonzero((words > 0) & (words < n))
    if len(few):
        at = w.bounds[few]
        grams = np.concatenate([grams, mix(_ranges(w.hash, at, at + words[few]) + words[few].astype(np.uint64))])
        doc = np.concatenate([doc, few])
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    if len(grams):
        fresh = np.append(True, (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1]))
        grams, doc = grams[fresh], doc[fresh]
    return grams, np.bincount(doc, minlength=len(off) - 1)


def trie_join(sizes: np.ndarray, sets: list[np.ndarray], side: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j) of sets and their overlaps, for all pairs that reach t.

    sizes are those of the whole sets, of which ``sets`` holds what may be shared.
    Where ``side`` has both 0 and 1, only pairs of the one with the other are made.
    """
    m = len(sets)
    lengths = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(m), lengths)
    _, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    place = np.empty(len(counts), np.int64)
    place[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    ordinal = place[inverse]
    shared = counts[inverse] > 1
    ordinal, owner = ordinal[shared], owner[shared]
    by = np.lexsort((ordinal, owner))
    ordinal, owner = ordinal[by], owner[by]
    bounds = np.searchsorted(owner, np.arange(m + 1))
    paths = [ordinal[i:j] for i, j in zip(bounds[:-1], bounds[1:])]
    turn = sorted(range(m), key=lambda k: paths[k].astype(">u4").tobytes())
    post = owner[np.argsort(ordinal, kind="stable")]
    post_at = np.concatenate([[0], np.cumsum(np.bincount(ordinal, minlength=len(counts)))])
    two = bool(side.any()) and not side.all()
    rank = np.empty(m, np.int64)
    rank[turn] = np.arange(m)

    def common(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        differ = a[:n] != b[:n]
        k = int(differ.argmax()) if n else 0
        return k if n and differ[k] else n

    lcp = [common(paths[a], paths[b]) for a, b in zip(turn, turn[1:])] + [0]
    lcps = np.array(lcp)
    length = np.array([len(paths[k]) for k in turn])
    size = sizes[turn]

    def add(path: np.ndarray, overlap: np.ndarray) -> np.ndarray:
        if not len(path):
            return overlap
        first, stop = post_at[path], post_at[path + 1]
        each = stop - first
        ends = np.cumsum(each)
        index = np.repeat(first - (ends - each), each) + np.arange(ends[-1])
        return overlap + np.bincount(post[index], minlength=m)

    none = np.zeros(0, np.int64)
    left, right, overlaps = [none], [none], [none]
    stack = [(0, np.zeros(m, np.int64))]
    k = 0
    while k < m:
        path, after = paths[turn[k]], lcp[k]
        depth, overlap = stack[-1]
        if after > depth:  # a branch below: may any probe still reach t in it?
            overlap = add(path[depth:after], overlap)
            depth = after
            end = k + 1 + int(np.argmax(np.append(lcps[k + 1 :] < depth, True)))
            rest = int((length[k : end + 1] - depth).max())
            if not (overlap + rest >= t / (1 + t) * (int(size[k : end + 1].min()) + sizes) - 1e-9).any():
                k = min(end, m - 1) + 1
                back = lcp[k - 1] if k <= m else 0
                while stack[-1][0] > back:
                    stack.pop()
                if stack[-1][0] < back:
                    at, known = stack[-1]
                    stack.append((back, add(path[at:back], known)))
                continue
            stack.append((depth, overlap))
        here = turn[k]
        full = add(path[depth:], overlap)
        good = (full >= t * (sizes + sizes[here] - full) - 1e-9) & (full > 0) & ((side != side[here]) if two else True) & (rank > k)
        found = np.flatnonzero(good)
        left.append(np.full(len(found), here))
        right.append(found)
        overlaps.append(full[found])
        while stack[-1][0] > after:
            stack.pop()
        if stack[-1][0] < after:
            at, known = stack[-1]
            stack.append((after, add(path[at:after], known)))
        k += 1
    return np.concatenate(left), np.concatenate(right), np.concatenate(overlaps)


_SETS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("sign", T.LongType()),
    T.StructField("mark", T.LongType()),
    T.StructField("size", T.LongType()),
    T.StructField("prefix", T.ArrayType(T.LongType())),
    T.StructField("grams", T.BinaryType()),
])
_SETS_ARROW = pa.schema([("doc_id", pa.int64()), ("sign", pa.int64()), ("mark", pa.int64()), ("size", pa.int64()), ("prefix", pa.list_(pa.int64())), ("grams", pa.binary())])
_PAIRS = T.StructType([T.StructField("doc_id_a", T.LongType()), T.StructField("doc_id_b", T.LongType()), T.StructField("jaccard", T.DoubleType())])
_PAIRS_ARROW = pa.schema([("doc_id_a", pa.int64()), ("doc_id_b", pa.int64()), ("jaccard", pa.float64())])
_LINKS = T.StructType([T.StructField(c, T.LongType()) for c in ("rep", "sign", "mark", "low", "links")])
_LINKS_ARROW = pa.schema([(c, pa.int64()) for c in ("rep", "sign", "mark", "low", "links")])
#: Two columns of 64 bits that tell sets apart.
_SET = ["sign", "mark"]


def prefix_length(size: np.ndarray, t: float) -> np.ndarray:
    return size - np.ceil(t * size - 1e-9).astype(np.int64) + 1


def marks(grams: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each set, by the sums of hashes of its grams."""
    total = np.zeros((2, len(grams) + 1), np.uint64)
    np.cumsum(mix(grams + np.uint64(0x5851F42D4C957F2D)), out=total[0, 1:])
    np.cumsum(mix(grams * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)), out=total[1, 1:])
    at = np.concatenate([[0], np.cumsum(sizes)])
    return tuple(mix(t[at[1:]] - t[at[:-1]] + sizes.astype(np.uint64)) for t in total)


def candidates(docs: DataFrame, n: int, t: float) -> DataFrame:
    """``(doc_id, sign, mark, size, prefix, grams)`` of the documents whose prefix holds a gram that another document has."""

    def produce(batch: pa.RecordBatch) -> Iterator[tuple[bytes, Columns]]:
        for part, raw, off in slices(batch, "text", SLICE):
            grams, sizes = gram_sets(raw, off, n)
            yield heads_of(part.column(0).to_numpy(zero_copy_only=False), sizes, *marks(grams, sizes)), (grams,)

    def finish(head: bytes, levels: np.ndarray, answers: Columns) -> Iterator[pa.RecordBatch]:
        ids = answers[0]
        doc_ids, sizes, sign, mark = head_parts(head, 4)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        known = np.flatnonzero(levels > 0)
        own = np.bincount(doc[known], minlength=len(sizes))
        need = prefix_length(sizes, t) - (sizes - own)  # grams of its own come first
        kept = (need > 0) & (own > 0)
        known = known[kept[doc[known]]]
        known = known[np.lexsort((ids[known], levels[known], doc[known]))]
        grams, at = ids[known], np.concatenate([[0], np.cumsum(own[kept])])
        spans = list(zip(at[:-1].tolist(), at[1:].tolist(), need[kept].tolist()))
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(c[kept]) for c in (doc_ids, sign, mark, sizes)),
                pa.array([grams[i : min(j, i + p)].view(np.int64) for i, j, p in spans], pa.list_(pa.int64())),
                pa.array([grams[i:j].tobytes() for i, j, _ in spans], pa.binary()),
            ],
            schema=_SETS_ARROW,
        )

    return trade(texts(docs), produce, counted, finish, _SETS, partitions(docs), widths=[5], answers=[5])


def representatives(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Membership ``(sign, mark, doc_id, rep, copies)`` of all sets, saved, and the rows of ``sets`` that stand for others.

    The smallest id of equal sets stands for them.  Counts combine before they are
    shuffled, so a set of which there are very many gathers nowhere.
    """
    narrow = sets.select(*_SET, "doc_id").distinct()
    reps = narrow.groupBy(*_SET).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    members = saved(narrow.join(reps, _SET))
    extra = sized(members.where("doc_id <> rep").select(*_SET, "doc_id"))
    return members, sets.join(extra, [*_SET, "doc_id"], "left_anti")


def blocks(one: DataFrame, members: DataFrame, t: float) -> DataFrame:
    """``(root, i, j, side, rep, sign, mark, copies, size, grams)``: the sets of each block, or of each two parts of a large one.

    Two sets that share a prefix gram get the gram's least document as a common
    neighbour; connected sets make a block.  A block of more than ``PART`` sets is cut
    into parts by classes of size and a hash, so that no task counts or sorts a whole
    block, and two parts meet if sets of their sizes can reach t.
    """
    token = one.select("doc_id", F.explode("prefix").alias("token")).distinct()
    low = token.groupBy("token").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")).where("n > 1").drop("n")
    tied = (components(token.join(low, "token").where("doc_id <> low").select(F.col("doc_id").alias("a"), F.col("low").alias("b"))))
    size_class = (F.floor(F.ln(F.col("size")) / (-0.5 * math.log(t))) if t < 1 else F.col("size")).cast("int")
    placed = one.select(F.col("doc_id").alias("node"), *_SET, "size").distinct().join(tied, "node").withColumn("class", size_class)
    placed = saved(placed.join(members.select(F.col("rep").alias("node"), *_SET, "copies").distinct(), ["node", *_SET]))
    total = F.sum("n").over(Window.partitionBy("root"))  # a row a class of size, no more than a few dozen a block
    sizes = placed.groupBy("root", "class").agg(F.count("*").alias("n"), F.min("size").alias("least"), F.max("size").alias("most")).withColumn("total", total)
    classes = saved(sizes.where(F.col("total") > PART).select("root", "class", F.ceil(F.col("n") / PART).cast("int").alias("parts"), "least", "most"))
    whole = lambda keys: keys.select("node", *_SET, "copies", "root", F.lit("").alias("i"), F.lit("").alias("j"), F.lit(0).alias("side"))
    if classes.isEmpty():
        return _filled(one, whole(placed))
    keys = placed.join(sized(classes.select("root", "class", "parts")), ["root", "class"], "left").withColumn("part", F.pmod(F.xxhash64("node", *_SET), F.coalesce("parts", F.lit(1))).cast("int"))
    each = classes.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    x, y = each.alias("x"), each.alias("y")
    ordered = (F.col("x.class") < F.col("y.class")) | ((F.col("x.class") == F.col("y.class")) & (F.col("x.part") <= F.col("y.part")))
    meets = x.join(y, (F.col("x.root") == F.col("y.root")) & ordered & (F.col("y.least") * t <= F.col("x.most") + 1e-9))
    name = lambda s: F.concat_ws(".", f"{s}.class", f"{s}.part")
    same = (F.col("x.class") == F.col("y.class")) & (F.col("x.part") == F.col("y.part"))
    ends = F.when(same, F.array(F.struct(F.col("x.class"), F.col("x.part"), F.lit(0).alias("side")))).otherwise(F.array(*[F.struct(F.col(f"{s}.class"), F.col(f"{s}.part"), F.lit(k).alias("side")) for k, s in enumerate("xy")]))
    sides = meets.select(F.col("x.root").alias("root"), name("x").alias("i"), name("y").alias("j"), F.inline(ends))
    cut = keys.where("parts IS NOT NULL").join(sides, ["root", "class", "part"]).select("node", *_SET, "copies", "root", "i", "j", "side")
    return _filled(one, whole(keys.where("parts IS NULL")).unionByName(cut))


def _filled(one: DataFrame, keys: DataFrame) -> DataFrame:
    return one.join(keys.withColumnRenamed("node", "doc_id"), ["doc_id", *_SET]).select("root", "i", "j", "side", F.col("doc_id").alias("rep"), *_SET, "copies", "size", "grams")


def _joined(one: DataFrame, members: DataFrame, t: float, pairs: bool) -> DataFrame:
    """All pairs of sets that reach t; or, without ``pairs``, their numbers of links and the least set that each is connected with."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (_, _, _, side, reps, sign, mark, copies, sizes, grams) in runs(batches, 0, 1, 2):
            first = list({(s, *key): k for k, (s, *key) in enumerate(zip(side, reps, sign, mark))}.values())  # a row that stands twice counts once
            ids, sign, mark, copies, sizes, side = (np.array(x, np.int64)[first] for x in (reps, sign, mark, copies, sizes, side))
            a, b, overlap = trie_join(sizes, [np.frombuffer(grams[k], np.uint64) for k in first], side, t)
            if pairs:
                keep = ids[a] != ids[b]
                a, b, overlap = a[keep], b[keep], overlap[keep]
                low, high = np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])
                yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), pa.array(overlap / (sizes[a] + sizes[b] - overlap))], schema=_PAIRS_ARROW)
                continue
            m = len(ids)
            links = np.zeros(m, np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            order = np.argsort(ids, kind="stable")
            rank = np.empty(m, np.int64)
            rank[order] = np.arange(m)
            low = ids[order][spanning(m, rank[a], rank[b])][rank]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, sign, mark, low, links)], schema=_LINKS_ARROW)

    parts = partitions(one)
    spread = blocks(one, members, t).repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j", "side", "rep")
    return arrow_map(spread, join, _PAIRS if pairs else _LINKS)


def jaccard_pairs(docs: DataFrame, n: int = N, t: float = THRESHOLD) -> DataFrame:
    """``(doc_id_a, doc_id_b, jaccard)``: all pairs a < b of different sets of word n-grams that reach t.

    The smallest id of the documents with one set stands for them in these pairs.
    Edge cases are those of ``jaccard_classes``.
    """
    members, one = representatives(saved(candidates(docs, n, t)))
    return _joined(one, members, t, True).groupBy("doc_id_a", "doc_id_b").agg(F.max("jaccard").alias("jaccard"))


def _classes(docs: DataFrame, n: int, t: float) -> tuple[DataFrame, DataFrame]:
    """``(node, root)`` of the documents that have a link, and ``(doc_id, links)`` of those that may have one."""
    members, one = representatives(saved(candidates(docs, n, t)))
    linked = saved(_joined(one, members, t, False))
    ties = linked.select(F.col("rep").alias("a"), F.col("low").alias("b")).unionByName(members.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    counts = linked.groupBy("rep", *_SET).agg(F.sum("links").alias("links"))
    own = members.join(counts, ["rep", *_SET], "left").select("doc_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    return components(ties.where("a <> b")), own.groupBy("doc_id").agg(F.sum("links").alias("links"))


def jaccard_classes(docs: DataFrame, n: int = N, t: float = THRESHOLD) -> DataFrame:
    """``(doc_id, class_id, links)``, one row an id: with how many other documents it reaches t, and the smallest id that a chain of such links leads to.

    Every link counts, those between copies and those between different texts, but
    none becomes a row.  Words are runs of letters and digits without regard to ASCII
    case, and single characters of scripts without spaces.  A text of fewer than n
    words is one gram.  Null and empty texts, and texts without a word, have no
    links and are classes of their own; rows without an id are left out.  Rows that
    repeat an id and a text count once; of those that repeat an id with other texts
    the links add up, those among each other included, and they are one document to
    the classes.  An empty table gives no rows; other columns are not read.
    """
    classes, links = _classes(docs, n, t)
    ids = docs.select(docs["doc_id"].cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    out = ids.join(classes.withColumnRenamed("node", "doc_id"), "doc_id", "left").join(links, "doc_id", "left")
    return out.select("doc_id", F.coalesce("root", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))


def keep_one(docs: DataFrame, n: int = N, t: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` but those that a chain of links ties to a document of smaller id; all columns are kept.

    Rows without an id or a text stay, and so do rows that repeat an id that stays.
    """
    gone = sized(_classes(docs, n, t)[0].where("node <> root").select(F.col("node").alias("gone")))
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document, at a similarity of 0.5 of word 4-grams; edge cases as in ``jaccard_classes``."""
    return jaccard_classes(table(spark, sf_dir, "documents"))


#: Compares all sets by an inverted index of grams that are texts; words as in ``textkit``, by Unicode classes.
SQL = r"""
WITH RECURSIVE t AS (
    SELECT doc_id, regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]\p{M}*)', ' \1 ', 'g') AS text
    FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), d AS (SELECT doc_id, list_filter(regexp_extract_all(text, '[\p{L}\p{M}\p{N}]+|[\p{Sm}\p{Sc}\p{So}]'), lambda x: NOT regexp_matches(x, '^[$+<=>|~]$')) AS w FROM t
), g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS gram FROM d WHERE len(w) > 0
), s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1
), o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM g x JOIN g y USING (gram) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2
), p AS MATERIALIZED (SELECT a, b FROM o JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE o.n >= 0.5 * (x.n + y.n - o.n)
), c AS (SELECT a AS node, a AS other FROM p UNION SELECT c.node, p.b FROM c JOIN p ON p.a = c.other
), k AS (SELECT node, min(other) AS class_id FROM c GROUP BY 1
), l AS (SELECT a AS node, count(*) AS links FROM p GROUP BY 1)
SELECT doc_id, coalesce(class_id, doc_id)::BIGINT AS class_id, coalesce(links, 0)::BIGINT AS links FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) LEFT JOIN k ON k.node = doc_id LEFT JOIN l ON l.node = doc_id
"""
