"""Repeated passages by bucket-pointer refinement.

Suffixes begin at every word.  Their initial buckets are those of their first q
words; a bucket's pointer is its number in the order of all q-grams of one route.
A suffix can only repeat for ``words`` words if it stands in a run of places whose
buckets all hold others, so shorter runs leave.  The buckets of the others are
refined by sorting: first on the pointers q words on, then, within what is still
together, on those 2q words on, and so forth up to the last q of the words; every
step sorts on the pointers that the step before has just renewed.  What is together
at the end shares all words, up to q-grams that agree in a hash of 64 bits while
the other q-grams of both windows agree as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import arrow_map
from .census import SLICE, Columns, head_parts, heads_of, numbered, partitions, texts, trade
from .frames import free, saved, table
from .textkit import slices, words_of

Q, WORDS = 13, 50

_PACKET = T.StructType([T.StructField(c, T.BinaryType()) for c in ("docs", "starts", "lengths", "pointers")])
_PACKET_ARROW = pa.schema([(c, pa.binary()) for c in ("docs", "starts", "lengths", "pointers")])
_SPANS = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "start_word", "end_word", "first_doc_id")])
_SPANS_ARROW = pa.schema([(c, pa.int64()) for c in ("doc_id", "start_word", "end_word", "first_doc_id")])
#: Makes the order of signed ids that of unsigned numbers.
_SIGN = np.uint64(1 << 63)


def later_offsets(words: int, q: int) -> list[int]:
    """Where the q-grams begin that cover, with the one at 0, a window of ``words`` words."""
    return [*range(q, words - q, q), words - q] if words > q else []


def first_buckets(docs: DataFrame, words: int, q: int, parts: int) -> DataFrame:
    """Runs of at least ``words - q + 1`` places whose q-grams all stand again, with the pointers of their buckets."""
    need = words - q + 1

    def produce(batch: pa.RecordBatch) -> Iterator[tuple[bytes, Columns]]:
        for part, raw, off in slices(batch, "text", SLICE):
            w = words_of(raw, off, exact=True)
            sizes = np.maximum(np.diff(w.bounds) - q + 1, 0)
            yield heads_of(part.column(0).to_numpy(zero_copy_only=False), sizes), (w.gram_hash(w.gram_starts(q), q),)

    def finish(head: bytes, levels: np.ndarray, answers: Columns) -> Iterator[pa.RecordBatch]:
        docs, sizes = head_parts(head, 2)
        begins = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(docs)), sizes)
        at = np.flatnonzero(levels)
        if not len(at):
            return
        fresh = np.append(True, (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]]))
        first = np.flatnonzero(fresh)
        lengths = np.diff(np.append(first, len(at)))
        kept = lengths >= need
        if not kept.any():
            return
        start, lengths = at[first[kept]], lengths[kept]
        own = owner[start]
        pointers = answers[0][np.repeat(start - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())]
        row = [docs[own].tobytes(), (start - begins[own]).tobytes(), lengths.tobytes(), pointers.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in row], schema=_PACKET_ARROW)

    return trade(texts(docs), produce, numbered, finish, _PACKET, parts, widths=[8], answers=[5])


def refined(columns: Columns) -> np.ndarray:
    """New pointers of suffixes, given by those of their q-grams at 0 and at the later offsets.

    A pointer is the place of a bucket's first suffix in the order so far.  Only
    buckets that hold several suffixes are sorted on, by the pointers at the next
    offset; their new pointers are what the next sort starts from.
    """
    order = np.argsort(columns[0], kind="stable")
    pointer = np.empty(len(order), np.int64)

    def renew(at: np.ndarray, where: np.ndarray, *keys: np.ndarray) -> np.ndarray:
        """Pointers of the suffixes ``at``, which stand at the places ``where`` of the order, sorted by the keys; which of them are together with others."""
        fresh = np.zeros(len(at), bool)
        fresh[:1] = True
        for k in keys:
            fresh[1:] |= k[1:] != k[:-1]
        first = np.flatnonzero(fresh)
        pointer[at] = where[first][np.cumsum(fresh) - 1]
        return np.repeat(np.diff(np.append(first, len(at))) > 1, np.diff(np.append(first, len(at))))

    where = np.arange(len(order))
    tied = renew(order, where, columns[0][order])
    for later in columns[1:]:
        where = where[tied]
        if not len(where):
            break
        at = order[where]
        at = at[np.lexsort((later[at], pointer[at]))]
        order[where] = at
        tied = renew(at, where, pointer[at].copy(), later[at])
    return pointer


def repeated_spans(docs: DataFrame, words: int = WORDS, q: int = Q, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start_word, end_word, first_doc_id)``: maximal spans whose every window of ``words`` words stands earlier too.

    Words are runs without ASCII white space, compared byte for byte; ``end_word``
    is exclusive.  Occurrences are ordered by document id and place; the first one
    isn't listed but named by ``first_doc_id``, which may be the document itself.
    A span ends where its first occurrence changes to another document.  Rows
    without an id or a text, and texts shorter than ``words``, have no spans.  Rows
    that repeat an id have their spans listed each, but occurrences at one place of
    rows of one id count as one.  Empty tables give no rows, and other columns are
    not read.
    """
    q = min(q, words)
    offsets = later_offsets(words, q)
    parts = partitions(docs)
    packets = saved(first_buckets(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")), words, q, parts))
    n = 1 + len(offsets)

    def produce(batch: pa.RecordBatch) -> Iterator[tuple[bytes, Columns]]:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            docs, starts, lengths = (np.frombuffer(x, np.int64) for x in row[:3])
            pointers = np.frombuffer(row[3], np.uint64)
            windows = lengths - (words - q)
            local = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
            at = np.repeat(np.cumsum(lengths) - lengths, windows) + local
            ids = np.repeat(docs, windows).view(np.uint64) ^ _SIGN
            places = (np.repeat(starts, windows) + local).astype(np.uint64)
            yield heads_of(docs, starts, windows), (pointers[at], *(pointers[at + o] for o in offsets), ids, places)

    def settle(columns: Columns, times: np.ndarray) -> tuple[np.ndarray, Columns]:
        pointer = refined(columns[:n])
        ids, places = columns[n:]
        order = np.lexsort((places, ids, pointer))
        fresh = np.append(True, pointer[order][1:] != pointer[order][:-1])
        starts = np.flatnonzero(fresh)
        each = np.cumsum(fresh) - 1
        levels, first, place = np.empty(len(order), np.uint8), np.empty(len(order), np.uint64), np.empty(len(order), np.uint64)
        levels[order] = (np.add.reduceat(times[order], starts) > 1)[each]
        first[order], place[order] = ids[order[starts]][each], places[order[starts]][each]
        return levels, (first, place)

    def finish(head: bytes, levels: np.ndarray, answers: Columns) -> Iterator[pa.RecordBatch]:
        docs, starts, windows = head_parts(head, 3)
        own = np.repeat(docs, windows)
        run = np.repeat(np.arange(len(docs)), windows)
        places = np.repeat(starts - (np.cumsum(windows) - windows), windows) + np.arange(len(own))
        firsts, first_places = (answers[0] ^ _SIGN).view(np.int64), answers[1].astype(np.int64)
        at = np.flatnonzero((levels > 0) & ((firsts != own) | (first_places != places)))
        own, run, places, firsts = own[at], run[at], places[at], firsts[at]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (run[1:] != run[:-1]) | (places[1:] > places[:-1] + 1) | (firsts[1:] != firsts[:-1])
        at = np.flatnonzero(fresh)
        last = np.append(at[1:], len(own)) - 1
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (own[at], places[at], places[last] + words if len(at) else places, firsts[at])], schema=_SPANS_ARROW)

    return trade(packets, produce, settle, finish, _SPANS, parts, widths=[5] + [8] * len(offsets) + [8, 4], answers=[8, 4], keys=n, hashed=False)


def without_repeats(docs: DataFrame, words: int = WORDS, q: int = Q) -> DataFrame:
    """``docs`` with all but the first of each repeated passage cut out of ``text``; other columns and rows stay as they are.

    Rows are numbered first, and passages are first by these numbers, so rows that
    repeat an id, or have none, are told apart.  Null texts stay null.
    """
    number, found = free(docs, "number", "spans")
    rows = saved(docs.withColumn(number, F.monotonically_increasing_id()))
    spans = repeated_spans(rows, words, q, number).groupBy(F.col("doc_id").alias("at")).agg(F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias("cuts"))
    schema = docs.schema
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(len(names)).to_pylist()
            out = batch.column(names.index("text")).to_pylist()
            for k, (text, found) in enumerate(zip(out, spans)):
                if text is None or not found:
                    continue
                data = text.encode()
                w = words_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]), exact=True)
                keep = np.ones(len(data), bool)
                for s in found:
                    keep[w.start[s["start_word"]] : w.end[s["end_word"] - 1]] = False
                out[k] = np.frombuffer(data, np.uint8)[keep].tobytes().decode()
            columns = [pa.array(out, pa.string()) if n == "text" else c for n, c in zip(names, batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    joined = rows.join(spans, rows[number] == spans["at"], "left").select(*[rows[c] for c in names], spans["cuts"].alias(found))
    return arrow_map(joined, cut, schema)


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of 50 words or more of all documents that stand earlier too; edge cases as in ``repeated_spans``."""
    return repeated_spans(table(spark, sf_dir, "documents"))


#: Windows are compared as texts; no hash takes part.
SQL = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(text, '[\t\n\r\f\v ]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), p AS (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS place FROM d WHERE len(w) >= 50
), g AS (SELECT doc_id, place, array_to_string(w[place + 1:place + 50], ' ') AS content FROM p
), f AS (SELECT doc_id, place, first_value(doc_id) OVER o AS first_doc_id, row_number() OVER o AS n FROM g WINDOW o AS (PARTITION BY content ORDER BY doc_id, place)
), r AS (SELECT *, place - row_number() OVER (PARTITION BY doc_id, first_doc_id ORDER BY place) AS island FROM f WHERE n > 1)
SELECT doc_id, min(place)::BIGINT AS start_word, (max(place) + 50)::BIGINT AS end_word, first_doc_id FROM r GROUP BY doc_id, first_doc_id, island
"""
