"""Hashed keys traded between the slices of a corpus and the buckets that settle them.

A key never becomes a row.  Texts are cut into slices of about half a megabyte; a
slice sends its keys, a few bytes each, to buckets by their leading bits, one blob a
bucket (several slices together where buckets are many).  Keys that repeat among
what is sent together go once, with how often they stand, so a key that stands
everywhere costs its bucket one entry a sending.  A bucket settles its keys with a
sort and answers each sending with a byte a key and, where that isn't 0, a few more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import arrow_map

#: Bytes of text in a slice; it bounds the memory of a step, not what is read.
SLICE = 1 << 19
#: Keys a bucket that slices are gathered for before they are sent, so that many buckets don't make blobs of one key.
FULL = 16

Columns = tuple[np.ndarray, ...]
#: Takes one Arrow batch, yields for each slice a head of its own and its keys, as columns of 64 bits.
Produce = Callable[[pa.RecordBatch], Iterator[tuple[bytes, Columns]]]
#: Takes the columns of a bucket's keys and how often each stands, gives a level for each and columns of answers.
Settle = Callable[[Columns, np.ndarray], tuple[np.ndarray, Columns]]
#: Takes a head, and for every key, in the same order, its level and its answers (0 where the level is).
Finish = Callable[[bytes, np.ndarray, Columns], Iterator[pa.RecordBatch]]

_SENT = T.StructType([
    T.StructField("slice", T.LongType()),
    T.StructField("route", T.IntegerType()),
    T.StructField("head", T.BinaryType()),
    T.StructField("blob", T.BinaryType()),
])
_SENT_ARROW = pa.schema([("slice", pa.int64()), ("route", pa.int32()), ("head", pa.binary()), ("blob", pa.binary())])
_LOCAL = np.uint64(40)


def partitions(df: DataFrame) -> int:
    """The session's shuffle partitions, which should grow with the input: a task holds half of its keys at a time."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def level_of(count: np.ndarray) -> np.ndarray:
    """0 for a key that stands once, else a number from 4 that grows with the logarithm of its count."""
    return np.minimum(255, np.floor(4 * np.log2(count))).astype(np.uint8)


def pack(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack(blob: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(blob) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8).reshape(-1, width)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def runs(batches: Iterator[pa.RecordBatch], *keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """The rows of each run of equal values in the columns ``keys``, as lists of columns; the input is sorted by them."""
    now, rows = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            key = tuple(row[k] for k in keys)
            if key != now:
                if rows:
                    yield now, [list(c) for c in zip(*rows)]
                now, rows = key, []
            rows.append(row)
    if rows:
        yield now, [list(c) for c in zip(*rows)]


def sorting(columns: Columns) -> np.ndarray:
    """The order that sorts rows by all columns."""
    return np.argsort(columns[0]) if len(columns) == 1 else np.lexsort(columns[::-1])


def changes(columns: Columns, order: np.ndarray) -> np.ndarray:
    """Which rows differ from the one before, in an order that sorts them."""
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for c in columns:
        ranked = c[order]
        fresh[1:] |= ranked[1:] != ranked[:-1]
    return fresh


def trade(df: DataFrame, produce: Produce, settle: Settle, finish: Finish, schema: T.StructType, parts: int, widths: Sequence[int], answers: Sequence[int], keys: int = 1, hashed: bool = True) -> DataFrame:
    """``finish`` applied to every slice that ``produce`` makes of ``df``, with what the buckets answer.

    ``widths`` and ``answers`` are the bytes that are kept of each column.  The first
    ``keys`` columns make a key; of rows with one key the least goes to the bucket.
    The bucket is told by the leading 24 bits of the first column if it is ``hashed``,
    else it is what stands beyond its 40 lowest bits: a first answer of five bytes
    gets its bucket added there, so it can be the first column of another trade.

    ``df`` should read a table or a file: slices are numbered by partition, so a
    partition that is computed again must have the same rows in the same order.
    """
    buckets = 2 * parts
    known_type = np.uint16 if buckets <= 65536 else np.uint32

    def sent(number: int, slices: list[tuple[bytes, Columns]]) -> pa.RecordBatch:
        columns = tuple(np.concatenate(c) for c in zip(*(c for _, c in slices)))
        route = (columns[0] >> _LOCAL) if not hashed else (columns[0] >> _LOCAL) * np.uint64(buckets) >> np.uint64(24)
        order = sorting(columns)
        fresh = changes(columns[:keys], order)
        starts = np.flatnonzero(fresh)
        n = len(order)
        first = np.zeros(n, bool)
        first[order[starts]] = True
        times = np.ones(n, np.int64)
        times[order[starts]] = np.diff(np.append(starts, n))
        again = np.flatnonzero(~first)
        source = np.empty(n, np.int64)
        source[order] = order[starts][np.cumsum(fresh) - 1]
        head = b"".join([
            np.array([len(slices), *(x for h, c in slices for x in (len(h), len(c[0])))], np.int64).tobytes(), *(h for h, _ in slices),
        ])
        known = route[first].astype(known_type)
        by = np.flatnonzero(first)[np.argsort(known, kind="stable")]
        used, at = np.unique(route[by].astype(np.int64), return_index=True)
        sorted_columns = [c[by] for c in columns]
        times = times[by]
        blobs = []
        for i, j in zip(at.tolist(), [*at[1:].tolist(), len(by)]):
            many = np.flatnonzero(times[i:j] > 1)
            blobs.append(b"".join([
                np.array([j - i, len(many)], np.uint32).tobytes(), *(pack(c[i:j], w) for c, w in zip(sorted_columns, widths)),
                many.astype(np.uint32).tobytes(), times[i:j][many].astype(np.uint32).tobytes(),
            ]))
        places = b"".join([np.array([n, len(again)], np.int64).tobytes(), again.astype(np.uint32).tobytes(), source[again].astype(np.uint32).tobytes(), known.tobytes()])
        rows = [
            pa.array(np.full(len(blobs) + 1, number)),
            pa.array(np.append(used, number % buckets).astype(np.int32)),
            pa.array([None] * len(blobs) + [head], pa.binary()),
            pa.array([*blobs, places], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(rows, schema=_SENT_ARROW)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting, held = [], 0
        for batch in batches:
            for head, columns in produce(batch):
                waiting.append((head, columns))
                held += len(columns[0])
                if held >= FULL * buckets:
                    yield sent(number, waiting)
                    number += 1
                    waiting, held = [], 0
        if waiting:
            yield sent(number, waiting)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (route,), (slices, _, heads, blobs) in runs(batches, 1):
            mine = [i for i, h in enumerate(heads) if h is None]
            sizes = [np.frombuffer(blobs[i], np.uint32, 2).tolist() for i in mine]
            columns, at = [], [8] * len(mine)
            for w in widths:
                columns.append(unpack(b"".join(blobs[i][a : a + w * n] for i, a, (n, _) in zip(mine, at, sizes)), w))
                at = [a + w * n for a, (n, _) in zip(at, sizes)]
            times, base = np.ones(sum(n for n, _ in sizes), np.int64), 0
            for i, a, (n, m) in zip(mine, at, sizes):
                if m:
                    times[base + np.frombuffer(blobs[i], np.uint32, m, a)] = np.frombuffer(blobs[i], np.uint32, m, a + 4 * m)
                base += n
            levels, replies = settle(tuple(columns), times) if len(times) else (np.zeros(0, np.uint8), ())
            base, given = 0, {}
            for i, (n, _) in zip(mine, sizes):
                own = levels[base : base + n]
                given[i] = own.tobytes() + b"".join(pack(r[base : base + n][own > 0], w) for r, w in zip(replies, answers))
                base += n
            each = [blobs[i] if h is not None else given[i] for i, h in enumerate(heads)]
            routes = [-1 if h is not None else route for h in heads]
            yield pa.RecordBatch.from_arrays([pa.array(slices, pa.int64()), pa.array(routes, pa.int32()), pa.array(heads, pa.binary()), pa.array(each, pa.binary())], schema=_SENT_ARROW)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (_, routes, heads, blobs) in runs(batches, 0):
            n, m = np.frombuffer(blobs[0], np.int64, 2).tolist()
            again, source = np.frombuffer(blobs[0], np.uint32, m, 16), np.frombuffer(blobs[0], np.uint32, m, 16 + 4 * m)
            known = np.frombuffer(blobs[0], known_type, n - m, 16 + 8 * m)
            first = np.ones(n, bool)
            first[again] = False
            order = np.flatnonzero(first)[np.argsort(known, kind="stable")]
            sizes = np.bincount(known, minlength=buckets)
            levels, replies = np.zeros(n, np.uint8), tuple(np.zeros(n, np.uint64) for _ in answers)
            at = 0
            for route, blob in zip(routes[1:], blobs[1:]):
                size = int(sizes[route])
                own = np.frombuffer(blob, np.uint8, size)
                where = order[at : at + size]
                levels[where] = own
                where, start = where[own > 0], size
                for k, (r, w) in enumerate(zip(replies, answers)):
                    r[where] = unpack(blob[start : start + w * len(where)], w) | (np.uint64(route) << _LOCAL if not k and w == 5 else np.uint64(0))
                    start += w * len(where)
                at += size
            levels[again] = levels[source]
            for r in replies:
                r[again] = r[source]
            count = int(np.frombuffer(heads[0], np.int64, 1)[0])
            lengths = np.frombuffer(heads[0], np.int64, 2 * count, 8).reshape(count, 2).tolist()
            at, start = 8 + 16 * count, 0
            for size, many in lengths:
                yield from finish(heads[0][at : at + size], levels[start : start + many], tuple(r[start : start + many] for r in replies))
                at, start = at + size, start + many

    routed = arrow_map(df, send, _SENT).repartition(parts, "route").sortWithinPartitions("route", "slice")
    settled = arrow_map(routed, answer, _SENT).repartition(parts, "slice").sortWithinPartitions("slice", "route")
    return arrow_map(settled, collect, schema)


def counted(columns: Columns, times: np.ndarray) -> tuple[np.ndarray, Columns]:
    """A settlement: the level of each key's count, and the key itself."""
    order = sorting(columns)
    fresh = changes(columns, order)
    starts = np.flatnonzero(fresh)
    total = np.add.reduceat(times[order], starts)
    levels = np.empty(len(order), np.uint8)
    levels[order] = np.repeat(level_of(total), np.diff(np.append(starts, len(order))))
    return levels, columns


def numbered(columns: Columns, times: np.ndarray) -> tuple[np.ndarray, Columns]:
    """A settlement: 1 for a key that stands again, 0 for others; and the key's number in the order of the bucket's keys."""
    order = sorting(columns)
    fresh = changes(columns, order)
    starts = np.flatnonzero(fresh)
    total = np.add.reduceat(times[order], starts)
    each = np.cumsum(fresh) - 1
    levels, numbers = np.empty(len(order), np.uint8), np.empty(len(order), np.uint64)
    levels[order] = (total > 1)[each]
    numbers[order] = each
    return levels, (numbers,)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names; rows without an id or a text are left out."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())


def heads_of(*columns: np.ndarray) -> bytes:
    return np.concatenate([np.asarray(c).astype(np.int64, copy=False) if c.dtype != np.uint64 else c.view(np.int64) for c in columns]).tobytes()


def head_parts(head: bytes, columns: int) -> list[np.ndarray]:
    return np.split(np.frombuffer(head, np.int64), columns)
