"""Exact dedup by sorting contents.

Texts are normalised, range-partitioned by splitters that Spark samples from
them, and sorted externally; equals are then neighbours, and each text is
compared with the one before it, in full.  Of equal texts the row with the
smallest identifier stays.  Range partitioning already clusters equal texts, so
the window below adds no further exchange.  Copies that a task reads close together
are dropped before they are sent, so a text of which there are very many doesn't
gather in full in one range.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import arrow_map
from .frames import free, table

#: White space that normalisation turns into single spaces.
SPACE = "\t\n\r\f\v"
#: Characters of a content that its splitter holds.
HEAD = 16
#: Bytes of contents among which a task drops copies before they are sent.
SLICE = 8 << 20


def normalised(text: Column) -> Column:
    """The text with runs of white space as one space and none at its ends."""
    flat = F.translate(text, SPACE, " " * len(SPACE))
    return F.trim(F.when(F.contains(flat, F.lit("  ")), F.regexp_replace(flat, " {2,}", " ")).otherwise(flat))


def _combined(docs: DataFrame, key: str, id_col: str) -> DataFrame:
    """The rows of ``docs`` without those that have an equal last column ``key`` and a smaller id among the rows read with them; and without ``key``."""
    at = docs.columns.index(id_col)

    def leave(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        code = rows.column(rows.num_columns - 1).cast(pa.large_string()).combine_chunks().dictionary_encode()
        code = (code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code).indices
        if pc.max(code).as_py() + 1 < len(code):
            order = pc.sort_indices(pa.table({"code": code, "id": rows.column(at)}), [("code", "ascending"), ("id", "ascending")], null_placement="at_end")
            ranked = code.take(order)
            fresh = pa.concat_arrays([pa.array([True]), pc.not_equal(ranked[1:], ranked[:-1])])
            kept = order.filter(fresh)
            rows = rows.take(kept.take(pc.sort_indices(kept)))
        yield from rows.select(range(rows.num_columns - 1)).to_batches(1000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(batch.num_columns - 1).nbytes
            if size >= SLICE:
                yield from leave(held)
                held, size = [], 0
        if any(b.num_rows for b in held):
            yield from leave(held)

    return arrow_map(docs, run, docs.drop(key).schema)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without all but one of each group of equal normalised texts, in the same columns.

    Of a group the smallest id stays; a null id counts as larger than any other.
    Of rows that agree in text and id one stays.  Texts that are null have no
    content to compare, and all stay; empty texts equal each other.  An empty
    table stays empty, and columns of any name stay as they are.
    """
    head, hashed, key, number = free(docs, "head", "hash", "content", "number")
    # Splitters come from the first bytes and a hash of the whole content: a sample of whole texts would
    # weigh on the driver, and contents that only begin alike need not fall into one range.
    content = normalised(F.col(f"`{text_col}`"))
    split = docs.where(docs[text_col].isNotNull()).withColumn(key, content)
    split = split.withColumns({head: F.substring(F.col(key), 1, HEAD), hashed: F.xxhash64(key)}).select(*[F.col(f"`{c}`") for c in docs.columns], head, hashed, key)
    spread = _combined(split, key, id_col).repartitionByRange(head, hashed).withColumn(key, content)
    order = Window.partitionBy(head, hashed, key).orderBy(F.col(f"`{id_col}`").asc_nulls_last())
    first = spread.withColumn(number, F.row_number().over(order)).where(F.col(number) == 1).drop(head, hashed, key, number)
    return first.unionByName(docs.where(docs[text_col].isNull()))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of the documents that stay; edge cases as in ``drop_copies``."""
    return drop_copies(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id")


SQL = r"""
WITH d AS (
    SELECT doc_id, text, trim(regexp_replace(translate(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' +', ' ', 'g')) AS content FROM documents
), r AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id NULLS LAST) AS n FROM d)
SELECT doc_id FROM r WHERE n = 1 OR text IS NULL
"""
