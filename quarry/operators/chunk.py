"""Splitting of lines that are too long."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..runtime import reachable  # noqa: F401 - callers need it for the UDF

_CLUSTER = regex.compile(r"\X")
_STOPS = frozenset(".,;:!?)]}")
_BREAK = re.compile(r"(?s).*[\s.,;:!?)\]}]")


def _plain_chunks(text: str, most: int) -> list[str]:
    """``chunks`` of ASCII text, in which each character is a cluster of one byte."""
    out, start, last = [], 0, len(text)
    while start < last:
        found = _BREAK.match(text, start, min(start + most, last - 1))
        end = found.end() if found else min(start + most, last)
        out.append(text[start:end])
        start = end
    return out


def chunks(text: str, most: int) -> list[str] | None:
    """Pieces of at most ``most`` UTF-8 bytes between grapheme clusters; None if a cluster is larger.

    A piece ends after the last white space or punctuation that fits, unless that
    is the text's end; else after the last cluster that fits.
    """
    if most <= 0:
        return None
    if len(text.encode("utf-8")) <= most:
        return [text]
    if text.isascii() and "\r\n" not in text:
        return _plain_chunks(text, most)
    clusters = _CLUSTER.findall(text)
    sizes = [len(c.encode("utf-8")) for c in clusters]
    if max(sizes) > most:
        return None
    breaks = [c.isspace() or c[-1] in _STOPS for c in clusters]
    out, start, last = [], 0, len(clusters)
    while start < last:
        end = room = start
        size, good = 0, 0
        while room < last and size + sizes[room] <= most:
            size += sizes[room]
            room += 1
            if breaks[room - 1] and room < last:
                good = room
        end = good or room
        out.append("".join(clusters[start:end]))
        start = end
    return out


def chunk_column(text: Column, most: int) -> Column:
    """``chunks`` as an array, in Arrow batches; lines that are short enough cross to Python as nulls.

    The function isn't declared deterministic, so that no filter repeats it.
    """
    if most <= 0:
        return F.lit(None).cast("array<string>")

    @pandas_udf("array<string>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if t is None else chunks(t, most) for t in batch], batch.index, object)

    long = F.octet_length(text) > most
    return F.when(~long, F.array(text)).when(long, cut.asNondeterministic()(F.when(long, text)))
