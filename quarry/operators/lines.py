"""Lines of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_lines(text: Column) -> Column:
    """Parts between ``\\n``; a text's last line break opens no further line."""
    parts = F.split(F.when(text.endswith("\n"), F.substring(text, F.lit(1), F.char_length(text) - 1)).otherwise(text), "\n")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(parts)


def without_return(line: Column) -> Column:
    """The line without one trailing ``\\r``."""
    return F.when(line.endswith("\r"), F.substring(line, F.lit(1), F.char_length(line) - 1)).otherwise(line)


#: Columns of a file that its lines keep.
HINTS = ["language_hint", "source_group"]


def kept(df: DataFrame) -> list[str]:
    return [c for c in HINTS if c in df.columns]


def lines(files: DataFrame, text: str = "text") -> DataFrame:
    """``path, line_number, line`` for the lines of ``path, text``, numbered from 1; nulls have no lines.

    Path hints that ``files`` has already go along.
    """
    numbered = files.select("path", *kept(files), F.posexplode(split_lines(F.col(text))).alias("n", "line"))
    return numbered.select("path", *kept(files), (F.col("n") + 1).cast("long").alias("line_number"), without_return(F.col("line")).alias("line"))


def raw_lines(files: DataFrame, content: str = "content") -> DataFrame:
    """``path, line_number, bytes`` of binary contents, split at the byte 0x0A; bytes need not be UTF-8.

    Latin-1 gives every byte one character, so the split is exact and stays in the JVM.
    """
    parts = lines(files.select("path", *kept(files), F.decode(F.col(content), "ISO-8859-1").alias("text")))
    return parts.select("path", *kept(files), "line_number", F.encode("line", "ISO-8859-1").alias("bytes"))
