"""Buckets of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

BUCKET = ["domain", "script", "language_hint", "source_group", "length_bin"]


def path_hints(files: DataFrame, root: str | None = None) -> DataFrame:
    """``files`` with ``language_hint`` and ``source_group`` from the path (below ``root``, if given); do it before lines are made."""
    path = T.relative_path(F.col("path"), root) if root else F.col("path")
    tokens = T.path_tokens(F.coalesce(path, F.lit("")))
    return files.withColumns({"language_hint": T.language_hint(tokens), "source_group": T.source_group(tokens)})


def by_text(lines: DataFrame) -> DataFrame:
    """``lines`` with those columns of BUCKET that their texts tell."""
    text = F.col("text")
    return lines.withColumns({"domain": T.domain(text), "script": T.dominant_script(text), "length_bin": T.length_bin(text)})


def classify(lines: DataFrame, root: str | None = None) -> DataFrame:
    """``lines`` with the five columns of BUCKET."""
    return by_text(lines if "language_hint" in lines.columns else path_hints(lines, root))


def order() -> list[Column]:
    """Bucket order: text before math, short before normal before long."""
    return [F.when(F.col("domain") == "text", 0).otherwise(1), F.col("script"), F.col("language_hint"), F.col("source_group"), F.when(F.col("length_bin") == "short", 0).when(F.col("length_bin") == "normal", 1).otherwise(2)]


def counts(classified: DataFrame) -> DataFrame:
    """Lines by bucket."""
    return classified.groupBy(*BUCKET).agg(F.count("*").alias("lines"))
