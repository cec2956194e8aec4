"""Reports beside the balance report, and a streaming run over a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import effective
from ..functions import text as T
from ..runtime import scratch
from ..streaming import latest_counts, read_stream, running_counts

#: Lines that each rule of canonicalization touches.
AXES = {
    "byte_order_mark": lambda t: F.contains(t, F.lit(T.BOM)),
    "zero_width_space": lambda t: F.contains(t, F.lit(T.ZWSP)),
    "no_break_space": lambda t: F.contains(t, F.lit(T.NBSP)),
    "soft_hyphen": lambda t: F.contains(t, F.lit(T.SHY)),
    "arabic_forms": lambda t: F.regexp_replace(t, T.BOM, "").rlike(T.ARABIC),
    "combining_marks": lambda t: t.rlike("[\\x{300}-\\x{36F}]"),
}
AXES_SQL = """
SELECT split_part(path, '/', 2) AS source, axis, count(*) FILTER (hit) AS lines FROM (
    SELECT path, unnest(['byte_order_mark', 'zero_width_space', 'no_break_space', 'soft_hyphen', 'arabic_forms', 'combining_marks']) AS axis,
        unnest([contains(line, chr(65279)), contains(line, chr(8203)), contains(line, chr(160)), contains(line, chr(173)), FORM <> '', contains(line, chr(769))]) AS hit FROM lines)
GROUP BY ALL"""


def axes(lines: DataFrame) -> DataFrame:
    """Lines that each rule touches, by the second part of the path; one pass, then unpivoted."""
    counted = lines.groupBy(F.split("path", "/")[1].alias("source")).agg(*[F.count_if(rule(F.col("line"))).alias(name) for name, rule in AXES.items()])
    return counted.unpivot("source", list(AXES), "axis", "lines")


def rollup(classified: DataFrame) -> DataFrame:
    """Line counts at three depths of the bucket key."""
    return classified.rollup("domain", "script", "language_hint").agg(F.count("*").alias("lines"))


def streamed(lines: DataFrame) -> DataFrame:
    """Lines written as text files, read as a stream, repaired and counted by what doesn't depend on the files' names.

    Returns when the stream has taken all files, however long that is; its failure is raised.
    """
    spark = lines.sparkSession
    at = scratch(spark)
    lines.select(F.col("line").alias("value")).write.text(f"{at}/in")
    config = effective({"corpus": {"path": at}, "output": {"work_dir": at, "model_prefix": "m"}})

    query = running_counts(read_stream(spark, f"{at}/in"), config, at).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return latest_counts(spark, at).groupBy("domain", "script", "length_bin").agg(F.sum("lines").alias("lines"))
