"""What a run writes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import bucket_stem
from ..operators.classify import BUCKET, order
from ..runtime import write_text


def write_fixed(outputs: DataFrame, path: str) -> None:
    """All kept lines as text, in the order of path, line and chunk, over as many files as the sort has partitions."""
    outputs.orderBy("path", "line_number", "chunk_index").select(F.col("text").alias("value")).write.mode("overwrite").text(path)


def write_shards(classified: DataFrame, path: str) -> DataFrame:
    """Kept lines in a folder a bucket, and the same rows read back from there; large buckets are written by several tasks."""
    classified.hint("rebalance", *BUCKET).write.mode("overwrite").partitionBy(*BUCKET).parquet(path)
    # With the schema given, buckets named like numbers stay strings.
    return classified.sparkSession.read.schema(classified.schema).parquet(path).select(*classified.columns)


def write_issues(issues: DataFrame, path: str) -> None:
    """The issue log as JSON lines, without fields that are null."""
    issues.write.mode("overwrite").json(path)


def write_parts(parts: DataFrame, path: str) -> list[str]:
    """Training parts, a folder of text a part, in shuffled order; the folders' names.

    One trailing carriage return a line goes.  A part is one task's sort, so
    ``max_part_lines`` bounds it.
    """
    named = parts.withColumn("file", bucket_stem("train", F.col("part"))).withColumn("value", F.regexp_replace("text", "\r\\z", ""))
    count = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named.repartition(count, "file").sortWithinPartitions("file", "position").select("file", "value").write.mode("overwrite").partitionBy("file").text(path)
    return sorted(f"{path}/file={r['file']}" for r in named.select("file").distinct().collect())


def write_report(report: DataFrame, files: list[str], path: str) -> dict:
    """The balance report as JSON, buckets in bucket order; it has a row a bucket."""
    rows = [{"bucket": {k: r[k] for k in BUCKET}, "input_lines": r["input_lines"], "target_lines": r["target_lines"], "output_lines": r["output_lines"], "training_files": [f for f in files if f"file={r['stem']}" in f]} for r in report.withColumn("stem", F.regexp_extract(bucket_stem("train", F.lit(0)), "^(.*)-part_", 1)).orderBy(*order()).collect()]
    out = {"training_files": files, "report": path, "input_lines": sum(r["input_lines"] for r in rows), "output_lines": sum(r["output_lines"] for r in rows), "buckets": rows}
    return write_json(out, path)


def write_json(value: dict, path: str) -> dict:
    write_text(path, json.dumps(value, ensure_ascii=False, indent=2) + "\n")
    return value
