"""The stateless operators over unbounded input, and running counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..config import Config
from ..operators.classify import BUCKET, by_text, classify, path_hints
from ..operators.repair import outputs, process
from ..runtime import file_system

_COUNTS = ", ".join(f"{c} string" for c in BUCKET) + ", lines bigint"


def read_stream(spark: SparkSession, path: str, files_a_batch: int = 1000) -> DataFrame:
    """``path, line_number, line`` of text files as they arrive.

    Files are split over tasks, so lines carry no number of their own; the hash of
    the line stands in for it.
    """
    read = spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", files_a_batch).option("recursiveFileLookup", "true").text(path)
    return read.select(F.col("_metadata.file_path").alias("path"), F.xxhash64("value").alias("line_number"), F.regexp_replace("value", "\r\\z", "").alias("line"))


def repaired(lines: DataFrame, config: Config, root: str | None = None) -> DataFrame:
    """Repaired, classified lines of a stream (or a table) of lines."""
    return classify(outputs(process(lines, config)), root)


def bucket_counts(lines: DataFrame, config: Config, root: str | None = None) -> DataFrame:
    """Line counts by bucket of a table or a batch of a stream; a path is looked at once a file and kind of line, not once a line."""
    rows = by_text(outputs(process(lines, config)))
    by_file = rows.groupBy("path", "domain", "script", "length_bin").agg(F.count("*").alias("lines"))
    return path_hints(by_file, root).groupBy(*BUCKET).agg(F.sum("lines").alias("lines"))


def running_counts(lines: DataFrame, config: Config, at: str, root: str | None = None) -> DataStreamWriter:
    """A writer that keeps the line counts by bucket of all batches so far in ``{at}/counts``, a folder a batch.

    Each batch adds its counts to those of the batch before, so that one that is run
    again gives the same.  There is a row a bucket; older folders are deleted.
    """
    folder = lambda number: f"{at}/counts/{number}"

    def add(batch: DataFrame, number: int) -> None:
        counts = bucket_counts(batch, config, root)
        if number:
            counts = counts.unionByName(_read(batch.sparkSession, folder(number - 1))).groupBy(*BUCKET).agg(F.sum("lines").alias("lines"))
        counts.write.mode("overwrite").parquet(folder(number))
        if number > 1:
            fs, old = file_system(batch.sparkSession, folder(number - 2))
            fs.delete(old, True)

    return lines.writeStream.option("checkpointLocation", f"{at}/state").foreachBatch(add)


def latest_counts(spark: SparkSession, at: str) -> DataFrame:
    """What ``running_counts`` has counted; no rows if there was no batch."""
    fs, folder = file_system(spark, f"{at}/counts")
    numbers = [int(x.getPath().getName()) for x in fs.listStatus(folder)] if fs.exists(folder) else []
    return _read(spark, f"{at}/counts/{max(numbers)}") if numbers else spark.createDataFrame([], _COUNTS)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_COUNTS).parquet(path)
