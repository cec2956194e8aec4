"""Small helpers on DataFrames and the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import dropped, saved, scratch, shared_dir

__all__ = ["BROADCAST_IDS", "dropped", "free", "saved", "scratch", "shared_dir", "sized", "table"]

#: Up to this many ids of 8 bytes a side may be broadcast; beyond it the join is left to shuffle.
BROADCAST_IDS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sized(df: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """The saved rows of a narrow table, hinted for broadcast only if there are at most ``most``."""
    kept = saved(df)
    return F.broadcast(kept) if kept.count() <= most else kept


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many ``_`` behind it as keep it apart from the columns of ``df`` and each other, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
