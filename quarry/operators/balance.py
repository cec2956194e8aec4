"""Targets of buckets, and the seeded sample, shuffle and parts that follow from them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Balancing
from ..runtime import saved
from .classify import BUCKET, order

#: Rows of the targets table that may be broadcast; more are joined by a shuffle.
BROADCAST_BUCKETS = 500_000
#: Rows that a range of the hash within a bucket is meant for; the largest bucket says how many ranges there are.
RANGE_ROWS = 100_000
#: Buckets whose targets the driver settles; more are settled by searching the level with aggregations.
DRIVER_BUCKETS = 1_000_000


def floors(counts: DataFrame, b: Balancing) -> DataFrame:
    """``counts`` with ``floor``: what is kept of a bucket at least; small buckets are kept whole."""
    n = F.col("lines")
    least = F.greatest(F.ceil(n * F.lit(b.min_keep_fraction)), F.ceil(n / F.lit(b.max_downsample_ratio)))
    return counts.withColumn("floor", F.when(n == 0, 0).when(n < b.collapse_buckets_below_lines, n).otherwise(F.least(F.greatest(least, F.lit(1)), n)).cast("long"))


def smoothed(counts: DataFrame, b: Balancing) -> DataFrame:
    """``floors`` with ``target``: shares by lines to the power of alpha, between floor and lines.

    The ratio is rounded at nine digits, so that the order of the sum doesn't show.
    """
    sums = counts.agg(F.sum(F.round(F.pow("lines", F.lit(b.alpha)), 9).cast("decimal(38,9)")).cast("double").alias("w"), F.least(F.lit(b.total_lines), F.sum("lines")).alias("requested"))
    share = F.round(F.round(F.round(F.pow("lines", F.lit(b.alpha)), 9) / F.col("w") * F.col("requested"), 9)).cast("long")
    joined = floors(counts, b).crossJoin(F.broadcast(sums))
    return joined.withColumn("target", F.least(F.greatest(share, F.col("floor")), F.col("lines"))).drop("w")


def settle(lines: np.ndarray, floor: np.ndarray, target: np.ndarray, requested: int) -> np.ndarray:
    """Targets raised, or lowered no further than floors, one line at a time until they sum to ``requested``.

    A line goes to the bucket with most headroom, or from the one with the largest
    target; of equals the last.  Found by the level that is left, not by loops.
    """
    target = target.astype(np.int64)
    change = requested - int(target.sum())
    if change > 0:
        low, high = np.zeros_like(target), lines - target  # units lie at the levels low + 1 .. high
    else:
        low, high = floor.astype(np.int64), target
    want = min(abs(change), int(np.maximum(high - low, 0).sum()))
    if not want:
        return target
    above = lambda level: np.maximum(high - np.maximum(low, level), 0)
    least, most = 0, int(high.max())
    while least < most:  # the smallest level above which no more than ``want`` units lie
        middle = (least + most) // 2
        if above(middle).sum() <= want:
            most = middle
        else:
            least = middle + 1
    taken = above(least)
    rest = want - int(taken.sum())
    if rest:
        at = np.flatnonzero((low < least) & (high >= least))
        taken[at[len(at) - rest :]] += 1
    return target + taken if change > 0 else target - taken


def settle_apart(buckets: DataFrame) -> DataFrame:
    """``settle`` for a saved table of ``lines, floor, target, requested``, with a few dozen aggregations instead of a row a bucket on the driver."""
    first = buckets.agg(F.first("requested").alias("requested"), F.sum("target").alias("target"), F.max("lines").alias("most")).first()
    change = first["requested"] - first["target"]
    if not change:
        return buckets
    low, high = (F.lit(0), F.col("lines") - F.col("target")) if change > 0 else (F.col("floor"), F.col("target"))
    above = lambda level: F.greatest(high - F.greatest(low, F.lit(level)), F.lit(0))
    total = lambda level: buckets.agg(F.sum(above(level)).alias("n")).first()["n"]
    want = min(abs(change), buckets.agg(F.sum(F.greatest(high - low, F.lit(0))).alias("n")).first()["n"])
    least, most = 0, first["most"]
    while least < most:
        middle = (least + most) // 2
        least, most = (least, middle) if total(middle) <= want else (middle + 1, most)
    rest = want - total(least)
    taken = buckets.withColumn("taken", above(least))
    at_level = (low < least) & (high >= least)
    extra = taken.where(at_level).orderBy(*[c.desc() for c in order()]).limit(rest).select(*[F.col(c).alias(f"{c}_x") for c in BUCKET]).withColumn("one", F.lit(1))
    same = F.lit(True)
    for c in BUCKET:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_x"))
    done = taken.join(extra, same, "left")
    units = F.col("taken") + F.coalesce("one", F.lit(0))
    return done.withColumn("target", F.col("target") + units if change > 0 else F.col("target") - units).select(*buckets.columns)


def targets(counts: DataFrame, b: Balancing) -> DataFrame:
    """``counts`` with ``floor`` and the final ``target`` of every bucket; all lines if balancing is off.

    Up to DRIVER_BUCKETS rows are settled on the driver, which holds a row a bucket.
    """
    if not b.enabled:
        return counts.withColumns({"floor": F.col("lines"), "target": F.col("lines")})
    columns = [*BUCKET, "lines", "floor", "target"]
    rows = smoothed(counts, b).orderBy(*order()).select(*columns, "requested").limit(DRIVER_BUCKETS + 1).collect()
    if len(rows) > DRIVER_BUCKETS:
        return settle_apart(saved(smoothed(counts, b))).select(*columns)
    if not rows:
        return smoothed(counts, b).select(*columns)
    n, floor, target = (np.array([r[c] for r in rows], np.int64) for c in ("lines", "floor", "target"))
    done = settle(n, floor, target, rows[0]["requested"])
    kinds = ", ".join(f"{c} string" for c in BUCKET) + ", lines bigint, floor bigint, target bigint"
    return counts.sparkSession.createDataFrame([(*(r[c] for c in BUCKET), r["lines"], r["floor"], int(t)) for r, t in zip(rows, done)], kinds)


def bucket_key() -> Column:
    return F.concat_ws("|", *BUCKET)


def _draw(salt: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(salt), F.lit(str(seed)), bucket_key(), "path", F.col("line_number").cast("string"), F.col("chunk_index").cast("string")))


def digits_for(lines: int) -> int:
    """Hexadecimal digits of the hash that cut a bucket of so many lines into ranges."""
    return next(d for d in range(1, 32) if lines <= RANGE_ROWS * 16**d)


def ranked(rows: DataFrame, hashed: Column, name: str, digits: int, least: Column | None = None) -> DataFrame:
    """``rows`` with their rank from 1, by the hash, within their bucket.

    A bucket is cut into ranges of the hash, counted first; a row's rank is that
    within its range after all ranges before.  So no window holds a whole bucket,
    however large it is.  With ``least``, only ranks up to it are computed: ranges
    that lie beyond are dropped before the sort.
    """
    cut = rows.withColumns({"__h": hashed}).withColumn("__r", F.substring("__h", 1, digits))
    sizes = cut.groupBy(*BUCKET, "__r").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*BUCKET).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.withColumn("__before", before).drop("__n")
    joined = cut.join(starts, [*BUCKET, "__r"])
    if least is not None:
        joined = joined.where(F.col("__before") < least)
    within = F.row_number().over(Window.partitionBy(*BUCKET, "__r").orderBy("__h", "path", "line_number", "chunk_index"))
    return joined.withColumn(name, F.col("__before") + within).drop("__h", "__r", "__before")


def sample(classified: DataFrame, targets: DataFrame, b: Balancing, rows: int | None = None) -> DataFrame:
    """The lines that are drawn: exactly ``target`` of each bucket, without replacement, the same for the same seed.

    ``rows`` is the number of buckets, if known; up to BROADCAST_BUCKETS they are broadcast.
    """
    wanted = targets.select(*BUCKET, "target")
    known = targets.agg(F.count("*").alias("rows"), F.max("lines").alias("most")).first()
    rows = known["rows"] if rows is None else rows
    joined = classified.join(F.broadcast(wanted) if rows <= BROADCAST_BUCKETS else wanted, BUCKET).where("target > 0")
    return ranked(joined, _draw("draw", b.shuffle_seed), "draw", digits_for(known["most"] or 0), F.col("target")).where(F.col("draw") <= F.col("target")).drop("draw", "target")


def parts(sampled: DataFrame, b: Balancing) -> DataFrame:
    """The sample shuffled within buckets: ``part`` from 0 and ``position`` from 1 within the bucket."""
    most = sampled.groupBy(*BUCKET).agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"]
    shuffled = ranked(sampled, _draw("shuffle", b.shuffle_seed), "position", digits_for(most or 0))
    return shuffled.withColumn("part", F.floor((F.col("position") - 1) / max(1, b.max_part_lines)).cast("int"))


def report(counts: DataFrame, targets: DataFrame, sampled: DataFrame) -> DataFrame:
    """Input, target and output lines of every bucket."""
    out = sampled.groupBy(*BUCKET).agg(F.count("*").alias("output_lines"))
    joined = targets.join(out, BUCKET, "left")
    return joined.select(*BUCKET, F.col("lines").alias("input_lines"), F.col("target").alias("target_lines"), F.coalesce("output_lines", F.lit(0)).alias("output_lines"))
