"""Resharding as a minimum-cost flow.

Old shards supply their bytes, new shards take up to their capacity, a byte that
stays in the shard of the same name costs nothing and one that moves costs its
distance.  The flow of least cost says how many bytes each shard hands to which;
the transfers are cut into blocks of documents, and only shards that lose or gain
are written anew.  The driver holds a row a shard; blocks, offsets and documents
stay in Spark.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import free, saved, scratch, sized, table

#: Wanted bytes of a block, and about how many blocks there may be; more bytes make larger blocks.
BLOCK_BYTES, BLOCKS = 4 << 20, 50_000
#: Shards that a plan may have, and that it may have under costs of a caller's own; it is solved on the driver.
SHARDS, PRICED_SHARDS = 1_000_000, 256
#: Bytes of a shard that one writer takes; a smaller shard has up to eight writers of 2 MB at least.
WRITER_BYTES = 128 << 20
#: What ``plan`` adds to the columns: old shard, bytes and new shard, with ``_`` behind where a name is taken.
PLAN = ("__shard", "__bytes", "__to")
#: Blocks whose table may be broadcast.
BROADCAST_BLOCKS = 1_000_000
#: Rows of cut blocks, of three short columns, that may be broadcast.
BROADCAST_ROWS = 500_000


def _surplus_to_room(sizes: dict[str, int], capacities: dict[str, int]) -> dict[tuple[str, str], int]:
    stays = {s: min(b, capacities.get(s, 0)) for s, b in sizes.items()}
    flow = {(s, s): b for s, b in stays.items() if b}
    rooms = iter([(s, c - stays.get(s, 0)) for s, c in sorted(capacities.items()) if c > stays.get(s, 0)])
    name, room = "", 0
    for s, b in sorted(sizes.items()):
        left = b - stays[s]
        while left:
            if not room:
                name, room = next(rooms)
            amount = min(left, room)
            flow[s, name] = amount
            left, room = left - amount, room - amount
    return flow


def least_cost_flow(sizes: dict[str, int], capacities: dict[str, int], cost: Callable[[str, str], int] | None = None) -> dict[tuple[str, str], int]:
    """Bytes from each old to each new shard, at the least total cost; zero flows are left out.

    ``cost(old, new)`` of a byte is 0 for the same name and 1 otherwise, unless
    given; it must not be negative.  Under a given cost: successive shortest paths,
    with potentials.  Under the default, where a shortest path either stays or is any
    way from a surplus to a room, the same flow is read off in one pass over both.
    Raises if the capacities don't hold all bytes, or if shards are too many.
    """
    if sum(capacities.values()) < sum(sizes.values()):
        raise ValueError("the new shards can't hold all bytes")
    if cost is None:
        return _surplus_to_room(sizes, capacities)
    if max(len(sizes), len(capacities)) > PRICED_SHARDS:
        raise ValueError(f"more than {PRICED_SHARDS} shards under a cost")
    old, new = sorted(sizes), sorted(capacities)
    n = len(old) + len(new)
    flow = {}
    left = dict(capacities)
    supply = dict(sizes)
    prices = [[cost(a, b) for b in new] for a in old]
    potential = [0] * n
    carried: list[dict[int, int]] = [{} for _ in new]  # by new shard: old shard and its bytes
    for i, a in enumerate(old):
        while supply[a] > 0:
            # Dijkstra from this shard over residual arcs: old to new always, new to old where bytes flow.
            far = [float("inf")] * n
            came: list[int] = [-1] * n
            far[i] = 0
            heap = [(0, i)]
            while heap:
                d, u = heapq.heappop(heap)
                if d > far[u]:
                    continue
                if u < len(old):
                    arcs = ((len(old) + j, prices[u][j]) for j in range(len(new)))
                else:
                    arcs = ((o, -prices[o][u - len(old)]) for o, b in carried[u - len(old)].items() if b > 0)
                for v, c in arcs:
                    step = d + c + potential[u] - potential[v]
                    if step < far[v]:
                        far[v], came[v] = step, u
                        heapq.heappush(heap, (step, v))
            free = [j for j, b in enumerate(new) if left[b] > 0 and far[len(old) + j] < float("inf")]
            end = min(free, key=lambda j: (far[len(old) + j] + potential[len(old) + j], j))
            reach = far[len(old) + end]
            for v in range(n):
                potential[v] += min(far[v], reach)
            path, v = [], len(old) + end
            while v != i:
                path.append((came[v], v))
                v = came[v]
            amount = min(supply[a], left[new[end]])
            for u, v in path:
                if u >= len(old):
                    amount = min(amount, carried[u - len(old)][v])
            for u, v in path:
                if u < len(old):
                    carried[v - len(old)][u] = carried[v - len(old)].get(u, 0) + amount
                else:
                    carried[u - len(old)][v] -= amount
            supply[a] -= amount
            left[new[end]] -= amount
    for j, own in enumerate(carried):
        for o, amount in own.items():
            if amount:
                flow[old[o], new[j]] = amount
    return flow


def even_capacities(sizes: dict[str, int], shards: int, slack: float = 0.05) -> dict[str, int]:
    """``shards`` equal capacities with some slack; old names are used again, the largest shards first."""
    names = sorted(sizes, key=lambda s: (-sizes[s], s))[:shards]
    names += [f"new{k:05d}" for k in range(shards - len(names))]
    return {s: int(-(-sum(sizes.values()) * (1 + slack) // shards)) for s in names}


def _planned(docs: DataFrame, shards: int, shard: str, slack: float, block_bytes: int, capacities: dict[str, int] | None, id_col: str, text_col: str) -> tuple[DataFrame, dict[tuple[str, str], int]]:
    """What ``plan`` returns, and the flow."""
    spark = docs.sparkSession
    shard_c, bytes_c, to_c = free(docs, *PLAN)
    own = F.coalesce(docs[shard].cast("string"), F.lit(""))
    size = F.coalesce(F.octet_length(docs[text_col].cast("string")), F.lit(0)).cast("long")
    place = F.md5(F.coalesce(docs[id_col].cast("string"), F.lit("")))
    narrow = saved(docs.select(own.alias("s"), docs[id_col].alias("id"), place.alias("h"), size.alias("b")))
    totals = narrow.groupBy("s").agg(F.sum("b").alias("b")).limit(SHARDS + 1).collect()
    if len(totals) > SHARDS:
        raise ValueError(f"more than {SHARDS} shards")
    sizes = {r["s"]: r["b"] for r in totals}
    flow = least_cost_flow(sizes, capacities or even_capacities(sizes, shards, slack)) if sizes else {}
    leaves: dict[str, list[tuple[bool, str, int]]] = {s: [] for s in sizes}
    for (old, new), b in flow.items():
        leaves[old].append((new != old, new, b))
    wanted = max(block_bytes, sum(sizes.values()) // BLOCKS)
    single, ranges, digits = [], [], []
    for s, out in leaves.items():
        if len(out) < 2:
            single.append((s, out[0][1] if out else s, 0))
            continue
        at = 0
        for k, (_, new, b) in enumerate(sorted(out)):
            ranges.append((s, at, at + b if k < len(out) - 1 else 1 << 62, new))
            at += b
        digits.append((s, None, next(d for d in range(1, 33) if sizes[s] <= wanted * 16**d)))
    # A row a shard, a row a flow: both are no more than the driver has just held.
    about = spark.createDataFrame(single + digits, "s string, one string, d int")
    where = spark.createDataFrame(ranges, "s string, lo bigint, hi bigint, new string")
    if len(single) + len(ranges) <= BROADCAST_ROWS:
        about, where = F.broadcast(about), F.broadcast(where)
    cut = narrow.join(about.where("one IS NULL"), "s").withColumn("k", F.expr("left(h, d)"))
    before = F.coalesce(F.sum("b").over(Window.partitionBy("s").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = saved(cut.groupBy("s", "k").agg(F.sum("b").alias("b")).withColumn("at", before))
    begins = lambda at: (F.col(at) >= F.col("lo")) & (F.col(at) < F.col("hi"))
    whole = sized(blocks.join(where, "s").where(begins("at") & (F.col("at") + F.col("b") <= F.col("hi"))).select("s", "k", "new"), BROADCAST_BLOCKS)
    # Only in blocks that a cut falls into, no more than there are flows, documents have offsets of their own.
    split = F.broadcast(saved(blocks.join(whole, ["s", "k"], "left_anti").select("s", "k", "at")))
    rows = cut.join(split, ["s", "k"]).groupBy("s", "k", "at", "h", "id").agg(F.sum("b").alias("b"))
    within = F.sum("b").over(Window.partitionBy("s", "k").orderBy("h", F.col("id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    parts = rows.withColumn("at", F.col("at") + F.coalesce(within, F.lit(0))).join(where, "s").where(begins("at"))
    parts = sized(parts.select("s", "id", F.col("new").alias("part")), BROADCAST_ROWS)  # a few blocks' ids; the texts aren't shuffled for them unless they are many
    s, h = free(docs, "__s", "__h")
    marked = docs.withColumns({s: own, h: place, bytes_c: size})
    placed = marked.join(about.withColumnsRenamed({"s": s + "a", "one": s + "one", "d": s + "d"}), F.col(s) == F.col(s + "a"), "left")
    placed = placed.join(whole.select(F.col("s").alias(s + "w"), F.col("k").alias(s + "k"), F.col("new").alias(s + "new")), (F.col(s) == F.col(s + "w")) & (F.expr(f"left(`{h}`, `{s}d`)") == F.col(s + "k")), "left")
    placed = placed.join(parts.select(F.col("s").alias(s + "p"), F.col("id").alias(s + "id"), F.col("part").alias(s + "part")), (F.col(s) == F.col(s + "p")) & docs[id_col].eqNullSafe(F.col(s + "id")), "left")
    out = placed.select(*[docs[c] for c in docs.columns], F.col(s).alias(shard_c), F.col(bytes_c), F.coalesce(s + "one", s + "new", s + "part", s).alias(to_c))
    return out, flow


def plan(docs: DataFrame, shards: int, shard: str = "source", slack: float = 0.05, block_bytes: int = BLOCK_BYTES, capacities: dict[str, int] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the old shard, the bytes and the new shard of each row, named by ``PLAN``.

    A shard's bytes are laid out by the MD5 of the ids, and cut where the flow wants
    them cut; a document that a cut falls into goes where it begins, so a new
    shard may exceed its capacity by a document for each shard that it takes from.
    Null shards are the shard "", null texts have no bytes; rows of one shard that
    share an id, or have none, move together.  An empty table stays empty, and columns
    of any name stay as they are.  Raises beyond ``SHARDS`` distinct shards.
    """
    return _planned(docs, shards, shard, slack, block_bytes, capacities, id_col, text_col)[0]


def reshard(docs: DataFrame, path: str, shards: int, shard: str = "source", slack: float = 0.05, block_bytes: int = BLOCK_BYTES, capacities: dict[str, int] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the shards that the flow changes under ``path``, one folder a new shard, and returns all rows with their shard.

    Rows of shards that neither lose nor gain are taken from ``docs`` as they are.
    Edge cases are those of ``plan``.
    """
    planned, flow = _planned(docs, shards, shard, slack, block_bytes, capacities, id_col, text_col)
    shard_c, _, to_c = free(docs, *PLAN)
    gains: dict[str, int] = {}
    for (_, new), b in flow.items():
        gains[new] = gains.get(new, 0) + b
    changed = sorted({s for (old, new) in flow if old != new for s in (old, new)})
    if not changed:
        return planned
    folder, name, writers = free(planned, "shard", "__c", "__n")
    # A writer gets a share of one shard, so that a large shard isn't one task's work.
    listed = docs.sparkSession.createDataFrame([(s, max(1, -(-gains.get(s, 0) // WRITER_BYTES), min(8, gains.get(s, 0) >> 21))) for s in changed], f"`{name}` string, `{writers}` int")
    listed = F.broadcast(listed) if len(changed) <= BROADCAST_ROWS else listed
    affected = planned.join(listed, F.col(to_c) == F.col(name))
    spread = affected.repartition(F.col(to_c), F.pmod(F.xxhash64(docs[id_col]), F.col(writers))).select(*planned.columns)
    spread.withColumn(folder, F.col(to_c)).write.partitionBy(folder).parquet(path)
    written = docs.sparkSession.read.schema(spread.schema).parquet(path).select(*planned.columns)
    return written.unionByName(planned.join(listed, F.col(to_c) == F.col(name), "left_anti"))


def op1_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' sources as shards of very different sizes, resharded to 32 of about equal bytes; edge cases as in ``plan``."""
    done = reshard(table(spark, sf_dir, "documents"), scratch(spark), 32)
    return done.select("doc_id", F.col("__shard").alias("old_shard"), F.col("__to").alias("new_shard"), F.col("__bytes").alias("n_bytes"), (F.col("__shard") != F.col("__to")).alias("moved"))


#: The flow as overlaps of surpluses and rooms, both laid end to end by name; offsets of documents as sums over the MD5 of their ids.
SQL = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS s, coalesce(strlen(text), 0)::BIGINT AS b, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
sizes AS (SELECT s, sum(b)::BIGINT AS b FROM d GROUP BY 1),
ranked AS (SELECT s, row_number() OVER (ORDER BY b DESC, s) AS n FROM sizes),
names AS (SELECT s FROM ranked WHERE n <= 32 UNION ALL SELECT printf('new%05d', k) FROM range(32 - least(32, (SELECT count(*) FROM sizes))) t(k)),
cap AS (SELECT s, (SELECT ceil(sum(b) * 1.05::DOUBLE / 32)::BIGINT FROM sizes) AS c FROM names),
stay AS (SELECT s, b, least(b, coalesce(c, 0)) AS own FROM sizes LEFT JOIN cap USING (s)),
more AS (SELECT s, own, sum(b - own) OVER (ORDER BY s) AS hi, sum(b - own) OVER (ORDER BY s) - (b - own) AS lo FROM stay WHERE b > own),
room AS (SELECT s, sum(r) OVER (ORDER BY s) AS hi, sum(r) OVER (ORDER BY s) - r AS lo FROM (SELECT s, c - coalesce(own, 0) AS r FROM cap LEFT JOIN stay USING (s)) WHERE r > 0),
flow AS (
    SELECT s, s AS new, 0 AS lo, own AS hi, 0 AS last FROM stay WHERE own > 0 OR b = 0
    UNION ALL SELECT m.s, r.s, m.own + greatest(m.lo, r.lo) - m.lo, m.own + least(m.hi, r.hi) - m.lo, 1 FROM more m JOIN room r ON r.lo < m.hi AND m.lo < r.hi
),
ends AS (SELECT s, new, lo, CASE WHEN row_number() OVER (PARTITION BY s ORDER BY lo DESC) = 1 THEN 1::BIGINT << 62 ELSE hi END AS hi FROM flow),
ids AS (SELECT s, h, doc_id, sum(b) AS b FROM d GROUP BY ALL),
placed AS (SELECT s, doc_id, coalesce(sum(b) OVER (PARTITION BY s ORDER BY h, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM ids),
too AS (SELECT p.s, doc_id, new FROM placed p JOIN ends ON ends.s = p.s AND o >= lo AND o < hi)
SELECT d.doc_id, d.s AS old_shard, new AS new_shard, d.b AS n_bytes, d.s <> new AS moved FROM d JOIN too ON too.s = d.s AND too.doc_id IS NOT DISTINCT FROM d.doc_id
"""
