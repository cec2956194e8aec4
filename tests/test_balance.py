import random

import numpy as np
import pytest

from quarry.config import Balancing
from quarry.operators import balance
from quarry.operators.classify import BUCKET


def settings(**changes):
    return Balancing(**({"enabled": True, "mode": "conservative", "total_lines": 6, "alpha": 0.7, "hierarchy": BUCKET, "min_keep_fraction": 0.5, "max_downsample_ratio": 4.0, "collapse_buckets_below_lines": 0, "max_part_lines": 10**6, "shuffle_seed": 1337} | changes))


def counts(spark, sizes):
    return spark.createDataFrame([("text", "latin", "en", f"s{k:03d}", "short", n) for k, n in enumerate(sizes)], "domain string, script string, language_hint string, source_group string, length_bin string, lines bigint")


@pytest.mark.parametrize(
    ("sizes", "total", "collapse", "floors", "clamped", "final"),
    [
        ([6, 1], 6, 0, [3, 1], [5, 1], [5, 1]),
        ([10000, 2000, 500], 6000, 1000, [5000, 1000, 500], [5000, 1344, 500], [5000, 1000, 500]),
        ([10000, 2000, 500], 9000, 1000, [5000, 1000, 500], [6220, 2000, 500], [6500, 2000, 500]),
        ([10000, 2000, 500], 20_000_000, 1000, [5000, 1000, 500], [8639, 2000, 500], [10000, 2000, 500]),
        ([300, 300], 301, 0, [150, 150], [151, 151], [151, 150]),
    ],
)
def test_targets(spark, sizes, total, collapse, floors, clamped, final):
    b = settings(total_lines=total, collapse_buckets_below_lines=collapse)
    smoothed = balance.smoothed(counts(spark, sizes), b).orderBy("source_group").collect()
    assert [r["floor"] for r in smoothed] == floors and [r["target"] for r in smoothed] == clamped
    assert [r["target"] for r in balance.targets(counts(spark, sizes), b).orderBy("source_group").collect()] == final


def greedy(lines, floor, target, requested):
    t = list(target)
    while sum(t) < requested and any(n > x for n, x in zip(lines, t)):
        k = max(range(len(t)), key=lambda i: (lines[i] - t[i], i))
        t[k] += 1
    while sum(t) > requested and any(x > f for x, f in zip(t, floor)):
        k = max((i for i in range(len(t)) if t[i] > floor[i]), key=lambda i: (t[i], i))
        t[k] -= 1
    return t


def test_settle_is_the_greedy_rule():
    r = random.Random(5)
    for _ in range(1500):
        lines = [r.randint(1, 30) for _ in range(r.randint(1, 6))]
        floor = [r.randint(0, n) for n in lines]
        target = [r.randint(f, n) for f, n in zip(floor, lines)]
        requested = r.randint(0, sum(lines))
        got = balance.settle(np.array(lines), np.array(floor), np.array(target), requested)
        assert got.tolist() == greedy(lines, floor, target, requested)


def rows(spark, sizes):
    data = [(f"p{k}", i, 0, f"t{i}", "text", "latin", "en", f"s{k:03d}", "short") for k, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(data, "path string, line_number bigint, chunk_index int, text string, " + ", ".join(f"{c} string" for c in BUCKET))


def test_sample_is_exact_seeded_and_independent_of_partitions(spark):
    b = settings(total_lines=60)
    lines = rows(spark, [100, 7, 1])
    wanted = balance.targets(counts(spark, [100, 7, 1]), b)
    a = {(r["path"], r["line_number"]) for r in balance.sample(lines, wanted, b).collect()}
    again = {(r["path"], r["line_number"]) for r in balance.sample(lines.repartition(11), wanted, b).collect()}
    other = {(r["path"], r["line_number"]) for r in balance.sample(lines, wanted, settings(total_lines=60, shuffle_seed=1)).collect()}
    assert a == again and a != other and len(a) == sum(r["target"] for r in wanted.collect())
    far = balance.sample(lines, wanted, b, rows=balance.BROADCAST_BUCKETS + 1)
    assert {(r["path"], r["line_number"]) for r in far.collect()} == a


def test_parts_are_runs_of_the_shuffle(spark):
    b = settings(max_part_lines=10)
    got = balance.parts(rows(spark, [35, 3]), b).orderBy("source_group", "position").collect()
    assert [r["position"] for r in got] == [*range(1, 36), 1, 2, 3] and [r["part"] for r in got] == [k // 10 for k in range(35)] + [0] * 3
    assert [r["line_number"] for r in got[:35]] != list(range(35))


def test_disabled_keeps_all(spark):
    b = settings(enabled=False, total_lines=1)
    assert [r["target"] for r in balance.targets(counts(spark, [9, 4]), b).orderBy("source_group").collect()] == [9, 4]
    assert balance.targets(counts(spark, []), settings()).count() == 0


@pytest.mark.parametrize("total", [6, 300, 900, 1500, 10**6])
def test_targets_of_more_buckets_than_the_driver_takes(spark, monkeypatch, total):
    r = random.Random(total)
    df, b = counts(spark, [r.choice([0, 1, 5, 40, 300]) for _ in range(12)]), settings(total_lines=total)
    want = {x["source_group"]: x["target"] for x in balance.targets(df, b).collect()}
    monkeypatch.setattr(balance, "DRIVER_BUCKETS", 3)
    assert {x["source_group"]: x["target"] for x in balance.targets(df, b).collect()} == want


def test_more_ranges_draw_the_same(spark, monkeypatch):
    rows = [("text", "latin", "en", "s", "short", f"p{k % 7}", k, 0, str(k)) for k in range(400)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in BUCKET) + ", path string, line_number int, chunk_index int, text string")
    wanted = spark.createDataFrame([("text", "latin", "en", "s", "short", 400, 100, 150)], ", ".join(f"{c} string" for c in BUCKET) + ", lines bigint, floor bigint, target bigint")
    b = settings(max_part_lines=40)
    draw = lambda: sorted((x["text"], x["part"], x["position"]) for x in balance.parts(balance.sample(df, wanted, b), b).collect())
    once = draw()
    monkeypatch.setattr(balance, "RANGE_ROWS", 3)
    assert draw() == once and len(once) == 150
