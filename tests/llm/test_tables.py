"""Resharding, host reputation, components and the pipeline."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import op01_reshard as shards
from quarry.llm import op07_hosts as hosts
from quarry.llm import graph
from quarry.llm.graph import components


def cost_of(flow, cost):
    return sum(b * cost(*arc) for arc, b in flow.items())


def test_flow_moves_the_fewest_bytes():
    r = random.Random(1)
    for _ in range(200):
        old = {f"s{k}": r.randint(0, 20) for k in range(r.randint(1, 5))}
        new = {f"s{k}": r.randint(0, 20) for k in r.sample(range(8), r.randint(1, 5))}
        if sum(new.values()) < sum(old.values()):
            with pytest.raises(ValueError):
                shards.least_cost_flow(old, new)
            continue
        flow = shards.least_cost_flow(old, new)
        assert all(sum(b for (i, _), b in flow.items() if i == s) == n for s, n in old.items())
        assert all(sum(b for (_, j), b in flow.items() if j == s) <= n for s, n in new.items())
        assert cost_of(flow, lambda a, b: a != b) == sum(max(0, n - new.get(s, 0)) for s, n in old.items())


def test_flow_under_other_costs_is_brute_force():
    r = random.Random(2)
    for _ in range(60):
        old = {f"a{k}": r.randint(0, 4) for k in range(2)}
        new = {f"b{k}": r.randint(0, 4) for k in range(3)}
        if sum(new.values()) < sum(old.values()):
            continue
        price = {(i, j): r.randint(0, 5) for i in old for j in new}
        best = 1 << 30
        ways = [[p for p in itertools.product(range(n + 1), repeat=3) if sum(p) == n] for n in old.values()]
        for x, y in itertools.product(*ways):
            if all(x[k] + y[k] <= new[f"b{k}"] for k in range(3)):
                best = min(best, sum(x[k] * price["a0", f"b{k}"] + y[k] * price["a1", f"b{k}"] for k in range(3)))
        assert cost_of(shards.least_cost_flow(old, new, lambda a, b: price[a, b]), lambda a, b: price[a, b]) == best


def test_many_shards_are_planned_at_once():
    r = random.Random(5)
    old = {f"s{k}": r.randint(0, 10**9) for k in range(4096)}
    new = {f"s{k}": sum(old.values()) // 4000 for k in range(2000, 6096)}
    flow = shards.least_cost_flow(old, new)
    assert cost_of(flow, lambda a, b: a != b) == sum(max(0, n - new.get(s, 0)) for s, n in old.items())


def test_reshard_keeps_columns_of_any_name(spark, tmp_path):
    names = ["__block", "__shard", "__TO", "__bytes", "__s", "__sone", "__h", "shard", "k", "at", "new", "__c", "__n"]
    docs = spark.createDataFrame([(k, "x" * (k % 50), f"s{k % 3}", *range(k, k + len(names))) for k in range(200)], f"doc_id bigint, text string, source string, {', '.join(f'`{n}` int' for n in names)}")
    got = shards.reshard(docs, str(tmp_path / "o"), 5, block_bytes=100)
    assert got.columns[: len(docs.columns)] == docs.columns and len({c.lower() for c in got.columns}) == len(got.columns)
    assert sorted(tuple(x)[: len(docs.columns)] for x in got.collect()) == sorted(map(tuple, docs.collect()))


def test_reshard_with_a_very_long_text_and_repeated_rows(spark, tmp_path):
    rows = [(1, "y" * 3_000_000, "a"), (2, "z", "a"), (2, "z", "a"), (3, "", "b"), (None, None, None)]
    got = shards.reshard(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), str(tmp_path / "o"), 2, block_bytes=10, capacities={"a": 2_000_000, "n": 2_000_000}).collect()
    assert sorted(((x["doc_id"], x["text"], x["source"]) for x in got), key=str) == sorted(rows, key=str)
    assert len({x["__to"] for x in got if x["doc_id"] == 2}) == 1


def test_reshard_fills_shards_and_moves_little(spark, tmp_path):
    r = random.Random(3)
    rows = [(k, "x" * r.randint(0, 400), "hot" if r.random() < 0.6 else f"s{r.randint(0, 3)}", k) for k in range(1500)] + [(None, "n" * 50, "s1", 1), (5000, None, "s1", 2), (5001, "", None, 3), (7, "again", "hot", 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, block int").selectExpr("*", "1 AS shard", "2 AS s", "3 AS part")
    got = shards.reshard(docs, str(tmp_path / "out"), 8, block_bytes=3000).collect()
    assert sorted(((x["doc_id"], x["text"], x["source"], x["block"]) for x in got), key=str) == sorted(rows, key=str)
    size, moved, old = {}, 0, {}
    for x in got:
        size[x["__to"]] = size.get(x["__to"], 0) + x["__bytes"]
        old[x["__shard"]] = old.get(x["__shard"], 0) + x["__bytes"]
        moved += x["__bytes"] * (x["__to"] != x["__shard"])
    capacity = shards.even_capacities(old, 8)
    least = sum(max(0, n - capacity.get(s, 0)) for s, n in old.items())
    assert abs(moved - least) <= 400 * 16 and all(n <= capacity[s] + 400 * 8 for s, n in size.items())


def test_reshard_of_nothing_and_of_what_fits(spark, tmp_path):
    docs = spark.createDataFrame([(1, "abc", "a"), (2, "abd", "b")], "doc_id bigint, text string, source string")
    kept = shards.reshard(docs, str(tmp_path / "o1"), 2).collect()
    assert all(x["__to"] == x["__shard"] for x in kept) and len(kept) == 2
    assert shards.reshard(docs.limit(0), str(tmp_path / "o2"), 2).count() == 0


def test_hosts_in_python(spark):
    urls = ["https://www.A.example.co.uk:8080/x?y", "http://u:p@b.example.com/", "ftp://example.com", "nonsense", None, "https://localhost/a", "https://x.y.z.org./"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(hosts.host_of(F.col("u")).alias("h"))
    df = df.withColumn("s", hosts.suffix_of(F.col("h"))).withColumn("d", hosts.domain_of(F.col("h"), F.col("s")))
    assert [tuple(x) for x in df.collect()] == [("a.example.co.uk", "co.uk", "example.co.uk"), ("b.example.com", "com", "example.com"), ("example.com", "com", "example.com"), ("", "", ""), ("", "", ""), ("localhost", "localhost", "localhost"), ("x.y.z.org", "org", "z.org")]


def test_hosts_under_generic_labels_of_countries_are_apart(spark):
    df = spark.createDataFrame([(h,) for h in ("good.com.tw", "a.spam.com.tw", "x.edu.au", "x.co.il", "com.tw", "a.t.co", "a.web.de", "a.com.info")], "h string")
    df = df.withColumn("s", hosts.suffix_of(F.col("h"))).withColumn("d", hosts.domain_of(F.col("h"), F.col("s")))
    assert [(x["s"], x["d"]) for x in df.collect()] == [("com.tw", "good.com.tw"), ("com.tw", "spam.com.tw"), ("edu.au", "x.edu.au"), ("co.il", "x.co.il"), ("com.tw", "com.tw"), ("co", "t.co"), ("de", "web.de"), ("info", "com.info")]


def test_reputation_shrinks_and_filters(spark):
    pages = [(k, f"http://bad.spam.com/{k}") for k in range(30)] + [(100 + k, f"http://good.fine.org/{k}") for k in range(30)] + [(200, "http://new.spam.com/"), (201, "http://new.fine.org/"), (202, None), (203, "http://one.other.net/"), (None, "http://bad.spam.com/")]
    labels = [(k, 0) for k in range(30)] + [(100 + k, 1) for k in range(30)] + [(203, 0), (999, 0), (None, 0), (5, None)]
    p = spark.createDataFrame([(*x, 7) for x in pages], "page_id bigint, url string, n int")
    y = spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = {x["page_id"]: x for x in hosts.reputations(p, y).collect()}
    assert len(got) == len(pages) and not got[0]["keep"] and got[100]["keep"] and got[None]["n"] == 30
    assert got[201]["rate"] < got[203]["rate"] < got[0]["rate"] and got[201]["rate"] < got[202]["rate"] < got[200]["rate"]
    assert got[203]["rate"] < 1 and got[202]["host"] == ""
    assert hosts.reputations(p.limit(0), y).count() == 0
    assert {x["rate"] for x in hosts.reputations(p, y.limit(0)).collect()} == {0.5}


@pytest.mark.parametrize("few", [0, 100])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW", few)
    edges = [(1, 2), (2, 3), (9, 8), (3, 3), (8, 10), (10, 9), (20, 21), (21, 20), (None, 4)] + [(k, k + 1) for k in range(100, 160)]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "a bigint, b bigint").where("a IS NOT NULL")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 10: 8, 20: 20, 21: 20} | {k: 100 for k in range(100, 161)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("documents", [True, False])
def test_the_pipeline_on_empty_tables_and_odd_rows(spark, tmp_path, documents):
    """Nulls in any column, repeated rows, empty and very long texts, columns that operators use names like; no benchmark."""
    r = random.Random(10)
    word = lambda: "".join(r.choice("etaoinshrdlucm") for _ in range(r.randint(3, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    same = text(50)
    rows = [(k, text(40), "en", "s", None, k, "x") for k in range(12)] + [(20, same, "en", None, 1, None, None)] * 3 + [(None, text(30), "en", "s", 1, 1, "y"), (21, text(60_000), None, "s", 1, 1, "z"), (22, None, "en", "s", 0, 1, "z"), (23, "", "en", "s", 0, 1, "z")]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, `__Content` bigint, rep string"
    spark.createDataFrame(rows if documents else [], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    got = [x["doc_id"] for x in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == (sorted([*range(12), 20, 21, None], key=str) if documents else [])


def test_hosts_in_numbers_and_rules_of_a_list(spark):
    urls = ["http://192.168.1.10/a", "https://[2001:db8::1]:80/", "http://b.co.il/", "http://a.gov.in/x", "http://x.y.ck/", "http://www.ck/", "http://z.uk/", "http://q.city.kawasaki.jp/", "http://w.other.kawasaki.jp/", "nothing"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(hosts.host_of(F.col("u")).alias("host"))
    mine = df.withColumn("s", hosts.suffix_of(F.col("host"))).withColumn("d", hosts.domain_of(F.col("host"), F.col("s"))).collect()
    assert [(x["s"], x["d"]) for x in mine][:4] == [("192.168.1.10", "192.168.1.10"), ("[2001:db8::1]", "[2001:db8::1]"), ("co.il", "b.co.il"), ("gov.in", "a.gov.in")]
    rules = ["// a comment", "", "com", "co.il", "*.ck", "!www.ck", "uk", "co.uk", "jp", "*.kawasaki.jp", "!city.kawasaki.jp"]
    got = {x["host"]: x["suffix"] for x in hosts.with_suffixes(df.distinct(), rules).collect()}
    assert got == {"192.168.1.10": "192.168.1.10", "[2001:db8::1]": "[2001:db8::1]", "b.co.il": "co.il", "a.gov.in": "in", "x.y.ck": "y.ck", "ck": "ck", "z.uk": "uk", "q.city.kawasaki.jp": "kawasaki.jp", "w.other.kawasaki.jp": "other.kawasaki.jp", "": ""}


def test_the_lower_quantile_is_that_of_the_beta_distribution(spark):
    shapes = [(2.0, 8.0), (1.0, 30.0), (12.0, 4.0), (0.8, 40.0), (50.0, 50.0), (3.0, 3.0)]
    df = spark.createDataFrame([(a / (a + b), a + b) for a, b in shapes], "rate double, s double")
    got = [x["q"] for x in df.select(hosts.lower_quantile(F.col("rate"), F.col("s"), 1.0).alias("q")).collect()]
    for (a, b), q in zip(shapes, got):
        x = (np.arange(2_000_000) + 0.5) / 2_000_000
        p = np.cumsum(x ** (a - 1) * (1 - x) ** (b - 1))
        true = x[np.searchsorted(p / p[-1], 0.158655)]
        assert abs(q - true) < 0.01


def test_the_pipeline_on_small_tables(spark, tmp_path):
    r = random.Random(9)
    word = lambda: "".join(r.choice("etaoinshrdlucm") for _ in range(r.randint(3, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    base, item = text(80), text(30)
    rows = [(k, text(60), "en") for k in range(40)] + [(40, base, "en"), (41, base + "\n", "en"), (42, base + " more", "en"), (43, f"{text(20)} {item} {text(20)}", "en"), (44, "12 34", "en"), (45, None, "en"), (46, "", None)]
    spark.createDataFrame([(i, t, la, "s", len(t or "")) for i, t, la in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(x["doc_id"] for x in got) == [*range(41)] and all(x["round_trip"] for x in got)
