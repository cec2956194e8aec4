"""Exact dedup, repeated passages and the n-gram Jaccard join."""

import random

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import census
from quarry.llm import op02_repeats as repeats
from quarry.llm import op08_jaccard as jaccard
from quarry.llm import op10_exact as exact
from quarry.llm.textkit import data_of


WORDS = [f"w{k}" for k in range(400)]


def words(r, n):
    return [r.choice(WORDS) for _ in range(n)]


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def test_exact_keeps_the_smallest_id(spark):
    rows = [(5, "a  b\n"), (2, " a b"), (9, "A b"), (None, "a b"), (7, ""), (8, " \n"), (1, None), (3, None), (4, "c"), (4, "c")]
    got = sorted(((r["doc_id"], r["text"]) for r in exact.drop_copies(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(2, " a b"), (9, "A b"), (7, ""), (1, None), (3, None), (4, "c")], key=str)


def test_exact_with_long_texts_clashing_names_and_no_rows(spark):
    long = "x y " * 60_000
    df = frame(spark, [(2, long, 1), (1, long + " ", 2), (3, long + "z", 3)], "doc_id bigint, text string, __content int")
    got = exact.drop_copies(df)
    assert got.columns == df.columns and sorted((r["doc_id"], r["__content"]) for r in got.collect()) == [(1, 2), (3, 3)]
    assert exact.drop_copies(frame(spark, [])).count() == 0


def test_exact_with_many_copies_and_names_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(exact, "SLICE", 200)
    names = ["__CONTENT", "Content", "head", "hash", "number", "__contenth"]
    r = random.Random(6)
    rows = [(r.randint(0, 90), " ".join(words(r, r.randint(0, 2))) if r.random() < 0.5 else "the same", *[k] * len(names)) for k in range(400)]
    df = frame(spark, rows, f"doc_id bigint, text string, {', '.join(f'`{n}` int' for n in names)}")
    least = {}
    for d, t, *_ in rows:
        least[t] = min(d, least.get(t, d))
    got = exact.drop_copies(df)
    assert got.columns == df.columns and sorted((x["text"], x["doc_id"]) for x in got.collect()) == sorted(least.items())


def test_exact_among_texts_that_begin_alike(spark):
    r = random.Random(3)
    rows = [(k, "the same beginning of all texts " + str(r.randint(0, 60))) for k in range(500)]
    want = {t: i for i, t in reversed(rows)}
    assert {x["text"]: x["doc_id"] for x in exact.drop_copies(frame(spark, rows)).collect()} == want


def brute_pairs(rows, n, t):
    rows = [x for x in rows if x[0] is not None and x[1] is not None]
    raw, off = data_of(pa.array([x[1] for x in rows], pa.string()))
    grams, sizes = jaccard.gram_sets(raw, off, n)
    at = np.concatenate([[0], np.cumsum(sizes)])
    sets = [set(grams[i:j].tolist()) for i, j in zip(at[:-1], at[1:])]
    out = {}
    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            both = len(sets[i] & sets[j])
            if a != b and both:
                s = both / (len(sets[i]) + len(sets[j]) - both)
                if s >= t - 1e-12:
                    out[min(a, b), max(a, b)] = max(s, out.get((min(a, b), max(a, b)), 0))
    return out


def brute_classes(rows, n, t):
    """Class and links of each id, over all pairs of rows; rows that repeat an id and a set count once."""
    raw, off = data_of(pa.array([x[1] for x in rows], pa.string()))
    grams, sizes = jaccard.gram_sets(raw, off, n)
    at = np.concatenate([[0], np.cumsum(sizes)])
    nodes = {(x[0], frozenset(grams[i:j].tolist())) for x, i, j in zip(rows, at[:-1], at[1:]) if x[0] is not None}
    links = {d: 0 for d, _ in nodes}
    near = {d: {d} for d, _ in nodes}
    for a, x in nodes:
        for b, y in nodes:
            if (a, x) != (b, y) and x & y and len(x & y) >= t * len(x | y) - 1e-12:
                links[a] += 1
                near[a].add(b)
    low = {}
    for d in sorted(near):
        todo = [d]
        while todo:
            if (x := todo.pop()) not in low:
                low[x] = d
                todo += near[x]
    return sorted((d, low[d], links[d]) for d in near)


def stands_for(rows, n):
    """The smallest id of the rows with the same set, by id."""
    raw, off = data_of(pa.array([x[1] for x in rows], pa.string()))
    grams, sizes = jaccard.gram_sets(raw, off, n)
    at = np.concatenate([[0], np.cumsum(sizes)])
    sets = [(x[0], frozenset(grams[i:j].tolist())) for x, i, j in zip(rows, at[:-1], at[1:]) if x[0] is not None]
    least = {}
    for d, s in sets:
        least[s] = min(d, least.get(s, d))
    return {least[s] for _, s in sets}


def near_rows(seed, groups=12):
    r = random.Random(seed)
    rows, k = [], 0
    passage = words(r, 60)
    for _ in range(groups):
        base = words(r, r.randint(3, 150))
        if r.random() < 0.4:
            base = base[:20] + passage + base[20:]
        for _ in range(r.randint(1, 7)):
            copy = [w if r.random() > 0.04 else r.choice(WORDS) for w in base]
            rows.append((k * 7 % 1009, " ".join(copy)))
            k += 1
    return rows


@pytest.mark.parametrize(("seed", "n", "t"), [(1, 4, 0.55), (2, 3, 0.8), (3, 1, 0.3)])
def test_jaccard_is_brute_force(spark, seed, n, t):
    rows = near_rows(seed) + [(2000, ""), (2001, None), (None, "w1 w2 w3 w4 w5"), (2002, "w1"), (2003, "W1"), (2004, "w1 w2"), (2002, "w1"), (2005, "!!")]
    got = {(r["doc_id_a"], r["doc_id_b"]): r["jaccard"] for r in jaccard.jaccard_pairs(frame(spark, rows), n, t).collect()}
    reps = stands_for(rows, n)
    want = {k: v for k, v in brute_pairs(rows, n, t).items() if reps.issuperset(k) and v < 1}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    rows += rows[:3] + [(rows[4][0], rows[0][1]), (rows[20][0], rows[0][1] + " w3"), (5000, rows[1][1]), (5001, rows[1][1])]
    assert sorted(map(tuple, jaccard.jaccard_classes(frame(spark, rows), n, t).collect())) == brute_classes(rows, n, t)


def test_jaccard_of_one_gram_in_all_and_one_block_of_all(spark, monkeypatch):
    """A gram that every document holds, a chain that ties all of them, and a third of equal rows."""
    r = random.Random(8)
    line = words(r, 400)
    rows = [(k, "one gram of all " + " ".join(line[3 * k : 3 * k + 12])) for k in range(100)] + [(1000 + k, "one gram of all") for k in range(50)]
    monkeypatch.setattr(jaccard, "PART", 16)
    assert sorted(map(tuple, jaccard.jaccard_classes(frame(spark, rows)).collect())) == brute_classes(rows, 4, 0.5)


def test_jaccard_with_clashing_names_no_rows_and_a_long_text(spark):
    long = " ".join(words(random.Random(4), 60_000))
    rows = [(1, long, "a"), (2, long + " end", "b"), (3, None, "c"), (4, "", "d"), (5, "w1", None)]
    df = frame(spark, rows, "doc_id bigint, text string, class_id string")
    assert sorted(map(tuple, jaccard.jaccard_classes(df).collect())) == [(1, 1, 1), (2, 1, 1), (3, 3, 0), (4, 4, 0), (5, 5, 0)]
    assert jaccard.jaccard_classes(frame(spark, [])).count() == 0


def test_jaccard_in_parts_is_the_same(spark, monkeypatch):
    rows = near_rows(5, 5) + [(3000 + k, "one text that all of these share word for word " + str(k % 3)) for k in range(30)]
    monkeypatch.setattr(jaccard, "PART", 4)
    assert sorted(map(tuple, jaccard.jaccard_classes(frame(spark, rows)).collect())) == brute_classes(rows, jaccard.N, jaccard.THRESHOLD)


def test_trie_join_prunes_nothing_that_reaches_t():
    r = np.random.RandomState(0)
    for _ in range(200):
        sets = [np.unique(r.randint(0, 30, r.randint(1, 15))).astype(np.uint64) for _ in range(r.randint(1, 12))]
        extra = r.randint(0, 4, len(sets))
        sizes = np.array([len(s) for s in sets]) + extra
        t = r.choice([0.3, 0.5, 0.8])
        a, b, o = jaccard.trie_join(sizes, sets, np.zeros(len(sets), int), t)
        got = {(min(i, j), max(i, j)): k for i, j, k in zip(a.tolist(), b.tolist(), o.tolist())}
        want = {}
        for i in range(len(sets)):
            for j in range(i):
                k = len(np.intersect1d(sets[i], sets[j]))
                if k and k / (sizes[i] + sizes[j] - k) >= t - 1e-12:
                    want[j, i] = k
        assert got == want and len(a) == len(got)


def test_copies_without_ascii_spaces_are_pairs(spark):
    r = random.Random(12)
    han = "".join(chr(0x4E00 + r.randint(0, 3000)) for _ in range(80))
    thai = "".join(chr(r.randint(0x0E01, 0x0E2E)) + r.choice(["", "\u0e34", "\u0e48"]) for _ in range(80))
    w = words(r, 60)
    rows = [
        (1, han), (2, han[:40] + "\u597d" + han[41:]), (3, thai), (4, thai[:40] + "\u0e2e" + thai[41:]),
        (5, "\u00a0".join(w)), (6, "\u3000".join([*w[:30], "other", *w[31:]])), (7, "\u201c" + "\u201d \u2014 ".join(w)), (8, "".join(r.sample(han, len(han)))),
    ]
    got = {(x["doc_id_a"], x["doc_id_b"]): x["jaccard"] for x in jaccard.jaccard_pairs(frame(spark, rows)).collect()}
    assert got.keys() == {(1, 2), (3, 4), (5, 6)}  # 5 stands for 7, which has the same words
    assert dict((x["doc_id"], x["links"]) for x in jaccard.jaccard_classes(frame(spark, rows)).collect()) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 2, 6: 2, 7: 2, 8: 0}


def test_one_of_each_group_stays(spark):
    base = " ".join(f"x{k}" for k in range(60))
    rows = [(7, base, "a"), (3, base + " y", "b"), (9, base + " y z", "c"), (4, "other text of five words", "d"), (None, base, "e"), (8, None, "f")]
    df = frame(spark, rows, "doc_id bigint, text string, node string")
    got = jaccard.keep_one(df)
    assert got.columns == df.columns and sorted(r["node"] for r in got.collect()) == ["b", "d", "e", "f"]
    assert jaccard.keep_one(frame(spark, [])).count() == 0


def brute_spans(rows, n):
    """Positions whose window stands earlier, as maximal runs with one first document."""
    split = sorted((d, i, t.split()) for i, (d, t) in enumerate(rows) if d is not None and t is not None)
    first = {}
    for d, _, w in split:
        for p in range(len(w) - n + 1):
            first[tuple(w[p : p + n])] = min(first.get(tuple(w[p : p + n]), (1 << 62, 0)), (d, p))
    out = set()
    for d, _, w in split:
        run = None
        for p in range(len(w) - n + 1):
            f = first[tuple(w[p : p + n])]
            if f == (d, p):
                run = None
            elif run and run[3] == f[0]:
                out.discard(run)
                run = (d, run[1], p + n, f[0])
                out.add(run)
            else:
                run = (d, p, p + n, f[0])
                out.add(run)
    return out


@pytest.mark.parametrize(("n", "q"), [(50, 13), (7, 3), (5, 8), (12, 5)])
def test_repeats_are_brute_force(spark, n, q):
    r = random.Random(n)
    shared = [words(r, n + r.randint(0, 30)) for _ in range(4)]
    rows = []
    for k in range(40):
        w = words(r, r.randint(0, 80))
        for _ in range(r.randint(0, 2)):
            at = r.randint(0, len(w))
            w = w[:at] + r.choice(shared) + w[at:]
        rows.append((k, "\n ".join(w)))
    rows += [(100, ""), (101, None), (None, " ".join(shared[0])), (102, " ".join(shared[1] * 3))]
    got = [tuple(x) for x in repeats.repeated_spans(frame(spark, rows), n, q).collect()]
    assert sorted(got) == sorted(brute_spans(rows, n)) and len(got) > 3


def test_repeats_are_cut_out(spark):
    a = " ".join(f"a{k}" for k in range(20))
    df = frame(spark, [(1, f"é {a} end", 1), (2, f"start {a}  tail é", 2), (3, None, 3), (4, "x", 4)], "doc_id bigint, text string, __n int")
    got = repeats.without_repeats(df, 20, 5)
    assert got.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: f"é {a} end", 2: "start   tail é", 3: None, 4: "x"}
    assert repeats.repeated_spans(frame(spark, [])).count() == 0


def test_repeats_of_rows_that_repeat_an_id_and_clashing_names(spark):
    a = " ".join(f"a{k}" for k in range(30))
    df = frame(spark, [(1, a, 1), (1, a, 2), (None, "x " + a, 3)], "doc_id bigint, text string, spans int")
    assert {r["spans"]: r["text"] for r in repeats.without_repeats(df.coalesce(1), 20, 5).collect()} == {1: a, 2: "", 3: "x "}


def test_repeats_in_a_long_text_and_negative_ids(spark):
    r = random.Random(2)
    w = words(r, 40_000)
    rows = [(-5, " ".join(w[100:200])), (3, " ".join(w)), (-7, " ".join(w[20_000:20_060]))]
    got = [tuple(x) for x in repeats.repeated_spans(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(brute_spans(rows, 50))


def test_slices_sent_together_give_the_same(spark, monkeypatch):
    rows = near_rows(6, 6)
    rows += [(2000 + d, t) for d, t in rows[:9]]
    want = brute_classes(rows, jaccard.N, jaccard.THRESHOLD)
    spans = brute_spans(rows, 12)
    for module in (jaccard, repeats):
        monkeypatch.setattr(module, "SLICE", 400)
    for full in (1, 40, 10**6):
        monkeypatch.setattr(census, "FULL", full)
        df = frame(spark, rows)
        assert sorted(map(tuple, jaccard.jaccard_classes(df).collect())) == want
        assert {tuple(r) for r in repeats.repeated_spans(df, 12, 5).collect()} == spans
