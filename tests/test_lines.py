import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.config import effective
from quarry.functions import text as T
from quarry.operators import chunk, classify, lines, repair

RAW = {"corpus": {"path": "c"}, "output": {"work_dir": "w", "model_prefix": "m"}}


def config(**sections):
    return effective(RAW | sections)


def processed(spark, rows, **sections):
    return repair.process(spark.createDataFrame(rows, "path string, line_number bigint, line string"), config(**sections))


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("﻿café ​", "café "), ("Ａ ﬁ ‌‍", "Ａ ﬁ ‌‍"), ("ﻛ", "ك"), ("co­operate", "cooperate"),
        ("line­", "line-"), ("x­​", "x"), ("﴾", "﴾"), ("q̣̇", "q̣̇"), ("", ""), ("plain", "plain"),
    ],
)
def test_canonical(spark, given, wanted):
    df = spark.createDataFrame([(given,)], "t string")
    assert df.select(T.canonical(F.col("t"))).first()[0] == wanted


def model(t):
    out = []
    for i, c in enumerate(t):
        if c in "﻿​":
            continue
        if c == "­":
            out.append("-" if i == len(t) - 1 else "")
        elif c == " ":
            out.append(" ")
        elif "ﭐ" <= c <= "﷿" or "ﹰ" <= c <= "﻿":
            out.append(unicodedata.normalize("NFKC", c))
        else:
            out.append(c)
    return unicodedata.normalize("NFC", "".join(out))


def test_canonical_like_a_model_by_character(spark):
    import random

    r = random.Random(1)
    signs = "ab  ­​﻿ﭐﷺﻛﹼе̧́é가가"
    rows = [("".join(r.choice(signs) for _ in range(r.randint(0, 8))),) for _ in range(400)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select("t", T.canonical(F.col("t")).alias("c"), T.canonical(T.canonical(F.col("t"))).alias("cc")).collect()
    assert all(x["c"] == model(x["t"]) and x["cc"] == x["c"] for x in got)


@pytest.mark.parametrize(
    ("text", "most", "wanted"),
    [
        ("alpha beta gamma", 10, ["alpha ", "beta ", "gamma"]), ("éééé", 5, ["éé", "éé"]), ("one, two three", 9, ["one, two ", "three"]), ("abcdefghij", 4, ["abcd", "efgh", "ij"]),
        ("ab cd", 5, ["ab cd"]), ("ab cd e", 6, ["ab cd ", "e"]), ("a b c d e f", 4, ["a b ", "c d ", "e ", "f"]), ("a.́bcdef", 5, ["a.́b", "cdef"]), ("x́̂y", 3, None), ("", 5, [""]), ("x", 0, None),
    ],
)
def test_chunks(text, most, wanted):
    assert chunk.chunks(text, most) == wanted


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .,é́日", max_size=40), st.integers(1, 12))
def test_chunks_fit_and_add_up(text, most):
    got = chunk.chunks(text, most)
    if got is not None:
        assert "".join(got) == text and all(len(c.encode()) <= most for c in got)


def test_lines_end_as_files_do(spark):
    df = spark.createDataFrame([("a", "x\r\ny\n"), ("b", "p\n\nq\r\r\n"), ("c", ""), ("d", None), ("e", "z")], "path string, text string")
    got = [tuple(r) for r in lines.lines(df).orderBy("path", "line_number").collect()]
    assert got == [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "p"), ("b", 2, ""), ("b", 3, "q\r"), ("e", 1, "z")]


def test_bad_utf8_is_skipped(spark):
    df = spark.createDataFrame([("f", b"ok\n\xff\n")], "path string, content binary")
    done = repair.process(lines.raw_lines(df), config())
    assert [r["text"] for r in repair.outputs(done).collect()] == ["ok"]
    assert [(r["id"], r["action"], r["line_number"], r["line_text"]) for r in repair.issues(done).collect()] == [("invalid_utf8", "skipped", 2, None)]
    assert repair.summary(done).first().asDict() == {"lines_read": 2, "lines_written": 1, "lines_fixed": 0, "lines_skipped": 1}


def test_fixes_count_each_and_skips_drop_them(spark):
    done = processed(spark, [("f", 1, "café one two"), ("f", 2, "x́̂y "), ("f", 3, None), ("f", 4, "")], sentencepiece={"max_sentence_length": 7})
    assert repair.summary(done).first().asDict() == {"lines_read": 4, "lines_written": 6, "lines_fixed": 3, "lines_skipped": 0}
    tight = processed(spark, [("f", 2, "x́̂̃y ")], sentencepiece={"max_sentence_length": 4})
    assert [r["id"] for r in repair.issues(tight).collect()] == ["max_sentence_length"]
    assert repair.outputs(processed(spark, [("f", 1, "abc")], sentencepiece={"max_sentence_length": 0})).count() == 0


def test_text_is_logged_only_on_demand(spark):
    row = [("f", 1, "a b")]
    assert repair.issues(processed(spark, row)).first()["line_text"] is None
    assert repair.issues(processed(spark, row, validation={"include_line_text_in_log": True})).first()["line_text"] == "a b"


def test_order_survives_partitions(spark):
    rows = [("f", k, f"line-{k}") for k in range(1, 500)]
    got = repair.outputs(processed(spark, rows)).repartition(7).orderBy("path", "line_number", "chunk_index").collect()
    assert [r["text"] for r in got] == [r[2] for r in rows]


@pytest.mark.parametrize(
    ("text", "script"),
    [("hello", "latin"), ("Привет мир", "cyrillic"), ("123 !", "unknown"), ("", "unknown"), ("日本語 ab", "han"), ("ab вг", "cyrillic"), ("𐐨𐐩 a", "deseret"), ("µ", "unknown"), ("ابت", "arabic")],
)
def test_scripts(spark, text, script):
    assert spark.createDataFrame([(text,)], "t string").select(T.dominant_script(F.col("t"))).first()[0] == script


def test_path_hints(spark):
    df = spark.createDataFrame([("vendor/es/books/file",), ("vendor/books/file",), ("x/y",), ("EN-us/ab/cde",), ("",), (None,)], "path string")
    got = [(r["language_hint"], r["source_group"]) for r in classify.path_hints(df).collect()]
    assert got == [("es", "vendor"), ("unknown", "vendor"), ("unknown", "unknown"), ("en", "cde"), ("unknown", "unknown"), ("unknown", "unknown")]
    below = spark.createDataFrame([("/corpus/vendor/es/books/page.txt",), ("/other/es.txt",)], "path string")
    assert [r["source_group"] for r in classify.path_hints(below, "/corpus/vendor/es").collect()] == ["books", "txt"]


def test_length_bins_and_domains(spark):
    df = spark.createDataFrame([("x" * n,) for n in (0, 40, 41, 240, 241)] + [("\\frac",), ("a ≤ b",)], "t string")
    assert [r[0] for r in df.select(T.length_bin(F.col("t"))).collect()[:5]] == ["short", "short", "normal", "normal", "long"]
    assert [r[0] for r in df.select(T.domain(F.col("t"))).collect()][4:] == ["text", "math", "math"]


def test_slug_and_languages(spark):
    df = spark.createDataFrame([("Ab--c d",), ("__",), ("é",)], "t string")
    assert [r[0] for r in df.select(T.slug(F.col("t"))).collect()] == ["ab_c_d", "unknown", "unknown"]
    assert len(T.LANGUAGES) == len(set(T.LANGUAGES)) == 197
