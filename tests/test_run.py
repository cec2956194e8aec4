import bz2
import gzip
import io
import json
import lzma
import random
import signal
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from quarry.__main__ import main
from quarry.config import effective
from quarry import control, streaming
from quarry.control import Cancelled, cancellable
from quarry.plans import corpus, registry
from quarry.sources import files
from quarry.train import TrainerError, train, vocabulary_checks


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(zipfile.ZipInfo(name), data)
    return out.getvalue()


def tarred(**members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as t:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


def found(spark, path, **options):
    texts, issues = files.discover(files.read_files(spark, str(path)), **options)
    return sorted((r["path"], bytes(r["content"])) for r in texts.collect()), sorted((r["id"], r["path"], r["reason"]) for r in issues.collect())


def test_single_file(spark, tmp_path):
    (tmp_path / "corpus.data").write_text("hello")
    assert [c for _, c in found(spark, tmp_path / "corpus.data")[0]] == [b"hello"]


def test_folders_go_by_content(spark, tmp_path):
    (tmp_path / "nested").mkdir()
    (tmp_path / "a.bin").write_text("a")
    (tmp_path / "nested" / "b.weird").write_text("b")
    (tmp_path / "binary").write_bytes(b"\x00\x9f\x92\x96")
    (tmp_path / ".hidden").write_text("x")
    (tmp_path / "empty").write_bytes(b"")
    (tmp_path / "skip.log").write_text("x")
    (tmp_path / ".gitignore").write_text("*.log\n")
    texts, issues = found(spark, tmp_path)
    assert [c for _, c in texts] == [b"a", b"b"]
    assert [(i, r) for i, _, r in issues] == [("unsupported_file", files.UNKNOWN), ("unsupported_file", "empty file")]


@pytest.mark.parametrize(
    ("name", "content"),
    [("zip", zipped(inside=b"inside")), ("zip in zip", zipped(a=zipped(b=b"inside"))), ("tar", tarred(a=b"inside")), ("gz", gzip.compress(b"inside")), ("bz2", bz2.compress(b"inside")), ("xz", lzma.compress(b"inside")), ("tar.gz", gzip.compress(tarred(a=b"inside")))],
)
def test_containers(spark, tmp_path, name, content):
    (tmp_path / name.replace(" ", "_")).write_bytes(content)
    texts, issues = found(spark, tmp_path)
    assert [c for _, c in texts] == [b"inside"] and issues == []
    assert len(texts[0][0]) == 64 and "!/" in found(spark, tmp_path, logical=True)[0][0][0]


def test_copies_depth_and_broken_members(spark, tmp_path):
    same = zipped(a=b"text")
    (tmp_path / "1").write_bytes(same)
    (tmp_path / "2").write_bytes(same)
    deep = b"core"
    for _ in range(files.DEPTH + 2):
        deep = zipped(x=deep)
    (tmp_path / "3").write_bytes(deep)
    (tmp_path / "4").write_bytes(gzip.compress(b"half" * 1000)[:-20])
    texts, issues = found(spark, tmp_path)
    assert [c for _, c in texts] == [b"text"]
    assert [i for i, _, _ in issues] == ["archive_cycle", "archive_depth_exceeded", "archive_read_failed"]


def test_files_are_read_twice_and_copies_of_a_path_told_apart(spark, tmp_path):
    log = str(tmp_path / "read")

    def note(frames):
        for frame in frames:
            with open(log, "a") as f:
                f.writelines(f"{p}\n" for p in frame["path"])
            yield frame

    inner = gzip.compress(b"inner", mtime=0)
    blobs = [("a", zipped(x=inner)), ("b", inner), ("c", zipped(x=inner, y=b"of c")), ("d", b"plain"), ("e", b"\x00"), ("f", gzip.compress(b"of f", mtime=0)), ("f", gzip.compress(b"of f", mtime=0)), ("g", b"\x1f\x8bnot gzip")]
    df = spark.createDataFrame([(p, bytearray(c)) for p, c in blobs], "path string, content binary")
    texts, issues = files.discover(df.mapInPandas(note, df.schema), logical=True)
    assert sorted((r["path"], bytes(r["content"])) for r in texts.collect()) == [("a!/x!/gzip", b"inner"), ("c!/y", b"of c"), ("d", b"plain"), ("f!/gzip", b"of f")]
    assert sorted((r["id"], r["path"]) for r in issues.collect()) == [("archive_cycle", "b"), ("archive_cycle", "c!/x"), ("archive_cycle", "f"), ("archive_read_failed", "g"), ("unsupported_file", "e")]
    with open(log) as f:
        assert len(f.readlines()) <= 2 * len(blobs)


def test_pages_are_packed_once(spark, tmp_path):
    log = str(tmp_path / "packed")
    spark.createDataFrame([(k, f"page {k}") for k in range(9)], "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))

    def pack(page, content):
        with open(log, "a") as f:
            f.write(f"{page}\n")
        return gzip.compress(content, mtime=0) if page else b"\0"

    texts, issues = registry._packed(spark, str(tmp_path), pack)
    assert sorted(bytes(r["content"]).decode() for r in texts.collect()) == [f"page {k}{k}" for k in range(1, 9)]
    assert [(r["id"], r["path"]) for r in issues.collect()] == [("unsupported_file", "0")]
    with open(log) as f:
        assert sorted(f.read().split()) == [str(k) for k in range(9)]


def test_pages_of_one_row_group_are_packed_by_several_tasks(spark, tmp_path):
    log = str(tmp_path / "tasks")
    pages = [(k, random.Random(k).randbytes(1 << 19).hex()) for k in range(12)]
    spark.createDataFrame(pages, "page_id long, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))

    def pack(page, content):
        from pyspark import TaskContext

        with open(log, "a") as f:
            f.write(f"{TaskContext.get().partitionId()}\n")
        return b"\0%d" % page

    assert registry._packed(spark, str(tmp_path), pack)[1].count() == len(pages)
    with open(log) as f:
        tasks = f.read().split()
    assert len(tasks) == len(pages) and len(set(tasks)) > 1


@pytest.mark.parametrize("name", ["container_dedupe", "archive_depth", "broken_archives", "unpack_containers", "unpack_gzip"])
def test_what_follows_unpacking_runs_no_python(spark, tmp_path, name):
    spark.createDataFrame([(k, f"page {k}") for k in range(9)], "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame([(k, "en", "web", f"text {k % 5}") for k in range(9)], "doc_id long, lang string, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    plan = registry.queries()[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "MapIn" not in plan and "Scan parquet" in plan


def test_unpack_gzip_on_copies_and_on_pages_without_content(spark, tmp_path):
    pages = [(2, "same"), (10, "same"), (3, None), (4, ""), (5, "other")]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    out = registry.queries()["unpack_gzip"](spark, str(tmp_path))
    assert sorted((r["page_id"], r["n_bytes"]) for r in out.collect()) == [(5, 5), (10, 4)]


def test_running_counts_add_batches_and_look_at_paths_by_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(4):
        (tmp_path / "in" / f"vendor{k % 2}-{k}.txt").write_text("word\n\n" + "x \u2211\n" * k)
    c = config(tmp_path, tmp_path / "in")
    root = "/elsewhere"  # so hints come from the files' names
    at = str(tmp_path / "run")
    assert streaming.latest_counts(spark, at).count() == 0
    for _ in range(2):  # the second finds no new files
        query = streaming.running_counts(streaming.read_stream(spark, str(tmp_path / "in"), 1), c, at, root).trigger(availableNow=True).start()
        query.awaitTermination()
        assert query.exception() is None
    table = spark.read.option("lineSep", "\n").text(str(tmp_path / "in")).select(F.col("_metadata.file_path").alias("path"), F.lit(1).cast("long").alias("line_number"), F.col("value").alias("line"))
    counts = streaming.bucket_counts(table, c, root)
    want = {("text", "latin", "unknown", f"vendor{k}", "short"): 2 for k in range(2)} | {("text", "unknown", "unknown", f"vendor{k}", "short"): 2 for k in range(2)} | {("math", "latin", "unknown", "vendor0", "short"): 2, ("math", "latin", "unknown", "vendor1", "short"): 4}
    for df in (counts, streaming.latest_counts(spark, at)):
        assert {tuple(r)[:5]: r["lines"] for r in df.collect()} == want
    assert sorted(x.name for x in (tmp_path / "run" / "counts").iterdir()) == ["2", "3"]
    assert "Aggregate [path" in counts._jdf.queryExecution().optimizedPlan().toString()


_PAGES = [(k, None if k in (1, 7) else f"page {k} " * 80) for k in range(10)]


def _results(spark, tmp_path, name, column):
    spark.createDataFrame(_PAGES, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    return sorted((r["page_id"], r[column]) for r in registry.queries()[name](spark, str(tmp_path)).collect())


def test_broken_archives_on_pages_without_content(spark, tmp_path):
    assert _results(spark, tmp_path, "broken_archives", "result") == sorted((k, r) for k, html in _PAGES if html for r in ("text", "archive_read_failed"))


def test_unpack_containers_on_pages_without_content(spark, tmp_path):
    assert _results(spark, tmp_path, "unpack_containers", "member") == [(k, ["a", "a", "gzip", "bzip2", "xz"][k % 5]) for k, html in _PAGES if html]


def test_unpack_containers_packs_within_a_small_dictionary(spark, tmp_path, monkeypatch):
    packs, packed = [], registry._packed
    monkeypatch.setattr(registry, "_packed", lambda spark, sf_dir, pack: packs.append(pack) or packed(spark, sf_dir, pack))
    assert _results(spark, tmp_path, "unpack_containers", "n_bytes") == [(k, len(html) + 1) for k, html in _PAGES if html]
    page = random.Random(2).randbytes(3000).hex().encode()
    xz = packs[0](4, page)
    assert files.sniff(xz)[0] == "xz" and lzma.LZMADecompressor(memlimit=1 << 20).decompress(xz) == page
    assert [files.sniff(packs[0](k, page))[0] for k in range(4)] == ["zip", "tar", "gzip", "bzip2"]
    assert packs[0](2, page) == packs[0](7, page) and packs[0](2, page)[4:8] == bytes(4)  # no clock in it


def test_sniff_counts_controls_of_one_byte_and_of_two():
    for odd in ("\x01", "\x7f", "\x80", "\x9f"):
        assert files.sniff((odd + "\xa0" * 19).encode())[0] == "text"
        assert files.sniff((odd + "\xa0" * 18).encode())[0] == "unsupported"
    assert files.sniff("\n\r\t\xc2".encode())[0] == "text"


def test_missing_paths(spark, tmp_path):
    with pytest.raises(files.SourceError, match="does not exist"):
        files.read_files(spark, str(tmp_path / "none"))
    assert files.read_files(spark, str(tmp_path)).count() == 0


def test_sniff_agrees_in_python_and_in_columns(spark):
    edge = b"a" * (files.SNIFF - 1) + "é".encode() + b"b"
    blobs = [b"", b"x", b"PK\x03\x04..", b"\x1f\x8b", b"BZh9", b"\xfd7zXZ\x00", b"x" * 257 + b"ustar", b"\xff", b"a\x00", edge, b"\x01" + b"a" * 19, b"\x01" + b"a" * 18, "é".encode()]
    df = spark.createDataFrame([(bytearray(b),) for b in blobs], "c binary")
    got = [r[0] for r in df.select(files.sniff_column(F.col("c"))).collect()]
    assert got == [files.sniff(b[: files.SNIFF + 1])[0] for b in blobs]
    assert files.sniff(edge, strict=True)[0] == "unsupported"


def config(tmp_path, source, **more):
    return effective({"corpus": {"path": str(source)}, "output": {"work_dir": str(tmp_path / "work"), "model_prefix": "tok"}} | more)


def test_a_whole_run_and_a_second_training(spark, tmp_path):
    source = tmp_path / "corpus" / "vendor" / "en"
    source.mkdir(parents=True)
    for k in range(3):
        (source / f"{k}.txt").write_text("".join(f"café number {k} {i} and some words­\n" for i in range(120)))
    (source / "z").write_bytes(zipped(a="zipped текст\n".encode() * 30))
    c = config(tmp_path, tmp_path / "corpus", balancing={"max_part_lines": 100, "total_lines": 300, "collapse_buckets_below_lines": 10}, sentencepiece={"vocab_size": 320, "train_extremely_large_corpus": False, "input_sentence_size": 1000}, num_threads=2)
    result = corpus.run(spark, c)
    assert (result["files_read"], result["lines_read"], result["lines_written"], result["lines_fixed"], result["lines_skipped"]) == (4, 390, 390, 360, 0)
    report = json.loads((tmp_path / "work" / "reports" / "balance.json").read_text())
    assert report["input_lines"] == 390 and report["output_lines"] == sum(b["output_lines"] for b in report["buckets"])
    assert all(b["target_lines"] == b["output_lines"] for b in report["buckets"])
    assert sum(len(spark.read.text(f).collect()) for f in report["training_files"]) == report["output_lines"]
    assert max(spark.read.text(f).count() for f in report["training_files"]) <= 100
    assert all(r["value"].endswith("words-") or "zipped" in r["value"] for r in spark.read.text(result["fixed_corpus"]).collect())
    assert spark.read.json(result["issue_log"]).count() == 360
    assert result["trainer"]["status"] == "succeeded" and (tmp_path / "work" / "tok.model").exists()
    assert corpus.train_only(c)["trainer"]["status"] == "succeeded"


def test_failures_are_told(spark, tmp_path):
    (tmp_path / "bad").write_bytes(b"\x00\x01")
    with pytest.raises(corpus.RunError, match="no usable lines"):
        corpus.run(spark, config(tmp_path, tmp_path / "bad"))
    (tmp_path / "few.txt").write_text("ab\n")
    with pytest.raises(TrainerError):
        corpus.run(spark, config(tmp_path, tmp_path / "few.txt"))
    said = json.loads((tmp_path / "work" / "trainer_output.json").read_text())
    assert said["status"] == "failed" and said["error"]


def test_train_only_needs_a_report(tmp_path):
    c = config(tmp_path, tmp_path)
    (tmp_path / "work" / "reports").mkdir(parents=True)
    (tmp_path / "work" / "reports" / "balance.json").write_text('{"training_files": []}')
    with pytest.raises(TrainerError, match="no training files"):
        corpus.train_only(c)


def test_the_command(spark, tmp_path, capfd):
    (tmp_path / "data").mkdir()
    for k in range(40):
        (tmp_path / "data" / f"{k}.txt").write_text(f"some text number {k} with words\n" * 5)
    raw = {"corpus": {"path": str(tmp_path / "data")}, "output": {"work_dir": str(tmp_path / "work"), "model_prefix": "tok"}, "sentencepiece": {"vocab_size": 330, "train_extremely_large_corpus": False}, "num_threads": 2}
    (tmp_path / "cfg.json").write_text(json.dumps(raw))
    assert main(["train", "--config", str(tmp_path / "cfg.json"), "--json"], spark) == 0
    said = json.loads(capfd.readouterr().out)
    assert (said["text_files"], said["lines_read"], said["balanced_lines"]) == (40, 200, 200)
    assert main(["train", "--config", str(tmp_path / "cfg.json"), "--train-only"], spark) == 0
    assert capfd.readouterr().out.startswith("trained again with preset ocr_multilingual")


def test_exit_codes(spark, tmp_path, capfd):
    assert main(["train", "--config", str(tmp_path / "none.json")], spark) == 2
    (tmp_path / "cfg.json").write_text(json.dumps({"corpus": {"path": str(tmp_path / "none")}, "output": {"work_dir": str(tmp_path / "w"), "model_prefix": "m"}}))
    assert main(["train", "--config", str(tmp_path / "cfg.json")], spark) == 3
    assert "does not exist" in capfd.readouterr().err


def test_cancelling(spark):
    with pytest.raises(Cancelled), cancellable(spark):
        signal.raise_signal(signal.SIGINT)
    assert spark.range(3).count() == 3


def test_names_that_look_like_patterns_are_read_once(spark, tmp_path):
    for name in ("a[1].txt", "a1.txt", "a(1).txt", "b*.txt", "bb.txt", "c?.txt", "cc.txt", "{d,e}.txt", "d.txt", "f g%20.txt"):
        (tmp_path / name).write_text(name)
    texts, _ = found(spark, tmp_path)
    assert sorted(c.decode() for _, c in texts) == sorted(x.name for x in tmp_path.iterdir())
    assert [c for _, c in found(spark, tmp_path / "b*.txt")[0]] == [b"b*.txt"]


def test_ignore_files_of_folders_above(tmp_path):
    (tmp_path / ".git" / "info").mkdir(parents=True)
    (tmp_path / ".git" / "info" / "exclude").write_text("# no comments\n*.tmp\n")
    (tmp_path / ".gitignore").write_text("*.log\n")
    root = tmp_path / "in" / "corpus"
    root.mkdir(parents=True)
    for name in ("a.txt", "b.log", "c.tmp", "d.log"):
        (root / name).write_text("x")
    (root / ".ignore").write_text("!d.log\n")
    assert [f.rsplit("/", 1)[1] for f in files.walk(str(root))] == ["a.txt", "d.log"]


def test_a_trainer_that_is_not_there_or_hangs(tmp_path):
    part = tmp_path / "part.txt"
    part.write_text("x\n")
    config = effective({"corpus": {"path": str(tmp_path)}, "output": {"work_dir": str(tmp_path), "model_prefix": "m"}})
    config.sentencepiece.python.runner = str(tmp_path / "nothing")
    with pytest.raises(TrainerError, match="can't be started"):
        train(config, [str(part)])
    assert json.loads((tmp_path / "trainer_output.json").read_text())["status"] == "failed"
    config.sentencepiece.python.runner = "python"
    config.sentencepiece.python.args = ["-c", "import sys, time; print('on its way', flush=True); time.sleep(60)"]
    with pytest.raises(TrainerError, match="stopped after 2"):
        train(config, [str(part)], timeout=2)
    assert json.loads((tmp_path / "trainer_output.json").read_text())["stdout"] == ["on its way"]


def test_an_equal_archive_within_another_is_unpacked_once(spark, tmp_path):
    inner = zipped(x=b"inside")
    (tmp_path / "1").write_bytes(zipped(a=inner, b=b"first"))
    (tmp_path / "2").write_bytes(zipped(a=inner, c=b"second"))
    (tmp_path / "3").write_bytes(inner)
    texts, issues = found(spark, tmp_path)
    assert sorted(c for _, c in texts) == [b"first", b"inside", b"second"]
    assert [i for i, _, _ in issues] == ["archive_cycle", "archive_cycle"]


def test_large_texts_are_read_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "WHOLE", 3000)
    lines = [("x" * (k % 90) + ("\r" if k % 7 == 0 else "")).encode() + (b"\xff" if k == 500 else b"") for k in range(2000)]
    (tmp_path / "big[1].txt").write_bytes(b"\n".join(lines) + b"\n")
    (tmp_path / "small.txt").write_text("a\nb")
    (tmp_path / "big.zip").write_bytes(zipped(a=bytes(random.Random(1).randbytes(9000))))
    (tmp_path / "big.bin").write_bytes(b"\0" * 9000)
    raw, issues, sizes = files.large_files(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        got = sorted((r["line_number"], bytes(r["bytes"])) for r in raw.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(k + 1, x.removesuffix(b"\r")) for k, x in enumerate(lines)]
    assert sorted(r["id"] for r in issues.collect()) == ["archive_read_failed", "unsupported_file"] and sizes.count() == 1
    config = effective({"corpus": {"path": str(tmp_path)}, "output": {"work_dir": str(tmp_path / "w"), "model_prefix": "m"}})
    sizes, source_issues, processed = corpus.repair_lines(spark, config)
    assert sizes.count() == 2 and source_issues.count() == 2 and processed.count() == 2002


def test_a_run_by_uris(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(20):
        (tmp_path / "in" / f"f{k}.txt").write_text("\n".join(f"some words of file {k} and line {j} here" for j in range(30)))
    raw = {"corpus": {"path": f"file://{tmp_path}/in"}, "output": {"work_dir": f"file://{tmp_path}/work", "model_prefix": "m"}, "sentencepiece": {"vocab_size": 330}}
    result = corpus.run(spark, effective(raw))
    assert (tmp_path / "work" / "m.model").exists() and (tmp_path / "work" / "reports" / "balance.json").exists() and result["lines_read"] == 600
    assert json.loads((tmp_path / "work" / "effective_config.json").read_text())["output"]["model_prefix"] == "m"
    assert vocabulary_checks(str(tmp_path / "work" / "m.model")) == {"pieces": 330, "not_nfc": 0, "many_digits": 0, "bytes": 256}
    again = corpus.train_only(effective(raw))
    assert again["trainer"]["status"] == "succeeded"
    remote = effective(raw | {"output": {"work_dir": f"viewless://{tmp_path}/work", "model_prefix": "m"}})
    with pytest.raises(Exception, match="viewless"):
        train(remote, [f"viewless://{tmp_path}/part"])


def test_progress_is_told_while_stages_run(spark, monkeypatch, capsys):
    monkeypatch.setattr(control, "PLAIN", 0.05)
    with control.progress(spark, True):
        spark.range(4, numPartitions=4).selectExpr("reflect('java.lang.Thread', 'sleep', id * 0 + 400L)").write.format("noop").mode("overwrite").save()
    assert "/4" in capsys.readouterr().err
