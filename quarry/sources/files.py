"""Texts from folders of anything: kinds by content, archives and compressed files unpacked to any depth."""

from __future__ import annotations

import bz2
import fnmatch
import gzip
import hashlib
import io
import lzma
import os
import re
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import BATCH_ROWS, arrow_map, read_bytes, saved

SNIFF, DEPTH = 8192, 16
#: Bytes of a file that one task takes as a whole; larger texts are read in parts, larger containers are issues.
WHOLE = 1 << 30
#: Bytes of texts that an unpacking task gathers before it hands them on.
BATCH_BYTES = 8 << 20
_TAR_AT = 257
_MAGIC = (("zip", (b"PK\x03\x04", b"PK\x05\x06", b"PK\x07\x08")), ("gzip", (b"\x1f\x8b",)), ("bzip2", (b"BZh",)), ("xz", (b"\xfd7zXZ\x00",)))
#: Control characters but tabs and line breaks: those of one byte, and those of two.
_CONTROLS, _C1 = bytes(c for c in (*range(32), 127) if c not in b"\n\r\t"), re.compile("[\x80-\x9f]")
UNKNOWN = "not recognized as text, archive, or compressed text"


class SourceError(OSError):
    """A corpus that can't be read at all."""


def sniff(head: bytes, strict: bool = False) -> tuple[str, str | None]:
    """Kind of a content by its first 8192 bytes, and the reason if it is unsupported.

    ``strict`` takes a character that the window cuts for an invalid one.
    """
    cut = len(head) > SNIFF or len(head) == SNIFF
    head = head[:SNIFF]
    if not head:
        return "unsupported", "empty file"
    for kind, starts in _MAGIC:
        if head.startswith(starts):
            return kind, None
    if head[_TAR_AT : _TAR_AT + 5] == b"ustar":
        return "tar", None
    for back in range(4 if cut and not strict else 1):
        try:
            text = (whole := head[: len(head) - back]).decode("utf-8")
        except UnicodeDecodeError:
            continue
        odd = len(whole) - len(whole.translate(None, _CONTROLS)) + (len(_C1.findall(text)) if b"\xc2" in whole else 0)
        if text and "\0" not in text and odd * 20 <= len(text):
            return "text", None
        break
    return "unsupported", UNKNOWN


def sniff_column(content: Column) -> Column:
    """The kind as a built-in expression over a binary column; a character that the window cuts is left out."""
    head = F.substring(content, 1, SNIFF)
    digits = F.hex(F.substring(content, 1, 6))
    kind = F.when(F.length(content) == 0, "unsupported")
    for name, starts in _MAGIC:
        kind = kind.when(digits.rlike("^(" + "|".join(s.hex().upper() for s in starts) + ")"), name)
    kind = kind.when(F.hex(F.substring(content, _TAR_AT + 1, 5)) == b"ustar".hex().upper(), "tar")
    text = F.try_validate_utf8(head.cast("string"))
    for back in (1, 2, 3):
        text = F.coalesce(text, F.when(F.length(content) > SNIFF, F.try_validate_utf8(F.substring(content, 1, SNIFF - back).cast("string"))))
    plain = text.isNotNull() & ~F.contains(text, F.lit("\0")) & (F.regexp_count(text, F.lit("[\\p{Cc}&&[^\\n\\r\\t]]")) * 20 <= F.length(text))
    return kind.when(plain, "text").otherwise("unsupported")


def _ignored(rules: list[tuple[str, list[str]]], path: str, folder: bool) -> bool:
    """Ignore files of the folders above, nearer ones and later lines last; ``!`` takes back."""
    out = False
    for root, lines in rules:
        below = os.path.relpath(os.path.abspath(path), root) if os.path.isabs(root) else os.path.relpath(path, root)
        for line in lines:
            wanted, take = (line[1:], False) if line.startswith("!") else (line, True)
            if wanted.endswith("/") and not folder:
                continue
            wanted = wanted.rstrip("/")
            fits = fnmatch.fnmatch(below, wanted.lstrip("/")) if "/" in wanted else fnmatch.fnmatch(os.path.basename(path), wanted)
            if fits:
                out = take
    return out


def _rules(folder: str) -> list[tuple[str, list[str]]]:
    found = []
    for name in (".gitignore", ".ignore"):
        if os.path.isfile(at := os.path.join(folder, name)):
            with open(at, encoding="utf-8", errors="replace") as f:
                found.append((folder, [x.strip() for x in f if x.strip() and not x.startswith("#")]))
    return found


def _above(root: str) -> list[tuple[str, list[str]]]:
    """Rules of the folders above, farthest first, and the excludes of the repository that the folder lies in."""
    found, folder = [], os.path.abspath(root)
    while True:
        exclude = os.path.join(folder, ".git", "info", "exclude")
        if os.path.isfile(exclude):
            with open(exclude, encoding="utf-8", errors="replace") as f:
                found.append((folder, [x.strip() for x in f if x.strip() and not x.startswith("#")]))
        parent = os.path.dirname(folder)
        if parent == folder:
            return found[::-1]
        found += _rules(parent)[::-1]
        folder = parent


def walk(root: str) -> list[str]:
    """Regular files below a folder, sorted; hidden ones and those that ignore files name, also those of folders above, are left out."""
    out, todo = [], [(root, _above(root))]
    while todo:
        folder, rules = todo.pop()
        rules = rules + _rules(folder)
        for entry in os.scandir(folder):
            if entry.name.startswith(".") or _ignored(rules, entry.path, entry.is_dir(follow_symlinks=False)):
                continue
            if entry.is_dir(follow_symlinks=False):
                todo.append((entry.path, rules))
            elif entry.is_file(follow_symlinks=False):
                out.append(entry.path)
    return sorted(set(out))


def _listed(spark: SparkSession, path: str) -> tuple[DataFrame | None, list[str]]:
    """A reader of all files of some bytes as ``path, length, content``, and the paths of files without any."""
    reader = spark.read.format("binaryFile")
    if "://" in path:
        return reader.option("recursiveFileLookup", "true").load(path), []
    if os.path.isfile(path) or os.path.isdir(path):
        paths = [path] if os.path.isfile(path) else walk(path)
        some = [_uri(p) for p in paths if os.path.getsize(p)]
        # Spark's listing leaves out files of no bytes.
        return reader.load(some) if some else None, [p for p in paths if not os.path.getsize(p)]
    if os.path.exists(path):
        raise SourceError(f"corpus path is neither a file nor a folder: {path}")
    raise SourceError(f"corpus path does not exist: {path}")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, content`` of a file, or of all files below a folder, up to WHOLE bytes each.

    A file that is named itself is taken whatever its name.  Folders on a local or
    mounted file system are walked with their ignore files; any other URI is left
    to Spark's own listing, which leaves out names that begin with ``.`` or ``_``.
    Larger files are those of ``large_files``; their content isn't read here.
    """
    files, empty = _listed(spark, path)
    none = spark.createDataFrame([(p, bytearray()) for p in empty], "path string, content binary")
    return none if files is None else _plain(files.where(F.col("length") <= WHOLE)).unionByName(none)


def large_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw lines, issues and ``path, length`` of the texts of the files beyond WHOLE bytes.

    Their kinds are told by their heads, on the driver, which holds a row a file.  Texts
    are split over tasks by Spark's reader; lines are numbered by the lines of the
    parts before.  Containers of that size are issues.
    """
    files, _ = _listed(spark, path)
    rows = [] if files is None else files.where(F.col("length") > WHOLE).select("path", "length").collect()
    texts, issues = [], []
    for r in rows:
        kind, reason = sniff(read_bytes(r["path"].removeprefix("file:") if r["path"].startswith("file:/") else r["path"], SNIFF))
        shown = re.sub("^file:(//)?", "", r["path"])
        if kind == "text":
            texts.append((r["path"], shown, r["length"]))
        elif kind == "unsupported":
            issues.append(("unsupported_file", shown, reason))
        else:
            issues.append(("archive_read_failed", shown, f"{kind} of {r['length']} bytes, beyond the limit of {WHOLE}"))
    sizes = spark.createDataFrame([(p, n) for _, p, n in texts], "path string, length bigint")
    found = spark.createDataFrame(issues, "id string, path string, reason string")
    if not texts:
        return spark.createDataFrame([], "path string, line_number bigint, bytes binary"), found, sizes
    read = spark.read.option("lineSep", "\n").text([_uri(p) for p, _, _ in texts])
    block = read.select(F.regexp_replace(F.col("_metadata.file_path"), "^file:(//)?", "").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    counts = block.groupBy("path", "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.withColumn("before", before).drop("n")  # a row a part of a file
    within = F.row_number().over(Window.partitionBy("path", "block").orderBy("at"))
    lines = block.join(starts, ["path", "block"]).select("path", (F.col("before") + within).alias("line_number"), F.regexp_replace(F.decode(F.col("value").cast("binary"), "ISO-8859-1"), "\r\\z", "").alias("line"))
    return lines.select("path", "line_number", F.encode("line", "ISO-8859-1").alias("bytes")), found, sizes


def _plain(files: DataFrame) -> DataFrame:
    return files.select(F.regexp_replace("path", "^file:(//)?", "").alias("path"), "content")


def _uri(path: str) -> str:
    """The path with what Spark reads as a pattern made literal."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def _members(kind: str, content: bytes, path: str) -> Iterator[tuple[int, str, bytes]]:
    if kind == "zip":
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for k, info in enumerate(z.infolist()):
                if not info.is_dir():
                    yield k, info.filename, z.read(info)
    elif kind == "tar":
        with tarfile.open(fileobj=io.BytesIO(content), mode="r:") as t:
            for k, info in enumerate(t):
                if info.isreg():
                    yield k, info.name, t.extractfile(info).read()
    else:
        yield 0, kind, {"gzip": gzip, "bzip2": bz2, "xz": lzma}[kind].decompress(content)


Unpacked = tuple[str, bytes | None, str | bytes | None, str | None, list[int]]


def unpack(path: str, content: bytes, depth: int = 0, logical: bool = False, strict: bool = False, seen: dict[bytes, int] | None = None, above: tuple[int, ...] = ()) -> Iterator[Unpacked]:
    """``(path, content, None, None, above)`` for each text in a file and ``(path, None, issue, reason, above)`` for what isn't read.

    Members read before an archive breaks are kept.  A member's path is the hash
    of container, index and name, or the two joined by ``!/`` if ``logical``.
    All streams of a compressed file are read.  ``seen`` gets the digest of every
    container with its number, and ``above`` has the numbers of those around a row;
    a container comes as a row ``(path, None, digest, kind of container, above)``
    whose last number is its own.
    """
    if depth > DEPTH:
        yield path, None, "archive_depth_exceeded", f"archive nesting exceeded depth limit {DEPTH}", list(above)
        return
    kind, reason = sniff(content, strict)
    if kind == "text":
        yield path, content, None, None, list(above)
    elif kind == "unsupported":
        yield path, None, "unsupported_file", reason, list(above)
    else:
        digest, seen = hashlib.sha256(content).digest(), {} if seen is None else seen
        word = "archive" if kind in ("zip", "tar") else "compressed"
        if digest in seen:
            yield path, None, "archive_cycle", f"{word} content was already seen", list(above)
            return
        seen[digest] = len(seen)
        above = (*above, seen[digest])
        yield path, None, digest, word, list(above)
        try:
            for k, name, inner in _members(kind, content, path):
                below = f"{path}!/{name}" if logical else hashlib.sha256(f"{path}:{k}:{name}".encode()).hexdigest()
                yield from unpack(below, inner, depth + 1, logical, strict, seen, above)
        except (OSError, EOFError, ValueError, RuntimeError, NotImplementedError, zipfile.BadZipFile, tarfile.TarError, lzma.LZMAError, zipfile.LargeZipFile) as error:
            yield path, None, "archive_read_failed", str(error) or type(error).__name__, list(above)


#: What comes of a file: texts and issues, and a row with a digest for each container.
_UNPACKED = "file bigint, top string, path string, content binary, digest binary, id string, reason string, above array<int>"


def _unpacked(batches: Iterator[pa.RecordBatch], logical: bool, strict: bool) -> Iterator[pa.RecordBatch]:
    """Rows of ``_UNPACKED`` of ``file, path, content``, up to BATCH_ROWS of them or BATCH_BYTES of texts at a time."""
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.string(), pa.string(), pa.list_(pa.int32())]
    names = [x.split()[0] for x in _UNPACKED.split(", ")]
    rows, size = [], 0
    flush = lambda: pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)
    for batch in batches:
        for file, top, content in zip(batch.column(0), batch.column(1), batch.column(2)):
            file, top = file.as_py(), top.as_py()
            for path, text, id_, reason, above in unpack(top, content.as_py(), 0, logical, strict):
                digest, id_ = (id_, None) if isinstance(id_, bytes) else (None, id_)
                rows.append((file, top, path, text, digest, id_, reason, above))
                size += len(text or b"")
                if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield flush()
                    rows, size = [], 0
    if rows:
        yield flush()


def discover(files: DataFrame, logical: bool = False, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Texts ``path, content`` and issues ``id, path, reason`` of ``path, content``.

    Texts pass by as they are, in the JVM.  Of containers with equal content, at any
    depth of any file, the first is taken, in the order of the files' paths and of
    members; the others are issues.  Every other file is unpacked once, in the task that
    reads it; what comes of it is written to the shared folder, and only digests are
    shuffled to find equal containers.  ``files`` is read twice, for texts and for the rest.
    """
    kinds = files.where(F.col("content").isNotNull()).withColumn("kind", sniff_column(F.col("content")))
    texts = kinds.where("kind = 'text'").select("path", "content")
    other = kinds.where("kind <> 'text'").select(F.monotonically_increasing_id().alias("file"), "path", "content")
    unpacked = saved(arrow_map(other, lambda batches: _unpacked(batches, logical, strict), _UNPACKED))
    container, own = F.col("digest").isNotNull(), F.element_at("above", -1)
    # A container that stands before in another file is an issue, and what it holds isn't taken from it.
    inside = unpacked.where(container).select("digest", "top", "file", own.alias("own"))
    place = F.row_number().over(Window.partitionBy("digest").orderBy("top", "file", "own"))
    again = saved(inside.withColumn("n", place).where("n > 1").select("file", "own"))
    gone = again.groupBy("file").agg(F.collect_set("own").alias("gone"))  # containers of one file, which is held by one task anyway
    within = lambda above: F.coalesce(F.arrays_overlap(above, "gone"), F.lit(False))
    left = unpacked.join(gone, "file", "left")
    found = left.where(F.col("content").isNotNull() & ~within("above")).select("path", "content")
    issues = left.where(F.col("id").isNotNull() & ~within("above")).select("id", "path", "reason")
    outer = left.where(container & F.array_contains("gone", own) & ~within(F.slice("above", F.lit(1), F.size("above") - 1)))
    cycles = outer.select(F.lit("archive_cycle").alias("id"), "path", F.concat("reason", F.lit(" content was already seen")).alias("reason"))
    return texts.unionByName(found), issues.unionByName(cycles)


def sizes(texts: DataFrame) -> DataFrame:
    """One row: how many texts of ``path, length`` there are, and their bytes."""
    return texts.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("n_bytes"))
