"""Queries over the test tables, one or more an operator, and the SQL that each is held against.

The documents hold nothing to repair, so artifacts are put into some of them by
their id, in the same way on both sides.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Balancing, Config, effective
from ..functions import text as T
from ..functions.names import bucket_stem
from ..operators import balance, classify, lines, repair
from ..runtime import arrow_map, saved, scratch
from ..sources import files as source
from ..sources.sinks import write_shards
from . import reports

#: Bytes a line in the chunking query; the other queries use the preset's limit.
SHORT = 200
#: A letter with more accents than ``SHORT`` bytes hold, as one cluster.
PILED = "e" + "\u0301" * 101
#: Arabic presentation forms, letters and ligatures, and what they fold to.
FORMS = {c: unicodedata.normalize("NFKC", c) for c in map(chr, (0xFB56, 0xFB8A, 0xFBFC, 0xFDF2, 0xFDFA, 0xFE8D, 0xFE91, 0xFECB, 0xFEDB, 0xFEE0, 0xFEF7, 0xFEFB))}
#: A line budget below what any test table holds, so that targets bind.
TOTAL = 1500


def config(most: int | None = None) -> Config:
    raw = {"corpus": {"path": "documents"}, "output": {"work_dir": "run", "model_prefix": "tokenizer"}}
    if most is not None:
        raw["sentencepiece"] = {"max_sentence_length": most}
    return effective(raw)


def budget() -> Balancing:
    b = config().balancing
    b.total_lines, b.collapse_buckets_below_lines, b.max_part_lines = TOTAL, 5, 40
    return b


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, text`` of all documents, with artifacts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    put = lambda n, s: F.when(F.col("doc_id") % n == 0, s).otherwise("")
    form = F.element_at(F.array(*map(F.lit, FORMS)), (F.floor(F.col("doc_id") / 17) % len(FORMS) + 1).cast("int"))
    text = F.concat(
        put(11, T.BOM), put(13, "Привет мир "), put(7, "cafe\u0301" + T.NBSP), put(17, F.concat(form, F.lit(" "))), put(19, "∑ x ≤ y "), put(29, "a" + T.ZWSP + "b "),
        put(31, "Ελλάδα και κόσμος "), put(37, "漢字 "), put(41, PILED + " "), "text", put(5, T.SHY), put(23, "\r"),
    )
    return docs.select(F.concat_ws("/", "lang", "source", "doc_id").alias("path"), text.alias("text"))


_FORM_LIST = "[" + ", ".join(f"'{c}'" for c in FORMS) + "]"
_FORM = "regexp_extract({0}, '[" + "".join(FORMS) + "]')"
_FILES = f"""
files AS (
    SELECT concat_ws('/', lang, source, doc_id) AS path,
        (CASE WHEN doc_id % 11 = 0 THEN chr(65279) ELSE '' END) || (CASE WHEN doc_id % 13 = 0 THEN 'Привет мир ' ELSE '' END)
        || (CASE WHEN doc_id % 7 = 0 THEN 'cafe' || chr(769) || chr(160) ELSE '' END) || (CASE WHEN doc_id % 17 = 0 THEN {_FORM_LIST}[(doc_id // 17) % {len(FORMS)} + 1] || ' ' ELSE '' END)
        || (CASE WHEN doc_id % 19 = 0 THEN '∑ x ≤ y ' ELSE '' END) || (CASE WHEN doc_id % 29 = 0 THEN 'a' || chr(8203) || 'b ' ELSE '' END)
        || (CASE WHEN doc_id % 31 = 0 THEN 'Ελλάδα και κόσμος ' ELSE '' END) || (CASE WHEN doc_id % 37 = 0 THEN '漢字 ' ELSE '' END) || (CASE WHEN doc_id % 41 = 0 THEN 'e' || repeat(chr(769), 101) || ' ' ELSE '' END) || text
        || (CASE WHEN doc_id % 5 = 0 THEN chr(173) ELSE '' END) || (CASE WHEN doc_id % 23 = 0 THEN chr(13) ELSE '' END) AS text
    FROM documents
),
split AS (SELECT path, string_split(text, chr(10)) AS parts FROM files WHERE text IS NOT NULL),
kept AS (SELECT path, CASE WHEN parts[len(parts)] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS parts FROM split),
numbered AS (SELECT path, unnest(range(1, len(parts) + 1)) AS line_number, unnest(parts) AS raw FROM kept),
lines AS (SELECT path, line_number, CASE WHEN suffix(raw, chr(13)) THEN left(raw, length(raw) - 1) ELSE raw END AS line FROM numbered)"""


def _folded(text: str) -> str:
    """At most one of the forms stands in a line."""
    return f"CASE {_FORM.format(text)} " + " ".join(f"WHEN '{c}' THEN replace({text}, '{c}', '{to}')" for c, to in FORMS.items()) + f" ELSE {text} END"


_CANON = f""",
mapped AS (
    SELECT path, line_number, line, replace(replace(replace(replace(
        CASE WHEN suffix(line, chr(173)) THEN left(line, length(line) - 1) || '-' ELSE line END, chr(160), ' '), chr(173), ''), chr(65279), ''), chr(8203), '') AS text
    FROM lines
), canon AS (SELECT path, line_number, line, nfc_normalize({_folded("text")}) AS text FROM mapped)"""


def _chunked(most: int) -> str:
    """Pieces of every line: characters stand for clusters, as the only long cluster has no place to break in it, and is over the shorter limit."""
    over = f"({most} < 203 AND contains(text, repeat(chr(769), 100)))"
    return f""",
over AS (SELECT path, line_number FROM canon WHERE {over}),
cut AS (
    SELECT path, line_number, -1 AS chunk_index, NULL::VARCHAR AS text, text AS rest FROM canon WHERE strlen(text) > {most} AND NOT {over}
    UNION ALL
    SELECT path, line_number, chunk_index + 1, left(rest, size), substr(rest, size + 1) FROM (
        SELECT *, coalesce(list_max(list_filter(range(1, room + 1), lambda i: i < length(rest) AND regexp_matches(substr(rest, i, 1), '[\\s.,;:!?)\\]}}]'))), room) AS size FROM (
            SELECT *, list_max(list_filter(range(1, least({most}, length(rest)) + 1), lambda i: strlen(left(rest, i)) <= {most})) AS room FROM cut WHERE rest <> ''))
),
repaired AS (
    SELECT path, line_number, 0 AS chunk_index, text FROM canon WHERE strlen(text) <= {most}
    UNION ALL SELECT path, line_number, chunk_index, text FROM cut WHERE chunk_index >= 0
)"""


_LANGUAGES = "[" + ", ".join(f"'{x}'" for x in T.LANGUAGES) + "]"
_HINTS = f""",
tokens AS (SELECT path, list_transform(list_filter(regexp_split_to_array(path, '[^0-9A-Za-z]+'), lambda t: t <> ''), lambda t: lower(t)) AS t FROM files),
hints AS (SELECT path, coalesce(list_filter(t, lambda x: list_contains({_LANGUAGES}, x))[1], 'unknown') AS language_hint,
    coalesce(list_filter(t, lambda x: NOT list_contains({_LANGUAGES}, x) AND strlen(x) >= 3)[1], 'unknown') AS source_group FROM tokens)"""
_CLASSES = r""",
scripts AS (SELECT *, [len(regexp_extract_all(text, '\p{Arabic}')), len(regexp_extract_all(text, '\p{Cyrillic}')), len(regexp_extract_all(text, '\p{Greek}')), len(regexp_extract_all(text, '\p{Han}')), len(regexp_extract_all(text, '\p{Latin}'))] AS n FROM repaired),
classified AS (
    SELECT s.path, line_number, chunk_index, text, language_hint, source_group,
        CASE WHEN regexp_matches(text, '[\\∑∫√≤≥]') THEN 'math' ELSE 'text' END AS domain,
        CASE WHEN list_max(n) = 0 THEN 'unknown' ELSE ['arabic', 'cyrillic', 'greek', 'han', 'latin'][list_position(n, list_max(n))] END AS script,
        CASE WHEN length(text) <= 40 THEN 'short' WHEN length(text) <= 240 THEN 'normal' ELSE 'long' END AS length_bin
    FROM scripts s JOIN hints USING (path)
)"""
_BUCKET = ", ".join(classify.BUCKET)
_ORDER = "CASE domain WHEN 'text' THEN 0 ELSE 1 END, script, language_hint, source_group, CASE length_bin WHEN 'short' THEN 0 WHEN 'normal' THEN 1 ELSE 2 END"


def _balanced(total: str | None = None) -> str:
    b = budget()
    total = total or str(b.total_lines)
    return f""",
counts AS (SELECT {_BUCKET}, count(*) AS lines FROM classified GROUP BY ALL),
floors AS (SELECT *, CASE WHEN lines = 0 THEN 0 WHEN lines < {b.collapse_buckets_below_lines} THEN lines
    ELSE least(greatest(ceil(lines * {b.min_keep_fraction}::DOUBLE), ceil(lines / {b.max_downsample_ratio}::DOUBLE), 1), lines) END::BIGINT AS floor FROM counts),
sums AS (SELECT sum(round(pow(lines, {b.alpha}::DOUBLE), 9)::DECIMAL(38, 9))::DOUBLE AS w, least({total}, sum(lines))::BIGINT AS requested FROM counts),
smoothed AS (SELECT {_BUCKET}, lines, floor, requested, least(greatest(round(round(round(pow(lines, {b.alpha}::DOUBLE), 9) / w * requested, 9))::BIGINT, floor), lines)::BIGINT AS target FROM floors CROSS JOIN sums),
placed AS (SELECT *, row_number() OVER (ORDER BY {_ORDER}) AS place, requested - sum(target) OVER () AS change FROM smoothed),
more AS (SELECT place, change, unnest(range(1, lines - target + 1)) AS level FROM placed WHERE change > 0),
fewer AS (SELECT place, change, unnest(range(floor + 1, target + 1)) AS level FROM placed WHERE change < 0),
raised AS (SELECT place, count(*) AS n FROM (SELECT *, row_number() OVER (ORDER BY level DESC, place DESC) AS r FROM more) WHERE r <= change GROUP BY 1),
lowered AS (SELECT place, count(*) AS n FROM (SELECT *, row_number() OVER (ORDER BY level DESC, place DESC) AS r FROM fewer) WHERE r <= -change GROUP BY 1),
targets AS (SELECT {_BUCKET}, lines, floor, (target + coalesce(raised.n, 0) - coalesce(lowered.n, 0))::BIGINT AS target FROM placed LEFT JOIN raised USING (place) LEFT JOIN lowered USING (place)),
drawn AS (
    SELECT c.*, target, row_number() OVER (PARTITION BY {_BUCKET} ORDER BY md5(concat_ws('|', 'draw', {b.shuffle_seed}, {_BUCKET}, path, line_number, chunk_index)), path, line_number, chunk_index) AS r
    FROM classified c JOIN targets USING ({_BUCKET})
),
sampled AS (SELECT * FROM drawn WHERE r <= target),
parts AS (SELECT *, ((position - 1) // {b.max_part_lines})::INTEGER AS part FROM (
    SELECT *, row_number() OVER (PARTITION BY {_BUCKET} ORDER BY md5(concat_ws('|', 'shuffle', {b.shuffle_seed}, {_BUCKET}, path, line_number, chunk_index)), path, line_number, chunk_index) AS position FROM sampled))"""


def _sql(select: str, *parts: str) -> str:
    return f"WITH RECURSIVE {_FILES}{''.join(parts)}\n{select}"


_MOST = config().sentencepiece.max_sentence_length
_REPAIRED = (_CANON, _chunked(_MOST))
_ALL = (*_REPAIRED, _HINTS, _CLASSES)
_UTF = (_CANON, _chunked(SHORT))


def _log(most: int) -> str:
    return f"""
SELECT 'canonicalized' AS id, 'fixed' AS action, path, line_number, 'line changed under configured canonicalization' AS reason FROM canon ANTI JOIN over USING (path, line_number) WHERE text <> line
UNION ALL
SELECT 'max_sentence_length', 'skipped', path, line_number, 'canonicalized line has a grapheme cluster over max_sentence_length {most}' FROM over
UNION ALL
SELECT 'chunked_long_line', 'fixed', path, line_number, 'canonicalized line is ' || strlen(c.text) || ' byte(s), split into ' || n || ' chunk(s) at max_sentence_length {most}'
FROM canon c JOIN (SELECT path, line_number, count(*) AS n FROM repaired GROUP BY ALL) USING (path, line_number) WHERE n > 1"""


def all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.lines(files(spark, sf_dir))


def processed(spark: SparkSession, sf_dir: str, most: int | None = None) -> DataFrame:
    return repair.process(all_lines(spark, sf_dir), config(most))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repaired lines in their buckets; paths are looked at once a file, before they become lines."""
    hinted = lines.lines(classify.path_hints(files(spark, sf_dir)))
    return classify.classify(repair.outputs(repair.process(hinted, config())))


def _canonicalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = all_lines(spark, sf_dir).withColumn("text", T.canonical(F.col("line")))
    return out.select("path", "line_number", "text", (F.col("text") != F.col("line")).alias("changed"))


def _idempotence(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = all_lines(spark, sf_dir).withColumn("once", T.canonical(F.col("line")))
    marked = once.select((F.col("once") != F.col("line")).alias("changed"), (T.canonical(F.col("once")) == F.col("once")).alias("stable"))
    return marked.groupBy("changed", "stable").agg(F.count("*").alias("lines"))


def _utf8_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh document gets the byte 0xFF at its end, so its last line isn't UTF-8."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    content = F.when(F.col("doc_id") % 7 == 0, F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF")))).otherwise(F.encode("text", "UTF-8"))
    raw = lines.raw_lines(docs.select(F.concat_ws("/", "lang", "source", "doc_id").alias("path"), content.alias("content")))
    return repair.issues(repair.process(raw, config())).where("id = 'invalid_utf8'").select("id", "action", "path", "line_number", "reason")


def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance.targets(classify.counts(classified(spark, sf_dir)), budget())


def _sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and ranks read the classified lines several times, so they are written once."""
    rows = saved(classified(spark, sf_dir))
    return balance.sample(rows, balance.targets(classify.counts(rows), budget()), budget())


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance.parts(saved(_sampled(spark, sf_dir)), budget())


def _blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as contents of every kind, by their id."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    html = F.encode("html", "UTF-8")
    put = lambda start: F.concat(F.unhex(F.lit(start)), html)
    kind = F.col("page_id") % 10
    content = F.when(kind == 0, put("504B0304")).when(kind == 1, put("1F8B")).when(kind == 2, put("425A68")).when(kind == 3, put("FD377A585A00")).when(kind == 4, F.encode(F.lit(""), "UTF-8"))
    content = content.when(kind == 5, put("00")).when(kind == 6, F.concat(F.encode(F.lpad(F.lit(""), 257, "x"), "UTF-8"), F.encode(F.lit("ustar"), "UTF-8"), html)).when(kind == 7, put("FF")).otherwise(html)
    return pages.select("page_id", "url", content.alias("content"))


_BLOBS = """
SELECT page_id, url, CASE page_id % 10 WHEN 0 THEN from_hex('504B0304') || encode(html) WHEN 1 THEN from_hex('1F8B') || encode(html) WHEN 2 THEN from_hex('425A68') || encode(html)
    WHEN 3 THEN from_hex('FD377A585A00') || encode(html) WHEN 4 THEN ''::BLOB WHEN 5 THEN from_hex('00') || encode(html) WHEN 6 THEN encode(repeat('x', 257)) || encode('ustar') || encode(html)
    WHEN 7 THEN from_hex('FF') || encode(html) ELSE encode(html) END AS content FROM pages"""


def _sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blobs(spark, sf_dir).select("page_id", source.sniff_column(F.col("content")).alias("kind"))


def _dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as contents of containers: of equal ones all but the first by path are issues."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.concat_ws("/", "lang", "source", "doc_id").alias("path"), F.concat(F.unhex(F.lit("1F8B")), F.encode("text", "UTF-8")).alias("content"))
    return source.discover(docs)[1].where("id = 'archive_cycle'")


def _unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages really compressed, in Arrow batches, then discovered and counted by kind of result."""
    import gzip

    def shrink(batches):
        for batch in batches:
            batch["content"] = [gzip.compress(bytes(c), 1, mtime=0) for c in batch["content"]]
            yield batch

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").where("html IS NOT NULL").select(F.col("page_id").cast("string").alias("path"), F.encode("html", "UTF-8").alias("content"))
    texts, _ = source.discover(saved(pages.mapInPandas(shrink, "path string, content binary")), logical=True)
    return texts.select(F.regexp_extract("path", "^([0-9]+)!", 1).cast("long").alias("page_id"), F.length("content").cast("long").alias("n_bytes"), F.md5("content").alias("digest"))


def _packed(spark: SparkSession, sf_dir: str, pack: Callable[[int, bytes], bytes]) -> tuple[DataFrame, DataFrame]:
    """Texts and issues of the pages, each made unlike any other by its id and packed in its own way."""

    def run(batches):
        for batch in batches:
            packed = [pack(int(p), c) for p, c in zip(*(x.to_pylist() for x in batch.columns))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], batch.schema.names)

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").where("html IS NOT NULL").select(F.col("page_id").cast("string").alias("path"), F.encode(F.concat("html", F.col("page_id").cast("string")), "UTF-8").alias("content"))
    # Packing takes far longer than sending, and a file is read by no more tasks than it has row groups, so pages are spread first.
    # Packed pages are written, like the files of a corpus: they are read twice, but packed once.
    return source.discover(saved(arrow_map(pages.repartition("path"), run, "path string, content binary")), logical=True)


def _page() -> Column:
    return F.regexp_extract("path", "^([0-9]+)", 1).cast("long").alias("page_id")


def _containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in archives and compressed files of every kind, in turn, unpacked."""
    import bz2
    import gzip
    import io
    import lzma
    import tarfile
    import zipfile

    def pack(page: int, content: bytes) -> bytes:
        out = io.BytesIO()
        if page % 5 == 0:
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(zipfile.ZipInfo("a"), content)
        elif page % 5 == 1:
            with tarfile.open(fileobj=out, mode="w") as t:
                info = tarfile.TarInfo("a")
                info.size = len(content)
                t.addfile(info, io.BytesIO(content))
        elif page % 5 == 2:
            return gzip.compress(content, 1, mtime=0)
        elif page % 5 == 3:
            return bz2.compress(content, 1)
        else:
            # The default preset clears tables for a dictionary of 8 MB at each page, which took most of the query's time.
            return lzma.compress(content, preset=0)
        return out.getvalue()

    return _packed(spark, sf_dir, pack)[0].select(_page(), F.regexp_extract("path", "!/(.*)$", 1).alias("member"), F.length("content").cast("long").alias("n_bytes"), F.md5("content").alias("digest"))


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages compressed 14 to 19 times over: those beyond the limit of depth are issues."""
    import gzip

    def pack(page: int, content: bytes) -> bytes:
        for _ in range(14 + page % 6):
            content = gzip.compress(content, 1, mtime=0)
        return content

    texts, issues = _packed(spark, sf_dir, pack)
    return texts.select(_page(), F.lit("text").alias("result")).unionByName(issues.select(_page(), F.col("id").alias("result")))


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages twice in an archive that ends within the second member: the first is kept, the archive is an issue."""
    import io
    import tarfile

    def pack(page: int, content: bytes) -> bytes:
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w") as t:
            for name in "ab":
                info = tarfile.TarInfo(name)
                info.size = len(content)
                t.addfile(info, io.BytesIO(content))
        return out.getvalue()[: -(-len(content) // 512) * 512 + 1024 + len(content) // 2]

    texts, issues = _packed(spark, sf_dir, pack)
    return texts.select(_page(), F.lit("text").alias("result")).unionByName(issues.select(_page(), F.col("id").alias("result")))


def _source_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the issue log says of sources: pages as contents of every kind, of which most can't be read."""
    blobs = _blobs(spark, sf_dir).select(F.col("page_id").cast("string").alias("path"), F.when(F.length("content") > 0, F.concat("content", F.encode(F.col("page_id").cast("string"), "UTF-8"))).otherwise(F.col("content")).alias("content"))
    texts, issues = source.discover(blobs, logical=True)
    log = repair.issues(repair.process(lines.raw_lines(texts), config()), issues)
    return log.where("line_number IS NULL").select("id", "action", "path", F.when(F.col("id") == "unsupported_file", F.col("reason")).alias("reason"))


def _corpus_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts, _ = source.discover(files(spark, sf_dir).select("path", F.encode("text", "UTF-8").alias("content")))
    return source.sizes(texts.select("path", F.length("content").alias("length")))


def _shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and characters of each bucket, from its shard files."""
    return write_shards(classified(spark, sf_dir), scratch(spark)).groupBy(*classify.BUCKET).agg(F.count("*").alias("lines"), F.sum(F.length("text")).alias("chars"))


def _filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets under a budget of nine tenths of the lines, which the shares of large buckets don't use up."""
    counts, b = saved(classify.counts(classified(spark, sf_dir))), budget()
    b.total_lines = (counts.agg(F.sum("lines")).first()[0] or 0) * 9 // 10
    return balance.targets(counts, b)


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _parts(spark, sf_dir).withColumn("name", bucket_stem("train", F.col("part")))
    return named.groupBy("name").agg(F.count("*").alias("lines"))


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = saved(classified(spark, sf_dir))
    counts = classify.counts(rows)
    wanted = balance.targets(counts, budget())
    return balance.report(counts, wanted, balance.sample(rows, wanted, budget()))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.summary(processed(spark, sf_dir, SHORT))


def _issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.issues(processed(spark, sf_dir, SHORT)).groupBy("id", "action").agg(F.count("*").alias("issues"))


def _hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.path_hints(files(spark, sf_dir)).select("path", "language_hint", "source_group")


def _by(column: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: classified(spark, sf_dir).groupBy(column).agg(F.count("*").alias("lines"), F.sum(F.length("text")).alias("chars"))


def _discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct paths in order, the bytes and the lines of each file."""
    out = files(spark, sf_dir).where("text IS NOT NULL").withColumn("n_bytes", F.octet_length("text").cast("long"))
    return out.groupBy("path").agg(F.sum("n_bytes").alias("n_bytes"), F.sum(F.size(lines.split_lines(F.col("text")))).alias("lines"))


Query = Callable[[SparkSession, str], DataFrame]
_ENTRIES: dict[str, tuple[Query, str | None]] = {
    "discovered_files": (_discovered, _sql("SELECT f.path, strlen(text) AS n_bytes, len(parts) AS lines FROM files f JOIN kept USING (path)")),
    "lines": (all_lines, _sql("SELECT path, line_number, line FROM lines")),
    "canonicalize": (_canonicalize, _sql("SELECT path, line_number, text, text <> line AS changed FROM canon", _CANON)),
    "arabic_fold": (lambda s, d: all_lines(s, d).where(F.col("line").rlike(T.ARABIC)).select("path", "line_number", T.fold_arabic(F.col("line")).alias("text")), _sql(f"SELECT path, line_number, {_folded('line')} AS text FROM lines WHERE {_FORM.format('line')} <> '' OR contains(line, chr(65279))")),
    "needs_repair": (lambda s, d: all_lines(s, d).groupBy(T.needs_mapping(F.col("line")).alias("needs_mapping")).agg(F.count("*").alias("lines")), _sql(f"SELECT contains(line, chr(65279)) OR contains(line, chr(8203)) OR contains(line, chr(160)) OR contains(line, chr(173)) OR {_FORM.format('line')} <> '' AS needs_mapping, count(*) AS lines FROM lines GROUP BY 1")),
    "idempotence_check": (_idempotence, _sql("SELECT text <> line AS changed, true AS stable, count(*) AS lines FROM canon GROUP BY 1, 2", _CANON)),
    "utf8_filter": (_utf8_filter, "WITH d AS (SELECT concat_ws('/', lang, source, doc_id) AS path, string_split(text, chr(10)) AS parts FROM documents WHERE doc_id % 7 = 0 AND text IS NOT NULL) SELECT 'invalid_utf8' AS id, 'skipped' AS action, path, len(parts)::BIGINT AS line_number, 'line is not valid UTF-8 from byte ' || strlen(parts[-1]) || ' on' AS reason FROM d"),
    "chunk_lines": (lambda s, d: repair.outputs(processed(s, d, SHORT)), _sql("SELECT path, line_number, chunk_index, text FROM repaired", *_UTF)),
    "issue_log": (lambda s, d: repair.issues(processed(s, d, SHORT)).drop("line_text"), _sql(_log(SHORT), *_UTF)),
    "issue_counts": (_issue_counts, _sql(f"SELECT id, action, count(*) AS issues FROM ({_log(SHORT)}) GROUP BY ALL", *_UTF)),
    "repair_summary": (_summary, _sql(f"SELECT (SELECT count(*) FROM lines) AS lines_read, (SELECT count(*) FROM repaired) AS lines_written, (SELECT count(*) FROM ({_log(SHORT)}) WHERE action = 'fixed') AS lines_fixed, (SELECT count(*) FROM over) AS lines_skipped", *_UTF)),
    "fixed_corpus": (lambda s, d: repair.outputs(processed(s, d)).orderBy("path", "line_number", "chunk_index"), _sql("SELECT * FROM repaired", *_REPAIRED)),
    "path_hints": (_hints, _sql("SELECT * FROM hints", _HINTS)),
    "classified_lines": (lambda s, d: classified(s, d).select("path", "line_number", "chunk_index", *classify.BUCKET), _sql(f"SELECT path, line_number, chunk_index, {_BUCKET} FROM classified", *_ALL)),
    **{f"{c}_counts": (_by(c), _sql(f"SELECT {c}, count(*) AS lines, sum(length(text))::BIGINT AS chars FROM classified GROUP BY 1", *_ALL)) for c in ("domain", "script", "length_bin")},
    "bucket_counts": (lambda s, d: classify.counts(classified(s, d)), _sql("SELECT * FROM counts", *_ALL, _balanced())),
    "bucket_floors": (lambda s, d: balance.floors(classify.counts(classified(s, d)), budget()), _sql("SELECT * FROM floors", *_ALL, _balanced())),
    "targets_smoothed": (lambda s, d: balance.smoothed(classify.counts(classified(s, d)), budget()), _sql(f"SELECT {_BUCKET}, lines, floor, target, requested FROM smoothed", *_ALL, _balanced())),
    "targets_final": (_targets, _sql("SELECT * FROM targets", *_ALL, _balanced())),
    "balanced_sample": (lambda s, d: _sampled(s, d).select("path", "line_number", "chunk_index", *classify.BUCKET), _sql(f"SELECT path, line_number, chunk_index, {_BUCKET} FROM sampled", *_ALL, _balanced())),
    "training_parts": (lambda s, d: _parts(s, d).select("path", "line_number", "chunk_index", "text", "part", "position", *classify.BUCKET), _sql(f"SELECT path, line_number, chunk_index, text, part, position, {_BUCKET} FROM parts", *_ALL, _balanced())),
    "part_names": (_names, _sql("SELECT printf('train-%s-script_%s-lang_%s-source_%s-len_%s-part_%04d-%s', domain, script, language_hint, source_group, length_bin, part + 1, left(sha256(printf('{\"domain\":\"%s\",\"script\":\"%s\",\"language_hint\":\"%s\",\"source_group\":\"%s\",\"length_bin\":\"%s\"}', domain, script, language_hint, source_group, length_bin)), 8)) AS name, count(*) AS lines FROM parts GROUP BY 1", *_ALL, _balanced())),
    "balance_report": (_report, _sql(f"SELECT {_BUCKET}, lines AS input_lines, target AS target_lines, coalesce(n, 0) AS output_lines FROM targets LEFT JOIN (SELECT {_BUCKET}, count(*) AS n FROM sampled GROUP BY ALL) USING ({_BUCKET})", *_ALL, _balanced())),
    "bucket_rollup": (lambda s, d: reports.rollup(classified(s, d)), _sql("SELECT domain, script, language_hint, count(*) AS lines FROM classified GROUP BY ROLLUP (domain, script, language_hint)", *_ALL)),
    "axis_report": (lambda s, d: reports.axes(all_lines(s, d)), _sql(reports.AXES_SQL.replace("FORM", _FORM.format("line")))),
    "sniff_kind": (_sniff, f"WITH b AS ({_BLOBS}) SELECT page_id, CASE page_id % 10 WHEN 0 THEN 'zip' WHEN 1 THEN 'gzip' WHEN 2 THEN 'bzip2' WHEN 3 THEN 'xz' WHEN 6 THEN 'tar' WHEN 4 THEN 'unsupported' WHEN 5 THEN 'unsupported' WHEN 7 THEN 'unsupported' ELSE CASE WHEN octet_length(content) = 0 THEN 'unsupported' ELSE 'text' END END AS kind FROM b"),
    "container_dedupe": (_dedupe, "SELECT 'archive_cycle' AS id, path, 'compressed content was already seen' AS reason FROM (SELECT concat_ws('/', lang, source, doc_id) AS path, row_number() OVER (PARTITION BY sha256(text) ORDER BY concat_ws('/', lang, source, doc_id)) AS n FROM documents WHERE text IS NOT NULL) WHERE n > 1"),
    "unpack_gzip": (_unpack, "SELECT page_id, n_bytes, digest FROM (SELECT page_id, strlen(html)::BIGINT AS n_bytes, md5(html) AS digest, row_number() OVER (PARTITION BY html ORDER BY page_id::VARCHAR) AS n FROM pages WHERE html <> '') WHERE n = 1"),
    "unpack_containers": (_containers, "SELECT page_id, ['a', 'a', 'gzip', 'bzip2', 'xz'][page_id % 5 + 1] AS member, strlen(html || page_id)::BIGINT AS n_bytes, md5(html || page_id) AS digest FROM pages WHERE html IS NOT NULL"),
    "archive_depth": (_nested, "SELECT page_id, CASE WHEN 14 + page_id % 6 <= 16 THEN 'text' ELSE 'archive_depth_exceeded' END AS result FROM pages WHERE html IS NOT NULL"),
    "broken_archives": (_broken, "SELECT page_id, unnest(['text', 'archive_read_failed']) AS result FROM pages WHERE html IS NOT NULL"),
    "source_issues": (_source_issues, "SELECT CASE WHEN page_id % 10 IN (4, 5, 7) THEN 'unsupported_file' ELSE 'archive_read_failed' END AS id, 'skipped' AS action, page_id::VARCHAR AS path, CASE page_id % 10 WHEN 4 THEN 'empty file' WHEN 5 THEN 'not recognized as text, archive, or compressed text' WHEN 7 THEN 'not recognized as text, archive, or compressed text' END AS reason FROM pages WHERE html IS NOT NULL AND page_id % 10 < 8"),
    "shard_files": (_shards, _sql(f"SELECT {_BUCKET}, count(*) AS lines, sum(length(text))::BIGINT AS chars FROM classified GROUP BY ALL", *_ALL)),
    "corpus_bytes": (_corpus_bytes, _sql("SELECT count(*) AS files, coalesce(sum(strlen(text)), 0)::BIGINT AS n_bytes FROM files WHERE text <> ''")),
    "targets_filled": (_filled, _sql("SELECT * FROM targets", *_ALL, _balanced("(SELECT sum(lines) * 9 // 10 FROM counts)"))),
    "streaming_bucket_counts": (lambda s, d: reports.streamed(all_lines(s, d)), _sql("SELECT domain, script, length_bin, count(*) AS lines FROM classified GROUP BY ALL", *_ALL)),
}


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in _ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ENTRIES.items() if sql is not None}
