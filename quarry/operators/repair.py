"""Repair of lines: what is fixed, what is skipped, and what comes out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import canonical
from ..runtime import reachable
from .chunk import chunk_column
from .lines import kept

ISSUE = "struct<id:string,action:string,path:string,line_number:bigint,reason:string,line_text:string>"


def _issue(id_: str, action: str, reason: Column, text: Column, log_text: bool) -> Column:
    shown = text if log_text else F.lit(None).cast("string")
    return F.struct(F.lit(id_).alias("id"), F.lit(action).alias("action"), F.col("path").alias("path"), F.col("line_number").alias("line_number"), reason.alias("reason"), shown.alias("line_text")).cast(ISSUE)


def _first_invalid(raw: Column, valid: Column) -> Column:
    """The byte from which bytes stop to be UTF-8, by the first replacement that they don't hold themselves."""
    step = lambda at, part: F.when(at["done"], at).otherwise(
        F.struct(
            (at["n"] + F.octet_length(part) + F.when(F.hex(F.substring(raw, at["n"] + F.octet_length(part) + 1, F.lit(3))) == "EFBFBD", 3).otherwise(0)).alias("n"),
            (F.hex(F.substring(raw, at["n"] + F.octet_length(part) + 1, F.lit(3))) != "EFBFBD").alias("done"),
        )
    )
    return F.aggregate(F.split(valid, "\ufffd"), F.struct(F.lit(0).alias("n"), F.lit(False).alias("done")), step, lambda at: at["n"])


def process(lines: DataFrame, config: Config) -> DataFrame:
    """``path, line_number`` with ``issues`` and ``output`` (both arrays) for ``path, line_number`` and ``line`` or ``bytes``.

    Bytes that aren't UTF-8 and lines with a cluster over the limit are skipped, the
    latter without their other issues; a line may be canonicalized and chunked.
    Null lines count as empty ones.
    """
    c, most, log_text = config.canonicalization, config.sentencepiece.max_sentence_length, config.validation.include_line_text_in_log
    reachable(lines.sparkSession)
    args = (tuple(c.strip), c.map_nbsp_to_space, c.fold_arabic_presentation_forms)
    if "bytes" in lines.columns:
        line = F.coalesce(F.col("bytes").cast("string"), F.lit(""))
        lines = lines.withColumns({"valid": F.is_valid_utf8(line), "line": F.make_valid_utf8(line)})
        from_ = F.when(~F.col("valid"), _first_invalid(F.col("bytes"), F.col("line")))
        lines = lines.withColumn("invalid", F.concat(F.lit("line is not valid UTF-8 from byte "), from_.cast("string"), F.lit(" on")))
    else:
        lines = lines.withColumns({"valid": F.lit(True), "line": F.coalesce("line", F.lit("")), "invalid": F.lit(None).cast("string")})
    # A line is canonicalized a second time only if that changed it.
    done = lines.withColumn("text", canonical(F.col("line"), *args)).withColumn("changed", F.col("text") != F.col("line"))
    done = done.withColumn("stable", ~F.col("changed") | (canonical(F.col("text"), *args) == F.col("text")))
    done = done.withColumn("chunks", F.when(F.col("valid") & F.col("stable"), chunk_column(F.col("text"), most)))
    line, text = F.col("line"), F.col("text")
    skip = lambda id_, reason, shown: F.array(_issue(id_, "skipped", reason, shown, log_text))
    long = F.concat(F.lit(f"canonicalized line has a grapheme cluster over max_sentence_length {most}"))
    cut = F.concat(F.lit("canonicalized line is "), F.octet_length(text).cast("string"), F.lit(" byte(s), split into "), F.size("chunks").cast("string"), F.lit(f" chunk(s) at max_sentence_length {most}"))
    fixes = F.filter(
        F.array(
            F.when(F.col("changed"), _issue("canonicalized", "fixed", F.lit("line changed under configured canonicalization"), line, log_text)),
            F.when(F.size("chunks") > 1, _issue("chunked_long_line", "fixed", cut, text, log_text)),
        ),
        lambda x: x.isNotNull(),
    )
    issues = (
        F.when(~F.col("valid"), skip("invalid_utf8", F.col("invalid"), F.lit(None).cast("string")))
        .when(~F.col("stable"), skip("non_idempotent_canonicalization", F.lit("line changed after a second canonicalization pass"), line))
        .when(F.col("chunks").isNull(), skip("max_sentence_length", long, text))
        .otherwise(fixes)
    )
    return done.select("path", *kept(done), "line_number", issues.alias("issues"), F.coalesce("chunks", F.array().cast("array<string>")).alias("output"))


def outputs(processed: DataFrame) -> DataFrame:
    """``path, line_number, chunk_index, text`` of what is kept, and path hints if there are any; path, line and chunk identify a row."""
    return processed.select("path", *kept(processed), "line_number", F.posexplode("output").alias("chunk_index", "text"))


def issues(processed: DataFrame, source_issues: DataFrame | None = None) -> DataFrame:
    """The issue log: issues of sources, then of lines."""
    found = processed.select(F.explode("issues").alias("i")).select("i.*")
    if source_issues is None:
        return found
    shown = source_issues.select("id", F.lit("skipped").alias("action"), "path", F.lit(None).cast("long").alias("line_number"), "reason", F.lit(None).cast("string").alias("line_text"))
    return shown.unionByName(found)


def summary(processed: DataFrame) -> DataFrame:
    """One row of counters; ``lines_fixed`` counts fixes, of which a line may have two."""
    count = lambda action: F.size(F.filter("issues", lambda i: i["action"] == action))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return processed.agg(
        F.count("*").alias("lines_read"),
        total(F.size("output")).alias("lines_written"),
        total(count("fixed")).alias("lines_fixed"),
        total(count("skipped")).alias("lines_skipped"),
    )
