"""A whole run: from a folder to training parts, reports and a model."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, read_json
from ..operators import balance, classify, lines, repair
from ..runtime import dropped, reachable, read_bytes, saved
from ..sources import files, sinks
from ..train import TrainerError, train


class RunError(RuntimeError):
    """A run that has nothing to go on with."""


def _root(path: str) -> str:
    """The folder that path hints are taken below."""
    return path if "://" in path or os.path.isdir(path) else os.path.dirname(path)


def repair_lines(spark: SparkSession, config: Config, logical: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``path, length`` of the texts, issues of sources, and processed lines of the corpus of ``config``."""
    reachable(spark)
    texts, source_issues = files.discover(files.read_files(spark, config.corpus.path), logical)
    large, large_issues, large_sizes = files.large_files(spark, config.corpus.path)
    root = _root(config.corpus.path)
    raw = lines.raw_lines(classify.path_hints(texts, root))
    raw = raw.unionByName(classify.path_hints(large, root).select(*raw.columns))
    sizes = texts.select("path", F.length("content").cast("long").alias("length")).unionByName(large_sizes)
    return sizes, source_issues.unionByName(large_issues), repair.process(raw, config)


def run(spark: SparkSession, config: Config, logical: bool = False, with_training: bool = True) -> dict:
    """Repairs, balances and writes the corpus, and trains a model; the summary of all of it.

    Processed lines are used by several sinks, so they are written to the shared folder once.
    """
    work = config.output.work_dir
    sizes, source_issues, processed = repair_lines(spark, config, logical)
    processed = saved(processed)
    try:
        sinks.write_json(config.to_dict(), os.path.join(work, "effective_config.json"))
        log = config.validation.issue_log
        log = log if os.path.isabs(log) or "://" in log else os.path.join(work, log)
        sinks.write_issues(repair.issues(processed, source_issues), log)
        out = repair.outputs(processed)
        sinks.write_fixed(out, os.path.join(work, "fixed_corpus.txt"))
        counters = repair.summary(processed).first().asDict()
        if not counters["lines_written"]:
            raise RunError(f"no usable lines were written; see {log}")
        summary = balance_lines(classify.classify(out), config)
        sizes = files.sizes(sizes).first()
        result = {
            "files_read": sizes["files"], **counters, "source_issues": source_issues.count(), "issue_log": log, "corpus_bytes": sizes["n_bytes"],
            "fixed_corpus": os.path.join(work, "fixed_corpus.txt"), "balance": summary,
        }
    finally:
        dropped(processed)
    if with_training:
        result["trainer"] = train(config, summary["training_files"])
    return result


def balance_lines(classified: DataFrame, config: Config) -> dict:
    """Targets, sample, training parts and report of classified lines."""
    b, work = config.balancing, config.output.work_dir
    classified = saved(classified)
    counts = saved(classify.counts(classified))
    try:
        wanted = balance.targets(counts, b)
        sampled = saved(balance.parts(saved(balance.sample(classified, wanted, b)), b))
        written = sinks.write_parts(sampled, os.path.join(work, "train_corpus"))
        return sinks.write_report(balance.report(counts, wanted, sampled), written, os.path.join(work, "reports", "balance.json"))
    finally:
        dropped(counts, classified)


def train_only(config: Config) -> dict:
    """Trains again from the parts that an earlier run's report names."""
    path = os.path.join(config.output.work_dir, "reports", "balance.json")
    report = json.loads(read_bytes(path)) if "://" in path else read_json(path)
    parts = report.get("training_files") or []
    if not parts:
        raise TrainerError(f"no training files in {path}")
    return {"balance": report, "trainer": train(config, parts)}
