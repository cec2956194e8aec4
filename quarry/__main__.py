"""``python -m quarry train --config cfg.json [--preset-config FILE] [--train-only] [--json]``"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .config import Config, ConfigError, dangers, load
from .control import Cancelled, cancellable, progress
from .plans.corpus import RunError, run, train_only
from .sources.files import SourceError
from .train import TrainerError

#: By what went wrong; 1 is left to what nobody foresaw.
CODES = {ConfigError: 2, SourceError: 3, RunError: 3, TrainerError: 4, Cancelled: 5}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="quarry")
    out.add_argument("--json", action="store_true", help="the summary as JSON, progress as plain lines")
    commands = out.add_subparsers(dest="command", required=True)
    one = commands.add_parser("train", help="repair and balance a corpus and train a tokenizer from it")
    one.add_argument("--config", default="cfg.json")
    one.add_argument("--preset-config", default=None, help="a catalog of presets; those built in otherwise")
    one.add_argument("--train-only", action="store_true", help="use the parts of an earlier run")
    one.add_argument("--json", action="store_true", default=argparse.SUPPRESS)
    return out


def summary(config: Config, result: dict) -> dict:
    ends = {"model": result["trainer"]["model"], "vocab": result["trainer"]["vocab"], "work_dir": config.output.work_dir, "model_prefix": config.output.model_prefix}
    out = {"preset": config.preset, "training_files": result["balance"]["training_files"], "balanced_lines": result["balance"]["output_lines"], "balance_report": result["balance"]["report"], **ends}
    if "lines_read" in result:
        out |= {"corpus_path": config.corpus.path, "text_files": result["files_read"], **{k: result[k] for k in ("fixed_corpus", "issue_log", "lines_read", "lines_written", "lines_fixed", "lines_skipped", "source_issues")}}
    return out


def told(s: dict) -> str:
    ends = f"{len(s['training_files'])} training part(s), {s['balanced_lines']} balanced line(s), model {s['model']}"
    if "lines_read" not in s:
        return f"trained again with preset {s['preset']}: {ends}"
    issues = f", {s['source_issues']} issue(s) of sources" if s["source_issues"] else ""
    return f"trained with preset {s['preset']}: {s['text_files']} text file(s), {s['lines_written']} line(s) kept, {s['lines_fixed']} fix(es), {s['lines_skipped']} skipped{issues}, {ends}"


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        config = load(args.config, args.preset_config)
        for danger in dangers(config):
            print(f"warning: {danger}", file=sys.stderr)
        if args.train_only:
            result = train_only(config)
        else:
            own = spark is None
            spark = spark or SparkSession.builder.appName("quarry").config("spark.ui.showConsoleProgress", "false").getOrCreate()
            try:
                with progress(spark, args.json), cancellable(spark):
                    result = run(spark, config)
            finally:
                if own:
                    spark.stop()
    except tuple(CODES) as error:
        print(f"error: {error}", file=sys.stderr)
        return next(code for kind, code in CODES.items() if isinstance(error, kind))
    s = summary(config, result)
    print(json.dumps(s, ensure_ascii=False, indent=2) if args.json else told(s))
    return 0


if __name__ == "__main__":
    sys.exit(main())
