"""Training of a SentencePiece model from the parts of a run, in a process of its own."""

from __future__ import annotations

import copy
import json
import os
import re
import subprocess
import sys
import tempfile
import threading
import time
from pathlib import Path

from pyspark.sql import SparkSession

from .config import Config, read_json
from .runtime import file_system
from .sources.sinks import write_json


class TrainerError(RuntimeError):
    """A trainer that ended badly; its output has been written."""


def _with_suffix(prefix: str, suffix: str) -> str:
    """A dotted ending of the prefix is replaced, as a file's extension is."""
    folder, _, name = prefix.rpartition("/")
    return (folder + "/" if folder or prefix.startswith("/") else "") + str(Path(name).with_suffix(suffix))


def request(config: Config, files: list[str]) -> dict:
    """Arguments of the trainer and the files that it makes."""
    s, work = config.sentencepiece, config.output.work_dir
    work = _here(work)
    prefix = os.path.join(work, config.output.model_prefix)
    knobs = {k: v for k, v in vars(s).items() if k not in ("trainer", "python")}
    return {
        "sentencepiece": {"input": list(files), "model_prefix": prefix, **knobs, "num_threads": config.num_threads},
        "output": {"model": _with_suffix(prefix, ".model"), "vocab": _with_suffix(prefix, ".vocab"), "trainer_output": os.path.join(work, "trainer_output.json")},
    }


def _text_files(paths: list[str]) -> list[str]:
    """A part is a file, or a folder of text files as Spark writes them."""
    out = []
    for p in paths:
        out += sorted(str(x) for x in Path(p).glob("*.txt")) if os.path.isdir(p) else [p]
    return out


def run_request(path: str) -> None:
    """Trains as a written request says; the only writer of neither result nor error is the caller."""
    import sentencepiece

    wanted = read_json(path)["sentencepiece"]
    sentences = (line.rstrip("\n") for p in _text_files(wanted["input"]) for line in open(p, encoding="utf-8", newline="\n"))  # noqa: SIM115
    arguments = {k: v for k, v in wanted.items() if k != "input"}
    sentencepiece.SentencePieceTrainer.train(sentence_iterator=sentences, **arguments)


def _watched(command: list[str], env: dict, timeout: float | None) -> tuple[int, list[str], list[str]]:
    """Exit code and lines of output and errors, which are also shown as they come; an interrupt or the timeout stops the process, and what it has said is kept."""
    try:
        process = subprocess.Popen(command, stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True, env=env)
    except OSError as error:
        return -1, [], [f"the trainer can't be started: {error}"]
    said: tuple[list[str], list[str]] = ([], [])

    def drain(pipe, lines: list[str]) -> None:
        for line in pipe:
            lines.append(line.rstrip("\n"))
            print(lines[-1], file=sys.stderr, flush=True)

    threads = [threading.Thread(target=drain, args=x, daemon=True) for x in zip((process.stdout, process.stderr), said)]
    for t in threads:
        t.start()
    try:
        code = process.wait(timeout)
    except BaseException as stopped:
        process.kill()
        process.wait()
        if not isinstance(stopped, subprocess.TimeoutExpired):
            raise
        code = -1
    finally:
        for t in threads:
            t.join(timeout=5)
    if code == -1:
        said[1].append(f"stopped after {timeout} seconds")
    return code, *said


def _here(path: str) -> str:
    return re.sub("^file:(//)?(?=/)", "", path)


def _apart(config: Config, files: list[str], timeout: float | None) -> dict:
    """Trains from parts on a remote file system: they come to the driver, which trains, and the results go back."""
    work = config.output.work_dir
    with tempfile.TemporaryDirectory(prefix="quarry-train-") as folder:
        parts = []
        for k, f in enumerate(files):
            fs, target = file_system(SparkSession.active(), f)
            if not fs.exists(target):
                raise TrainerError(f"training corpus file is missing: {f}")
            fs.copyToLocalFile(False, target, file_system(SparkSession.active(), f"file:{folder}/part{k:06d}")[1], True)
            parts.append(f"{folder}/part{k:06d}")
        own = copy.deepcopy(config)
        own.output.work_dir = f"{folder}/work"
        try:
            result = train(own, parts, timeout)
        finally:
            for name in os.listdir(own.output.work_dir) if os.path.isdir(own.output.work_dir) else []:
                fs, target = file_system(SparkSession.active(), f"{work}/{name}")
                fs.copyFromLocalFile(False, True, file_system(SparkSession.active(), f"file:{folder}/work/{name}")[1], target)
    ends = request(config, files)["output"]
    return result | {"model": ends["model"], "vocab": ends["vocab"]}


def train(config: Config, files: list[str], timeout: float | None = None) -> dict:
    """Writes the request, runs the trainer, writes and returns its output; raises TrainerError if it fails."""
    if not files:
        raise TrainerError("no training files")
    if "://" in _here(config.output.work_dir) or any("://" in _here(f) for f in files):
        return _apart(config, files, timeout)
    files = [_here(f) for f in files]
    for f in files:
        if not os.path.exists(f):
            raise TrainerError(f"training corpus file is missing: {f}")
    wanted = request(config, files)
    path = os.path.join(_here(config.output.work_dir), "trainer_request.json")
    write_json(wanted, path)
    python = config.sentencepiece.python
    runner = sys.executable if python.runner == "python" else python.runner
    root = str(Path(__file__).resolve().parent.parent)
    env = os.environ | {"PYTHONPATH": f"{root}:{os.environ.get('PYTHONPATH', '')}"}
    began = time.monotonic()
    code, out, err = _watched([runner, *python.args, "-m", python.module, path], env, timeout)
    result = {
        "status": "failed" if code else "succeeded",
        "model": wanted["output"]["model"],
        "vocab": wanted["output"]["vocab"],
        "stdout": out,
        "stderr": err,
        "elapsed_ms": int((time.monotonic() - began) * 1000),
    }
    if code:
        result["error"] = next((x for x in reversed(err) if x.strip()), "no message")
    write_json(result, wanted["output"]["trainer_output"])
    if code:
        raise TrainerError(result["error"])
    return result


def vocabulary_checks(model: str) -> dict:
    """Pieces that a repaired corpus shouldn't give: an extension."""
    import unicodedata

    import sentencepiece

    s = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = [s.id_to_piece(k) for k in range(s.get_piece_size())]
    plain = [p for k, p in enumerate(pieces) if not (s.is_byte(k) or s.is_control(k) or s.is_unknown(k))]
    return {
        "pieces": len(pieces),
        "not_nfc": sum(unicodedata.normalize("NFC", p) != p for p in plain),
        "many_digits": sum(sum(c.isdigit() for c in p) > 1 for p in plain),
        "bytes": sum(s.is_byte(k) for k in range(len(pieces))),
    }


if __name__ == "__main__":
    if len(sys.argv) != 2:
        print("usage: python -m quarry.train REQUEST.json", file=sys.stderr)
        sys.exit(2)
    run_request(sys.argv[1])
    print(json.dumps({"status": "succeeded"}))
