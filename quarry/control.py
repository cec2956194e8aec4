"""Progress and cancelling of a run, through Spark's own signal handler and status tracker."""

from __future__ import annotations

import sys
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Seconds between lines of progress where output is read by a program, and where a person looks on.
PLAIN, LIVE = 10.0, 1.0


class Cancelled(RuntimeError):
    """The run was interrupted; what it had written stays."""


@contextmanager
def cancellable(spark: SparkSession) -> Iterator[None]:
    """Ctrl+C, on which Spark cancels the session's jobs, ends the run with ``Cancelled``."""
    try:
        yield
    except KeyboardInterrupt as error:
        spark.sparkContext.cancelAllJobs()
        raise Cancelled("cancelled") from error


@contextmanager
def progress(spark: SparkSession, plain: bool) -> Iterator[None]:
    """Tasks done of the stages that run, to stderr: a line every ten seconds, or one line that is kept up to date."""
    tracker, done = spark.sparkContext.statusTracker(), threading.Event()

    def watch() -> None:
        while not done.wait(PLAIN if plain else LIVE):
            stages = [s for s in map(tracker.getStageInfo, tracker.getActiveStageIds()) if s]
            if stages:
                said = ", ".join(f"{s.name.split(' at ')[0]} {s.numCompletedTasks}/{s.numTasks}" for s in stages)
                print(said if plain else f"\r\033[K{said}", end="\n" if plain else "", file=sys.stderr, flush=True)

    thread = threading.Thread(target=watch, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join(timeout=5)
        if not plain:
            print("\r\033[K", end="", file=sys.stderr)
