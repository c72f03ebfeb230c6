"""How far a pass is: when to speak, and what share of its Spark tasks is done."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Cadence:
    # Seconds of quiet before the first update, before the second, and before every later one.
    first: float = 30.0
    second: float = 300.0
    later: float = 900.0

    def due(self, quiet: float, given: int) -> bool:
        """Whether so many seconds of quiet call for an update when so many were given."""
        return quiet >= (self.first if given == 0 else self.second if given == 1 else self.later)


def duration(seconds: float) -> str:
    """A time span as ISO 8601 writes it, whole seconds: PT1H2M3S."""
    minutes, s = divmod(max(round(seconds), 0), 60)
    h, m = divmod(minutes, 60)
    parts = [f"{n}{unit}" for n, unit in ((h, "H"), (m, "M"), (s, "S")) if n]
    return "PT" + ("".join(parts) or "0S")


def remaining(done: int, total: int, elapsed: float) -> float | None:
    """Seconds still needed at the rate so far; nothing while there is no rate."""
    return elapsed * (total - done) / done if done > 0 else None


def status(what: str, done: int, total: int, elapsed: float) -> str:
    """One line of progress: share, counts with thousands marks, time spent and time expected."""
    rest = remaining(done, total, elapsed)
    share = 100 * done // total if total else 100
    return f"{what}: {share}% ({done:,}/{total:,}), elapsed {duration(elapsed)}" + ("" if rest is None else f", remaining {duration(rest)}")


@contextmanager
def told(spark: SparkSession, what: str, say: Callable[[str], None] = print, cadence: Cadence = Cadence(), every: float = 1.0):
    """Speaks while the Spark jobs of the block run: at its start, when an update is due, and at its end."""
    say(f"{what}: started")
    began = time.monotonic()
    stop = threading.Event()

    def watch() -> None:
        spoken, given = began, 0
        while not stop.wait(every):
            now = time.monotonic()
            if not cadence.due(now - spoken, given):
                continue
            tracker = spark.sparkContext.statusTracker()
            stages = [s for s in map(tracker.getStageInfo, tracker.getActiveStageIds()) if s is not None]
            if stages:
                say(status(what, sum(s.numCompletedTasks for s in stages), sum(s.numTasks for s in stages), now - began))
            spoken, given = now, given + 1

    thread = threading.Thread(target=watch, daemon=True)
    thread.start()
    try:
        yield
    finally:
        stop.set()
        thread.join()
        say(f"{what}: ended after {duration(time.monotonic() - began)}")


def guarded(run: Callable[[], object], name: str = "pass") -> object:
    """Runs a pass; a failure ends the program with one line that names it, a stop with its own words goes through."""
    try:
        return run()
    except Exception as x:
        raise SystemExit(f"{name} failed ({type(x).__name__}): {x}") from x


def require(**there: bool) -> None:
    """Stops before any work where an input is not there: require(items=True, branches=False)."""
    missing = sorted(name for name, ok in there.items() if not ok)
    if missing:
        raise SystemExit(f"missing inputs: {', '.join(missing)}; run the steps that write them first")
