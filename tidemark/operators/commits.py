"""A log of numbered entries in a shared folder, each number taken by one writer only.

An entry appears whole or not at all: it is written beside the log and then given
its number by a step that fails if the number is taken.  Whoever fails reads
the log again, so what an entry says always follows from all entries before it.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Taken(Exception):
    """The name is there already."""


def _local(spark: SparkSession, path: str) -> str | None:
    """The path for the driver's own file calls where the store is a local or mounted one."""
    uri = _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(_path(spark, path)).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def put_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet; raises ``Taken`` if it is.

    A mounted folder links the written file to its name, a distributed store
    renames it; both refuse a name that is taken.
    """
    local, spare = _local(spark, path), f"{os.path.dirname(path)}/_{uuid.uuid4().hex}"
    if local:
        folder = os.path.dirname(local)
        os.makedirs(folder, exist_ok=True)
        beside = f"{folder}/{os.path.basename(spare)}"
        with open(beside, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(beside, local)
        except FileExistsError:
            raise Taken(path) from None
        finally:
            os.unlink(beside)
        return
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    store = _path(spark, path).getFileSystem(conf)
    out = store.create(_path(spark, spare), False)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), conf)
    try:
        context.rename(_path(spark, spare), _path(spark, path), options)
    except Exception as error:
        store.delete(_path(spark, spare), False)
        if store.exists(_path(spark, path)):
            raise Taken(path) from error
        raise


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all in it; one that is gone already is no error."""
    _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration()).delete(_path(spark, path), True)


class CommitLog:
    """Entries 0, 1, 2, ... of a log; an entry is a small dictionary."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> list[dict]:
        """All entries in order, one for each run and so few; each with its ``number``."""
        try:
            files = self.spark.read.option("wholetext", True).text(f"{self.path}/entry-*.json")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        found = files.select(F.regexp_extract("_metadata.file_name", r"(\d+)", 1).cast("long"), "value").collect()
        return [json.loads(text) | {"number": number} for number, text in sorted(found)]

    def append(self, make: Callable[[list[dict]], dict | None]) -> dict | None:
        """Add the entry that ``make`` derives from all entries before it; nothing if it gives None.

        Where another writer takes the number first, ``make`` is asked again.
        """
        while True:
            before = self.entries()
            entry = make(before)
            if entry is None:
                return None
            number = before[-1]["number"] + 1 if before else 0
            try:
                put_once(self.spark, f"{self.path}/entry-{number:012d}.json", json.dumps(entry))
            except Taken:
                continue
            return entry | {"number": number}


@dataclass(frozen=True)
class Interval:
    """A claimed interval; ``number`` is the batch that its rows are written as."""

    number: int
    run: str
    start: datetime
    end: datetime
    done: bool


class IntervalLog:
    """Intervals of incremental runs: claimed before the work, marked done after it."""

    def __init__(self, spark: SparkSession, path: str):
        self.log = CommitLog(spark, path)

    @staticmethod
    def _read(entries: Sequence[dict]) -> list[Interval]:
        done = {e["claim"] for e in entries if e["kind"] == "done"}
        return [
            Interval(e["number"], e["run"], datetime.fromisoformat(e["start"]), datetime.fromisoformat(e["end"]), e["number"] in done)
            for e in entries
            if e["kind"] == "claim"
        ]

    def intervals(self) -> list[Interval]:
        return self._read(self.log.entries())

    def claim(self, run: str, ttl: int | None, now: datetime) -> Interval | None:
        """The interval that ``run`` has to do; None if none is left.

        A run that is started again under its name gets the interval it claimed
        before, or None if that is done.  Any other run gets the time from the last
        claimed end to ``now``, which no other run can get.
        """
        held: list[Interval] = []

        def make(entries: list[dict]) -> dict | None:
            held.clear()
            taken = self._read(entries)
            own = [i for i in taken if i.run == run]
            if own:
                held.extend(own)
                return None
            start, end = next_interval([(i.start, i.end) for i in taken], ttl, now)
            if start >= end:
                return None
            return {"kind": "claim", "run": run, "start": start.isoformat(), "end": end.isoformat()}

        entry = self.log.append(make)
        if entry is not None:
            return self._read([entry])[0]
        return held[0] if held and not held[0].done else None

    def finish(self, interval: Interval) -> None:
        """Mark an interval as done; once is enough."""

        def make(entries: list[dict]) -> dict | None:
            done = any(e["kind"] == "done" and e["claim"] == interval.number for e in entries)
            return None if done else {"kind": "done", "claim": interval.number}

        self.log.append(make)

    def unfinished(self) -> list[Interval]:
        """Claimed intervals that nobody marked as done: runs at work, or lost ones to start again by name."""
        return [i for i in self.intervals() if not i.done]


def next_interval(
    intervals: Sequence[tuple[datetime, datetime]], ttl: int | None, now: datetime
) -> tuple[datetime, datetime]:
    """Interval of the next incremental run.

    It starts at the newest recorded end; with no record it reaches back one
    TTL, or one year for a TTL of zero.  A view without a TTL must be given a
    first interval by hand.
    """
    if intervals:
        return max(end for _, end in intervals), now
    if ttl is None:
        raise ValueError("a view with no TTL and no earlier run needs an explicit start")
    return now - (timedelta(seconds=ttl) if ttl else timedelta(weeks=52)), now


def incremental_run(
    log: IntervalLog,
    run: str,
    ttl: int | None,
    now: datetime,
    rows: Callable[[datetime, datetime], DataFrame],
    write: Callable[[DataFrame, int], None],
) -> Interval | None:
    """One incremental run: claim, write the interval's rows as the batch of its number, mark it done.

    A run that fails is started again under its name: it does the same interval
    and replaces its own batch.
    """
    interval = log.claim(run, ttl, now)
    if interval is not None:
        write(rows(interval.start, interval.end), interval.number)
        log.finish(interval)
    return interval
