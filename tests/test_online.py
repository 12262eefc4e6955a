"""Commit log, intervals and the bucketed online table."""

import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.operators.commits import CommitLog, IntervalLog, Taken, incremental_run, put_once
from tidemark.operators.online import BUCKET, SOURCE, OnlineTable
from tidemark.session import fresh_path

BASE = dt.datetime(2024, 1, 1)
DAY = dt.timedelta(days=1)
ROWS = "k long, ts timestamp, v long"


def test_a_name_is_taken_once(spark):
    path = fresh_path(spark, "once")
    put_once(spark, f"{path}/a.json", "one")
    with pytest.raises(Taken):
        put_once(spark, f"{path}/a.json", "two")
    assert spark.read.text(f"{path}/a.json").first()[0] == "one"


def test_writers_at_once_get_numbers_of_their_own(spark):
    log = CommitLog(spark, fresh_path(spark, "log"))
    assert log.entries() == []
    made = []

    def work(name):
        for _ in range(4):
            made.append(log.append(lambda before: {"by": name, "after": len(before)}))

    threads = [threading.Thread(target=work, args=(n,)) for n in "abc"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    entries = log.entries()
    assert [e["number"] for e in entries] == list(range(12)) == [e["after"] for e in entries]
    assert sorted(e["number"] for e in made) == list(range(12))
    assert log.append(lambda before: None) is None


def test_runs_at_once_never_share_an_interval(spark):
    log = IntervalLog(spark, fresh_path(spark, "intervals"))
    got = []

    def work(name):
        for i in range(3):
            claimed = log.claim(f"{name}-{i}", 86400, BASE + DAY * random.Random(name + str(i)).randint(1, 30))
            got.extend([claimed] if claimed else [])

    threads = [threading.Thread(target=work, args=(n,)) for n in "abc"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    ordered = sorted(got, key=lambda i: i.start)
    assert len({i.number for i in got}) == len(got) and all(i.start < i.end for i in got)
    assert all(a.end == b.start for a, b in zip(ordered, ordered[1:], strict=False))
    assert [i.number for i in log.unfinished()] == sorted(i.number for i in got)


def test_a_lost_run_does_its_interval_again(spark):
    log = IntervalLog(spark, fresh_path(spark, "rerun"))
    written = []

    def rows(start, end):
        return spark.createDataFrame([(start, end)], "a timestamp, b timestamp")

    def fail(df, batch):
        written.append((batch, "lost"))
        raise RuntimeError("lost")

    def write(df, batch):
        written.append((batch, df.first()))

    with pytest.raises(RuntimeError):
        incremental_run(log, "one", 86400, BASE + DAY, rows, fail)
    two = incremental_run(log, "two", 86400, BASE + 3 * DAY, rows, write)
    again = incremental_run(log, "one", 86400, BASE + 9 * DAY, rows, write)
    assert (again.start, again.end, again.number) == (BASE, BASE + DAY, 0)
    assert (two.start, two.end) == (BASE + DAY, BASE + 3 * DAY) and not log.unfinished()
    assert incremental_run(log, "one", 86400, BASE + 9 * DAY, rows, write) is None
    assert log.claim("three", 86400, BASE + 2 * DAY) is None  # nothing is left up to that time
    assert [b for b, _ in written] == [0, two.number, 0]
    with pytest.raises(ValueError):
        IntervalLog(spark, fresh_path(spark, "none")).claim("x", None, BASE)


def expected(pushes):
    """Newest event per key; at equal times the first write stays."""
    out = {}
    for rows in pushes:
        newest = {}
        for k, ts, v in rows:
            if k not in newest or (ts, v) > newest[k]:
                newest[k] = (ts, v)
        for k, new in newest.items():
            if k not in out or new[0] > out[k][0]:
                out[k] = new
    return out


def test_pushes_upserts_and_compaction_say_the_same(spark):
    rnd = random.Random(1)
    path, pushes = fresh_path(spark, "online"), []
    stored = OnlineTable(spark, path, ["k"], "ts", buckets=8)
    with pytest.raises(ValueError):
        stored.read()
    for i in range(5):
        rows = [(rnd.choice([None, *range(30)]), BASE + dt.timedelta(hours=rnd.randrange(20)), rnd.randrange(99)) for _ in range(25)]
        pushes.append(rows)
        df = spark.createDataFrame(rows, ROWS)
        (stored.upsert if i in (1, 4) else stored.append)(df)
        assert {r.k: (r.ts, r.v) for r in stored.read().collect()} == expected(pushes)
    stored.append(spark.createDataFrame(pushes[0], ROWS), push="again")
    stored.append(spark.createDataFrame(pushes[0], ROWS), push="again")
    assert stored.compact()
    assert stored.compact() == []
    assert {r.k: (r.ts, r.v) for r in stored.read().collect()} == expected(pushes)
    with pytest.raises(ValueError):
        OnlineTable(spark, path, ["k"], "ts", buckets=9)
    assert OnlineTable(spark, path, ["k"], "ts", buckets=8).read().count() == len(expected(pushes))


def test_a_lookup_opens_the_folders_of_its_keys(spark):
    stored = OnlineTable(spark, fresh_path(spark, "folders"), ["k"], "ts", buckets=32)
    stored.append(spark.range(400).select(F.col("id").alias("k"), F.lit(BASE).alias("ts"), (F.col("id") * 2).alias("v")))
    requests = spark.createDataFrame([(5, "a"), (5, "b"), (7, "c"), (None, "d"), (9999, "e")], "k long, name string")
    found = stored.lookup(requests)
    assert {r.name: r.v for r in found.collect()} == {"a": 10, "b": 10, "c": 14, "d": None, "e": None}
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "PartitionFilters" in x)
    assert f"PartitionFilters: [{BUCKET}" in scan and f"{BUCKET}#" in scan and " IN " in scan
    touched = stored._touched(requests)
    assert len(touched) <= 4 and stored.log(touched).select("k").count() < 100


def test_an_upsert_rewrites_the_buckets_it_touches(spark):
    stored = OnlineTable(spark, fresh_path(spark, "touched"), ["k"], "ts", buckets=32)
    old = spark.range(400).select(F.col("id").alias("k"), F.lit(BASE).alias("ts"), F.col("id").alias("v"))
    stored.append(old, push="first")
    before = {(r[SOURCE], r[BUCKET]) for r in stored.log().select(SOURCE, BUCKET).distinct().collect()}
    touched = stored.upsert(spark.createDataFrame([(5, BASE + DAY, -1), (7, BASE - DAY, -1), (1000, BASE, -1)], ROWS))
    after = {(r[SOURCE], r[BUCKET]) for r in stored.log().select(SOURCE, BUCKET).distinct().collect()}
    assert {b for s, b in after if s != "first"} == set(touched)
    assert {x for x in before if x[1] not in touched} == {x for x in after if x[0] == "first"}
    values = {r.k: r.v for r in stored.read().collect()}
    assert len(values) == 401 and (values[5], values[7], values[1000], values[8]) == (-1, 7, -1, 8)


def test_two_writers_on_one_bucket_lose_nothing(spark):
    """The second reads before the first removes: what both read is merged twice, which changes nothing."""
    stored = OnlineTable(spark, fresh_path(spark, "both"), ["k"], "ts", buckets=1)
    stored.append(spark.createDataFrame([(1, BASE, 1)], ROWS))
    frames = [spark.createDataFrame([(k, BASE + DAY, k)], ROWS) for k in (2, 3)]
    threads = [threading.Thread(target=stored._write, args=(stored._newest(stored.log().drop(SOURCE, BUCKET).unionByName(
        f.withColumns({"log_committed": F.lit(9), "log_writer": F.lit("w")}))), f"base-{i}")) for i, f in enumerate(frames)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert {r.k: r.v for r in stored.read().collect()} == {1: 1, 2: 2, 3: 3}
