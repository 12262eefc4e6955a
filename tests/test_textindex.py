"""The stored index against plain Python, with blocks small enough to be left out."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import search, textindex
from tidemark.session import fresh_path

WORDS = "the of and a cat dog rat eel owl".split()


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    weights = [60, 30, 20, 10, 5, 4, 3, 2, 1]
    text = lambda n: " ".join(rnd.choices(WORDS, weights, k=n))
    made = [(i, text(rnd.randint(1, 60)).title(), text(rnd.randint(0, 3))) for i in range(300)]
    return [*made, (900, None, "cat"), (901, "", None), (902, None, None), (903, "rat, RAT; rat", "rat the"), (904, "dog", "cat")]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a string, b string")


@pytest.fixture(scope="module")
def index(spark, frame):
    return textindex.write_index(frame.repartition(3), "id", ["a", "b"], fresh_path(spark, "index"), buckets=8, block=4)


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


QUERIES = ["the", "the of", "The, the of!", "eel owl", "cat nosuch", "nosuch", "owl the a", "dog cat"]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_bm25_equals_a_scan(spark, rows, index, k):
    docs = {i: words(a) + words(b) for i, a, b in rows}
    mean = sum(map(len, docs.values())) / len(docs)
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id long, text string")
    got = {}
    for r in index.bm25(queries, k).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.score))
    for q, text in enumerate(QUERIES):
        terms = set(words(text))
        scored = []
        for i, own in docs.items():
            if all(t in own for t in terms):
                score = 0.0
                for t in terms:
                    df, tf = sum(t in d for d in docs.values()), own.count(t)
                    idf = math.log((len(docs) - df + 0.5) / (df + 0.5))
                    damping = 1.2 * (0.25 + 0.75 * len(own) / mean)
                    score += (idf if idf > 0 else 1e-6) * tf * 2.2 / (tf + damping)
                scored.append((-round(score, 9), i))
        want = sorted(scored)[:k]
        found = sorted(got.get(q, []))
        assert [r for r, _, _ in found] == list(range(1, len(want) + 1)), text
        assert [-round(s, 9) for _, _, s in found] == [s for s, _ in want], text
        assert {i for _, i, s in found if -round(s, 9) != want[-1][0]} == {i for s, i in want if s != want[-1][0]}, text


def test_one_query_equals_the_scanning_search(spark, frame, index):
    for text in ("the of", "eel"):
        one = spark.createDataFrame([(0, text)], "query_id long, text string")
        got = [(r.id, round(r.score, 9)) for r in index.bm25(one, 10).orderBy("rank").collect()]
        want = [(r.id, round(r.score, 9)) for r in search.bm25_search(frame, "id", ["a", "b"], text, 10).collect()]
        assert got == want


def test_phrases_equal_a_scan(spark, rows, index):
    phrases = ["the the", "the of the", "rat rat", "dog cat", "the the the the", "owl", "nosuch the", "THE, of"]
    queries = spark.createDataFrame(list(enumerate(phrases)), "query_id long, text string")
    want = set()
    for q, text in enumerate(phrases):
        wanted = words(text)
        for i, *fields in rows:
            times = 0
            for field in map(words, fields):
                times += sum(field[at : at + len(wanted)] == wanted for at in range(len(field) - len(wanted) + 1))
            if times:
                want.add((q, i, times))
    assert {tuple(r) for r in index.phrases(queries).collect()} == want
    assert (3, 904, 1) not in want  # two fields are no phrase


def test_only_the_asked_folders_are_opened(spark, index):
    queries = spark.createDataFrame([(0, "eel")], "query_id long, text string")
    plan = index.phrases(queries)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "PartitionFilters" in x and "bucket" in x]
    assert scans and all("PartitionFilters: [isnotnull(bucket" in x or "PartitionFilters: [bucket" in x or "bucket#" in x.split("PartitionFilters")[1] for x in scans)
    asked = queries.select(F.explode(search.tokens(F.col("text"))).alias("term"))
    held = index._lists(asked)
    assert {r.term for r in held.select("term").distinct().collect()} == {"eel"}
    blocks = spark.read.parquet(f"{index.path}/blocks").where("term = 'the'").orderBy("block").select("top", "n", "impacts").collect()
    assert len(blocks) > 10 and all(len(b.impacts) == b.n <= 4 and max(b.impacts) == b.top for b in blocks)
    assert [b.top for b in blocks] == sorted((b.top for b in blocks), reverse=True)


def test_an_index_of_nothing(spark, frame):
    index = textindex.write_index(frame.limit(0), "id", ["a", "b"], fresh_path(spark, "none"))
    queries = spark.createDataFrame([(0, "the of")], "query_id long, text string")
    assert index.bm25(queries, 3).count() == 0 and index.phrases(queries).count() == 0


def test_batched_cells_against_a_scan(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(c * 9, 1) for c in (i % 4, i % 3)]) for i in range(200)] + [(500, None), (501, [1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    queries = spark.createDataFrame([(q, rows[q][1]) for q in range(0, 60, 7)] + [(99, None)], "query_id long, vector array<double>")
    centres = search.fit_centres(df.where("size(v) = 2"), "v", 8)
    cells = search.write_ivf(df, "v", centres, fresh_path(spark, "cells"))
    exact = {(r.query_id, r["rank"], r.id) for r in search.vector_topk(df, "id", "v", queries, 5).collect()}
    for most in (None, 2):
        every = search.ivf_topk_batch(cells, centres, "id", "v", queries, 5, 8, max_queries=most)
        assert {(r.query_id, r["rank"], r.id) for r in every.collect()} == exact
    near = np_nearest(centres, rows)
    for r in search.ivf_topk_batch(cells, centres, "id", "v", queries, 5, 2).collect():
        probed = sorted(range(8), key=lambda c: (math.dist(centres[c], rows[r.query_id][1]), c))[:2]
        assert near[r.id] in probed
    assert search.ivf_topk_batch(cells, centres, "id", "v", queries.limit(0), 5).count() == 0
    assert {(r.query_id, r["rank"], r.id) for r in search.vector_topk(df, "id", "v", queries, 5, max_queries=2).collect()} == exact


def np_nearest(centres, rows):
    return {i: min(range(len(centres)), key=lambda c: (math.dist(centres[c], v), c)) for i, v in rows if v and len(v) == 2}


def test_terms_that_go_on_in_other_tasks(spark, rows, frame, index, monkeypatch):
    monkeypatch.setattr(textindex, "WORDS_PER_TASK", 500)
    monkeypatch.setattr(textindex, "SLICE_ROWS", 16)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        small = textindex.write_index(frame.repartition(3), "id", ["a", "b"], fresh_path(spark, "cut"), buckets=8, block=4)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    blocks = spark.read.schema(small.schema).parquet(f"{small.path}/blocks").orderBy("term", "block").collect()
    assert len({b.block >> 32 for b in blocks if b.term == "the"}) > 1
    got = {}
    for b in blocks:
        assert len(b.ids) == len(b.impacts) == len(b.places) == b.n <= 4 and b.top == b.impacts[0]
        got.setdefault(b.term, []).extend(zip(b.ids, b.impacts, b.places))
    for term, held in got.items():
        assert [(-x, i) for i, x, _ in held] == sorted((-x, i) for i, x, _ in held)
        want = [
            (i, [f * textindex.FIELD + at for f, own in enumerate(map(words, fields)) for at, w in enumerate(own) if w == term])
            for i, *fields in rows
        ]
        assert sorted((i, p) for i, _, p in held) == [(i, p) for i, p in want if p]
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id long, text string")
    assert sorted(map(tuple, small.bm25(queries, 3).collect())) == sorted(map(tuple, index.bm25(queries, 3).collect()))


def test_postings_are_made_where_the_rows_are(spark, frame):
    split = frame.select("id", F.array(search.tokens(F.coalesce("a", F.lit("")))).alias("words")).withColumn("length", F.size(F.col("words")[0]))
    plan = textindex._postings_of(split)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    twice = split.where("id = 903").unionAll(split.where("id in (903, 904)"))
    got = {(r.id, r.term): r.places for r in textindex._postings_of(twice).collect()}
    assert got == {(903, "rat"): [0, 0, 1, 1, 2, 2], (904, "dog"): [0]}
