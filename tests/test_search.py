import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import search, text


def vectors(spark, rows):
    return spark.createDataFrame(rows, "id long, v array<float>")


def queries(spark, rows):
    return spark.createDataFrame(rows, "query_id long, vector array<double>")


def brute(rows, point, k, metric):
    q = np.array(point)
    scored = []
    for i, v in rows:
        if v is None or len(v) != len(point):
            continue
        a = np.array(v, dtype=np.float32).astype(float)
        d = {
            "L1": lambda: np.abs(a - q).sum(),
            "L2": lambda: math.sqrt(((a - q) ** 2).sum()),
            "inner_product": lambda: -(a @ q),
            "cosine": lambda: 1 - (a @ q) / (np.linalg.norm(a) * np.linalg.norm(q))
            if np.linalg.norm(a)
            else math.nan,
        }[metric]()
        if not math.isnan(d):
            scored.append((d, i))
    return [i for _, i in sorted((round(d, 9), i) for d, i in scored)[:k]]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    made = [(i, [rng.uniform(-1, 1) for _ in range(5)]) for i in range(200)]
    made += [(500, None), (501, [1.0, 2.0]), (502, [0.0] * 5)]
    return made + [(1000 + i, [0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(150)]


@pytest.mark.parametrize("metric", search.METRICS)
@pytest.mark.parametrize("max_queries", [None, 1])
def test_topk_equals_brute_force(spark, rows, metric, max_queries):
    points = {1: [0.5] * 5, 2: [1.0, -1.0, 0.25, 0.0, 2.0], 3: [0.1] * 5}
    df = vectors(spark, rows).repartition(5)
    got = search.vector_topk(
        df, "id", "v", queries(spark, list(points.items())), 12, metric, max_queries
    )
    found = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r.id)
    for name in (2, 3):
        assert found[name] == brute(rows, points[name], 12, metric), name
    assert [len(v) for v in found.values()] == [12, 12, 12]


def test_copies_are_ordered_by_id(spark, rows):
    got = search.vector_topk(vectors(spark, rows), "id", "v", queries(spark, [(1, [0.5] * 5)]), 5)
    assert [r.id for r in got.orderBy("rank").collect()] == [1000, 1001, 1002, 1003, 1004]


def test_string_ids(spark):
    df = spark.createDataFrame([("b", [1.0]), ("a", [1.0])], "id string, v array<float>")
    got = search.vector_topk(df, "id", "v", queries(spark, [(1, [1.0])]), 2).orderBy("rank")
    assert [r.id for r in got.collect()] == ["a", "b"]


def test_batch_is_padded(spark):
    df = spark.createDataFrame([(7, [3.0, 4.0], "seven")], "id long, v array<float>, text string")
    got = search.vector_topk_batch(
        df, "id", "v", "text", queries(spark, [(1, [6.0, 8.0]), (2, [0.0, 0.0])]), 2
    )
    rows = {(r.query_id, r["rank"]): (r.id, r.text, r.v) for r in got.collect()}
    assert rows[(1, 1)] == (7, "seven", [3.0, 4.0])
    assert rows[(1, 2)] == rows[(2, 1)] == rows[(2, 2)] == (-1, "", [0.0, 0.0])


def test_scores(spark):
    df = vectors(spark, [(1, [3.0, 4.0]), (2, None)])
    one = queries(spark, [(0, [3.0, 0.0])])
    score = lambda m: search.vector_score(df, "id", "v", one, 5, m).collect()[0].score
    assert score("cosine") == pytest.approx(1.6)
    assert score("inner_product") == 9.0
    assert score("L2") == pytest.approx(0.2)
    with pytest.raises(ValueError):
        score("L1")
    with pytest.raises(ValueError):
        search.vector_topk(df, "id", "v", one, 5, "hamming")


def test_combine(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0])], "a array<double>, b array<double>")
    made = lambda *a: df.select(search.combine_embeddings(F.col("a"), F.col("b"), *a)).first()[0]
    assert made("weighted_sum", 0.25, 0.75) == [2.5, 0.5]
    assert made("average") == [2.0, 1.0]
    assert made("concatenate") == [1.0, 2.0, 3.0]
    with pytest.raises(ValueError):
        made("weighted_sum", 0.5, 0.6)
    with pytest.raises(ValueError):
        made("product")


def test_ivf_recall(spark, small, tmp_path):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    centres = search.fit_centres(df, "embedding", nlist=8)
    cells = search.write_ivf(df, "embedding", centres, str(tmp_path / "ivf"))
    assert cells.count() == df.count()
    hits = total = 0
    for row in df.orderBy("vec_id").limit(4).collect():
        one = queries(spark, [(0, [float(x) for x in row.embedding])])
        exact = {r.id for r in search.vector_topk(df, "vec_id", "embedding", one, 10).collect()}
        near = search.ivf_topk(cells, centres, "vec_id", "embedding", row.embedding, 10, nprobe=5)
        hits += len(exact & {r.id for r in near.collect()})
        total += 10
        full = search.ivf_topk(cells, centres, "vec_id", "embedding", row.embedding, 10, nprobe=8)
        assert exact == {r.id for r in full.collect()}
    assert hits / total >= 0.7
    plan = near._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_ivf_stores_rows_without_a_vector(spark, tmp_path):
    rows = [(1, [0.0, 0.0]), (2, [5.0, 5.0]), (3, None), (4, [1.0])]
    df = spark.createDataFrame(rows, "i long, v array<double>")
    cells = search.write_ivf(df, "v", np.array([[0.0, 0.0], [5.0, 5.0]]), str(tmp_path / "ivf"))
    assert {r.i: r.cell for r in cells.collect()} == {1: 0, 2: 1, 3: None, 4: None}


DOCS = [
    (1, "The cat sat. The CAT ran!", "a"),
    (2, "a cat and a dog", "the"),
    (3, "Élan vital, naïve café", "x"),
    (4, "", None),
    (5, "dog dog dog", "b"),
]


def test_text_search(spark):
    df = spark.createDataFrame(DOCS, "id long, t string, s string")
    ranked = search.text_search_rank(df, "id", ["t", "s"], "The cat", 5)
    assert [tuple(r) for r in ranked.collect()] == [(1, 4), (2, 2)]
    found = search.text_search_contains(df, "id", ["t", "s"], "og", 5)
    assert [r.id for r in found.collect()] == [2, 5]
    assert [r.id for r in search.text_search_rank(df, "id", ["t"], "ÉLAN café", 5).collect()] == [3]
    assert search.text_search_rank(df, "id", ["t"], "he", 5).count() == 0
    with pytest.raises(ValueError):
        search.text_search_rank(df, "id", ["t"], " !? ", 5)


def test_bm25(spark):
    df = spark.createDataFrame(DOCS, "id long, t string, s string")
    got = {r.id: r.score for r in search.bm25_search(df, "id", ["t"], "dog", 5).collect()}
    words = {1: 6, 2: 5, 3: 4, 4: 0, 5: 3}
    mean = sum(words.values()) / 5
    idf = math.log((5 - 2 + 0.5) / (2 + 0.5))
    for doc, tf in {2: 1, 5: 3}.items():
        damp = 1.2 * (0.25 + 0.75 * words[doc] / mean)
        assert got.pop(doc) == pytest.approx(idf * tf * 2.2 / (tf + damp))
    assert not got


def test_hybrid(spark):
    df = spark.createDataFrame(
        [(1, "cat dog", [1.0]), (2, "cat", [0.0]), (3, "dogs cat", [0.0])], "id long, t string, v array<float>"
    )
    got = search.hybrid_search(df, "id", "v", ["t"], "dog cat", queries(spark, [(0, [0.0])]), 5)
    assert [r.id for r in got.collect()] == [1]


# -- chunking and embedding -------------------------------------------------------------------


def allowed_end(content, begin, size):
    """The end that the rule asks for, from all offsets at which a chunk could end."""
    if begin + size >= len(content):
        return len(content)
    ends = range(begin + 1, begin + size + 1)
    for mark in (". ", "\n\n", "\n", " "):
        good = [e for e in ends if content[begin:e].endswith(mark) and e - len(mark) - begin > size // 2]
        if good:
            return good[-1]
    return begin + size


def holds_to_the_rule(content, chunks, size, overlap, tail):
    """Whether chunks of one text start, end, follow each other and stop as described."""
    begins = [begin for _, begin, _ in chunks]
    follow = [0, *(max(end - overlap, begin + 1) for _, begin, end in chunks)]
    reached = [end == len(content) for _, _, end in chunks]
    return (
        begins == follow[:-1]
        and all(end == allowed_end(content, begin, size) for _, begin, end in chunks)
        and all(words == content[begin:end].strip() for words, begin, end in chunks)
        and (follow[-1] >= len(content) or tail == "stop" and reached[-1])
        and (tail == "reference" or not any(reached[:-1]))
        and all(begin < len(content) for begin in begins)
    )


@pytest.mark.parametrize("tail", ["stop", "reference"])
def test_chunks(spark, tail):
    rng = random.Random(6)
    alphabet = ["word", "é€", ". ", "\n", "\n\n", " ", "𝄞", "x" * 30]
    docs = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(80)))) for i in range(60)]
    docs.append((60, None))
    df = spark.createDataFrame(docs, "id long, t string").repartition(4)
    got = text.chunk_text(df, "id", "t", 50, 10, tail=tail, rows_per_split=9).orderBy("chunk_id")
    rows = [tuple(r) for r in got.collect()]
    assert [r[0] for r in rows] == list(range(len(rows)))
    assert [r[1] for r in rows] == sorted(r[1] for r in rows)
    for i, content in docs:
        own = [r[2:] for r in rows if r[1] == i]
        assert holds_to_the_rule(content or "", own, 50, 10, tail)


def test_chunk_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        text.chunk_text(spark.createDataFrame([(1, "a")], "i long, t string"), "i", "t", 0, 0)


def test_default_embedding(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "A, b... a!"), (3, ""), (4, None)], "i long, t string")
    got = {r.i: r.embedding for r in text.embed_text(df, "t", width=16).collect()}
    assert got[1] == got[2] and sum(x * x for x in got[1]) == pytest.approx(1.0)
    assert sorted(x for x in got[1] if x)[-1] == pytest.approx(2 / math.sqrt(5))
    assert got[3] == got[4] == [0.0] * 16


def test_given_model(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "i long, t string")
    made = text.embed_text(df, "t", model=lambda ts: np.array([[len(t), 1.0] for t in ts]))
    assert {r.i: r.embedding for r in made.collect()} == {1: [3.0, 1.0], 2: [0.0, 1.0]}


def test_hits_with_their_features(spark):
    df = spark.createDataFrame([(1, [1.0], "a", 5), (2, [2.0], "b", None), (3, [9.0], "c", 7)], "id long, v array<double>, s string, n int")
    one = spark.createDataFrame([(0, [1.2])], "query_id long, vector array<double>")
    found = search.hit_features(search.vector_topk(df, "id", "v", one, 2), df, "id", ["s", "n"])
    assert sorted((r["rank"], r.id, r.s, r.n) for r in found.collect()) == [(1, 1, "a", 5), (2, 2, "b", None)]
    with pytest.raises(ValueError):
        search.hit_features(search.vector_topk(df, "id", "v", one, 2), df, "id", ["rank"])


def test_embedding_counts_a_slice_at_a_time(spark, monkeypatch):
    rows = [(i, f"w{i} w{i % 3} w{i} " + "x " * (i % 5) if i % 4 else None) for i in range(23)]
    df = spark.createDataFrame(rows, "i long, t string").coalesce(1)
    whole = {r.i: r.embedding for r in text.embed_text(df, "t", width=16).collect()}
    monkeypatch.setattr(text, "SLICE_ROWS", 5)
    assert {r.i: r.embedding for r in text.embed_text(df, "t", width=16).collect()} == whole
    assert whole[0] == [0.0] * 16 and sum(x * x for x in whole[1]) == pytest.approx(1.0)
