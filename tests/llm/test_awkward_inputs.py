"""Very long texts, names that clash with the operators' own, ties, and training against plain loops."""

import random

import corpus_pipeline as cp
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import crosspolytope, extraction, language, learned_partitions, manifest, mixing, quality, trie

#: Names that operators use for columns of their own.
CLASHING = (
    "fp fingerprint root whole size kept spans chunk score toxicity_score quality_score part row n rest crc ids tree place node "
    "block key range number host path lines packed text_ v rep dims look query_id rank label_ times component_id"
).split()


def clashing(df):
    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING) if c not in df.columns})


def digest(df):
    return sorted((repr(tuple(r)) for r in df.collect()))


@pytest.fixture(scope="module")
def long_text():
    rnd = random.Random(1)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    return " ".join(rnd.choice(words) for _ in range(200_000))  # over 1 MB


def test_pages_with_clashing_names(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    assert digest(extraction.extract(clashing(pages))) == digest(extraction.extract(pages))
    model = language.fit(spark.read.parquet(f"{small}/documents.parquet"))
    assert digest(language.identify(clashing(pages), model)) == digest(language.identify(pages, model))


def test_vectors_with_clashing_names(spark, small):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet")
    assert digest(crosspolytope.near_duplicates(clashing(vectors))) == digest(crosspolytope.near_duplicates(vectors))
    asked = F.col("vec_id") % 100 == 0
    found = learned_partitions.search(clashing(vectors), asked)
    assert digest(found) == digest(learned_partitions.search(vectors, asked))


def test_new_operators_with_clashing_names(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    leaf = manifest.leaf_digest(F.col("doc_id"), F.col("text"))
    made = [manifest.manifest(d, "doc_id", "source", leaf) for d in (documents, clashing(documents))]
    assert digest(made[0]) == digest(made[1])
    assert digest(mixing.mix(clashing(documents))) == digest(mixing.mix(documents))
    conversations = spark.read.parquet(f"{small}/conversations.parquet")
    assert digest(trie.conversation_trie(clashing(conversations))) == digest(trie.conversation_trie(conversations))


def test_long_pages(spark, small, long_text):
    body = long_text.replace(" ", "</p><p>", 5)
    page = f"<html lang='en'><body><nav>menu</nav><article><p>{body}</p></article></body></html>"
    rows = [(1, "http://h.example.com/a", page), (2, "http://h.example.com/b", page + "<p" * 100_000), (3, None, "<!--" + long_text)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in extraction.extract(pages).collect()}
    assert texts[1] == body.replace("</p><p>", "\n\n") and texts[3] == ""
    model = language.fit(spark.read.parquet(f"{small}/documents.parquet"))
    assert language.identify(pages, model).count() == 3


def test_stages_with_long_texts_and_clashing_names(spark, long_text):
    root = "/root/testdata/sf0.01"
    rows = [(10**6 + i, t, "en", "s", 1) for i, t in enumerate([long_text, long_text[: len(long_text) // 2], "short text"])]
    given = spark.read.parquet(f"{root}/documents.parquet")
    docs = clashing(given.unionByName(spark.createDataFrame(rows, given.schema)))
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, root)
        assert out.columns == docs.columns, name
        assert out.schema == docs.schema or [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        assert 0 < out.where("doc_id >= 1000000 or doc_id < 1000000").count() <= docs.count(), name
    pieces = cp.packing_stage(spark, docs.where("doc_id >= 1000000"), root)
    placed = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("tokens")).collect()
    assert len(placed) == 3 and all(r.n == r.tokens for r in placed)


def test_pair_loss_is_least_at_the_trained_weights():
    """The loss by a plain loop over the pairs: its numeric gradient is zero at the weights found."""
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(60, 4))
    label = (rows[:, 0] + 0.5 * rng.normal(size=60) > 0).astype(int)
    model = quality.train(rows, label)
    wide = np.clip((rows - rows.mean(axis=0)) / (rows.std(axis=0) + 1e-9), -quality.CLIP, quality.CLIP)
    wide = np.hstack([wide, wide * wide])

    draw = np.random.default_rng(0)  # the pairs that training draws with its seed
    better, worse = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    few, many = sorted((better, worse), key=len)
    few_side = [*np.repeat(few, quality.PAIRS_EACH), *draw.choice(few, len(many))]
    many_side = [*draw.choice(many, len(few_side) - len(many)), *many]
    pairs = list(zip(few_side, many_side, strict=True))
    if label[few[0]] == 0:
        pairs = [(b, a) for a, b in pairs]

    def loss(weight):
        total = quality.RIDGE * float(weight @ weight) / 2
        for first, second in pairs:
            total += float(np.logaddexp(0, -(wide[first] - wide[second]) @ weight))
        return total

    step = 1e-4
    for i in range(len(model.weight)):
        move = step * np.eye(len(model.weight))[i]
        assert abs(loss(model.weight + move) - loss(model.weight - move)) / (2 * step) < 1e-2
    for _ in range(20):
        assert loss(model.weight) <= loss(model.weight + rng.normal(scale=0.1, size=len(model.weight)))


def test_ties_at_the_quantile():
    """Documents that can't be told apart share one score, and one side of the cut."""
    rows = np.array([[1.0, 2.0]] * 6 + [[3.0, 1.0]] * 2)
    model = quality.train(rows, np.array([0, 1, 0, 1, 0, 0, 1, 1]))
    scores = model.score(rows)
    assert len(set(scores[:6])) == 1 and len(set(scores[6:])) == 1 and scores[7] > scores[0]
    same = quality.train(np.ones((4, 2)), np.array([0, 1, 0, 1])).score(np.ones((3, 2)))
    assert len(set(same)) == 1 and same[0] == pytest.approx(quality.THRESHOLD)
