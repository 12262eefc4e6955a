"""Operators against brute force, on hand-made awkward rows and the small tables."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import (
    bpe, common, crosspolytope, extraction, language, learned_partitions, packing, quality, simhash, substrings, suffix_sort, toxicity,
)
from tidemark.llm.components import components

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
MEDIUM = "/root/testdata/sf0.1"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()


@pytest.fixture(scope="module")
def awkward(spark):
    """NULLs, empty and long texts, copies, repeated rows, shared passages, columns with clashing names."""
    rnd = random.Random(5)
    line = " ".join(rnd.choice(WORDS) for _ in range(30))
    texts = [None, "", " \n", "one", "two words", "É ñ 漢字 🙂 <|endoftext|> it's", line, line, line + " x"]
    texts += [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(5, 60))) + " " + line for _ in range(25)]
    texts += ["ab" * 3000, "z" * 500, " ".join(rnd.choice(WORDS) for _ in range(9000))]
    rows = [(i, t, "en", "s", 1, "c0", 7) for i, t in enumerate(texts)] + [(6, line, "en", "s", 1, "c0", 7)] * 2
    rows += [(None, line, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, Whole string, chunk int")


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.limit(0)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_bpe_matches_the_library(spark, awkward, empty):
    library = Tokenizer.from_file(VOCABULARY)
    ours = bpe.load(VOCABULARY)
    rnd = random.Random(1)
    letters = "aáß'tsrevml0½९ \t\n\x1c Σσςİ漢🙂-_<|>endoftxΩÅǅ"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(2000)] + ["q" * 900]
    cache = ours.cached("test", tuple)
    for text in texts:
        ids = [i for word in cache.of(text) for i in word]
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert ours.decode(ids) == library.decode(ids, skip_special_tokens=False)
    want = []
    for r in awkward.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        want.append((r.doc_id, len(ids), *sha))
    assert rows_of(bpe.digests(awkward, VOCABULARY)) == sorted(want, key=repr)
    assert bpe.digests(empty, VOCABULARY).count() == 0
    there = bpe.decode(bpe.encode(awkward, VOCABULARY), VOCABULARY)
    assert there.columns == [*awkward.columns, "ids", "decoded"]
    assert there.where("doc_id = 3").first().decoded == "one</w>"


def test_packing_places_each_id_once(awkward, empty):
    library = Tokenizer.from_file(VOCABULARY)
    ids = {}
    for r in awkward.collect():
        own = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        ids.setdefault(r.doc_id, []).append(own)
    for window in (16, 2048):
        pieces = packing.pack(awkward, VOCABULARY, window).collect()
        count, by_sequence = {}, {}
        for p in pieces:
            own = ids[p.doc_id][0]
            assert p.doc_tokens == len(own)
            assert p.ids_crc32 == zlib.crc32(own[p.start : p.start + p.length].tobytes())
            for i in range(p.start, p.start + p.length):
                count[p.doc_id, i] = count.get((p.doc_id, i), 0) + 1
            by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert count == {(d, i): len(own) for d, own in ids.items() for i in range(len(own[0]))}
        for own in by_sequence.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at == window or at & (at - 1) == 0
    assert packing.pack(empty, VOCABULARY).count() == 0


def _fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").split(" ")]
    words = [w for part in words for w in part.replace("\t", "\n").replace("\r", "\n").replace("\x0c", "\n").split("\n") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(size, links):
    parent = list(range(size))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(size)]


def test_simhash_links_all_within_distance(awkward, empty):
    rows = awkward.select("doc_id", "text").collect()
    prints = [_fingerprint(r.text) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    roots, least = _roots(len(rows), links), {}
    for r, root in zip(rows, roots, strict=True):
        if r.doc_id is not None:
            least[root] = min(least.get(root, r.doc_id), r.doc_id)
    want = [(r.doc_id, f"{p:016x}", least.get(root)) for r, p, root in zip(rows, prints, roots, strict=True)]
    assert rows_of(simhash.near_duplicates(awkward)) == sorted(want, key=repr)
    assert simhash.near_duplicates(empty).count() == 0


def test_blocks_split_a_crowded_bucket(spark, monkeypatch):
    from tidemark.llm import blocks

    monkeypatch.setattr(blocks.dealt_pairs, "__defaults__", (4,))
    prints = spark.createDataFrame([(i,) for i in range(40)], "fp long")  # 40 numbers near each other
    roots = {r.node: r.root for r in components(simhash.near_links(prints)).collect()}
    assert set(roots) | {min(roots.values())} == set(range(40)) and len(set(roots.values())) == 1


def test_tasks_stay_bounded_in_a_crowded_bucket(spark):
    from tidemark.llm import blocks

    rows = spark.range(600).selectExpr("id AS rep", "CAST(1 AS LONG) AS key", "CAST(600 AS LONG) AS bucket_rows")
    dealt = blocks.dealt_tasks(rows, "key", "rep", group_rows=200, block_rows=20)
    sizes = [r["count"] for r in dealt.groupBy("task").count().collect()]
    assert sum(sizes) == 600 * 30 and max(sizes) < 3 * 200 and len(sizes) > 60  # three tasks of 6,000 rows before
    met = dealt.select("unit", "rep").distinct().groupBy("unit").count().agg(F.max("count")).first()[0]
    assert met <= 2 * 3 * 20


def _removed(rows, length=50):
    first = {}
    for doc, text in rows:
        for i in range(len(text) - length + 1):
            if doc is not None:
                first[text[i : i + length]] = min(first.get(text[i : i + length], doc), doc)
    for doc, text in rows:
        gone = np.zeros(len(text), dtype=bool)
        for i in range(len(text) - length + 1):
            if doc is not None and first[text[i : i + length]] < doc:
                gone[i : i + length] = True
        yield doc, len(text), np.frombuffer(text, np.uint8)[~gone].tobytes()


@pytest.mark.parametrize(("hot", "per_task"), [((64, 20_000), None), ((1, 2), None), ((1, 2), 1)])
def test_repeated_strings_go(awkward, empty, monkeypatch, hot, per_task):
    for name in ("CHUNKS_PER_TASK", "BUCKETS_PER_TASK", "ANSWERS_PER_TASK") if per_task else ():
        monkeypatch.setattr(substrings, name, per_task)  # more tasks than the session's shuffle partitions
    monkeypatch.setattr(substrings, "CHUNK_HOT", hot[0])
    monkeypatch.setattr(substrings, "ALL_HOT", hot[1])
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 5_000)
    monkeypatch.setattr(substrings, "ENTRY_BYTES", 9_000)
    rows = [(r.doc_id, (r.text or "").encode()) for r in awkward.select("doc_id", "text").collect()]
    found = substrings.remove_repeats(awkward)
    assert set(awkward.columns) - {"text"} < set(found.columns)
    got = rows_of(found.select("doc_id", "n_bytes", F.col("kept")))
    assert got == sorted(_removed(rows), key=repr)
    assert substrings.remove_repeats(empty).count() == 0


def test_partitions_follow_from_the_size_once_it_needs_more(spark):
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(1000).withColumn("chunk", F.col("id") % 500)
    assert common.in_tasks(rows, "chunk", 16 * usual, 16) is rows
    wide = common.in_tasks(rows, "chunk", 16 * usual + 1, 16)
    assert wide.rdd.getNumPartitions() == usual + 1 and wide.count() == 1000


def test_suffix_sort_orders_and_groups(monkeypatch):
    rng = np.random.default_rng(3)
    rows = rng.integers(97, 99, size=(30, 24)).astype(np.uint8)
    row, start = np.repeat(np.arange(30), 15), np.tile(np.arange(15), 30)
    segment = np.sort(rng.integers(0, 4, size=len(row)))
    suffixes = suffix_sort.Suffixes(rows, row, start, 10)
    text = [rows[r, s : s + 10].tobytes() for r, s in zip(row, start, strict=True)]
    order, run = suffixes.equal_runs(segment)
    assert [(segment[i], text[i]) for i in order] == sorted((s, t) for s, t in zip(segment, text, strict=True))
    assert len({(segment[i], text[i]) for i in order}) == run[-1] + 1
    monkeypatch.setattr(suffix_sort.Suffixes, "common", lambda self, a, b: np.full(len(a), self.length))  # collisions
    again, runs = suffixes.equal_runs(segment)
    assert [(segment[i], text[i]) for i in again] == [(segment[i], text[i]) for i in order] and (runs == run).all()


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(120, 16))
    near = base[:30] + 0.05 * rng.normal(size=(30, 16))
    rows = [(i, v.tolist(), 0) for i, v in enumerate([*base, *near, *[base[0]] * 40])]
    rows += [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, [None] + [1.0] * 15, 0)]
    rows += [(904, [1.0, 2.0], 0), (905, [1.0, 2.1], 0), (906, [], 0), (None, [1.0] * 16, 0), (5, base[5].tolist(), 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def _usable(rows):
    good = {r.vec_id: np.array(r.embedding) for r in rows if r.vec_id is not None and r.embedding and None not in r.embedding}
    return {k: v for k, v in good.items() if np.isfinite(v).all() and v.any()}


@pytest.mark.parametrize("dims", [1, 2, 5, 64, 100])
def test_cross_polytope_buckets_name_the_foremost_axes(monkeypatch, dims):
    """Against the transform as a matrix; blocks of rows change nothing."""
    rows = np.random.default_rng(dims).normal(size=(40, dims))
    signs = crosspolytope.rotations(dims)
    width = signs.shape[-1]
    place = np.arange(width)
    matrix = np.where(np.bitwise_count(place[:, None] & place) % 2, -1.0, 1.0) / np.sqrt(width)
    found = crosspolytope.buckets(rows, signs)
    padded = np.zeros((40, width))
    padded[:, :dims] = rows
    for table, hashes in enumerate(signs):
        axes = np.stack(np.unravel_index(found[:, table, 0], [2 * width] * len(hashes)))
        for own, rounds in zip(axes, hashes, strict=True):
            turned = padded
            for sign in rounds:
                turned = (turned * sign) @ matrix
            both = np.concatenate([turned, -turned], axis=1)
            assert np.allclose(both[np.arange(40), own], both.max(axis=1))  # a foremost axis, whichever of equal ones
    monkeypatch.setattr(crosspolytope, "ROTATED_AT_ONCE", 3 * width)
    assert (crosspolytope.buckets(rows, signs) == found).all()


def test_cross_polytope_links(vectors):
    rows = vectors.collect()
    good = _usable(rows)
    ids = sorted(good)
    unit = {k: v / np.linalg.norm(v) for k, v in good.items()}
    links = [
        (i, j) for i in range(len(ids)) for j in range(i)
        if len(unit[ids[i]]) == len(unit[ids[j]]) and unit[ids[i]] @ unit[ids[j]] >= 0.9
    ]
    count = {k: 0 for k in ids}
    for i, j in links:
        count[ids[i]] += 1
        count[ids[j]] += 1
    roots = dict(zip(ids, (ids[x] for x in _roots(len(ids), links)), strict=True))
    want = [
        (r.vec_id, count.get(r.vec_id, 0), roots.get(r.vec_id, r.vec_id), r.vec_id is not None and roots.get(r.vec_id, r.vec_id) == r.vec_id)
        for r in rows
    ]
    assert rows_of(crosspolytope.near_duplicates(vectors)) == sorted(want, key=repr)
    assert crosspolytope.near_duplicates(vectors.limit(0)).count() == 0


@pytest.mark.parametrize("dims", [64, 384])
def test_cross_polytope_recall_near_the_threshold(spark, dims):
    """Pairs at cosine 0.9 to 0.92, none nearer: recall of the links, and of the sketches alone."""
    rng = np.random.default_rng(11)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    a = unit(rng.normal(size=(500, dims)))
    side = rng.normal(size=(500, dims))
    side = unit(side - (side * a).sum(axis=1, keepdims=True) * a)
    cosine = rng.uniform(0.9, 0.92, size=(500, 1))
    b = cosine * a + np.sqrt(1 - cosine**2) * side
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))]
    found = crosspolytope.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    linked = found.where("vec_id >= 500 and component_id = vec_id - 500").count()
    assert linked >= (0.98 if dims == 64 else 0.95) * 500
    x, y = crosspolytope.sketches(a).view(np.uint64), crosspolytope.sketches(unit(b)).view(np.uint64)
    assert (np.bitwise_count(x ^ y).sum(axis=1) <= crosspolytope.sketch_bound(0.9)).all()


def test_crowded_buckets_of_near_copies_meet_whole(spark, monkeypatch):
    """Small blocks and groups: a cluster of distinct near copies links every pair, through both meetings."""
    monkeypatch.setattr("tidemark.llm.blocks.BLOCK_ROWS", 16)
    rng = np.random.default_rng(12)
    centre = rng.normal(size=32)
    rows = [(i, (centre + 0.01 * rng.normal(size=32)).tolist()) for i in range(150)]
    rows += [(1000 + i, rng.normal(size=32).tolist()) for i in range(50)]
    found = crosspolytope.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in found.collect()}
    assert all(got[i] == (149, 0) for i in range(150)) and all(got[1000 + i] == (0, 1000 + i) for i in range(50))


def test_learned_partitions_find_the_nearest(spark, vectors, small):
    for df, dims in ((vectors, None), (spark.read.parquet(f"{small}/embeddings.parquet"), 64)):
        good = _usable(df.collect())
        got = {}
        for r in learned_partitions.search(df, F.col("vec_id") % 10 == 0).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        hit = total = 0
        for query in (k for k in good if k % 10 == 0):
            others = sorted(
                (np.sqrt(((v - good[query]) ** 2).sum()), k) for k, v in good.items() if k != query and len(v) == len(good[query])
            )[:10]
            own = sorted(got.get(query, []))
            assert [x[0] for x in own] == list(range(1, len(own) + 1))
            assert [(s, k) for _, k, s in own] == sorted((s, k) for _, k, s in own)
            hit, total = hit + len({k for _, k, _ in own} & {k for _, k in others}), total + len(others)
        assert hit >= 0.9 * total
    assert learned_partitions.search(vectors.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def _recall(rows, found, queries, k=10):
    hit = total = 0
    own = {}
    for r in found.collect():
        own.setdefault(r.query_id, set()).add(r.vec_id)
    for q in queries:
        gap = ((rows - rows[q]) ** 2).sum(axis=1)
        gap[q] = np.inf
        near = set(np.argsort(gap, kind="stable")[:k].tolist())
        hit, total = hit + len(near & own.get(q, set())), total + k
    return hit / total


def test_crowded_parts_are_split_by_a_second_level(spark):
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(60, 24))[rng.integers(0, 60, 6000)] + 0.4 * rng.normal(size=(6000, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    placed = learned_partitions.clean_vectors(df, "vec_id", "embedding")
    routes, placed = learned_partitions.build(placed, 10, 0.94, split_rows=300)
    parts = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert sum(parts.values()) == 6000 and routes.below
    # a part is cut in two at least wherever the first level left more than 300 rows
    split = {p // learned_partitions.SUBPARTS for p in parts if p % learned_partitions.SUBPARTS}
    assert split == set(routes.below)
    found = learned_partitions.search(df, F.col("vec_id") % 50 == 0, split_rows=300)
    assert _recall(rows, found, range(0, 6000, 50)) >= 0.9
    again = learned_partitions.search(df, F.col("vec_id") % 50 == 0, split_rows=300)
    assert rows_of(found) == rows_of(again)


def test_a_query_goes_on_until_its_list_is_full():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(400, 8))
    top = learned_partitions.fit(rows, 100_000)
    top.probes = 1
    below = learned_partitions.fit(rows, 100_000)
    routes = learned_partitions.Routes(top, {0: below})
    everything = sorted(
        p * learned_partitions.SUBPARTS + s for p in range(8) for s in (range(below.second.shape[1]) if p == 0 else [0])
    )
    sizes = dict.fromkeys(everything, 3)
    own = routes.parts(rows[:20], True)
    for row, found in zip(rows, own, strict=False):
        more = routes.fill(row, found, sizes, 11)
        assert more[: len(found)] == found and len(set(more)) == len(more)
        assert 11 <= 3 * len(more) < 11 + 3 or more == found
        assert sorted(routes.fill(row, found, sizes, 10**6)) == everything


@pytest.mark.parametrize(("module", "label", "least"), [(quality, "quality", 0.97), (toxicity, "toxic", 0.95)])
def test_classifiers_on_the_held_out_fold(spark, awkward, empty, module, label, least):
    documents, labels = (spark.read.parquet(f"{MEDIUM}/{n}.parquet") for n in ("documents", "labels"))
    model = module.fit(documents, labels)
    scored = module.score(documents, model)
    assert scored.where("held_out <> (crc32(cast(doc_id as string)) % 5 = 0) or score < 0 or score > 1").isEmpty()
    joined = scored.where("held_out").join(labels, "doc_id")
    assert joined.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] >= least
    assert module.score(awkward, model).where("score is not null").count() == awkward.count()
    assert module.with_score(awkward, model, "s").columns == [*awkward.columns, "s"]
    none = module.fit(empty, spark.createDataFrame([], labels.schema))
    assert module.score(awkward, none).count() == awkward.count() and module.score(empty, none).count() == 0


def test_toxicity_locates_sentences():
    model = toxicity.Model(["idiot"], np.array([12.0]), -6.0)
    text = "A fine day. You idiot! All good."
    value, spans = model.score(text, model.known())
    assert value > 0.9 and [text[a:b].strip() for a, b, _ in spans] == ["You idiot"]
    assert model.score("", model.known()) == (0.0, [])


def test_long_clean_text_is_not_toxic(spark):
    documents, labels = (spark.read.parquet(f"{MEDIUM}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.fit(documents, labels)
    known = model.known()
    for count in (5_000, 50_000):
        assert model.score("A fine day. " * count, known)[0] < 0.05
    joined = documents.join(labels.where("toxic = 0"), "doc_id").orderBy("doc_id").select("text")
    texts = [t for (t,) in joined.collect() if model.score(t or "", known)[0] < 0.05]
    sentences = [s for t in texts for s in toxicity.SENTENCE.findall(t or "") if s.strip()]
    for count in (5_000, 50_000):
        assert model.score(".".join(sentences[:count]), known)[0] < 0.05
    toxic = documents.join(labels.where("toxic = 1"), "doc_id").orderBy("doc_id").select("text").collect()
    worst = max((t for (t,) in toxic), key=lambda t: model.score(t, known)[0])
    assert model.score(".".join(sentences[:50_000]) + "." + worst, known)[0] >= toxicity.THRESHOLD


def test_joined_clean_documents_are_judged_by_their_worst(spark):
    """Ten whole clean documents in one are toxic about as often as one of them is."""
    documents, labels = (spark.read.parquet(f"{MEDIUM}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.fit(documents, labels)
    known = model.known()
    clean = [t or "" for (t,) in documents.join(labels.where("toxic = 0"), "doc_id").orderBy("doc_id").select("text").collect()]
    called = [model.score(t, known)[0] >= toxicity.THRESHOLD for t in clean]
    tens = range(0, len(clean) - 9, 10)
    joined = sum(model.score(". ".join(clean[i : i + 10]), known)[0] >= toxicity.THRESHOLD for i in tens)
    single = sum(any(called[i : i + 10]) for i in tens)
    assert joined - single <= 0.03 * len(tens)


def test_noisy_or_training_against_numeric_gradients(monkeypatch):
    """One Adam step from the start moves each weight by the sign of the loss's numeric gradient."""
    rnd = random.Random(12)
    rows = [(int(i % 3 == 0), rnd.randint(0, 3), [[rnd.randrange(5) for _ in range(2)] for _ in range(rnd.randint(0, 3))]) for i in range(40)]

    def loss(weight, bias):
        total = 0.0
        for label, plain, bags in rows:
            base = np.logaddexp(0, bias)
            odds = [bias + weight[sorted(b)].sum() for b in bags]
            clean = (base if plain or bags else 0.0) + sum(np.logaddexp(0, z) - base for z in odds if z >= bias)
            total += -np.log(max(-np.expm1(-clean), 1e-9)) if label else clean
        return total / len(rows) + toxicity.SHRINK * (weight**2).sum() / 2

    monkeypatch.setattr(toxicity, "STEPS", 1)
    monkeypatch.setattr(toxicity, "gate", lambda bias, closed=1.0: bias)
    weight, bias = toxicity.train(rows, 5)
    start, step = np.zeros(5), 1e-5
    for i in range(5):
        up = loss(start + step * np.eye(5)[i], -5.0) - loss(start, -5.0)
        assert np.sign(weight[i]) == -np.sign(up)
    assert np.sign(bias + 5.0) == -np.sign(loss(start, -5.0 + step) - loss(start, -5.0 - step))
    monkeypatch.setattr(toxicity, "STEPS", 300)
    assert loss(*toxicity.train(rows, 5)) < loss(start, -5.0)


def test_extraction(spark):
    def page(body):
        return f"<html><head><title>t</title></head><body><nav>menu</nav>{body}<form>f</form><div class='comments'><p>c</p></div></body></html>"

    shared = "<p>Our &amp; template line</p>"
    rows = [
        (1, "http://h.example/a/1", page(f"{shared}<p>First  own\ntext</p><p>Second <b>bold</b></p>")),
        (2, "http://h.example/a/2", page(f"{shared}<p>Another page's text</p>")),
        (3, "http://h.example/b", page("<div>out</div><article><h1>T</h1><p>In<br>side<p>More</article><aside>x</aside>")),
        (4, None, None), (5, "http://alone.example/", ""), (6, "", "plain < text<script>var x='<p>'</script>"),
        (6, "", "plain < text<script>var x='<p>'</script>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = rows_of(extraction.extract(df.repartition(3)))
    texts = {1: "First own text\n\nSecond bold", 2: "Another page's text", 3: "T\n\nIn side\n\nMore", 4: "", 5: "", 6: "plain < text"}
    assert got == sorted(((i, u, texts[i], len(texts[i])) for i, u, _ in rows), key=repr)
    assert extraction.extract(df.limit(0)).count() == 0
    assert extraction.shared_lines(list("abcbd"), list("xbcd")) == {1, 2, 4}


def test_page_names_and_long_templates():
    body = "<p>one</p><h2 id='side-effects'>two</h2><section id='related-work'>three</section><p data-id='menu'>four</p>"
    body += "<div class='entry-header'>five</div><div class='comment-list comments'>gone</div><p class='site-footer'>gone</p>"
    for markup in (body, f"<article>{body.replace('site-footer', 'footer')}</article>"):
        assert extraction.main_lines(extraction.blocks(markup), None) == ["one", "two", "three", "four", "five"]
    page = lambda text: [("a long template line " * 20, False, False), (text, False, False)]
    a, b, c = page("short a"), page("short b"), page("short c")
    assert extraction.main_lines(a, b, c) == ["short a"]
    assert extraction.main_lines(a, a, b) == ["short a"]  # a copy beside another page
    assert extraction.main_lines(a, a, a) == extraction.main_lines(a, a) == [x[0] for x in a]


def test_difference_decides_on_marked_pages():
    def page(n):
        words = [f"own words {n} {i}" for i in range(2 * n)]
        lines = [f"title {n}", "By our staff", *words[:n], "a quoted passage", *words[n:], "Read on"]
        return extraction.blocks("<article>" + "".join(f"<p>{x}</p>" for x in lines) + "</article>")

    left = [b[0] for b in page(3) if b[0] not in ("By our staff", "Read on")]
    assert extraction.main_lines(page(3), page(4), page(5)) == left and "a quoted passage" in left
    assert extraction.main_lines(page(3), page(3), page(3)) == [b[0] for b in page(3)]
    assert extraction.main_lines(page(3), page(4)) == [b[0] for b in page(3)]
    card = lambda n: extraction.blocks(f"<article>see also {n}</article><p>The site</p><div>{'real text ' * 9}{n}</div>")
    assert extraction.main_lines(card(1), card(2)) == ["see also 1", "real text " * 9 + "1"]


@pytest.mark.parametrize("parts, size", [(1, 8 << 20), (2, 8 << 20), (7, 8 << 20), (1, 10)])
def test_second_neighbours_across_tasks(spark, monkeypatch, parts, size):
    """Also where texts leave a task in batches of few characters."""
    monkeypatch.setattr(extraction, "ARROW_BYTES", size)
    template = "<p>" + "a long template line " * 20 + "</p>"
    rows = [(i, f"http://h.example/{i}", f"{template}<p>short {i}</p>") for i in range(7)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = extraction.extract(df.repartition(parts)).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == 7 and all(texts[i] == f"short {i}" for i in range(1, 6))  # 0 and 6 have one neighbour only


def test_language(spark, small):
    documents, pages = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "pages"))
    model = language.fit(documents)
    found = language.identify(pages, model)
    told = F.regexp_extract("url", r"://[^/]+/([a-z]{2})/", 1)
    assert found.agg(F.avg((F.col("lang") == told).cast("int"))).first()[0] >= 0.98
    odd = spark.createDataFrame([(1, None, None), (1, None, None), (None, "x", "")], "page_id long, url string, html string")
    assert language.identify(odd, model).where("lang is not null and score > 0").count() == 3
    assert language.identify(pages.limit(0), model).count() == 0
    assert language.identify(odd, language.fit(documents.limit(0))).where("lang is null").count() == 3


def test_language_fusion_against_plain_sums(spark, small):
    """The fused chances from group sums in plain Python; one host holds a third of the pages."""
    documents = spark.read.parquet(f"{small}/documents.parquet")
    model = language.fit(documents)
    texts = [r.text for r in documents.orderBy("doc_id").select("text").limit(40).collect()]
    rows = []
    for i, t in enumerate(texts):
        host = "hot.example.fr" if i % 3 == 0 else f"h{i % 5}.site{i % 2}.de"
        lang = f" lang='{('en', 'fr', 'xx')[i % 3]}'" if i % 4 else ""
        rows.append((i, f"http://{host}/{i}" if i % 10 else None, f"<html{lang}><p>{t or ''}</p><script>no</script></html>", "clash"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in language.identify(pages.repartition(3), model).collect()}
    size, parts = len(model.languages), {}
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    for i, url, markup, _ in rows:
        logs = model.log_likelihood(language.page_text(markup))
        host = re.match("http://([^/]*)", url)[1] if url else ""
        mark = re.search("lang='(..)'", markup)
        keys = {"h": host, "d": ".".join(host.split(".")[-2:]), "m": mark and mark[1], "s": host.rpartition(".")[2]}
        parts[i] = (logs, soft(logs), {k: v for k, v in keys.items() if v})
    base = (sum(p for _, p, _ in parts.values()) + 1.0) / (len(parts) + size)
    for i, (logs, own, keys) in parts.items():
        def others(kind):
            same = [p for j, (_, p, k) in parts.items() if j != i and kind in keys and k.get(kind) == keys[kind]]
            return sum(same) if same else np.zeros(size)
        domain = (others("d") + 5 * base) / (others("d").sum() + 5)
        host = (others("h") + 5 * domain) / (others("h").sum() + 5)
        marks = [(others(k) + base) / (others(k).sum() + 1) / base for k in "ms"]
        want = soft(logs + np.log(host) + np.log(marks[0]) + np.log(marks[1]))
        assert got[i].score == pytest.approx(want.max(), abs=1e-6)
        assert got[i].lang == model.languages[int(want.argmax())]
    assert language.identify(pages.limit(0), model).count() == 0


def test_components(spark):
    rnd = random.Random(4)
    links = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    want = _roots(461, links)
    got = components(spark.createDataFrame(links, "a long, b long").repartition(7))
    assert {r.node: r.root for r in got.collect()} == {i: r for i, r in enumerate(want) if i != r}


def test_broken_and_long_pages_take_time_in_proportion():
    began = time.monotonic()
    for piece in ("<a ", '<a "', "<!", "<![CDATA[", "<a<a \"'", "<!--", "<script", "<style>", "<a '\">", '<p x="'):
        for end in ("", '">'):
            markup = piece * (1_000_000 // len(piece)) + end
            extraction.blocks(markup)
            language.page_text(markup)
    rnd = random.Random(8)
    lines, others = ([str(rnd.randrange(50_000)) for _ in range(100_000)] for _ in range(2))
    assert extraction.shared_lines(lines, others)
    assert time.monotonic() - began < 60


def test_alignment_by_halves_is_a_longest_one(monkeypatch):
    rnd = random.Random(9)

    def longest(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    def is_part(some, whole):
        rest = iter(whole)
        return all(x in rest for x in some)

    for bits in (1 << 28, 8):
        monkeypatch.setattr(extraction, "ROW_BITS", bits)
        for _ in range(200):
            a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(0, 25))] for _ in range(2))
            found = extraction.shared_lines(a, b)
            assert len(found) == longest(a, b) and is_part([a[i] for i in sorted(found)], b)


def test_pages_against_a_second_parser():
    """Blocks of well-formed pages as the standard library's parser sees them."""
    from html.parser import HTMLParser

    class Texts(HTMLParser):
        def __init__(self):
            super().__init__()
            self.found, self.piece, self.raw = [], "", 0

        def flush(self):
            text = " ".join(self.piece.split())
            self.found += [text] if text else []
            self.piece = ""

        def handle_starttag(self, tag, attrs):
            self.raw += tag in ("script", "style")
            if tag not in extraction.INLINE:
                self.flush()

        def handle_endtag(self, tag):
            self.raw -= tag in ("script", "style")
            if tag not in extraction.INLINE:
                self.flush()

        def handle_data(self, data):
            self.piece += "" if self.raw else data

    rnd = random.Random(10)
    words = ["one", "two &amp; three", "a < b", "é&#8217;s", "  wide\n\tspace "]

    def element(depth):
        if not depth or rnd.random() < 0.3:
            return rnd.choice(words)
        tag = rnd.choice(["p", "div", "b", "a href='x>y'", 'span class="q"', "section", "script"])
        inner = "var x = 1;" if tag == "script" else "".join(element(depth - 1) for _ in range(rnd.randint(0, 3)))
        return f"<{tag}>{inner}</{tag.split()[0]}><!-- <p>no</p> -->"

    for _ in range(300):
        page = "<html><body>" + "".join(f"<div>{element(3)}</div>" for _ in range(4)) + "</body></html>"
        page = re.sub(r"<p>(?=.*<p>)", "<div>", page).replace("</p>", "</div>") if page.count("<p>") else page
        page = page.replace("<p>", "<div>")
        parser = Texts()
        parser.feed(page)
        parser.flush()
        assert [b[0] for b in extraction.blocks(page)] == parser.found
