"""Manifest, mix and trie against plain Python, on awkward rows and the small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import manifest, mixing, queries, trie
from tidemark.llm.prefix import prefix_sums

WORDS = "alpha beta gamma delta epsilon zeta eta theta".split()
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark):
    """NULLs everywhere, empty and long texts, repeated ids and rows, names that the results use too."""
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["a", "b", "é", "Z", "", None]), rnd.choice(["en", None]), rnd.choice([None, 7]), None) for i in range(60)]
    texts = [None, "", " \n\t", "One", "two  words", "É Ñ 漢字 🙂 A\x0bB", "Ab cd " * 9000]
    rows = [(*r[:4], texts[i] if i < len(texts) else " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 30))).title(), 1, 2, 3) for i, r in enumerate(rows)]
    rows += [(7, "a", "en", 1, "same row", 1, 2, 3)] * 5 + [(7, "a", "en", 1, "other row", 1, 2, 3)]
    rows += [(None, "a", None, None, "no id", 1, 2, 3)] * 3 + [(None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, source string, lang string, n_chars long, text string, size int, place int, target int"
    )


@pytest.fixture(scope="module")
def documents_dir(documents, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("documents"))
    documents.write.parquet(f"{root}/documents.parquet")
    return root


def order(value):
    return (value is not None, value if value is not None else 0)


# ---- prefix sums


def test_prefix_sums_of_hot_and_null_keys(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["hot", "hot", "hot", None, "c", f"k{rnd.randrange(9)}"]), i, rnd.choice([None, 1, 5])) for i in range(700)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    found = prefix_sums(df, ["k"], ["o"], {"n": F.lit(1), "total": F.col("v")}, rows_per_split=40).collect()
    want, n, total = set(), Counter(), Counter()
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        n[k] += 1
        total[k] += v or 0
        want.add((k, o, v, n[k], total[k]))
    assert {tuple(r) for r in found} == want
    assert prefix_sums(df.limit(0), [], ["o"], {"n": F.lit(1)}).count() == 0


# ---- manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    out = ""
    for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def plain_steps(levels, place):
    out = []
    for nodes in levels[:-1]:
        first = place - place % 16
        out.append((place % 16, [n for i, n in enumerate(nodes[first : first + 16]) if i != place % 16]))
        place //= 16
    return out


def plain_manifest(rows):
    sources = defaultdict(list)
    for r in rows:
        sources[r["source"]].append((order(r["doc_id"]), leaf_of(r), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        sources[s].sort(key=lambda x: x[:2])
        trees[s] = plain_tree([x[1] for x in sources[s]])
    top = plain_tree([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for i, (_, leaf, r) in enumerate(sources[s]):
            steps = plain_steps(trees[s], i) + plain_steps(top, at)
            claimed = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                claimed["text"] = re.sub("[A-Z]", lambda m: m[0].lower(), r["text"])
            node = leaf_of(claimed)
            for place, others in steps:
                node = sha("".join([*others[:place], node, *others[place:]]))
            proof = sha("".join("".join(o) for _, o in steps))
            out.append((r["doc_id"], leaf, trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def found_manifest(df):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest(spark, documents, documents_dir, monkeypatch, levels):
    """With one level a superblock holds 16 nodes, so sources and their list go through several rounds."""
    monkeypatch.setattr(manifest, "LEVELS", levels)
    got = found_manifest(queries.merkle_manifest(spark, documents_dir))
    assert got == plain_manifest([r.asDict() for r in documents.collect()])


def test_manifest_of_many_sources_and_of_none(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", 1)
    rows = [(i, f"s{i % 300}" if i < 700 else "s9", "en", i, f"Text {i}") for i in range(1100)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert found_manifest(queries.merkle_manifest(spark, str(tmp_path))) == plain_manifest([r.asDict() for r in df.collect()])
    df.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert queries.merkle_manifest(spark, str(tmp_path / "none")).count() == 0


def test_proofs_fold_to_the_root(documents):
    leaf = manifest.leaf_digest(F.col("doc_id"), F.col("text"))
    for r in manifest.manifest(documents, "doc_id", "source", leaf, proofs=True).collect():
        assert r.verified and manifest.folded(bytes.fromhex(r.leaf), bytes(r.proof)).hex() == r.root
        assert manifest.folded(bytes(32), bytes(r.proof)).hex() != r.root


# ---- mix


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """The shares by the words of the contract: share out, stop at the limit, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), share * sum(sizes.values())
    while left > 1e-9:
        free = [s for s in names if target[s] < most * sizes[s] - 1e-9]
        if not free:
            break
        unit, over = left / sum(weight[s] for s in free), 0.0
        for s in free:
            wanted = target[s] + weight[s] * unit
            target[s] = min(wanted, most * sizes[s])
            over += wanted - target[s]
        left = over
    return target


def check_mix(rows, documents):
    size = lambda r: len(SPLIT.findall(r["text"] or ""))
    sizes = Counter()
    for r in documents:
        sizes[r["source"]] += size(r)
    targets = plain_targets(sizes)
    taken = Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == int(targets[s] + 1e-6) for s in sizes)
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((r["doc_id"], size(r)) for r in documents)


def test_mix_meets_each_budget(spark, documents):
    plain = [r.asDict() for r in documents.collect()]
    got = [r.asDict() for r in mixing.mix(documents, range_rows=4).collect()]
    check_mix(got, plain)
    again = [r.asDict() for r in mixing.mix(documents.repartition(7), range_rows=9).collect()]
    digest = lambda rows: sorted((repr(r["doc_id"]), repr(r["source"]), r["size"], r["taken"]) for r in rows)
    assert digest(got) == digest(again)
    other = [r.asDict() for r in mixing.mix(documents, seed=1).collect()]
    check_mix(other, plain)
    assert digest(other) != digest(got)
    assert mixing.mix(documents.limit(0)).count() == 0
    for r in mixing.mix(documents, share=5).collect():
        assert r.taken == 2 * r.size
    with pytest.raises(ValueError):
        mixing.mix(documents, weights=(1, 0))


def test_mix_on_a_given_table(spark):
    root = "/root/testdata/sf0.01"
    docs = [r.asDict() for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    source = {r["doc_id"]: r["source"] for r in docs}
    rows = [r.asDict() | {"source": source[r["doc_id"]]} for r in queries.mixed_sources(spark, root).collect()]
    check_mix(rows, docs)


def test_mixed_texts_hold_what_is_taken(documents):
    mixed = mixing.mix(documents, carry=("text",)).cache()
    taken, texts = Counter(), defaultdict(set)
    for r in mixed.collect():
        taken[(r.doc_id, r.source)] += r.taken
        texts[(r.doc_id, r.source)].add(r.document.text)
    found = Counter()
    for r in mixing.mixed_texts(mixed).collect():
        assert len(SPLIT.findall(r.text)) == r.words
        assert any(SPLIT.findall(t or "")[: r.words] == SPLIT.findall(r.text) for t in texts[(r.doc_id, r.source)])
        found[(r.doc_id, r.source)] += r.words
    assert found == +taken
    mixed.unpersist()


# ---- trie


def plain_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[c].append((order(turn), digest, (role, text)))
    own = {c: [x[2] for x in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + mine[h:]
    members = defaultdict(list)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        worth = (len(cs) - 1) * len(SPLIT.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += worth
    out = []
    for p, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(rebuilt[c]) == len(p))))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p], sha(ends)))
    return sorted(out, key=repr)


def found_trie(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SCHEMA = "conv_id long, turn int, role string, text string"


@pytest.mark.parametrize("last, chunk", [(16_384, 4096), (8, 3)])
def test_trie_on_awkward_conversations(spark, monkeypatch, last, chunk):
    """Small bounds send conversations, siblings, tour and ends through every chunk and round."""
    monkeypatch.setattr(trie, "CHUNK", chunk)
    monkeypatch.setattr("tidemark.llm.prefix.CHUNK", chunk)
    monkeypatch.setattr(trie, "LISTED", chunk)
    rnd = random.Random(4)
    rows = [(None, 1, "user", "nobody"), (0, None, "user", "first"), (0, None, "user", "first"), (1, 0, None, None), (1, 0, "", "")]
    rows += [(c, t, rnd.choice(["user", "assistant"]), rnd.choice(["Hi", "Go  on\n", "", "long " * 3000])) for c in range(90) for t in range(rnd.randint(0, 5))]
    rows += [(c, t, "user", f"same {t}") for c in range(200, 260) for t in range(4)]  # copies
    rows += [(300, t, "user", f"turn {t}") for t in range(40)] + [(301, 0, "user", "x")] * 9 + [(317, 1, "user", "short")]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("clash")).withColumn("node", F.lit(None).cast("int"))
    assert found_trie(trie.conversation_trie(df.repartition(5), last)) == plain_trie(rows)
    assert trie.conversation_trie(df.limit(0), last).count() == 0


def test_trie_on_a_given_table(spark):
    root = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{root}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found_trie(queries.conversation_trie(spark, root)) == plain_trie(rows)


def test_list_ranking(spark):
    rnd = random.Random(6)
    arcs = rnd.sample(range(10**6), 500)
    links = spark.createDataFrame(list(zip(arcs, [*arcs[1:], None], strict=True)), "arc long, next long")
    assert {(r.arc, r.at) for r in trie.ranked(links.repartition(4), last=10).collect()} == {(a, i) for i, a in enumerate(arcs)}
