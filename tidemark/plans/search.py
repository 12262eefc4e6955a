"""Vector, text and hybrid search, chunking and embedding."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import search, text
from tidemark.plans.catalog import query
from tidemark.operators.textindex import write_index
from tidemark.session import cut_lineage, fresh_path, spread_table, table

K = 10


def mean_vectors(spark, root, *by):
    """Mean embedding of the table, or of each group, as query vectors."""
    cells = table(spark, root, "embeddings").select(
        *by, F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "x")
    )
    means = cells.groupBy(*by, "i").agg(F.avg("x").alias("x"))
    pairs = F.array_sort(F.collect_list(F.struct("i", "x")))
    key = F.col(by[0]).cast("long") if by else F.lit(0).cast("long")
    return (
        means.groupBy(*by)
        .agg(pairs.alias("p"))
        .select(key.alias("query_id"), F.transform("p", lambda p: p["x"]).alias("vector"))
    )


VECTORS = "v AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings)"
MEAN = f"""
{VECTORS},
m AS (SELECT list(x ORDER BY i) AS q FROM (
  SELECT i, avg(e[i]) AS x FROM v, range(1, 65) r(i) GROUP BY i))"""
MEANS = f"""
{VECTORS},
m AS (SELECT label AS query_id, list(x ORDER BY i) AS q FROM (
  SELECT label, i, avg(e[i]) AS x FROM v, range(1, 65) r(i) GROUP BY label, i) GROUP BY label)"""

#: Cells that the approximate search reads.
PROBED = 3

DISTANCE = {
    "cosine": "1 - list_cosine_similarity(e, q)",
    "L1": "list_sum(list_transform(range(1, 65), lambda i: abs(e[i] - q[i])))",
    "L2": "list_distance(e, q)",
    "inner_product": "-list_dot_product(e, q)",
}


def top_sql(metric: str) -> str:
    return f"""(SELECT '{metric}' AS metric, vec_id AS id, round({DISTANCE[metric]}, 6) AS distance
      FROM v, m ORDER BY {DISTANCE[metric]}, vec_id LIMIT {K})"""


@query("vector_topk", f"WITH {MEAN} " + " UNION ALL ".join(top_sql(m) for m in search.METRICS))
def vector_topk(spark, root):
    vectors = table(spark, root, "embeddings")
    queries = cut_lineage(mean_vectors(spark, root))
    parts = [
        search.vector_topk(vectors, "vec_id", "embedding", queries, K, m).select(
            F.lit(m).alias("metric"), "id", F.round("distance", 6).alias("distance")
        )
        for m in search.METRICS
    ]
    return reduce(lambda a, b: a.unionAll(b), parts)


@query(
    "cosine_search",
    f"""
WITH {MEAN} SELECT vec_id AS id, round(list_cosine_similarity(e, q), 6) AS similarity
FROM v, m ORDER BY list_cosine_similarity(e, q) DESC, vec_id LIMIT {K}
""",
)
def cosine_search(spark, root):
    vectors = table(spark, root, "embeddings")
    found = search.cosine_search(vectors, "vec_id", "embedding", mean_vectors(spark, root), K)
    return found.select("id", F.round("similarity", 6).alias("similarity"))


@query(
    "vector_topk_batch",
    f"""
WITH {MEANS},
d AS (SELECT query_id, vec_id, label, 1 - list_cosine_similarity(e, q) AS distance FROM v, m),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
SELECT query_id::BIGINT AS query_id, rank::INTEGER AS rank, vec_id AS id, 'label ' || label AS text,
       round(distance, 6) AS distance FROM r WHERE rank <= {K}
""",
)
def vector_topk_batch(spark, root):
    vectors = table(spark, root, "embeddings").withColumn(
        "text", F.concat(F.lit("label "), F.col("label"))
    )
    queries = mean_vectors(spark, root, "label")
    found = search.vector_topk_batch(vectors, "vec_id", "embedding", "text", queries, K)
    return found.select("query_id", "rank", "id", "text", F.round("distance", 6).alias("distance"))


@query(
    "ivf_topk",
    f"""
WITH {MEANS},
p AS (SELECT list(x ORDER BY i) AS point FROM (SELECT i, avg(e[i]) AS x FROM v, range(1, 65) r(i) GROUP BY i)),
c AS (SELECT vec_id, any_value(e) AS e, arg_min(query_id, list_distance(e, q)) AS cell FROM v, m GROUP BY vec_id),
near AS (SELECT query_id AS cell FROM m, p ORDER BY list_distance(q, point), query_id LIMIT {PROBED})
SELECT vec_id AS id, round(list_distance(e, point), 6) AS distance FROM c JOIN near USING (cell), p
ORDER BY list_distance(e, point), vec_id LIMIT {K}
""",
)
def ivf_topk(spark, root):
    """Cells around the labels' means, stored; the nearest ones are read."""
    vectors = table(spark, root, "embeddings")
    means = mean_vectors(spark, root, "label").orderBy("query_id").collect()  # one for each label
    centres = np.array([r["vector"] for r in means])
    cells = search.write_ivf(vectors, "embedding", centres, fresh_path(spark, "ivf"))
    point = mean_vectors(spark, root).first()["vector"]
    found = search.ivf_topk(cells, centres, "vec_id", "embedding", point, K, PROBED)
    return found.select("id", F.round("distance", 6).alias("distance"))


@query(
    "hit_features",
    f"""
WITH {MEAN} SELECT vec_id AS id, round(list_distance(e, q), 6) AS distance, label, d.lang, d.source
FROM v JOIN documents d ON d.doc_id = v.vec_id, m ORDER BY list_distance(e, q), vec_id LIMIT {K}
""",
)
def hit_features(spark, root):
    """Hits of a vector search with features of their rows."""
    documents = table(spark, root, "documents").select(F.col("doc_id").alias("vec_id"), "lang", "source")
    rows = table(spark, root, "embeddings").join(documents, "vec_id")
    found = search.vector_topk(rows, "vec_id", "embedding", mean_vectors(spark, root), K)
    hits = search.hit_features(found, rows, "vec_id", ["label", "lang", "source"])
    return hits.select("id", F.round("distance", 6).alias("distance"), "label", "lang", "source")


@query(
    "vector_score",
    f"""
WITH {MEAN}
(SELECT 'cosine' AS metric, vec_id AS id, round(1 + list_cosine_similarity(e, q), 6) AS score
 FROM v, m ORDER BY list_cosine_similarity(e, q) DESC, vec_id LIMIT {K})
UNION ALL
(SELECT 'inner_product', vec_id, round(list_dot_product(e, q), 6)
 FROM v, m ORDER BY list_dot_product(e, q) DESC, vec_id LIMIT {K})
UNION ALL
(SELECT 'L2', vec_id, round(1 / (1 + list_distance(e, q)), 6)
 FROM v, m ORDER BY list_distance(e, q), vec_id LIMIT {K})
""",
)
def vector_score(spark, root):
    vectors = table(spark, root, "embeddings")
    queries = cut_lineage(mean_vectors(spark, root))
    parts = [
        search.vector_score(vectors, "vec_id", "embedding", queries, K, m).select(
            F.lit(m).alias("metric"), "id", F.round("score", 6).alias("score")
        )
        for m in ("cosine", "inner_product", "L2")
    ]
    return reduce(lambda a, b: a.unionAll(b), parts)


@query(
    "validate_vector_len",
    """
SELECT vec_id, (CASE WHEN label % 2 = 1 THEN 60 + label END)::INTEGER AS found, 64 AS declared
FROM embeddings WHERE label % 2 = 1 AND 60 + label < 64
""",
)
def validate_vector_len(spark, root):
    odd = F.slice("embedding", 1, F.col("label") + 60)
    vectors = table(spark, root, "embeddings").withColumn(
        "embedding", F.when(F.col("label") % 2 == 1, odd).otherwise(F.col("embedding"))
    )
    return search.validate_vector_len(vectors, "vec_id", "embedding", 64)


@query(
    "combine_embeddings",
    f"""
WITH {VECTORS}, h AS (SELECT vec_id, e, e[1:48] AS f FROM v)
SELECT vec_id,
  round(list_sum(list_transform(range(1, 65),
    lambda i: i * (0.3 * e[i] + 0.7 * coalesce(f[i], 0)))), 6) AS weighted,
  round(list_sum(list_transform(range(1, 65),
    lambda i: i * (e[i] + coalesce(f[i], 0)) / 2)), 6) AS average,
  len(e || f) AS joined
FROM h
""",
)
def combine_embeddings(spark, root):
    vectors = table(spark, root, "embeddings")
    first, second = F.col("embedding"), F.slice("embedding", 1, 48)

    def moment(vector):
        """Sum of the entries weighted by their position, which tells their order apart."""
        placed = F.transform(vector, lambda x, i: x * (i + 1))
        return F.round(F.aggregate(placed, F.lit(0.0), lambda a, x: a + x), 6)

    weighted = search.combine_embeddings(first, second, "weighted_sum", 0.3, 0.7)
    average = search.combine_embeddings(first, second, "average")
    joined = search.combine_embeddings(first, second, "concatenate")
    return vectors.select(
        "vec_id",
        moment(weighted).alias("weighted"),
        moment(average).alias("average"),
        F.size(joined).cast("long").alias("joined"),
    )


@query(
    "text_search_contains",
    """
SELECT doc_id, lang, source FROM documents
WHERE contains(text, 'tion the') OR contains(source, 'tion the') ORDER BY doc_id LIMIT 20
""",
)
def text_search_contains(spark, root):
    documents = table(spark, root, "documents")
    found = search.text_search_contains(documents, "doc_id", ["text", "source"], "tion the", 20)
    return found.select("doc_id", "lang", "source")


TOKENS = r"""
t AS (SELECT doc_id, list_filter(string_split_regex(lower(text || chr(10) || source),
             '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
c AS (SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: x = 'the')) AS a,
             len(list_filter(w, lambda x: x = 'and')) AS b FROM t)"""


@query(
    "text_search_rank",
    f"""
WITH {TOKENS} SELECT doc_id, (a + b)::INTEGER AS text_rank FROM c WHERE a > 0 AND b > 0
ORDER BY text_rank DESC, doc_id LIMIT {K}
""",
)
def text_search_rank(spark, root):
    documents = spread_table(spark, root, "documents")
    return search.text_search_rank(documents, "doc_id", ["text", "source"], "the and", K)


@query(
    "bm25_search",
    f"""
WITH {TOKENS},
s AS (SELECT count(*) AS n, avg(n) AS mean, count(*) FILTER (a > 0) AS da,
             count(*) FILTER (b > 0) AS db FROM c),
i AS (SELECT mean, CASE WHEN ln((n - da + 0.5) / (da + 0.5)) > 0
                   THEN ln((n - da + 0.5) / (da + 0.5)) ELSE 1e-6 END AS ia,
             CASE WHEN ln((n - db + 0.5) / (db + 0.5)) > 0
                   THEN ln((n - db + 0.5) / (db + 0.5)) ELSE 1e-6 END AS ib FROM s),
r AS (SELECT doc_id, ia * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * n / mean))
                   + ib * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * n / mean)) AS score
      FROM c, i WHERE a > 0 AND b > 0)
SELECT doc_id, round(score, 9) AS score FROM r ORDER BY r.score DESC, doc_id LIMIT {K}
""",
)
def bm25_search(spark, root):
    documents = spread_table(spark, root, "documents")
    found = search.bm25_search(documents, "doc_id", ["text", "source"], "the and", K)
    return found.withColumn("score", F.round("score", 9))


@query(
    "hybrid_search",
    f"""
WITH {MEAN}, {TOKENS}
SELECT vec_id AS id, round(list_distance(e, q), 6) AS distance
FROM v JOIN c ON c.doc_id = v.vec_id, m WHERE a > 0 AND b > 0
ORDER BY list_distance(e, q), vec_id LIMIT {K}
""",
)
def hybrid_search(spark, root):
    documents = spread_table(spark, root, "documents").withColumnRenamed("doc_id", "vec_id")
    rows = table(spark, root, "embeddings").join(documents, "vec_id")
    queries = mean_vectors(spark, root)
    found = search.hybrid_search(
        rows, "vec_id", "embedding", ["text", "source"], "the and", queries, K
    )
    return found.select("id", F.round("distance", 6).alias("distance"))


ASKED = ("the and", "Is the of", "oferwhin, of", "the nosuchword", "the the in")
PHRASES = ("the the the", "of the of", "The And", "is the is", "no such phrase")
WORDS_SQL = r"""
t AS (SELECT doc_id, list_filter(string_split_regex(lower(text || chr(10) || source), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
asked AS (SELECT i - 1 AS query_id, string_split(q[i], ' ') AS terms FROM (SELECT ["the and", "is the of", "oferwhin of",
  "the nosuchword", "the in"] AS q), range(1, 6) r(i))""".replace('"', "'")


def asked(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")


def text_index(spark, root):
    documents = spread_table(spark, root, "documents")
    return write_index(documents, "doc_id", ["text", "source"], fresh_path(spark, "text-index"))


@query(
    "bm25_index",
    f"""
WITH {WORDS_SQL},
s AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM t),
p AS (SELECT doc_id, len(w) AS n, term, len(list_filter(w, lambda x: x = term)) AS tf
      FROM t, (SELECT DISTINCT unnest(terms) AS term FROM asked) WHERE list_contains(w, term)),
d AS (SELECT term, count(*) AS df FROM p GROUP BY term),
i AS (SELECT term, CASE WHEN ln((n - df + 0.5) / (df + 0.5)) > 0 THEN ln((n - df + 0.5) / (df + 0.5)) ELSE 1e-6 END AS idf FROM d, s),
r AS (SELECT query_id, doc_id, sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * p.n / mean))) AS score
      FROM asked a JOIN p ON list_contains(a.terms, p.term) JOIN i ON i.term = p.term, s
      GROUP BY query_id, doc_id, len(a.terms) HAVING count(*) = len(a.terms))
SELECT query_id::BIGINT AS query_id, doc_id AS id, round(score, 9) AS score FROM r
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= {K}
""",
)
def bm25_index(spark, root):
    """Five queries at once from the stored index; one has a word that no row holds."""
    found = text_index(spark, root).bm25(asked(spark, ASKED), K)
    return found.select("query_id", "id", F.round("score", 9).alias("score"))


PHRASE_HITS = r"""
tt AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
ph AS (SELECT i - 1 AS query_id, string_split(q[i], ' ') AS p FROM (SELECT ['the the the', 'of the of', 'the and', 'is the is',
  'no such phrase'] AS q), range(1, 6) r(i)),
hits AS (SELECT query_id::BIGINT AS query_id, doc_id AS id,
    len(list_filter(range(1, len(w) + 1), lambda i: w[i:i + len(p) - 1] = p)) AS times FROM tt, ph WHERE times > 0)"""


@query("phrase_search", f"WITH {PHRASE_HITS} SELECT query_id, id, times::INTEGER AS times FROM hits")
def phrase_search(spark, root):
    """Phrases with repeated words, every hit of each."""
    return text_index(spark, root).phrases(asked(spark, PHRASES))


@query(
    "phrase_vector_score",
    f"""
WITH {MEAN}, {PHRASE_HITS},
d AS (SELECT query_id, vec_id AS id, 1 + list_cosine_similarity(e, q) AS cosine, 1 / (1 + list_distance(e, q)) AS l2
      FROM hits JOIN v ON v.vec_id = hits.id, m)
(SELECT 'cosine' AS metric, query_id, id, round(cosine, 6) AS score FROM d
 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, id) <= {K})
UNION ALL
(SELECT 'L2', query_id, id, round(l2, 6) FROM d QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY l2 DESC, id) <= {K})
""",
)
def phrase_vector_score(spark, root):
    """Rows that hold a phrase, by the score of their vectors."""
    vectors = table(spark, root, "embeddings")
    hits = cut_lineage(text_index(spark, root).phrases(asked(spark, PHRASES)))
    mean = cut_lineage(mean_vectors(spark, root)).select("vector").scalar()
    queries = asked(spark, PHRASES).select("query_id", mean.alias("vector"))
    parts = [
        search.phrase_vector_score(vectors, "vec_id", "embedding", hits, queries, K, m).select(
            F.lit(m).alias("metric"), "query_id", "id", F.round("score", 6).alias("score")
        )
        for m in ("cosine", "L2")
    ]
    return parts[0].unionAll(parts[1])


@query(
    "ivf_topk_batch",
    f"""
WITH {MEANS},
c AS (SELECT vec_id, any_value(e) AS e, arg_min(query_id, list_distance(e, q)) AS cell FROM v, m GROUP BY vec_id),
asked AS (SELECT vec_id AS query_id, e AS point FROM v WHERE vec_id % 20 = 0),
near AS (SELECT a.query_id, point, m.query_id AS cell FROM asked a, m
         QUALIFY row_number() OVER (PARTITION BY a.query_id ORDER BY list_distance(q, point), m.query_id) <= {PROBED}),
r AS (SELECT query_id, vec_id, list_distance(e, point) AS d FROM near JOIN c USING (cell))
SELECT query_id, vec_id AS id, round(d, 6) AS distance FROM r
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) <= {K}
""",
)
def ivf_topk_batch(spark, root):
    """Every twentieth vector as a query, in one scan of the probed cells."""
    vectors = table(spark, root, "embeddings")
    means = mean_vectors(spark, root, "label").orderBy("query_id").collect()  # one for each label
    centres = np.array([r["vector"] for r in means])
    cells = search.write_ivf(vectors, "embedding", centres, fresh_path(spark, "ivf"))
    queries = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    found = search.ivf_topk_batch(cells, centres, "vec_id", "embedding", queries, K, PROBED)
    return found.select("query_id", "id", F.round("distance", 6).alias("distance"))


@query("ivf_recall", "SELECT 128 AS cells, 10 AS probes, TRUE AS finds_half_or_more, TRUE AS all_cells_find_all")
def ivf_recall(spark, root):
    """Default cells and probes: recall of every twentieth vector's ten nearest against the full scan.

    The given vectors hardly cluster, so a probe finds few more than its share of the cells.
    """
    vectors = table(spark, root, "embeddings")
    queries = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    centres = search.fit_centres(vectors, "embedding", 128)
    cells = search.write_ivf(vectors, "embedding", centres, fresh_path(spark, "ivf"))
    exact = cut_lineage(search.vector_topk(vectors, "vec_id", "embedding", queries, K).select("query_id", "id"))
    wanted = exact.count()

    def recall(probes):
        found = search.ivf_topk_batch(cells, centres, "vec_id", "embedding", queries, K, probes)
        return found.join(exact, ["query_id", "id"], "left_semi").count() / wanted

    row = [(128, 10, recall(10) >= 0.5, recall(128) == 1.0)]
    return spark.createDataFrame(row, "cells int, probes int, finds_half_or_more boolean, all_cells_find_all boolean")


def last_break(mark: str, width: int) -> str:
    """Offset of the last ``mark`` in ``piece``, or -1."""
    return (
        f"CASE WHEN strpos(reverse(piece), {mark}) > 0 "
        f"THEN length(piece) - strpos(reverse(piece), {mark}) - {width - 1} ELSE -1 END"
    )


@query(
    "chunk_text",
    f"""
WITH RECURSIVE cut AS (
  SELECT doc_id, -1 AS start_char, 0 AS next_start, 0 AS end_char, length(text) AS n FROM documents
  UNION ALL
  SELECT doc_id, next_start, greatest(stop - 200, next_start + 1), stop, n FROM (
    SELECT doc_id, next_start, n, CASE WHEN next_start + 1000 >= n THEN n
      WHEN p1 > 500 THEN next_start + p1 + 2 WHEN p2 > 500 THEN next_start + p2 + 2
      WHEN p3 > 500 THEN next_start + p3 + 1 WHEN p4 > 500 THEN next_start + p4 + 1
      ELSE next_start + 1000 END AS stop
    FROM (SELECT doc_id, next_start, n, {last_break("' .'", 2)} AS p1,
                 {last_break("chr(10) || chr(10)", 2)} AS p2, {last_break("chr(10)", 1)} AS p3,
                 {last_break("' '", 1)} AS p4
          FROM (SELECT c.doc_id, c.next_start, c.n, substr(d.text, c.next_start + 1, 1000) AS piece
                FROM cut c JOIN documents d ON d.doc_id = c.doc_id WHERE c.end_char < c.n)))),
spans AS (SELECT doc_id, start_char, end_char FROM cut WHERE start_char >= 0)
SELECT row_number() OVER (ORDER BY s.doc_id, s.start_char) - 1 AS chunk_id, s.doc_id, d.source,
       regexp_replace(regexp_replace(substr(d.text, s.start_char + 1, s.end_char - s.start_char),
         '^\\s+', ''), '\\s+$', '') AS text,
       s.start_char::INTEGER AS start_char, s.end_char::INTEGER AS end_char
FROM spans s JOIN documents d ON d.doc_id = s.doc_id
""",
)
def chunk_text(spark, root):
    documents = spread_table(spark, root, "documents")
    return text.chunk_text(documents, "doc_id", "text", 1000, 200, keep=["source"])


@query(
    "embed_text",
    r"""
WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> ''))
             AS word FROM documents),
n AS (SELECT doc_id, ('0x' || substr(sha256(word), 1, 8))::BIGINT % 384 AS place, count(*)::DOUBLE AS n FROM w GROUP BY ALL)
SELECT doc_id, place, (n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)))::FLOAT::DOUBLE AS value FROM n
""",
)
def embed_text(spark, root):
    """Every entry other than zero of each document's vector."""
    documents = spread_table(spark, root, "documents").select("doc_id", "text")
    entries = text.embed_text(documents, "text", "vector").select("doc_id", F.posexplode("vector").alias("place", "value"))
    return entries.where("value <> 0").select(
        "doc_id", F.col("place").cast("long").alias("place"), F.col("value").cast("double").alias("value")
    )
