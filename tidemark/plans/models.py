"""Splits, training and scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import aggregate, ml
from tidemark.plans.catalog import query
from tidemark.session import cut_lineage, table


@query(
    "stratified_split",
    """
WITH h AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_returnflag,
                  sha256((l_orderkey * 10 + l_linenumber) || ':42') AS x FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY x, id) AS p,
             count(*) OVER (PARTITION BY l_returnflag) AS n FROM h)
SELECT id, l_returnflag, p <= floor(n * 0.2 + 0.5) AS is_test FROM r
""",
)
def stratified_split(spark, root):
    lines = table(spark, root, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "l_returnflag"
    )
    return ml.stratified_split(lines, "id", "l_returnflag")


FEATURES = ["o_totalprice", "n_lines", "quantity", "discount"]


def order_features(spark, root):
    """Orders with line totals; the label is whether discounts take more than 5.25 % of the lines' prices."""
    lines = table(spark, root, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    price = F.col("l_extendedprice").cast("double")
    totals = lines.agg(
        F.count("*").alias("n_lines"),
        F.sum("l_quantity").alias("quantity"),
        F.max("l_discount").alias("discount"),
        (F.sum(price * F.col("l_discount")) > 0.0525 * F.sum(price)).cast("int").alias("label"),
    )
    return table(spark, root, "orders").select("o_orderkey", "o_totalprice").join(totals, "o_orderkey")


@query(
    "train_classifier",
    """
WITH t AS (SELECT o_orderkey, sum(l_extendedprice::DOUBLE * l_discount) > 0.0525::DOUBLE * sum(l_extendedprice::DOUBLE) AS label
           FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1),
r AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY sha256(o_orderkey || ':42'), o_orderkey) AS p,
             count(*) OVER (PARTITION BY label) AS n FROM t),
s AS (SELECT label, p <= floor(n * 0.2 + 0.5) AS is_test FROM r)
SELECT count(*) FILTER (is_test) AS test_rows, count(*) FILTER (is_test AND label) AS test_positives,
       round((count(*) FILTER (NOT is_test AND NOT label))::DOUBLE / count(*) FILTER (NOT is_test AND label), 2) AS weight,
       TRUE AS auc_is_good
FROM s
""",
)
def train_classifier(spark, root):
    """Held-out rows, class weight, and whether the AUC of the full training run is 0.7 or more."""
    rows = cut_lineage(order_features(spark, root))  # the split reads them several times
    split = cut_lineage(ml.stratified_split(rows, "o_orderkey", "label"))
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    model = ml.train_classifier(train, FEATURES, "label")
    scored = cut_lineage(ml.probability(model, test))
    metrics = aggregate.eval_metrics(scored, "label", "probability_1")
    counts = scored.agg(F.count("*").alias("test_rows"), F.count_if(F.col("label") == 1).alias("test_positives"))
    return counts.select(
        "*",
        aggregate.class_weight(train, "label").select("weight").scalar().alias("weight"),
        (metrics.select("roc_auc").scalar() >= 0.7).alias("auc_is_good"),
    )


@query(
    "batch_predict",
    """
WITH x AS (SELECT o_orderkey, coalesce(c_acctbal, 0) AS bal,
  CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 0 END AS seg
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey),
p AS (SELECT o_orderkey, 1 / (1 + exp(-(bal / 4000 + seg * 0.7 - 1.5))) AS p FROM x)
SELECT o_orderkey, round(p, 4) AS probability, (p >= 0.5)::INTEGER AS prediction FROM p
""",
)
def batch_predict(spark, root):
    requests = table(spark, root, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    latest = table(spark, root, "customer")
    logit = F.col("c_acctbal") / 4000 + F.col("c_mktsegment") * 0.7 - 1.5
    scored = ml.batch_predict(
        requests,
        latest,
        ["c_custkey"],
        1 / (1 + F.exp(-logit)),
        ["c_acctbal"],
        {"c_mktsegment": {"AUTOMOBILE": 0, "BUILDING": 1, "MACHINERY": 2}},
    )
    return scored.drop("c_custkey")


@query(
    "ordinal_encode",
    """
SELECT p_partkey, (dense_rank() OVER (ORDER BY p_type) - 1)::DOUBLE AS kind,
       (dense_rank() OVER (ORDER BY p_brand) - 1)::DOUBLE AS brand, p_retailprice AS price FROM part
""",
)
def ordinal_encode(spark, root):
    part = table(spark, root, "part")
    model = ml.ordinal_encode(part, ["p_type", "p_brand"], ["p_retailprice"])
    encoded = model.transform(part).withColumn("v", vector_to_array("features"))
    names = ["kind", "brand", "price"]
    return encoded.select("p_partkey", *[F.col("v")[i].alias(n) for i, n in enumerate(names)])
