"""L1, L2, L5-L16, C15p, E2."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.catalog.registry import Tables, query
from tabkit.functions.target import TargetTransform
from tabkit.operators import learn, leafwise, levelwise, search
from tabkit.operators.categories import CategoryStats, FrequencyIndexer, TargetMeanEncoder, encode
from tabkit.operators.joins import lookup_join
from tabkit.operators.shape import as_continuous
from tabkit.plans import text_classifier
from tabkit.runtime import materialize, persisted


@query("""
SELECT p_partkey, round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_samp(p_size) FROM part), 6) AS size_z,
       round((p_retailprice - (SELECT avg(p_retailprice) FROM part)) / (SELECT stddev_samp(p_retailprice) FROM part), 6) AS price_z
FROM part
""")
def standardize(t: Tables) -> DataFrame:
    part = learn.assemble(t("part").select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])
    scaled, _ = learn.standardize(part, part, "features")
    z = vector_to_array("scaled")
    return scaled.select("p_partkey", F.round(z[0], 6).alias("size_z"), F.round(z[1], 6).alias("price_z"))


@query("""
WITH b AS (SELECT p_brand AS v, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS i FROM part GROUP BY 1),
     n AS (SELECT count(*) AS size FROM b)
SELECT p_partkey, CAST(size - 1 AS BIGINT) AS width, CAST(CASE WHEN i = size - 1 THEN -1 ELSE i END AS BIGINT) AS hot
FROM part JOIN b ON v = p_brand, n
""")
def one_hot(t: Tables) -> DataFrame:
    part = t("part").select("p_partkey", "p_brand")
    indexed = FrequencyIndexer(["p_brand"]).fit(part).transform(part)
    encoded, _ = learn.one_hot(indexed, indexed, ["p_brand_index"])
    cells = vector_to_array("p_brand_index_onehot")
    return encoded.select(
        "p_partkey",
        F.size(cells).cast("long").alias("width"),
        (F.array_position(cells, 1.0) - 1).alias("hot"),
    )


@query(r"""
WITH w AS (SELECT doc_id, regexp_split_to_array(regexp_replace(lower(text), '\s+$', ''), '\s') AS words FROM documents)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) AS DOUBLE) AS hashed, CAST(10 AS BIGINT) AS width
FROM w
""")
def tokenize_hash(t: Tables) -> DataFrame:
    words = learn.tokenize(t("documents").select("doc_id", "text"), "text")
    cells = vector_to_array("features")
    return learn.hash_tf(words, "words", 10).select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate(cells, F.lit(0.0), lambda a, x: a + x).alias("hashed"),
        F.size(cells).cast("long").alias("width"),
    )


@query()
def text_classify(t: Tables) -> DataFrame:
    labels = t("labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    hashed = text_classifier.features(t("documents").select("doc_id", "text")).select("doc_id", "features")
    return text_classifier.classify_hashed(materialize(hashed, "hashed-texts"), labels, key="doc_id")


@query("""
WITH m AS (SELECT o_orderpriority, avg(o_totalprice) AS prediction FROM orders GROUP BY 1)
SELECT round(sqrt(avg(power(o_totalprice - prediction, 2))), 3) AS rmse
FROM orders JOIN m USING (o_orderpriority)
""")
def rmse(t: Tables) -> DataFrame:
    orders = t("orders")
    means = orders.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("prediction"))
    predicted = lookup_join(orders, materialize(means, "means"), "o_orderpriority")
    value = learn.rmse(predicted, label="o_totalprice")
    return t.spark.createDataFrame([(round(value, 3),)], ["rmse"])


CATEGORIES = ["o_orderstatus", "o_orderpriority", "segment", "nation"]
FEATURES = [
    *[f"{c}_index" for c in CATEGORIES],
    *[f"{c}_target" for c in CATEGORIES],
    "year",
    "month",
    "balance",
]
TARGET = TargetTransform("o_totalprice")


SPLIT = "1998-01-01"


def _orders(t: Tables) -> DataFrame:
    """Orders with their customers, written once."""
    customer = t("customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("string").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )
    orders = lookup_join(t("orders"), customer, "o_custkey").select(
        "o_orderkey",
        "o_totalprice",
        *CATEGORIES,
        "balance",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        (F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")).alias("early"),
    )
    return materialize(orders.na.fill("missing", CATEGORIES).na.fill(-9999.0, ["balance"]), "orders-customers")


def _features(train: DataFrame, *tables: DataFrame) -> list[DataFrame]:
    """One feature vector per order of each table, with category codes learned from ``train``."""
    stats = CategoryStats.fit(train, CATEGORIES, "o_totalprice")
    out = []
    for table in tables:
        coded = encode(
            table,
            FrequencyIndexer(CATEGORIES, invalid="keep").from_stats(stats),
            TargetMeanEncoder(CATEGORIES, "o_totalprice").from_stats(stats),
        )
        coded = as_continuous(coded, [f"{c}_index" for c in CATEGORIES])
        out.append(learn.assemble(coded, FEATURES).select("o_orderkey", TARGET.forward().alias("label"), "features"))
    return out


@query()
def gbt_cv(t: Tables) -> DataFrame:
    """Three depths, five folds, default trees otherwise."""
    orders = _orders(t)
    depths = [3, 4, 5]
    errors = levelwise.cross_validate_depths(_features(orders, orders)[0], depths, folds=5)
    best = errors.index(min(errors))
    return learn.zip_columns(t.spark, ["max_depth", "rmse", "is_best"], [depths, errors, [i == best for i in range(len(depths))]])


@query()
def feature_importance(t: Tables) -> DataFrame:
    """Sixty trees of depth four."""
    orders = _orders(t)
    model = learn.fit_gbt(_features(orders, orders)[0], maxIter=60, maxDepth=4, stepSize=0.1, subsamplingRate=0.85)
    return learn.feature_importance(t.spark, model, FEATURES)


@query()
def score_submission(t: Tables) -> DataFrame:
    """Prices of the orders from 1998 on, by sixty trees of depth four fitted on the earlier ones."""
    orders = _orders(t)
    early = orders.filter("early")
    train, late = _features(early, early, orders.filter("NOT early"))
    model = learn.fit_gbt(train, maxIter=60, maxDepth=4, stepSize=0.1, subsamplingRate=0.85)
    return learn.score(model, late, "o_orderkey", "o_totalprice", TARGET.inverse())


def _closed(t: Tables) -> DataFrame:
    """Orders with the one feature that they are closed, and a fold."""
    closed = (F.col("o_orderstatus") == "F").cast("double").alias("closed")
    orders = t("orders").select(
        "o_orderkey", closed, F.col("o_totalprice").alias("label"), (F.col("o_orderkey") % 3).cast("int").alias("fold")
    )
    return learn.assemble(as_continuous(orders, ["closed"]), ["closed"])


@query("""
SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_orderstatus = 'F'), 2) AS prediction FROM orders
""")
def tree_of_one_split(t: Tables) -> DataFrame:
    """A tree of depth one on a 0/1 feature predicts the mean of each side."""
    rows = _closed(t)
    model = learn.fit_gbt(rows, maxIter=1, maxDepth=1)
    return learn.score(model, rows, "o_orderkey", "prediction", F.round("prediction", 2))


@query("""
SELECT o_orderkey, round(avg(CAST(o_orderpriority < '3' AS INTEGER)) OVER (PARTITION BY o_orderstatus = 'F'), 4) AS rate FROM orders
""")
def logistic_of_one_feature(t: Tables) -> DataFrame:
    """Without a penalty the probability is the rate of each side."""
    urgent = (F.col("o_orderpriority") < "3").cast("double").alias("label")
    orders = t("orders").select("o_orderkey", urgent, (F.col("o_orderstatus") == "F").cast("double").alias("closed"))
    rows = learn.assemble(orders, ["closed"])
    with persisted(rows) as kept:
        model = learn.fit_logistic(kept, iterations=100, reg=0.0)
    return learn.score(model, rows, "o_orderkey", "rate", F.round(vector_to_array("probability")[1], 4))


@query("""
WITH o AS (SELECT o_orderkey % 3 AS fold, o_orderstatus = 'F' AS closed, o_totalprice AS y FROM orders),
     f AS (SELECT unnest(range(3)) AS fold),
     m0 AS (SELECT f.fold, avg(y) AS m FROM f JOIN o ON o.fold <> f.fold GROUP BY 1),
     m1 AS (SELECT f.fold, closed, avg(y) AS m FROM f JOIN o ON o.fold <> f.fold GROUP BY 1, 2),
     r AS (SELECT 0 AS max_depth, fold, sqrt(avg(power(y - m, 2))) AS rmse FROM o JOIN m0 USING (fold) GROUP BY fold
           UNION ALL SELECT 1, fold, sqrt(avg(power(y - m, 2))) FROM o JOIN m1 USING (fold, closed) GROUP BY fold),
     p AS (SELECT max_depth, avg(rmse) AS rmse FROM r GROUP BY 1)
SELECT CAST(max_depth AS BIGINT) AS max_depth, round(rmse, 2) AS rmse, rmse = (SELECT min(rmse) FROM p) AS is_best FROM p
""")
def cv_by_fold(t: Tables) -> DataFrame:
    """The mean error over given folds of a mean and of one split."""
    values = {"maxDepth": [0, 1]}
    model = learn.cross_validate(_closed(t), learn.gbt(maxIter=1), values, folds=3, parallelism=2, fold_col="fold")
    best = learn.best_params(model, ["maxDepth"])["maxDepth"]
    points = [(d, round(float(m), 2), d == best) for d, m in zip(values["maxDepth"], model.avgMetrics, strict=True)]
    return learn.zip_columns(t.spark, ["max_depth", "rmse", "is_best"], [list(c) for c in zip(*points, strict=True)])


@query("""
WITH o AS (SELECT o_orderkey % 3 AS fold, o_orderstatus = 'F' AS closed, o_totalprice AS y FROM orders),
     f AS (SELECT unnest(range(3)) AS fold),
     m0 AS (SELECT f.fold, avg(y) AS m FROM f JOIN o ON o.fold <> f.fold GROUP BY 1),
     m1 AS (SELECT f.fold, closed, avg(y) AS m FROM f JOIN o ON o.fold <> f.fold GROUP BY 1, 2),
     w AS (SELECT unnest([0.25, 1.0]) AS rate),
     r AS (SELECT 1 AS leaves, rate, fold, sqrt(avg(power(y - m, 2))) AS rmse FROM o JOIN m0 USING (fold), w GROUP BY rate, fold
           UNION ALL
           SELECT 2, rate, fold, sqrt(avg(power(y - (1 - rate) * m0.m - rate * m1.m, 2)))
           FROM o JOIN m0 USING (fold) JOIN m1 USING (fold, closed), w GROUP BY rate, fold),
     p AS (SELECT leaves, rate, avg(rmse) AS rmse FROM r GROUP BY ALL)
SELECT CAST(leaves AS BIGINT) AS leaves, CAST(rate AS DOUBLE) AS rate, round(rmse, 2) AS rmse,
       row_number() OVER (ORDER BY round(rmse, 6), leaves, rate) = 1 AS is_best FROM p
""")
def leafwise_cv_by_fold(t: Tables) -> DataFrame:
    """The mean error over given folds of a mean and of one split, the latter in part and in full."""
    values = {"trees": [1], "leaves": [1, 2], "rate": [0.25, 1.0]}
    found = search.cross_validate_leafwise(_closed(t), values, folds=3, fold_col="fold")
    return found.select("leaves", "rate", F.round("rmse", 2).alias("rmse"), "is_best")


@query("""
SELECT 'closed' AS feature, CAST(count(*) > 0 AS INTEGER)::DOUBLE AS importance FROM orders
UNION ALL SELECT 'same', CAST(count(*) < 0 AS INTEGER)::DOUBLE FROM orders
""")
def importance_of_one_feature(t: Tables) -> DataFrame:
    """All importance goes to the one feature that varies."""
    rows = t("orders").select(
        (F.col("o_orderstatus") == "F").cast("double").alias("closed"), F.lit(1.0).alias("same"), F.col("o_totalprice").alias("label")
    )
    model = learn.fit_gbt(learn.assemble(rows, ["closed", "same"]), maxIter=3, maxDepth=2)
    return learn.feature_importance(t.spark, model, ["closed", "same"])


def _side(tree: str) -> str:
    return f"(CASE {tree}.f WHEN 0 THEN status WHEN 1 THEN priority ELSE month END) < {tree}.e"


def _round(k: int) -> str:
    """SQL of one tree of two leaves on the residuals ``g`` of ``r{k}``: its split and the next residuals."""
    return f"""
u{k} AS (SELECT g, unnest([0, 1, 2]) AS f, unnest([status, priority, month]) AS x FROM r{k}),
c{k} AS (SELECT f, x, count(*) AS n, sum(g) AS s FROM u{k} GROUP BY f, x),
k{k} AS (SELECT f, x AS e, sum(n) OVER below AS nl, sum(s) OVER below AS gl, sum(n) OVER every AS nt, sum(s) OVER every AS gt FROM c{k}
         WINDOW below AS (PARTITION BY f ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), every AS (PARTITION BY f)),
t{k} AS (SELECT f, e FROM k{k} WHERE nl > 0 ORDER BY gl * gl / nl + (gt - gl) * (gt - gl) / (nt - nl) DESC, f, e LIMIT 1),
m{k} AS (SELECT {_side(f"t{k}")} AS side, avg(g) AS v FROM r{k}, t{k} GROUP BY 1),
r{k + 1} AS (SELECT r{k}.* REPLACE (g - 0.5 * v AS g) FROM r{k}, t{k}, m{k} WHERE side = ({_side(f"t{k}")}))"""


@query(f"""
WITH r0 AS (
  SELECT o_orderkey, o_totalprice AS y, o_totalprice - avg(o_totalprice) OVER () AS g, CAST(month(o_orderdate) AS DOUBLE) AS month,
         CASE o_orderstatus WHEN 'F' THEN 0.0 WHEN 'O' THEN 1.0 ELSE 2.0 END AS status, CAST(left(o_orderpriority, 1) AS DOUBLE) AS priority
  FROM orders
), {_round(0)}, {_round(1)}, {_round(2)}
SELECT o_orderkey, round(y - g, 2) AS prediction FROM r3
""")
def leafwise_trees(t: Tables) -> DataFrame:
    """Three trees of two leaves on three features, each with half its weight."""
    status = F.when(F.col("o_orderstatus") == "F", 0.0).when(F.col("o_orderstatus") == "O", 1.0).otherwise(2.0)
    rows = t("orders").select(
        "o_orderkey",
        "o_totalprice",
        status.alias("status"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
        F.month("o_orderdate").cast("double").alias("month"),
    )
    names = ["status", "priority", "month"]
    model = leafwise.fit_leafwise(rows, names, "o_totalprice", trees=3, leaves=2, rate=0.5, leaf_rows=1)
    return learn.score(model, rows, "o_orderkey", "prediction", F.round("prediction", 2))


@query()
def leafwise_submission(t: Tables) -> DataFrame:
    """Prices of the orders from 1998 on, by leaf-wise trees fitted on the earlier ones."""
    orders = _orders(t)
    early = orders.filter("early")
    train, late = _features(early, early, orders.filter("NOT early"))
    model = leafwise.fit_leafwise(train, trees=10, leaves=8)
    return learn.score(model, late, "o_orderkey", "o_totalprice", TARGET.inverse())


@query("""
WITH o AS (SELECT o_orderstatus = 'F' AS closed, o_orderpriority < '3' AS urgent, o_totalprice AS y FROM orders),
     a AS (SELECT closed, sum(y) AS s, count(*) AS n FROM o GROUP BY 1),
     b AS (SELECT urgent, sum(y) AS s, count(*) AS n FROM o GROUP BY 1),
     c AS (SELECT closed, urgent, sum(y) AS s, count(*) AS n FROM o GROUP BY 1, 2),
     g AS (SELECT sum(y) * sum(y) / count(*) AS none FROM o),
     e AS (SELECT (SELECT sum(s * s / n) FROM a) - none AS first, (SELECT sum(s * s / n) FROM b) - none AS second,
                  (SELECT sum(s * s / n) FROM c) - none AS pair FROM g)
SELECT 'closed' AS feature, round((CASE WHEN first >= second THEN first ELSE pair - second END) / pair, 6) AS importance FROM e
UNION ALL SELECT 'urgent', round((CASE WHEN first >= second THEN pair - first ELSE second END) / pair, 6) FROM e
""")
def importance_of_two_features(t: Tables) -> DataFrame:
    """A tree of depth two on two 0/1 features: the gain of its first split, and what the splits below add."""
    rows = t("orders").select(
        (F.col("o_orderstatus") == "F").cast("double").alias("closed"),
        (F.col("o_orderpriority") < "3").cast("double").alias("urgent"),
        F.col("o_totalprice").alias("label"),
    )
    model = learn.fit_gbt(learn.assemble(rows, ["closed", "urgent"]), maxIter=1, maxDepth=2)
    return learn.feature_importance(t.spark, model, ["closed", "urgent"]).withColumn("importance", F.round("importance", 6))
