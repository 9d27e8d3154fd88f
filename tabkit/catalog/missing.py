"""D1-D7, K7, L3, L4."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.catalog.registry import Tables, query
from tabkit.operators.categories import MISSING, CategoryStats, FrequencyIndexer, ModeImputer, TargetMeanEncoder, encode
from tabkit.operators.joins import lookup_join
from tabkit.operators.missing import fill_numeric, fill_string, null_out, numeric_with_sentinel, replace_values
from tabkit.runtime import Limits, materialize


@query("""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'missing' ELSE c_mktsegment END AS segment,
       coalesce(nullif(c_nationkey, 4), 0) AS nation, coalesce(nullif(c_nationkey, 5), -9999) AS nation_sentinel,
       nullif(nullif(c_name, 'Customer#000000007'), 'Customer#000000008') AS name
FROM customer
""")
def replace_and_fill(t: Tables) -> DataFrame:
    customer = t("customer").select(
        "c_custkey",
        F.col("c_mktsegment").alias("segment"),
        F.nullif("c_nationkey", F.lit(4)).alias("nation"),
        F.nullif("c_nationkey", F.lit(5)).alias("nation_sentinel"),
        F.col("c_name").alias("name"),
    )
    out = replace_values(customer, ["segment"], {"BUILDING": "B", "MACHINERY": None})
    out = fill_numeric(fill_numeric(out, 0, ["nation"]), -9999, ["nation_sentinel"])
    out = fill_string(out, "missing", ["segment"])
    return null_out(out, ["Customer#000000007", "Customer#000000008"])


@query("""
WITH d AS (SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN 'NA' WHEN p_size % 10 = 1 THEN p_name ELSE CAST(p_size AS VARCHAR) END AS size FROM part)
SELECT p_partkey, CASE WHEN size = 'NA' THEN -9999.0 ELSE TRY_CAST(size AS DOUBLE) END AS size FROM d
""")
def sentinel_numeric(t: Tables) -> DataFrame:
    last = F.col("p_size") % 10
    part = t("part").select(
        "p_partkey",
        F.when(last == 0, "NA")
        .when(last == 1, F.col("p_name"))
        .otherwise(F.col("p_size").cast("string"))
        .alias("size"),
    )
    return numeric_with_sentinel(part, ["size"])


@query("""
WITH d AS (SELECT o_orderkey, o_orderdate, nullif(o_orderpriority, '5-LOW') AS priority,
                  strftime(o_orderdate, '%Y-%m') AS month FROM orders),
     train AS (SELECT coalesce(priority, 'missing') AS priority, month FROM d WHERE o_orderdate < TIMESTAMP '1998-01-01'),
     mp AS (SELECT priority FROM train GROUP BY 1 ORDER BY count(*) DESC, priority LIMIT 1),
     mm AS (SELECT month FROM train GROUP BY 1 ORDER BY count(*) DESC, month LIMIT 1)
SELECT o_orderkey,
       CASE WHEN priority IS NULL OR priority NOT IN (SELECT priority FROM train) THEN (SELECT priority FROM mp) ELSE priority END AS priority,
       CASE WHEN month IN (SELECT month FROM train) THEN month ELSE (SELECT month FROM mm) END AS month
FROM d
""")
def mode_impute_unseen(t: Tables) -> DataFrame:
    orders = t("orders").select(
        "o_orderkey",
        "o_orderdate",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )
    early = orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    imputer = ModeImputer(["priority", "month"]).fit(early)
    return imputer.replace_unseen(imputer.transform(orders)).drop("o_orderdate")


def _orders_with_customers(t: Tables) -> DataFrame:
    customer = t("customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("string").alias("nation"), "c_mktsegment"
    )
    orders = t("orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return lookup_join(orders, customer, "o_custkey")


@query("""
WITH d AS (SELECT o_orderkey, o_orderdate, o_totalprice, CAST(c_nationkey AS VARCHAR) AS nation,
                  coalesce(nullif(c_mktsegment, 'FURNITURE'), 'missing') AS segment,
                  strftime(o_orderdate, '%Y-%m') AS month
           FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
     train AS (SELECT * FROM d WHERE o_orderdate < TIMESTAMP '1998-01-01'),
     p AS (SELECT avg(o_totalprice) AS prior FROM train),
     n AS (SELECT nation AS v, 1 / (1 + exp(count(o_totalprice) - 1)) AS w, avg(o_totalprice) AS m FROM train GROUP BY 1),
     s AS (SELECT segment AS v, 1 / (1 + exp(count(o_totalprice) - 1)) AS w, avg(o_totalprice) AS m FROM train GROUP BY 1),
     o AS (SELECT month AS v, 1 / (1 + exp(count(o_totalprice) - 1)) AS w, avg(o_totalprice) AS m FROM train GROUP BY 1)
SELECT o_orderkey,
       round(coalesce(n.w * prior + (1 - n.w) * n.m, prior), 4) AS nation_target,
       round(coalesce(s.w * prior + (1 - s.w) * s.m, prior), 4) AS segment_target,
       round(coalesce(o.w * prior + (1 - o.w) * o.m, prior), 4) AS month_target
FROM d, p LEFT JOIN n ON n.v = nation LEFT JOIN s ON s.v = segment LEFT JOIN o ON o.v = month
""")
def target_mean_encode(t: Tables) -> DataFrame:
    cols = ["nation", "segment", "month"]
    orders = materialize(
        _orders_with_customers(t).select(
            "o_orderkey",
            "o_orderdate",
            "o_totalprice",
            "nation",
            F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("segment"),
            "month",
        ),
        "orders-customers",
    )
    early = orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    encoded = TargetMeanEncoder(cols, "o_totalprice").fit(early).transform(orders)
    return encoded.select("o_orderkey", *[F.round(f"{c}_target", 4).alias(f"{c}_target") for c in cols])


@query("""
WITH n AS (SELECT p_name AS v, row_number() OVER (ORDER BY count(*) DESC, p_name) - 1 AS i FROM part GROUP BY 1),
     b AS (SELECT p_brand AS v, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS i FROM part GROUP BY 1)
SELECT p_partkey, CAST(n.i AS DOUBLE) AS p_name_index, CAST(b.i AS DOUBLE) AS p_brand_index
FROM part JOIN n ON n.v = p_name JOIN b ON b.v = p_brand
""")
def index_categories(t: Tables) -> DataFrame:
    part = t("part").select("p_partkey", "p_name", "p_brand")
    return FrequencyIndexer(["p_name", "p_brand"]).fit(part).transform(part).drop("p_name", "p_brand")


@query("""
WITH d AS (SELECT o_orderkey, nullif(o_orderpriority, '3-MEDIUM') AS priority, strftime(o_orderdate, '%Y-%m') AS month,
                  o_orderdate < TIMESTAMP '1998-01-01' AS early FROM orders),
     p AS (SELECT priority AS v, row_number() OVER (ORDER BY count(*) DESC, priority) - 1 AS i
           FROM d WHERE early AND priority IS NOT NULL GROUP BY 1),
     m AS (SELECT month AS v, row_number() OVER (ORDER BY count(*) DESC, month) - 1 AS i FROM d WHERE early GROUP BY 1)
SELECT o_orderkey, CAST(coalesce(p.i, (SELECT count(*) FROM p)) AS DOUBLE) AS priority_index,
       CAST(coalesce(m.i, (SELECT count(*) FROM m)) AS DOUBLE) AS month_index
FROM d LEFT JOIN p ON p.v = priority LEFT JOIN m ON m.v = month
""")
def index_keep_unseen(t: Tables) -> DataFrame:
    orders = t("orders").select(
        "o_orderkey",
        "o_orderdate",
        F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("priority"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )
    early = orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    indexer = FrequencyIndexer(["priority", "month"], invalid="keep").fit(early)
    return indexer.transform(orders).select("o_orderkey", "priority_index", "month_index")


@query("""
WITH d AS (SELECT o_orderkey, o_totalprice, nullif(o_custkey % 50, 7) AS grp, o_orderdate < TIMESTAMP '1997-01-01' AS early FROM orders),
     p AS (SELECT avg(o_totalprice) AS prior FROM d WHERE early),
     g AS (SELECT grp, 1 / (1 + exp(count(o_totalprice) - 1)) AS w, avg(o_totalprice) AS m FROM d WHERE early GROUP BY 1)
SELECT o_orderkey, CAST(d.grp AS BIGINT) AS grp, round(coalesce(w * prior + (1 - w) * m, prior), 4) AS grp_target
FROM d CROSS JOIN p LEFT JOIN g ON d.grp IS NOT DISTINCT FROM g.grp
""")
def target_mean_int(t: Tables) -> DataFrame:
    orders = t("orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice", F.nullif(F.col("o_custkey") % 50, F.lit(7)).cast("long").alias("grp")
    )
    early = orders.filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    encoded = TargetMeanEncoder(["grp"], "o_totalprice").fit(early).transform(orders)
    return encoded.select("o_orderkey", "grp", F.round("grp_target", 4).alias("grp_target"))


@query("""
WITH d AS (SELECT o_orderkey, CAST(o_custkey % 30 AS INTEGER) AS grp, o_custkey % 30 < 20 AS seen FROM orders),
     m AS (SELECT grp FROM d WHERE seen GROUP BY 1 ORDER BY count(*) DESC, CAST(grp AS VARCHAR) LIMIT 1)
SELECT o_orderkey, CASE WHEN d.seen THEN d.grp ELSE m.grp END AS grp, 'int' AS kind FROM d, m
""")
def mode_unseen_int(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey", (F.col("o_custkey") % 30).cast("int").alias("grp"))
    imputer = ModeImputer(["grp"]).fit(orders.filter("grp < 20"))
    out = imputer.replace_unseen(imputer.transform(orders))
    return out.withColumn("kind", F.lit(dict(out.dtypes)["grp"]))


@query("""
WITH d AS (SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_partkey AS VARCHAR) AS part, nullif(l_returnflag, 'R') AS flag FROM lineitem),
     p AS (SELECT avg(l_quantity) AS prior FROM d),
     n AS (SELECT part AS v, row_number() OVER (ORDER BY count(*) DESC, part) - 1 AS i,
                  1 / (1 + exp(count(l_quantity) - 1)) AS w, avg(l_quantity) AS m FROM d GROUP BY 1),
     f AS (SELECT coalesce(flag, 'missing') AS v, row_number() OVER (ORDER BY count(*) DESC, coalesce(flag, 'missing')) - 1 AS i,
                  1 / (1 + exp(count(l_quantity) - 1)) AS w, avg(l_quantity) AS m FROM d GROUP BY 1)
SELECT l_orderkey, l_linenumber, CAST(n.i AS DOUBLE) AS part_index, CAST(coalesce(CASE WHEN flag IS NOT NULL THEN f.i END, (SELECT count(*) FROM f)) AS DOUBLE) AS flag_index,
       round(n.w * prior + (1 - n.w) * n.m, 4) AS part_target, round(f.w * prior + (1 - f.w) * f.m, 4) AS flag_target
FROM d CROSS JOIN p JOIN n ON n.v = part JOIN f ON f.v = coalesce(flag, 'missing')
""")
def encode_shuffled(t: Tables) -> DataFrame:
    """No vocabulary may be broadcast: every lookup shuffles, hot values are spread."""
    cols = ["part", "flag"]
    lines = t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.col("l_partkey").cast("string").alias("part"),
        F.nullif("l_returnflag", F.lit("R")).alias("flag"),
    )
    stats = CategoryStats.fit(lines, cols, "l_quantity", limits=Limits(rows=0), missing=MISSING)
    coded = encode(
        lines,
        FrequencyIndexer(cols, invalid="keep").from_stats(stats),
        TargetMeanEncoder(cols, "l_quantity").from_stats(stats),
    )
    targets = [F.round(f"{c}_target", 4).alias(f"{c}_target") for c in cols]
    return coded.select("l_orderkey", "l_linenumber", "part_index", "flag_index", *targets)
