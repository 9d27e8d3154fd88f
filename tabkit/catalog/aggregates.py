"""F1-F13, H1, H2."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.catalog.registry import Tables, query
from tabkit.operators import aggregate, shape
from tabkit.operators.categories import CategoryStats
from tabkit.operators.order import top_k
from tabkit.runtime import materialize

MONEY = "decimal(18,2)"


@dataclass
class OrderTotal:
    status: str
    priority: str
    total: float


@query("""
SELECT o_orderstatus AS status, o_orderpriority AS priority,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1, 2
""")
def group_sum_composite(t: Tables) -> DataFrame:
    orders = t("orders").select(
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast(MONEY).alias("price"),
    )
    totals = aggregate.group_sum(orders, ["status", "priority"], "price", "total")
    return shape.conform(totals.withColumn("total", F.col("total").cast("double")), OrderTotal)


@query("""
WITH d AS (SELECT o_orderpriority, nullif(o_orderstatus, 'P') AS status,
                  CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)
SELECT o_orderpriority, count(status) AS n_status, count(price) AS n_orders,
       CAST(sum(price) AS DOUBLE) / count(price) AS mean_price,
       (SELECT CAST(sum(price) AS DOUBLE) / count(price) FROM d) AS overall_mean
FROM d GROUP BY 1
""")
def group_count_mean(t: Tables) -> DataFrame:
    orders = t("orders").select(
        "o_orderpriority",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.col("o_totalprice").cast(MONEY).alias("price"),
    )
    groups = materialize(
        orders.groupBy("o_orderpriority").agg(
            F.count("status").alias("n_status"), F.count("price").alias("n_orders"), F.sum("price").alias("total")
        ),
        "group-sums",
    )
    overall = groups.agg(F.sum("total").cast("double") / F.sum("n_orders")).first()[0]
    return groups.select(
        "o_orderpriority",
        "n_status",
        "n_orders",
        (F.col("total").cast("double") / F.col("n_orders")).alias("mean_price"),
        F.lit(overall).alias("overall_mean"),
    )


@query("""
SELECT c_mktsegment, count(c_acctbal) AS "count", round(avg(c_acctbal), 2) AS mean
FROM customer GROUP BY 1
""")
def count_and_mean(t: Tables) -> DataFrame:
    out = aggregate.count_and_mean(t("customer"), "c_mktsegment", "c_acctbal")
    return out.withColumn("mean", F.round("mean", 2))


@query("SELECT p_brand, CAST(sum(p_size) // count(p_size) AS BIGINT) AS mean FROM part GROUP BY 1")
def int_mean_by_key(t: Tables) -> DataFrame:
    return aggregate.int_mean_by_key(t("part"), "p_brand", "p_size")


@query("""
WITH r AS (SELECT c_nationkey, c_custkey,
                  (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 50 AS chunk
           FROM customer)
SELECT CAST(c_nationkey AS BIGINT) AS nation, CAST(chunk AS BIGINT) AS chunk,
       string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS customers
FROM r GROUP BY 1, 2
""")
def collect_by_key(t: Tables) -> DataFrame:
    groups = aggregate.collect_by_key(t("customer"), "c_nationkey", "c_custkey", chunk_rows=50)
    return groups.select(
        F.col("c_nationkey").cast("long").alias("nation"),
        "chunk",
        F.array_join(F.col("values").cast("array<string>"), ",").alias("customers"),
    )


@query("""
WITH r AS (SELECT s_nationkey, s_name,
                  (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name) - 1) // 10000 AS chunk
           FROM supplier)
SELECT CAST(s_nationkey AS BIGINT) AS nation, CAST(chunk AS BIGINT) AS chunk,
       string_agg(s_name, ',' ORDER BY s_name) AS suppliers
FROM r GROUP BY 1, 2
""")
def collect_small_groups(t: Tables) -> DataFrame:
    groups = aggregate.collect_by_key(t("supplier"), "s_nationkey", "s_name", 10_000)
    return groups.select(
        F.col("s_nationkey").cast("long").alias("nation"), "chunk", F.array_join("values", ",").alias("suppliers")
    )


@query("""
WITH k AS (SELECT p_retailprice AS v FROM part UNION ALL SELECT s_acctbal FROM supplier)
SELECT 'min' AS measure, min(v) AS v FROM k UNION ALL SELECT 'max', max(v) FROM k
UNION ALL SELECT 'first', min(v) FROM k UNION ALL SELECT 'last', max(v) FROM k
""")
def min_max(t: Tables) -> DataFrame:
    values = shape.union_all(
        t("part").select(F.col("p_retailprice").alias("v")), t("supplier").select(F.col("s_acctbal").alias("v"))
    )
    both = aggregate.min_max(values, "v").unpivot([], ["min", "max"], "measure", "v")
    first = top_k(values, ["v"], 1).select(F.lit("first").alias("measure"), "v")
    last = top_k(values, [("v", "desc")], 1).select(F.lit("last").alias("measure"), "v")
    return shape.union_all(both, first, last)


@query("""
SELECT o_orderpriority AS o_orderpriority_o_orderstatus,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
       count(*) FILTER (WHERE o_orderstatus = 'O') AS "O",
       count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
FROM orders GROUP BY 1 ORDER BY 1
""")
def crosstab_segment(t: Tables) -> DataFrame:
    return aggregate.crosstab(t("orders"), "o_orderpriority", "o_orderstatus")


@query("""
SELECT coalesce(CAST(nullif(l_suppkey, 3) AS VARCHAR), 'null') AS l_suppkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
       count(*) AS n FROM lineitem GROUP BY 1, 2
""")
def crosstab_wide(t: Tables) -> DataFrame:
    lines = t("lineitem").select(F.nullif("l_suppkey", F.lit(3)).alias("l_suppkey"), "l_partkey")
    return aggregate.pair_counts(lines, "l_suppkey", "l_partkey")


@query("""
SELECT coalesce(CAST(nullif(p_size, 7) AS VARCHAR), 'null') AS p_size_kind,
       count(*) FILTER (WHERE p_brand = 'Brand#1') AS first_brand,
       count(*) FILTER (WHERE p_brand <> 'Brand#1') AS "null"
FROM part GROUP BY 1
""")
def crosstab_with_nulls(t: Tables) -> DataFrame:
    part = t("part").select(
        F.nullif("p_size", F.lit(7)).alias("p_size"),
        F.when(F.col("p_brand") == "Brand#1", "first_brand").alias("kind"),
    )
    return aggregate.crosstab(part, "p_size", "kind", numeric_order=True)


@query("""
WITH d AS (SELECT nullif(o_orderstatus, 'P') AS status, o_orderpriority AS priority, o_custkey FROM orders)
SELECT 'status' AS "column", count(*) AS "rows", count(*) - count(status) AS nulls, count(DISTINCT status) AS distincts FROM d
UNION ALL SELECT 'priority', count(*), count(*) - count(priority), count(DISTINCT priority) FROM d
UNION ALL SELECT 'o_custkey', count(*), count(*) - count(o_custkey), count(DISTINCT o_custkey) FROM d
""")
def profile_columns(t: Tables) -> DataFrame:
    orders = t("orders").select(
        F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.col("o_orderpriority").alias("priority"), "o_custkey"
    )
    return aggregate.profile(orders, ["status", "priority", "o_custkey"])


@query("SELECT DISTINCT l_shipdate::DATE::VARCHAR AS shipped FROM lineitem")
def distinct_values(t: Tables) -> DataFrame:
    lines = t("lineitem").select(F.col("l_shipdate").cast("date").cast("string").alias("shipped"))
    return aggregate.distinct_values(lines, "shipped")


@query("""
WITH c AS (
  SELECT 'p_name' AS "column", p_name AS mode, count(*) AS n FROM part GROUP BY 1, 2
  UNION ALL SELECT 'p_brand', p_brand, count(*) FROM part GROUP BY 1, 2
  UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY 1, 2)
SELECT "column", mode, n FROM c
QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, mode) = 1
""")
def mode_per_column(t: Tables) -> DataFrame:
    return CategoryStats.fit(t("part"), ["p_name", "p_brand", "p_type"]).mode_table()


@query("""
SELECT l_shipmode, "count" FROM (
  SELECT l_returnflag || l_linestatus AS l_shipmode, count(*) AS "count" FROM lineitem GROUP BY 1)
ORDER BY "count" DESC, l_shipmode LIMIT 1
""")
def mode_of_expression(t: Tables) -> DataFrame:
    flags = t("lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("l_shipmode"))
    return aggregate.mode_of(flags, "l_shipmode")


@query(r"""
WITH w AS (SELECT unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word FROM documents),
v AS (SELECT 'word' AS "column", word AS value FROM w WHERE word <> ''
      UNION ALL SELECT 'l_partkey', CAST(l_partkey AS VARCHAR) FROM lineitem
      UNION ALL SELECT 'l_suppkey l_linenumber', l_suppkey || ' ' || l_linenumber FROM lineitem),
c AS (SELECT "column", value, count(*) AS "count" FROM v GROUP BY 1, 2)
SELECT "column", value, "count" FROM c
QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY "count" DESC,
                           try_cast(split_part(value, ' ', 1) AS BIGINT), try_cast(split_part(value, ' ', 2) AS BIGINT),
                           value) <= CASE "column" WHEN 'word' THEN 20 ELSE 5 END
""")
def mode_by_sketch(t: Tables) -> DataFrame:
    words = t("documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("v"))
    lines = t("lineitem")

    def named(column: str, found: DataFrame, *parts: str) -> DataFrame:
        return found.select(F.lit(column).alias("column"), F.concat_ws(" ", *parts).alias("value"), "count")

    parts = aggregate.most_frequent(lines, ["l_partkey"], 5)
    pairs = aggregate.most_frequent(lines, ["l_suppkey", "l_linenumber"], 5)
    return shape.union_all(
        named("word", aggregate.most_frequent(words, ["v"], 20), "v"),
        named("l_partkey", parts, "l_partkey"),
        named("l_suppkey l_linenumber", pairs, "l_suppkey", "l_linenumber"),
    )


@query("""
WITH w AS (SELECT unnest(CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' THEN []
                              ELSE string_split(rtrim(text, ' '), ' ') END) AS word FROM documents)
SELECT word, count(*) AS "count" FROM w GROUP BY 1
""")
def word_counts(t: Tables) -> DataFrame:
    return aggregate.word_counts(t("documents"), "text")


@query("""
SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer
UNION ALL SELECT s_nationkey, s_acctbal FROM supplier
""")
def union_all(t: Tables) -> DataFrame:
    return shape.union_all(
        t("customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")),
        t("supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")),
    )


@query("""
SELECT nullif(c_nationkey, 3) AS nation FROM customer
EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey < 2
""")
def except_values(t: Tables) -> DataFrame:
    return shape.subtract(
        t("customer").select(F.nullif("c_nationkey", F.lit(3)).alias("nation")),
        t("nation").filter("n_regionkey < 2").select(F.col("n_nationkey").alias("nation")),
    )


@query("""
SELECT o_custkey AS customer, o_orderstatus AS status FROM orders
EXCEPT SELECT c_custkey, 'F' FROM customer
""")
def except_rows(t: Tables) -> DataFrame:
    return shape.subtract(
        t("orders").select(F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status")),
        t("customer").select(F.col("c_custkey").alias("customer"), F.lit("F").alias("status")),
    )
