"""E1, E2, G1-G7, I12."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.catalog.registry import Tables, query
from tabkit.operators import joins, order


@query("""
SELECT CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS rank, o_orderkey, o_totalprice
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def top_k_ranked(t: Tables) -> DataFrame:
    return order.top_k(t("orders").select("o_orderkey", "o_totalprice"), [("o_totalprice", "desc")], 10, unique=["o_orderkey"])


@query("""
SELECT l_quantity, l_returnflag, l_orderkey, l_linenumber, rank FROM (
  SELECT *, row_number() OVER (ORDER BY l_quantity DESC, l_returnflag, l_orderkey, l_linenumber) AS rank
  FROM (SELECT l_quantity, l_returnflag, l_orderkey, l_linenumber FROM lineitem)) WHERE rank <= 500
""")
def top_k_ties(t: Tables) -> DataFrame:
    lines = t("lineitem").select("l_quantity", "l_returnflag", "l_orderkey", "l_linenumber")
    return order.top_k(lines, [("l_quantity", "desc")], 500)


@query("""
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS rank FROM orders
""")
def global_rank(t: Tables) -> DataFrame:
    return order.global_rank(t("orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"], unique=["o_orderkey"])


@query("""
SELECT l_returnflag, l_quantity, row_number() OVER (ORDER BY l_returnflag DESC, l_quantity) AS rank FROM lineitem
""")
def global_rank_copies(t: Tables) -> DataFrame:
    return order.global_rank(t("lineitem").select("l_returnflag", "l_quantity"), [("l_returnflag", "desc")])


@query("""
SELECT p_size, p_retailprice, p_partkey,
       row_number() OVER (ORDER BY p_size DESC, p_retailprice DESC, p_partkey) AS place FROM part
""")
def secondary_sort(t: Tables) -> DataFrame:
    part = t("part").select("p_size", "p_retailprice", "p_partkey")
    by = [("p_size", "desc"), ("p_retailprice", "desc")]
    return order.global_rank(part, by, unique=["p_partkey"], rank="place")


@query("""
SELECT p_partkey, p_size, p_retailprice FROM part
ORDER BY p_size DESC, p_retailprice DESC, p_partkey LIMIT 20
""")
def secondary_sort_head(t: Tables) -> DataFrame:
    part = t("part").select("p_partkey", "p_size", "p_retailprice")
    return order.sort_by(part, [("p_size", "desc"), ("p_retailprice", "desc"), "p_partkey"]).limit(20)


@query("""
SELECT s_name, s_nationkey FROM supplier ORDER BY s_nationkey DESC, s_name
""")
def sorted_rows(t: Tables) -> DataFrame:
    return order.sort_by(t("supplier").select("s_name", "s_nationkey"), [("s_nationkey", "desc"), "s_name"])


@query("""
SELECT c_custkey, c_name, n_name FROM customer
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 1) ON c_nationkey = n_nationkey
""")
def lookup_join(t: Tables) -> DataFrame:
    nation = t("nation").filter("n_regionkey <> 1").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return joins.lookup_join(t("customer"), nation, "c_nationkey").select("c_custkey", "c_name", "n_name")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, o_orderpriority, o_totalprice
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
""")
def lookup_join_orders(t: Tables) -> DataFrame:
    orders = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_totalprice")
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return joins.lookup_join(lines, orders, "l_orderkey")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, o_orderpriority, o_totalprice
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
""")
def lookup_join_shuffled(t: Tables) -> DataFrame:
    orders = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_totalprice")
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return joins.lookup_join(lines, orders, "l_orderkey", small=False)


@query("""
WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
                  date_trunc('year', o_orderdate) + INTERVAL 123457 MICROSECOND AS moment FROM orders),
     d AS (SELECT status, moment, count(*) AS n FROM o WHERE status IS NOT NULL GROUP BY 1, 2)
SELECT o_orderkey, status, CAST(moment AS VARCHAR) AS moment, n FROM o LEFT JOIN d USING (status, moment)
""")
def lookup_join_timestamps(t: Tables) -> DataFrame:
    orders = t("orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.expr("make_timestamp_ntz(year(o_orderdate), 1, 1, 0, 0, 0.123457)").alias("moment"),
    )
    counts = orders.filter("status IS NOT NULL").groupBy("status", "moment").agg(F.count("*").alias("n"))
    joined = joins.lookup_join(orders, counts, ["status", "moment"], small=False)
    return joined.select("o_orderkey", "status", F.col("moment").cast("string").alias("moment"), "n")


@query("""
WITH a AS (SELECT c_custkey AS oldest, row_number() OVER (ORDER BY c_custkey) AS position FROM customer),
     b AS (SELECT c_acctbal AS poorest, row_number() OVER (ORDER BY c_acctbal) AS position FROM customer)
SELECT position, oldest, poorest FROM a JOIN b USING (position)
""")
def zip_positions(t: Tables) -> DataFrame:
    customer = t("customer")
    return order.zip_by_position(
        customer.select(F.col("c_custkey").alias("oldest")),
        ["oldest"],
        customer.select(F.col("c_acctbal").alias("poorest")),
        ["poorest"],
    )


@query("SELECT count(*) AS n, count(*) AS n_ids FROM orders")
def generated_ids(t: Tables) -> DataFrame:
    ids = t("orders").select(F.monotonically_increasing_id().alias("id"))
    return ids.agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"))
