"""A1-A13, B1-B3: tables are written to the scratch folder whole and read back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.catalog.registry import Tables, query
from tabkit.operators.joins import lookup_join
from tabkit.runtime import materialize, scratch_path
from tabkit.sources import from_records, parse_lines, read_csv, read_delimited_text, write_csv, write_text


@dataclass
class Part:
    p_partkey: int
    p_name: str
    p_brand: str
    p_type: str
    p_size: T.IntegerType
    p_retailprice: float


@dataclass
class Tags:
    o_orderpriority: str
    tags: list[str]


def _nulled_part(t: Tables) -> DataFrame:
    return t("part").withColumn("p_brand", F.nullif("p_brand", F.lit("Brand#9")))


@query("SELECT p_partkey, p_name, nullif(p_brand, 'Brand#9') AS p_brand, p_type, p_size, p_retailprice FROM part")
def csv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    write_csv(_nulled_part(t), path, sep=";", null_value="NA")
    return read_csv(t.spark, path, schema=Part, infer=True, sep=";", null_value="NA")


@query("SELECT p_partkey, p_name, nullif(p_brand, 'Brand#9') AS p_brand, p_size, p_retailprice FROM part")
def csv_inferred(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    write_csv(_nulled_part(t).drop("p_type"), path, null_value="unknown", files=4)
    part = read_csv(t.spark, path, infer=True, null_value="unknown")
    return part.withColumn("p_partkey", F.col("p_partkey").cast("long"))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, nullif(c_mktsegment, 'FURNITURE') AS c_mktsegment,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer
""")
def csv_as_strings(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    customer = t("customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("c_mktsegment"), "c_nationkey"
    )
    write_csv(customer, path)
    write_csv(customer, path, mode="overwrite", files=1)
    return read_csv(t.spark, path)


@query("""
SELECT p_partkey, p_brand = 'Brand#1' AS is_nan, CASE WHEN p_brand <> 'Brand#1' THEN p_retailprice END AS price FROM part
""")
def csv_nan_token(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    price = F.when(F.col("p_brand") == "Brand#1", "none").otherwise(F.col("p_retailprice").cast("string"))
    write_csv(t("part").select("p_partkey", price.alias("price")), path)
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("price", T.DoubleType())])
    part = read_csv(t.spark, path, schema=schema, nan_value="none")
    is_nan = F.isnan("price")
    return part.select("p_partkey", is_nan.alias("is_nan"), F.when(~is_nan, F.col("price")).alias("price"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier")
def text_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "text")
    header = "s_suppkey|s_name|s_nationkey"
    lines = t("supplier").select(F.concat_ws("|", "s_suppkey", "s_name", "s_nationkey").alias("value"))
    write_text(lines.unionByName(t.spark.createDataFrame([(header,)], ["value"])), path)
    return read_delimited_text(t.spark, path, "|", {"s_suppkey": 0, "s_nationkey": 2}, header=header)


@query("""
SELECT s_suppkey, s_name, CASE WHEN s_nationkey <> 4 THEN CAST(s_nationkey AS INTEGER) END AS s_nationkey FROM supplier
""")
def parsed_lines(t: Tables) -> DataFrame:
    nation = F.when(F.col("s_nationkey") == 4, "none").otherwise(F.col("s_nationkey").cast("string"))
    lines = t("supplier").select(F.concat_ws(", ", "s_suppkey", "s_name", nation).alias("line"))
    schema = T.StructType(
        [
            T.StructField("s_suppkey", T.LongType()),
            T.StructField("s_name", T.StringType()),
            T.StructField("s_nationkey", T.IntegerType()),
        ]
    )
    return parse_lines(lines, "line", ",", schema)


@query("""
SELECT CAST(c_custkey % 10 AS BIGINT) AS part, count(*) AS n, min(c_custkey) AS lo, max(c_custkey) AS hi
FROM customer GROUP BY 1
""")
def text_by_partition(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "text")
    write_text(t("customer"), path, line="c_custkey", key="c_custkey", partitions=10)
    lines = t.spark.read.text(path).select(F.col("part").cast("long"), F.col("value").cast("long").alias("key"))
    return lines.groupBy("part").agg(
        F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")
    )


@query("""
WITH r(o_orderpriority, tag) AS (VALUES ('1-URGENT', 'rush'), ('1-URGENT', 'air'), ('2-HIGH', 'rush'), ('5-LOW', 'sea'))
SELECT tag, count(*) AS n FROM orders LEFT JOIN r USING (o_orderpriority) GROUP BY 1
""")
def inline_rows(t: Tables) -> DataFrame:
    tags = from_records(
        t.spark,
        [Tags("1-URGENT", ["rush", "air"]), Tags("2-HIGH", ["rush"]), Tags("5-LOW", ["sea"])],
        Tags,
    )
    counts = t("orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    tagged = lookup_join(counts, tags, "o_orderpriority")
    return tagged.select(F.explode_outer("tags").alias("tag"), "n").groupBy("tag").agg(F.sum("n").alias("n"))


@query("""
WITH b AS (SELECT min(p_partkey) AS lo, max(p_partkey) AS hi FROM part),
     k AS (SELECT unnest(range(lo, hi + 1)) AS partkey FROM b),
     n AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT partkey, coalesce(n, 0) AS n_lines FROM k LEFT JOIN n ON l_partkey = partkey
""")
def generated_range(t: Tables) -> DataFrame:
    low, high = t("part").agg(F.min("p_partkey"), F.max("p_partkey")).first()
    keys = t.spark.range(low, high + 1, 1, 16).withColumnRenamed("id", "partkey")
    lines = t("lineitem").groupBy(F.col("l_partkey").alias("partkey")).agg(F.count("*").alias("n"))
    return lookup_join(keys, materialize(lines, "line-counts"), "partkey").select("partkey", F.coalesce("n", F.lit(0)).alias("n_lines"))
