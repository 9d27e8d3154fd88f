"""C1p-C16p, I1-I11, K1-K6, K8."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.catalog.registry import Tables, query
from tabkit.functions.dates import date_from_parts, day_gap, years_since
from tabkit.functions.numeric import guarded_ratio
from tabkit.functions.target import TargetTransform
from tabkit.operators import shape
from tabkit.operators.features import (
    clamped_diff,
    cross_feature,
    date_age,
    ratio_feature,
    sum_feature,
    year_age,
)
from tabkit.operators.shape import (
    align_to,
    cast_columns,
    conform,
    format_rows,
    register,
    rename,
    split_columns,
)

AS_OF = datetime.date(2020, 6, 30)


@query("SELECT p_partkey, p_name FROM part WHERE p_brand = 'Brand#7'")
def sql_view(t: Tables) -> DataFrame:
    register(t("part"), "tabkit_part")
    return t.spark.sql("SELECT p_partkey, p_name FROM tabkit_part WHERE p_brand = 'Brand#7'")


@query("""
SELECT p_partkey, nullif(p_brand, 'Brand#3') || '-' || p_type AS strict,
       concat_ws('_', nullif(p_brand, 'Brand#3'), p_type, CAST(p_size AS VARCHAR)) AS loose,
       trim('  ' || p_name || ' ') AS trimmed, CAST(length(p_name) AS BIGINT) AS len,
       string_split(p_name, ' ')[1] AS first_word
FROM part
""")
def concat_variants(t: Tables) -> DataFrame:
    brand = F.nullif("p_brand", F.lit("Brand#3"))
    return t("part").select(
        "p_partkey",
        F.concat(brand, F.lit("-"), "p_type").alias("strict"),
        F.concat_ws("_", brand, "p_type", F.col("p_size").cast("string")).alias("loose"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.length("p_name").cast("long").alias("len"),
        F.split("p_name", " ")[0].alias("first_word"),
    )


@query("""SELECT 'Name: ' || s_name || ' Nation: ' || CAST(nullif(s_nationkey, 4) AS VARCHAR) AS "value" FROM supplier""")
def formatted_rows(t: Tables) -> DataFrame:
    supplier = t("supplier").withColumn("nation", F.nullif("s_nationkey", F.lit(4)))
    return format_rows(supplier, "Name: {} Nation: {}", ["s_name", "nation"])


@query("""
SELECT o_orderkey, strftime(make_date(year(o_orderdate), month(o_orderdate), 1), '%Y-%m-%d') AS month_start,
       lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS mm,
       CAST(2020 - year(o_orderdate) AS DOUBLE) AS age,
       CASE WHEN year(o_orderdate) = 1996 THEN 1996.0 ELSE CAST(2020 - year(o_orderdate) AS DOUBLE) END AS age_or_sentinel,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2020-06-30') AS BIGINT) AS days
FROM orders
""")
def date_parts(t: Tables) -> DataFrame:
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    return t("orders").select(
        "o_orderkey",
        date_from_parts(year, month).cast("string").alias("month_start"),
        F.lpad(month.cast("string"), 2, "0").alias("mm"),
        years_since(year, AS_OF).alias("age"),
        years_since(year, AS_OF, sentinel=1996.0).alias("age_or_sentinel"),
        day_gap(F.lit(AS_OF), F.col("o_orderdate").cast("date")).cast("long").alias("days"),
    )


@query("""
WITH d AS (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders)
SELECT o_orderkey, CAST(2020 - y AS DOUBLE) AS year_age,
       CAST(date_diff('day', make_date(y, m, 1), DATE '2020-06-30') AS BIGINT) AS event_age,
       CAST(date_diff('day', make_date(y, 1, 1), make_date(y, m, 1)) AS BIGINT) AS since_new_year
FROM d
""")
def date_features(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    orders = year_age(orders, "y", AS_OF, "year_age")
    orders = date_age(orders, "y", "m", AS_OF, "event_age", {"since_new_year": "y"})
    return orders.select(
        "o_orderkey", "year_age", F.col("event_age").cast("long"), F.col("since_new_year").cast("long")
    )


@query("""
WITH d AS (SELECT o_orderkey, nullif(year(o_orderdate), 1995) AS y, nullif(month(o_orderdate), 5) + o_orderkey % 2 * 12 AS m FROM orders)
SELECT o_orderkey, CAST(CASE WHEN m <= 12 THEN make_date(y, m, 1) END AS VARCHAR) AS start,
       CAST(date_diff('day', CASE WHEN m <= 12 THEN make_date(y, m, 1) END, DATE '2020-06-30') AS BIGINT) AS age
FROM d
""")
def date_edges(t: Tables) -> DataFrame:
    """Null years and months, months beyond twelve, years as doubles."""
    month = F.nullif(F.month("o_orderdate"), F.lit(5)) + F.col("o_orderkey") % 2 * 12
    orders = t("orders").select(
        "o_orderkey", F.nullif(F.year("o_orderdate"), F.lit(1995)).cast("double").alias("y"), month.alias("m")
    )
    orders = date_age(orders, "y", "m", AS_OF, "age", {})
    start = date_from_parts(F.col("y"), F.col("m")).cast("string")
    return orders.select("o_orderkey", start.alias("start"), F.col("age").cast("long"))


@query("""
SELECT p_partkey, round(ln(1 + p_retailprice), 6) AS log_price,
       round(exp(ln(1 + p_retailprice)) - 1, 4) AS price_again,
       round(exp(-p_size / 10.0), 6) AS decay, CAST(p_size // 7 AS BIGINT) AS size_div,
       CAST((0 - p_size) // 2 AS BIGINT) AS neg_div, round((p_retailprice - p_size) * 2 / 3, 4) AS mixed
FROM part
""")
def math_features(t: Tables) -> DataFrame:
    price, size = F.col("p_retailprice"), F.col("p_size")
    return t("part").select(
        "p_partkey",
        F.round(F.log1p(price), 6).alias("log_price"),
        F.round(F.expm1(F.log1p(price)), 4).alias("price_again"),
        F.round(F.exp(-size / 10.0), 6).alias("decay"),
        F.expr("p_size div 7").alias("size_div"),
        F.expr("(0 - p_size) div 2").alias("neg_div"),
        F.round((price - size) * 2 / 3, 4).alias("mixed"),
    )


@query("""
WITH d AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS price, l_quantity AS quantity,
                  CASE WHEN l_tax = 0 THEN -9999.0 ELSE l_quantity END AS area FROM lineitem),
     e AS (SELECT *, quantity + CASE WHEN area = -9999.0 THEN 0 ELSE area END AS total_area FROM d)
SELECT l_orderkey, l_linenumber, round(ln(1 + price / total_area), 6) AS label,
       round(price, 2) AS price_again FROM e
""")
def target_transform(t: Tables) -> DataFrame:
    lines = t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_tax") == 0, -9999.0).otherwise(F.col("l_quantity")).alias("area"),
    )
    target = TargetTransform("price", ("quantity", "area"))
    labelled = lines.withColumn("label", target.forward())
    return labelled.select(
        "l_orderkey",
        "l_linenumber",
        F.round("label", 6).alias("label"),
        F.round(target.inverse("label"), 2).alias("price_again"),
    )


@query("""
WITH d AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_tax, l_discount,
                  CASE WHEN l_quantity = 1 THEN -9999.0 ELSE l_quantity END AS guarded FROM lineitem)
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_discount = 0 THEN -9999.0 ELSE l_tax / l_discount END AS tax_share,
       CASE WHEN guarded = -9999.0 THEN -9999.0 ELSE l_extendedprice / guarded END AS unit_price,
       l_tax + l_discount + l_quantity AS added,
       greatest(l_tax - l_discount, 0.0) AS tax_over
FROM d
""")
def ratio_features(t: Tables) -> DataFrame:
    lines = t("lineitem").withColumn(
        "guarded", F.when(F.col("l_quantity") == 1, -9999.0).otherwise(F.col("l_quantity"))
    )
    lines = ratio_feature(lines, "l_tax", "l_discount", "tax_share")
    lines = sum_feature(lines, ["l_tax", "l_discount", "l_quantity"], "added")
    lines = clamped_diff(lines, "l_tax", "l_discount", "tax_over")
    unit = guarded_ratio(F.col("l_extendedprice"), F.col("guarded"), inputs=[F.col("guarded")])
    return lines.select("l_orderkey", "l_linenumber", "tax_share", unit.alias("unit_price"), "added", "tax_over")


@query("""
SELECT p_partkey, concat_ws('_', nullif(p_brand, 'Brand#2'), p_type, CAST(p_size AS VARCHAR)) AS kind, p_name AS title
FROM part
""")
def cross_features(t: Tables) -> DataFrame:
    part = t("part").withColumn("p_brand", F.nullif("p_brand", F.lit("Brand#2"))).drop("p_retailprice")
    crossed = cross_feature(part, ["p_brand", "p_type", "p_size"])
    return rename(crossed, {"p_brand_p_type_p_size": "kind", "p_name": "title"})


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'low' END AS band
FROM orders WHERE nullif(o_orderstatus, 'P') IS NULL
""")
def conditional_columns(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    missing = t("orders").filter(F.nullif("o_orderstatus", F.lit("P")).isNull())
    return missing.select(
        "o_orderkey", F.when(price > 250000, "high").when(price > 100000, "mid").otherwise("low").alias("band")
    )


@query("""
SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size, TRY_CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS p_brand,
       TRY_CAST(p_name AS DOUBLE) AS p_name FROM part
""")
def cast_in_place(t: Tables) -> DataFrame:
    part = t("part").select(
        "p_partkey", "p_size", F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("p_brand"), "p_name"
    )
    return cast_columns(part, {"p_size": "string", "p_brand": "int", "p_name": "double"})


@query("SELECT p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def split_align_columns(t: Tables) -> DataFrame:
    part = t("part")
    numeric, categorical = split_columns(part, exclude=("p_partkey",))
    return align_to(part.select(*numeric, *categorical), part, drop=("p_partkey",))


@query("""
SELECT s_suppkey, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_name FROM supplier
""")
def conform_types(t: Tables) -> DataFrame:
    wider = T.StructType(
        [
            T.StructField("s_nationkey", T.LongType()),
            T.StructField("s_name", T.StringType()),
            T.StructField("s_suppkey", T.LongType()),
        ]
    )
    return conform(t("supplier"), wider)


@query("SELECT p_partkey, p_brand, nullif(p_brand, 'Brand#5') AS with_null FROM part")
def drop_constant(t: Tables) -> DataFrame:
    part = t("part").select(
        "p_partkey",
        "p_brand",
        F.nullif("p_brand", F.lit("Brand#5")).alias("with_null"),
        F.lit("same").alias("one_value"),
        F.lit(None).cast("string").alias("only_null"),
    )
    _, rest, _ = shape.drop_constant(part, part, ["p_brand", "with_null", "one_value", "only_null"])
    return rest
