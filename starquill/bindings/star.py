"""The star-schema test tables seen as tables of the rental schema.

Each method gives one rental table for one reading of the star schema; the same readings
stand as SQL in the module constants, for the comparison queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starquill.sources.tables import STAR_SCHEMAS, TableSet


def money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


def year(column: str) -> Column:
    return F.year(column)


class Star(TableSet):
    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder, STAR_SCHEMAS)

    # nation -> customer -> orders -> lineitem as store -> copy -> rental -> payment

    def store(self) -> DataFrame:
        return self["nation"].select(F.col("n_nationkey").alias("store_id"),
                                     F.col("n_nationkey").alias("address_id"))

    def address(self) -> DataFrame:
        second = (F.when(F.col("n_regionkey") == 0, F.lit(None)).when(
            F.col("n_regionkey") == 1, "").otherwise(F.concat(F.lit("R"), "n_regionkey")))
        return self["nation"].select(F.col("n_nationkey").alias("address_id"),
                                     F.col("n_nationkey").alias("city_id"),
                                     F.col("n_name").alias("address"), second.alias("address2"))

    def customer_copies(self) -> DataFrame:
        return self["customer"].select(F.col("c_custkey").alias("inventory_id"),
                                       F.col("c_nationkey").alias("store_id"),
                                       F.col("c_nationkey").alias("film_id"))

    def order_rentals(self) -> DataFrame:
        return self["orders"].select(F.col("o_orderkey").alias("rental_id"),
                                     F.col("o_custkey").alias("inventory_id"))

    def line_payments(self) -> DataFrame:
        return self["lineitem"].select(
            F.col("l_orderkey").alias("rental_id"), F.col("l_suppkey").alias("staff_id"),
            money("l_extendedprice").alias("amount"), F.col("l_shipdate").alias("payment_date"),
            F.struct("l_orderkey", "l_linenumber", "l_partkey",
                     money("l_extendedprice").alias("amount")).alias("payment_id"))

    # orders as films: lines link them to suppliers or parts

    def order_films(self) -> DataFrame:
        return self["orders"].select(F.col("o_orderkey").alias("film_id"),
                                     year("o_orderdate").alias("release_year"))

    # parts as films: copies are the distinct (part, supplier) pairs of the lines

    def part_films(self) -> DataFrame:
        rating = (F.when(F.col("p_type") == "PROMO", "G").when(F.col("p_type") == "ECONOMY", "PG")
                  .when(F.col("p_type") == "SMALL", "PG-13").when(F.col("p_type") == "MEDIUM", "R")
                  .otherwise(F.col("p_type")))
        rate = (F.when(F.col("p_type") == "PROMO", "0.99").when(F.col("p_type") == "SMALL", "2.99")
                .otherwise("4.99").cast("decimal(4,2)"))
        return self["part"].select(
            F.col("p_partkey").alias("film_id"), F.col("p_name").alias("title"),
            (F.col("p_size") + 1990).alias("release_year"), F.col("p_type").alias("language_id"),
            F.col("p_size").alias("length"), rating.alias("rating"),
            rate.alias("rental_rate"), F.col("p_size").alias("rental_duration"),
            money("p_retailprice").alias("replacement_cost"))

    def part_copies(self) -> DataFrame:
        pairs = self["lineitem"].select("l_partkey", "l_suppkey").distinct()
        return pairs.select(F.struct("l_partkey", "l_suppkey").alias("inventory_id"),
                            F.col("l_partkey").alias("film_id"),
                            F.col("l_suppkey").alias("store_id"))

    def line_copies(self) -> DataFrame:
        """Rentals without their order: what the popularity report needs."""
        return self["lineitem"].select(F.col("l_orderkey").alias("rental_id"),
                                       F.struct("l_partkey", "l_suppkey").alias("inventory_id"))

    def line_rentals(self) -> DataFrame:
        back = F.when(F.col("l_linestatus") != "O", F.greatest("l_shipdate", "o_orderdate"))
        return (self["lineitem"].join(self["orders"],
                                      F.col("l_orderkey") == F.col("o_orderkey"))
                .select(F.col("l_orderkey").alias("rental_id"),
                        F.struct("l_partkey", "l_suppkey").alias("inventory_id"),
                        F.col("o_custkey").alias("customer_id"),
                        F.col("o_orderdate").alias("rental_date"), back.alias("return_date")))

    def type_languages(self) -> DataFrame:
        return self["part"].select(F.col("p_type").alias("language_id"),
                                   F.col("p_type").alias("name")).distinct()

    def numbered_languages(self) -> DataFrame:
        return (self["part"].groupBy(F.col("p_type").alias("name"))
                .agg(F.min("p_partkey").alias("language_id")))

    # people

    def customers(self) -> DataFrame:
        return self["customer"].select(
            F.col("c_custkey").alias("customer_id"), F.lit("Customer").alias("first_name"),
            F.col("c_name").alias("last_name"), F.col("c_nationkey").alias("address_id"),
            F.col("c_mktsegment").alias("segment"))

    def supplier_actors(self) -> DataFrame:
        return self["supplier"].select(
            F.col("s_suppkey").alias("actor_id"),
            F.concat(F.lit("N"), "s_nationkey").alias("first_name"),
            F.col("s_name").alias("last_name"))

    def part_actors(self) -> DataFrame:
        return self["part"].select(F.col("p_partkey").alias("actor_id"),
                                   F.col("p_brand").alias("first_name"),
                                   F.col("p_name").alias("last_name"))

    def order_facts(self) -> DataFrame:
        """Orders as rows of a customer: rentals, payments or both."""
        return self["orders"].select(
            F.col("o_orderkey").alias("rental_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("payment_date"), money("o_totalprice").alias("amount"))

    def line_paid_by_customer(self) -> DataFrame:
        """Lines as payments of the customer who ordered them."""
        return (self["lineitem"].join(self["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
                .select(F.col("o_custkey").alias("customer_id"),
                        F.col("l_shipdate").alias("payment_date"),
                        money("l_extendedprice").alias("amount")))


# The same readings in SQL.

ADDRESS = """loc AS (
  SELECT n_nationkey, n_name AS addr1,
         CASE n_regionkey WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'R' || n_regionkey END AS addr2
  FROM nation)"""
ADDRESS_TEXT = "CASE WHEN addr2 IS NULL OR addr2 = '' THEN addr1 ELSE addr1 || ', ' || addr2 END"

LINES = """li AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS amt FROM lineitem)"""

ORDERS = """ord AS (
  SELECT *, CAST(o_totalprice AS DECIMAL(12,2)) AS amt,
         CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders)"""

RENTALS = """rent AS (
  SELECT l_partkey AS p, l_suppkey AS s, l_orderkey AS rid, o_custkey AS cust,
         o_orderdate AS out_at,
         CASE WHEN l_linestatus = 'O' THEN NULL
              ELSE greatest(l_shipdate, o_orderdate) END AS back_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PART_FILMS = """film AS (
  SELECT p_partkey AS film_id, p_name AS title, CAST(p_size + 1990 AS INTEGER) AS release_year,
         p_type AS language_id, p_size AS length, p_size AS rental_duration,
         CASE p_type WHEN 'PROMO' THEN 'G' WHEN 'ECONOMY' THEN 'PG' WHEN 'SMALL' THEN 'PG-13'
              WHEN 'MEDIUM' THEN 'R' ELSE p_type END AS rating,
         CAST(CASE p_type WHEN 'PROMO' THEN 0.99 WHEN 'SMALL' THEN 2.99 ELSE 4.99 END
              AS DECIMAL(4,2)) AS rental_rate,
         CAST(p_retailprice AS DECIMAL(12,2)) AS replacement_cost
  FROM part)"""
