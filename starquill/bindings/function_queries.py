"""Table functions on the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from starquill.bindings.star import LINES, ORDERS, PART_FILMS, RENTALS, Star
from starquill.functions.periods import period_status
from starquill.operators.aggregates import text_concat
from starquill.plans import table_functions as tf

# nation -> region as film -> category


def _sales(t: Star):
    links = t["nation"].select(F.col("n_nationkey").alias("film_id"),
                               F.col("n_regionkey").alias("category_id"))
    regions = t["region"].select(F.col("r_regionkey").alias("category_id"),
                                 F.col("r_name").alias("name"))
    return t.line_payments(), t.order_rentals(), t.customer_copies(), links, regions


def category_revenue(spark, folder):
    return tf.category_revenue(*_sales(Star(spark, folder)), "1997-q2 ")


def current_category_revenue(spark, folder):
    return tf.current_category_revenue(*_sales(Star(spark, folder)), dt.date(1998, 2, 10))


def _revenue_sql(year: int, quarter: int, start: str, after: str) -> str:
    return f"""
WITH {LINES}
SELECT {year} AS report_year, {quarter} AS report_quarter, r_name AS category_name,
       CAST(round(sum(amt), 2) AS DECIMAL(38,2)) AS total_sales_revenue
FROM li JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE l_shipdate >= TIMESTAMP '{start}' AND l_shipdate < TIMESTAMP '{after}'
GROUP BY r_regionkey, r_name
"""


def _period_texts():
    """Periods written from the orders in several ways, good and bad."""
    quarter = F.concat(F.year("o_orderdate"), F.lit("-Q"), F.quarter("o_orderdate"))
    by_month = F.concat(F.lit(" "), F.year("o_orderdate"), F.lit("-q"), F.month("o_orderdate"),
                        F.lit(" "))
    return (F.when(F.col("o_orderstatus") == "F", quarter)
            .when(F.col("o_orderstatus") == "O", by_month).otherwise(F.col("o_orderpriority")))


def revenue_of_periods(spark, folder):
    """Every quarter that the orders name."""
    t = Star(spark, folder)
    texts = t["orders"].select(_period_texts().alias("period"))
    return tf.revenue_of_periods(*_sales(t), texts)


REVENUE_OF_PERIODS = f"""
WITH {LINES},
texts AS (
  SELECT DISTINCT upper(trim(CASE o_orderstatus
           WHEN 'F' THEN year(o_orderdate) || '-Q' || quarter(o_orderdate)
           WHEN 'O' THEN ' ' || year(o_orderdate) || '-q' || month(o_orderdate) || ' '
           ELSE o_orderpriority END)) AS t
  FROM orders),
asked AS (
  SELECT CAST(left(t, 4) AS INTEGER) AS y, CAST(right(t, 1) AS INTEGER) AS q FROM texts
  WHERE regexp_full_match(t, '[0-9]{{4}}-Q[1-4]')),
bounds AS (
  SELECT y, q, make_timestamp(y, 3 * q - 2, 1, 0, 0, 0) AS a FROM asked)
SELECT y AS report_year, q AS report_quarter, r_name AS category_name,
       CAST(round(sum(amt), 2) AS DECIMAL(38,2)) AS total_sales_revenue
FROM bounds JOIN li ON l_shipdate >= a AND l_shipdate < a + INTERVAL 3 MONTH
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY y, q, r_regionkey, r_name
"""


def validate_periods(spark, folder):
    """Periods written from the orders in several ways, good and bad."""
    quarter = F.concat(F.year("o_orderdate"), F.lit("-Q"), F.quarter("o_orderdate"))
    by_month = F.concat(F.lit(" "), F.year("o_orderdate"), F.lit("-q"), F.month("o_orderdate"),
                        F.lit(" "))
    other = (F.when(F.col("o_orderpriority") == "2-HIGH", "  ")
             .when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    text = (F.when(F.col("o_orderstatus") == "F", quarter)
            .when(F.col("o_orderstatus") == "O", by_month).otherwise(other))
    return (Star(spark, folder)["orders"]
            .groupBy("o_orderstatus", period_status(text).alias("status"))
            .agg(F.count(F.lit(1)).alias("n")))


VALIDATE = """
WITH texts AS (
  SELECT o_orderstatus,
         CASE o_orderstatus
           WHEN 'F' THEN year(o_orderdate) || '-Q' || quarter(o_orderdate)
           WHEN 'O' THEN ' ' || year(o_orderdate) || '-q' || month(o_orderdate) || ' '
           ELSE CASE o_orderpriority WHEN '2-HIGH' THEN '  ' WHEN '5-LOW' THEN NULL
                                     ELSE o_orderpriority END END AS t
  FROM orders)
SELECT o_orderstatus,
       CASE WHEN t IS NULL OR trim(t) = '' THEN 'empty'
            WHEN NOT regexp_full_match(upper(trim(t)), '[0-9]{4}-Q[1-4]') THEN 'malformed'
            ELSE 'valid' END AS status,
       count(*) AS n
FROM texts GROUP BY 1, 2
"""

ASKED = ["NATION_3", " nation_7 ", "ATLANTIS", "nation_3", "", None, "Nation_12"]


def most_popular(spark, folder):
    t = Star(spark, folder)
    nations = t["nation"].select(F.col("n_nationkey").alias("country_id"),
                                 F.col("n_name").alias("country"))
    cities = t["nation"].select(F.col("n_nationkey").alias("city_id"),
                                F.col("n_nationkey").alias("country_id"))
    films = t.part_films().withColumn(
        "release_year", F.when(F.col("length") <= 40, F.col("release_year")))
    return tf.most_popular_films(nations, cities, t.address(), t.customers(), t.line_rentals(),
                                 t.part_copies(), films, t.type_languages(), ASKED)


MOST_POPULAR = f"""
WITH {PART_FILMS}, asked(ord, name, match) AS (VALUES
  (1, 'NATION_3', 'NATION_3'), (2, 'nation_7', 'NATION_7'), (3, 'ATLANTIS', 'ATLANTIS'),
  (7, 'Nation_12', 'NATION_12')),
counted AS (
  SELECT ord, l_partkey, count(*) AS n
  FROM asked JOIN nation ON upper(n_name) = match JOIN customer ON c_nationkey = n_nationkey
  JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2),
ranked AS (
  SELECT counted.ord, film.*,
         row_number() OVER (PARTITION BY ord ORDER BY n DESC, title, film_id) AS rn
  FROM counted JOIN film ON film_id = l_partkey)
SELECT asked.ord, name AS country, coalesce(title, '-') AS film, coalesce(rating, '-') AS rating,
       coalesce(language_id, '-') AS language,
       coalesce(CAST(length AS VARCHAR), '-') AS length,
       coalesce(CASE WHEN length <= 40 THEN CAST(release_year AS VARCHAR) END, '-')
         AS release_year
FROM asked LEFT JOIN ranked ON asked.ord = ranked.ord AND rn = 1
"""


def _in_stock(pattern):
    def query(spark, folder):
        t = Star(spark, folder)
        return tf.films_in_stock(t.part_films(), t.type_languages(), t.part_copies(),
                                 t.line_rentals(), t.customers(), pattern)
    return query


IN_STOCK = f"""
WITH {RENTALS}, {PART_FILMS},
copies AS (
  SELECT p, s, max(CASE WHEN back_at IS NULL THEN 1 ELSE 0 END) AS is_out
  FROM rent GROUP BY p, s),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p, s
                   ORDER BY out_at DESC, rid DESC, cust DESC) AS rn FROM rent) WHERE rn = 1),
picked AS (
  SELECT * FROM (
    SELECT film_id, title, language_id, cust, out_at,
           row_number() OVER (PARTITION BY film_id ORDER BY out_at DESC, copies.s) AS pick
    FROM film JOIN copies ON copies.p = film_id AND is_out = 0
    JOIN latest ON latest.p = copies.p AND latest.s = copies.s
    WHERE title LIKE '%ring%') WHERE pick = 1)
SELECT row_number() OVER (ORDER BY title, film_id) AS row_num, title AS film_title,
       language_id AS language, 'Customer ' || c_name AS customer_name,
       strftime(out_at, '%Y-%m-%d %H:%M:%S') AS rental_date
FROM picked JOIN customer ON cust = c_custkey
"""

IN_STOCK_EMPTY = """
SELECT CAST(1 AS BIGINT) AS row_num,
       'Film not found in stock for pattern: %RING%' AS film_title,
       '-' AS language, '-' AS customer_name, '-' AS rental_date
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_name LIKE '%RING%')
"""


def _split_copy(df):
    keys = df.select("inventory_id.*", *[c for c in df.columns if c != "inventory_id"])
    return keys.drop("film_id", "store_id")


def copies_in_stock(spark, folder):
    t = Star(spark, folder)
    return _split_copy(tf.copies_in_stock(t.part_copies(), t.line_rentals()))


def copies_not_in_stock(spark, folder):
    t = Star(spark, folder)
    return _split_copy(tf.copies_not_in_stock(t.part_copies(), t.line_rentals()))


def copy_holders(spark, folder):
    t = Star(spark, folder)
    return _split_copy(tf.copy_holders(t.part_copies(), t.line_rentals()))


def _copies_sql(having: str) -> str:
    return f"""
SELECT l_partkey, l_suppkey FROM lineitem GROUP BY l_partkey, l_suppkey
HAVING max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) = {having}
"""


HOLDERS = f"""
WITH {RENTALS}, copies AS (SELECT DISTINCT p, s FROM rent),
held AS (SELECT * FROM (SELECT p, s, cust, row_number() OVER (PARTITION BY p, s
           ORDER BY out_at DESC, rid DESC, cust DESC) AS rn FROM rent WHERE back_at IS NULL)
         WHERE rn = 1)
SELECT copies.p AS l_partkey, copies.s AS l_suppkey, cust AS customer_id
FROM copies LEFT JOIN held ON copies.p = held.p AND copies.s = held.s
"""


def customer_balances(spark, folder):
    t = Star(spark, folder)
    return tf.customer_balances(t.customers(), t.line_rentals(), t.part_copies(),
                                t.part_films(), t.order_facts(), dt.datetime(1998, 6, 30))


BALANCES = f"""
WITH {RENTALS}, {PART_FILMS}, {ORDERS},
kept AS (
  SELECT cust, p, greatest(0, CAST(ceil(epoch(
           least(coalesce(back_at, TIMESTAMP '1998-06-30'), TIMESTAMP '1998-06-30') - out_at)
           / 86400.0) AS INTEGER)) AS days
  FROM rent WHERE out_at <= TIMESTAMP '1998-06-30'),
charged AS (
  SELECT cust, sum(rental_rate + CASE WHEN days > 2 * rental_duration THEN replacement_cost
                        WHEN days > rental_duration
                        THEN CAST(days - rental_duration AS DECIMAL(12,2)) ELSE 0 END) AS c
  FROM kept JOIN film ON p = film_id GROUP BY cust),
paid AS (SELECT o_custkey, sum(amt) AS a FROM ord
         WHERE o_orderdate <= TIMESTAMP '1998-06-30' GROUP BY o_custkey)
SELECT c_custkey AS customer_id,
       CAST(coalesce(c, 0) - coalesce(a, 0) AS DECIMAL(38,2)) AS balance
FROM customer LEFT JOIN charged ON c_custkey = cust LEFT JOIN paid ON c_custkey = o_custkey
"""


def rewards(spark, folder):
    t = Star(spark, folder)
    return tf.rewards_report(t.customers(), t.order_facts(), 1, 100, dt.date(2001, 7, 15))


def rewards_latest(spark, folder):
    t = Star(spark, folder)
    return tf.rewards_report(t.customers(), t.line_paid_by_customer(), 1, 1000)


REWARDS = f"""
WITH {ORDERS}
SELECT c_custkey AS customer_id, 'Customer' AS first_name, c_name AS last_name,
       c_nationkey AS address_id, c_mktsegment AS segment
FROM customer WHERE c_custkey IN (
  SELECT o_custkey FROM ord
  WHERE o_orderdate >= TIMESTAMP '2001-07-01' AND o_orderdate < TIMESTAMP '2001-08-01'
  GROUP BY o_custkey HAVING count(*) > 1 AND sum(amt) > 100)
"""

REWARDS_LATEST = f"""
WITH {LINES},
month AS (SELECT date_trunc('month', max(l_shipdate)) AS m FROM lineitem)
SELECT c_custkey AS customer_id, 'Customer' AS first_name, c_name AS last_name,
       c_nationkey AS address_id, c_mktsegment AS segment
FROM customer WHERE c_custkey IN (
  SELECT o_custkey FROM li JOIN orders ON l_orderkey = o_orderkey, month
  WHERE l_shipdate >= m AND l_shipdate < m + INTERVAL 1 MONTH
  GROUP BY o_custkey HAVING count(*) > 1 AND sum(amt) > 1000)
"""

PART_SIZE = 50


def brand_names(spark, folder):
    parts = Star(spark, folder)["part"]
    return text_concat(parts, ["p_brand"], "p_name", ["p_name", "p_partkey"], ", ", PART_SIZE,
                       "part_names")


def customer_priorities(spark, folder):
    """One text per customer: the different priorities of its orders, five at most."""
    kinds = Star(spark, folder)["orders"].select("o_custkey", "o_orderpriority").distinct()
    return text_concat(kinds, ["o_custkey"], "o_orderpriority", ["o_orderpriority"], ", ",
                       part_size=None, name="priorities")


BRAND_NAMES = f"""
WITH numbered AS (
  SELECT p_brand, p_name, row_number() OVER (PARTITION BY p_brand
           ORDER BY p_name, p_partkey) AS rn FROM part)
SELECT p_brand, CAST((rn - 1) // {PART_SIZE} + 1 AS INTEGER) AS part_no,
       string_agg(p_name, ', ' ORDER BY rn) AS part_names
FROM numbered GROUP BY 1, 2
"""

CUSTOMER_PRIORITIES = """
SELECT o_custkey, string_agg(o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities
FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) GROUP BY o_custkey
"""

QUERIES = {
    "fn_revenue_by_category_quarter": category_revenue,
    "fn_revenue_current_quarter": current_category_revenue,
    "fn_period_validate": validate_periods,
    "fn_revenue_of_periods": revenue_of_periods,
    "fn_most_popular_by_group": most_popular,
    "fn_in_stock_search": _in_stock("ring"),
    "fn_in_stock_search_empty": _in_stock("%RING%"),
    "fn_copies_in_stock": copies_in_stock,
    "fn_copies_not_in_stock": copies_not_in_stock,
    "fn_copy_holder": copy_holders,
    "fn_customer_balance": customer_balances,
    "fn_rewards_report": rewards,
    "fn_rewards_report_latest": rewards_latest,
    "agg_text_concat": brand_names,
    "agg_text_concat_whole": customer_priorities,
}

ORACLES = {
    "fn_revenue_by_category_quarter": _revenue_sql(1997, 2, "1997-04-01", "1997-07-01"),
    "fn_revenue_current_quarter": _revenue_sql(1998, 1, "1998-01-01", "1998-04-01"),
    "fn_period_validate": VALIDATE,
    "fn_revenue_of_periods": REVENUE_OF_PERIODS,
    "fn_most_popular_by_group": MOST_POPULAR,
    "fn_in_stock_search": IN_STOCK,
    "fn_in_stock_search_empty": IN_STOCK_EMPTY,
    "fn_copies_in_stock": _copies_sql("0"),
    "fn_copies_not_in_stock": _copies_sql("1"),
    "fn_copy_holder": HOLDERS,
    "fn_customer_balance": BALANCES,
    "fn_rewards_report": REWARDS,
    "fn_rewards_report_latest": REWARDS_LATEST,
    "agg_text_concat": BRAND_NAMES,
    "agg_text_concat_whole": CUSTOMER_PRIORITIES,
}
