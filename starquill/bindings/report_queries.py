"""Reports on the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from starquill.bindings.star import (ADDRESS, ADDRESS_TEXT, LINES, ORDERS, PART_FILMS, Star)
from starquill.plans import reports


def _category_films(form):
    def query(spark, folder):
        t = Star(spark, folder)
        pairs = t["lineitem"].select("l_partkey", "l_suppkey").distinct()
        supplied = (pairs.join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
                    .select(F.col("l_partkey").alias("film_id"),
                            F.col("s_nationkey").alias("category_id")).distinct())
        nations = t["nation"].select(F.col("n_nationkey").alias("category_id"),
                                     F.col("n_name").alias("name"))
        films = t.part_films().withColumn("rental_rate", F.col("replacement_cost"))
        return form(films, supplied, nations, "nation_3", (2000, 2012), 920)
    return query


CATEGORY_FILMS = """
SELECT p_partkey AS film_id, p_name AS title, CAST(p_size + 1990 AS INTEGER) AS release_year,
       CAST(p_retailprice AS DECIMAL(12,2)) AS rental_rate
FROM part
WHERE p_size + 1990 BETWEEN 2000 AND 2012 AND p_retailprice > 920
  AND EXISTS (SELECT 1 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
              JOIN nation ON s_nationkey = n_nationkey
              WHERE l_partkey = p_partkey AND upper(n_name) = 'NATION_3')
"""


def _store_revenue(form):
    def query(spark, folder):
        t = Star(spark, folder)
        return form(t.store(), t.address(), t.customer_copies(), t.order_rentals(),
                    t.line_payments(), "2001-11-01 00:00:00")
    return query


STORE_REVENUE = f"""
WITH {ADDRESS}, {LINES},
paid AS (SELECT c_nationkey, sum(amt) AS revenue
         FROM li JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         WHERE l_shipdate >= TIMESTAMP '2001-11-01 00:00:00' GROUP BY c_nationkey)
SELECT n_nationkey AS store_id, {ADDRESS_TEXT} AS store_address,
       CAST(coalesce(revenue, 0) AS DECIMAL(38,2)) AS revenue
FROM loc LEFT JOIN paid ON n_nationkey = c_nationkey
"""


def _busiest(form):
    def query(spark, folder):
        t = Star(spark, folder)
        links = t["lineitem"].select(F.col("l_suppkey").alias("actor_id"),
                                     F.col("l_orderkey").alias("film_id"))
        return form(t.supplier_actors(), links, t.order_films(), 1999)
    return query


BUSIEST = """
SELECT s_suppkey AS actor_id, 'N' || s_nationkey AS first_name, s_name AS last_name,
       count(*) AS number_of_movies
FROM supplier JOIN lineitem ON s_suppkey = l_suppkey JOIN orders ON l_orderkey = o_orderkey
WHERE year(o_orderdate) >= 1999
GROUP BY s_suppkey, s_nationkey, s_name
ORDER BY number_of_movies DESC, last_name, first_name, actor_id LIMIT 5
"""


def _yearly_counts(form):
    def query(spark, folder):
        t = Star(spark, folder)
        links = t["lineitem"].select(F.col("l_orderkey").alias("film_id"),
                                     F.col("l_partkey").alias("category_id"))
        types = t["part"].select(F.col("p_partkey").alias("category_id"),
                                 F.col("p_type").alias("name"))
        return form(t.order_films(), links, types,
                    {"n_promo": "promo", "n_economy": "economy", "n_none": "no such type"})
    return query


YEARLY_COUNTS = f"""
WITH {ORDERS}
SELECT yr AS release_year,
       count(DISTINCT CASE WHEN p_type = 'PROMO' THEN o_orderkey END) AS n_promo,
       count(DISTINCT CASE WHEN p_type = 'ECONOMY' THEN o_orderkey END) AS n_economy,
       CAST(0 AS BIGINT) AS n_none
FROM ord LEFT JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN part ON l_partkey = p_partkey
GROUP BY yr
"""


def _top_earners(form):
    def query(spark, folder):
        t = Star(spark, folder)
        staff = t["supplier"].select(
            F.col("s_suppkey").alias("staff_id"),
            F.concat(F.lit("N"), "s_nationkey").alias("first_name"),
            F.col("s_name").alias("last_name"))
        return form(staff, t.line_payments(), t.order_rentals(), t.customer_copies(), t.store(),
                    t.address(), 1997)
    return query


TOP_EARNERS = f"""
WITH {ADDRESS}, {LINES},
paid AS (SELECT * FROM li WHERE l_shipdate >= TIMESTAMP '1997-01-01'
                            AND l_shipdate < TIMESTAMP '1998-01-01'),
rev AS (SELECT l_suppkey AS k, sum(amt) AS revenue FROM paid GROUP BY 1),
last_at AS (
  SELECT k, c_nationkey FROM (
    SELECT l_suppkey AS k, c_nationkey, row_number() OVER (
             PARTITION BY l_suppkey
             ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC,
                      amt DESC) AS rn
    FROM paid JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
  WHERE rn = 1)
SELECT s_suppkey AS staff_id, 'N' || s_nationkey || ' ' || s_name AS staff_full_name,
       c_nationkey AS last_store_id, {ADDRESS_TEXT} AS last_store_address,
       CAST(revenue AS DECIMAL(38,2)) AS revenue
FROM supplier JOIN rev ON s_suppkey = rev.k JOIN last_at ON s_suppkey = last_at.k
JOIN loc ON c_nationkey = n_nationkey
ORDER BY revenue DESC, staff_id LIMIT 3
"""


def _popular(form):
    def query(spark, folder):
        t = Star(spark, folder)
        return form(t.part_films(), t.part_copies(), t.line_copies())
    return query


POPULAR = f"""
WITH {PART_FILMS}
SELECT film_id, title, count(*) AS number_of_rentals, rating,
       CASE rating WHEN 'G' THEN 'All ages' WHEN 'PG' THEN 'Parental guidance suggested'
            WHEN 'PG-13' THEN '13+ (parents strongly cautioned)'
            WHEN 'R' THEN 'Under 17 requires accompanying parent/adult guardian'
            WHEN 'NC-17' THEN '18+ only / adults only' ELSE 'Unknown' END AS audience
FROM film JOIN lineitem ON film_id = l_partkey
GROUP BY film_id, title, rating
ORDER BY number_of_rentals DESC, title, film_id LIMIT 5
"""


def _part_years(form, *args):
    def query(spark, folder):
        t = Star(spark, folder)
        links = t["lineitem"].select(F.col("l_partkey").alias("actor_id"),
                                     F.col("l_orderkey").alias("film_id"))
        return form(t.part_actors(), links, t.order_films(), *args)
    return query


INACTIVE = f"""
WITH {ORDERS},
last_year AS (SELECT l_partkey AS k, max(yr) AS y
              FROM lineitem JOIN ord ON l_orderkey = o_orderkey GROUP BY l_partkey)
SELECT p_partkey AS actor_id, p_brand AS first_name, p_name AS last_name,
       y AS last_release_year, CAST(2002 - y AS INTEGER) AS inactivity_years
FROM part JOIN last_year ON p_partkey = k
WHERE y = (SELECT min(y) FROM last_year)
"""

LARGEST_GAP = f"""
WITH {ORDERS},
years AS (SELECT DISTINCT l_partkey AS k, yr FROM lineitem JOIN ord ON l_orderkey = o_orderkey),
gaps AS (SELECT k, yr, lead(yr) OVER (PARTITION BY k ORDER BY yr) AS nxt FROM years)
SELECT p_partkey AS actor_id, p_brand AS first_name, p_name AS last_name,
       yr AS previous_release_year, nxt AS next_release_year,
       CAST(nxt - yr AS INTEGER) AS gap_in_years
FROM part JOIN gaps ON p_partkey = k
WHERE nxt - yr = (SELECT max(nxt - yr) FROM gaps)
"""

AS_OF = dt.date(2002, 3, 1)

QUERIES = {
    "rpt_category_filter_join": _category_films(reports.category_films_join),
    "rpt_category_filter_semi": _category_films(reports.category_films_semi),
    "rpt_category_filter_cte": _category_films(reports.category_films_cte),
    "rpt_location_revenue_join": _store_revenue(reports.store_revenue_join),
    "rpt_location_revenue_scalar": _store_revenue(reports.store_revenue_scalar),
    "rpt_location_revenue_preagg": _store_revenue(reports.store_revenue_preagg),
    "rpt_top_participation_join": _busiest(reports.busiest_actors_join),
    "rpt_top_participation_scalar": _busiest(reports.busiest_actors_scalar),
    "rpt_top_participation_cte": _busiest(reports.busiest_actors_cte),
    "rpt_conditional_counts_join": _yearly_counts(reports.yearly_category_counts_join),
    "rpt_conditional_counts_scalar": _yearly_counts(reports.yearly_category_counts_scalar),
    "rpt_conditional_counts_cte": _yearly_counts(reports.yearly_category_counts_cte),
    "rpt_top_earner_last_location_join": _top_earners(reports.top_earners_join),
    "rpt_top_earner_last_location_scalar": _top_earners(reports.top_earners_scalar),
    "rpt_top_earner_last_location_cte": _top_earners(reports.top_earners_cte),
    "rpt_popular_with_label": _popular(reports.popular_films_cte),
    "rpt_popular_with_label_join": _popular(reports.popular_films_join),
    "rpt_popular_with_label_scalar": _popular(reports.popular_films_scalar),
    "rpt_inactivity_max": _part_years(reports.longest_inactive, AS_OF),
    "rpt_inactivity_max_scalar": _part_years(reports.longest_inactive_scalar, AS_OF),
    "rpt_largest_gap_window": _part_years(reports.largest_gap_window),
    "rpt_largest_gap_selfjoin": _part_years(reports.largest_gap_selfjoin),
    "rpt_largest_gap_scalar": _part_years(reports.largest_gap_scalar),
}

_SQL_BY_PREFIX = {
    "rpt_category_filter": CATEGORY_FILMS, "rpt_location_revenue": STORE_REVENUE,
    "rpt_top_participation": BUSIEST, "rpt_conditional_counts": YEARLY_COUNTS,
    "rpt_top_earner": TOP_EARNERS, "rpt_popular": POPULAR, "rpt_inactivity": INACTIVE,
    "rpt_largest_gap": LARGEST_GAP,
}

ORACLES = {key: next(sql for prefix, sql in _SQL_BY_PREFIX.items() if key.startswith(prefix))
           for key in QUERIES}
