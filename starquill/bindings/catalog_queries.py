"""SQL functions and views of the catalog on the test tables, called by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starquill import catalog
from starquill.bindings import function_queries as fq
from starquill.bindings.access_queries import PRINCIPAL, ROLES, _orders, _role_map
from starquill.bindings.star import ORDERS, Star
from starquill.plans import access


def _sales(spark, folder) -> None:
    names = ("payment", "rental", "inventory", "film_category", "category")
    catalog.register(spark, dict(zip(names, fq._sales(Star(spark, folder)))), "sales_",
                     ["revenue_by_category", "current_revenue"])


def _parts(spark, folder) -> Star:
    """Parts as films; films longer than 40 have no year, as in the popularity report."""
    t = Star(spark, folder)
    films = t.part_films().withColumn(
        "release_year", F.when(F.col("length") <= 40, F.col("release_year")))
    nations = t["nation"]
    catalog.register(spark, {
        "film": films, "language": t.type_languages(), "inventory": t.part_copies(),
        "rental": t.line_rentals(), "customer": t.customers(), "payment": t.order_facts(),
        "address": t.address(),
        "country": nations.select(F.col("n_nationkey").alias("country_id"),
                                  F.col("n_name").alias("country")),
        "city": nations.select(F.col("n_nationkey").alias("city_id"),
                               F.col("n_nationkey").alias("country_id"))}, "parts_")
    return t


def revenue_by_category(spark, folder):
    _sales(spark, folder)
    return spark.sql("SELECT * FROM sales_revenue_by_category('1997-q2 ')")


def revenue_view(spark, folder):
    _sales(spark, folder)
    spark.sql("SET VARIABLE sales_report_date = DATE'1998-02-10'")
    return spark.table("sales_current_revenue")


def most_popular(spark, folder):
    _parts(spark, folder)
    asked = ", ".join("NULL" if name is None else f"'{name}'" for name in fq.ASKED)
    return spark.sql(f"SELECT * FROM parts_most_popular_films(array({asked}))")


def _in_stock(pattern: str):
    def query(spark, folder):
        _parts(spark, folder)
        return spark.sql(f"SELECT * FROM parts_films_in_stock(pattern => '{pattern}')")
    return query


def _copies(name: str):
    def query(spark, folder):
        _parts(spark, folder)
        return spark.sql(f"SELECT inventory_id.* FROM parts_{name}()")
    return query


def copies_of_store(spark, folder):
    _parts(spark, folder)
    return spark.sql("SELECT inventory_id.*, store_id FROM parts_copies_in_stock(store_id => 7)")


COPIES_OF_STORE = """
SELECT l_partkey, l_suppkey, l_suppkey AS store_id FROM lineitem WHERE l_suppkey = 7
GROUP BY l_partkey, l_suppkey HAVING max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) = 0
"""


def copy_holders(spark, folder):
    _parts(spark, folder)
    return spark.sql("SELECT inventory_id.*, customer_id FROM parts_copy_holders")


def balances(spark, folder):
    _parts(spark, folder)
    return spark.sql("SELECT * FROM parts_customer_balances(timestamp_ntz'1998-06-30 00:00:00')")


def rewards(spark, folder):
    _parts(spark, folder)
    return spark.sql("SELECT * FROM parts_rewards_report(1, 100, ref_date => DATE'2001-07-15')")


def session_principal(spark, folder):
    """What two principals, an unknown one and none see through the same two views: rows of their
    own, and rows of others among them."""
    t = Star(spark, folder)
    catalog.register(spark, {"payment": _orders(t),
                             "customer_role_map": access.principals(*_role_map(t))}, "own_")
    second = PRINCIPAL.replace("042", "007")
    seen = []
    for name in (PRINCIPAL, second, "client_of_nobody", None):
        value = "NULL" if name is None else f"'{name}'"
        spark.sql(f"SET VARIABLE own_principal = {value}")
        # the variable's value is part of a plan from its analysis on
        rows = spark.sql("SELECT count(*) AS n_rows, coalesce(sum(amt), 0) AS total "
                         "FROM own_own_payment")
        hidden = spark.sql("SELECT count(*) AS n_foreign FROM own_foreign_payment")
        seen.append(rows.select(F.lit(value).alias("principal"), "n_rows",
                                F.col("total").cast("decimal(38,2)").alias("total"),
                                hidden.scalar().alias("n_foreign")))
    return reduce(DataFrame.unionByName, seen)


SESSION_PRINCIPAL = f"""
WITH {ORDERS}, {ROLES},
asked(principal) AS (VALUES ('{PRINCIPAL}'), ('{PRINCIPAL.replace("042", "007")}'),
                            ('client_of_nobody'), (NULL))
SELECT coalesce('''' || principal || '''', 'NULL') AS principal, count(o_orderkey) AS n_rows,
       CAST(coalesce(sum(amt), 0) AS DECIMAL(38,2)) AS total, CAST(0 AS BIGINT) AS n_foreign
FROM asked LEFT JOIN roles ON role_name = principal LEFT JOIN ord ON o_custkey = c_custkey
GROUP BY 1
"""


QUERIES = {
    "sql_revenue_by_category": revenue_by_category,
    "sql_revenue_view": revenue_view,
    "sql_most_popular_films": most_popular,
    "sql_films_in_stock": _in_stock("ring"),
    "sql_films_in_stock_none": _in_stock("%RING%"),
    "sql_copies_in_stock": _copies("copies_in_stock"),
    "sql_copies_not_in_stock": _copies("copies_not_in_stock"),
    "sql_copies_of_store": copies_of_store,
    "sql_copy_holders": copy_holders,
    "sql_customer_balances": balances,
    "sql_rewards_report": rewards,
    "acc_session_principal": session_principal,
}

ORACLES = {
    "sql_revenue_by_category": fq.ORACLES["fn_revenue_by_category_quarter"],
    "sql_revenue_view": fq.ORACLES["fn_revenue_current_quarter"],
    "sql_most_popular_films": fq.MOST_POPULAR,
    "sql_films_in_stock": fq.IN_STOCK,
    "sql_films_in_stock_none": fq.IN_STOCK_EMPTY,
    "sql_copies_in_stock": fq.ORACLES["fn_copies_in_stock"],
    "sql_copies_not_in_stock": fq.ORACLES["fn_copies_not_in_stock"],
    "sql_copies_of_store": COPIES_OF_STORE,
    "sql_copy_holders": fq.HOLDERS,
    "sql_customer_balances": fq.BALANCES,
    "sql_rewards_report": fq.REWARDS,
    "acc_session_principal": SESSION_PRINCIPAL,
}
