"""Access filters on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starquill.bindings.star import ORDERS, Star, money
from starquill.plans import access

PRINCIPAL = "client_customer_customer_000000042"


def _orders(t):
    return t["orders"].select(F.col("o_custkey").alias("customer_id"), "o_orderkey",
                              "o_orderdate", money("o_totalprice").alias("amt"))


def _role_map(t):
    """Customers with orders and purchases have an account."""
    purchases = (t["events"].filter(F.col("event_type") == "purchase")
                 .select(F.col("user_id").alias("customer_id")))
    return t.customers(), _orders(t), purchases


def row_filter(spark, folder):
    t = Star(spark, folder)
    return access.own_rows(_orders(t), access.principals(*_role_map(t)), PRINCIPAL)


ROLES = """roles AS (
  SELECT lower('client_Customer_' || regexp_replace(c_name, '[^a-zA-Z0-9]+', '_', 'g'))
           AS role_name, min(c_custkey) AS c_custkey
  FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
    AND c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')
  GROUP BY 1)"""

ROW_FILTER = f"""
WITH {ORDERS}, {ROLES}
SELECT o_custkey AS customer_id, o_orderkey, o_orderdate, amt FROM ord
WHERE o_custkey = (SELECT c_custkey FROM roles WHERE role_name = '{PRINCIPAL}')
"""


def column_subset(spark, folder):
    customers = Star(spark, folder)["customer"]
    return access.allowed_columns(customers, ["c_custkey", "c_name"], masked=["c_acctbal"])


COLUMN_SUBSET = """
SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer
"""


def principal_choice(spark, folder):
    return access.first_principal(*_role_map(Star(spark, folder)))


PRINCIPAL_CHOICE = f"""
WITH {ROLES}
SELECT role_name, c_custkey AS customer_id FROM roles ORDER BY c_custkey LIMIT 1
"""


def row_counts(spark, folder):
    t = Star(spark, folder)
    return access.own_row_counts(_orders(t), access.principals(*_role_map(t)))


ROW_COUNTS = f"""
WITH {ROLES}
SELECT role_name, c_custkey AS customer_id, count(o_orderkey) AS n_rows
FROM roles LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2
"""

QUERIES = {"acc_row_filter": row_filter, "acc_column_subset": column_subset,
           "acc_principal_choice": principal_choice, "acc_row_counts": row_counts}

ORACLES = {"acc_row_filter": ROW_FILTER, "acc_column_subset": COLUMN_SUBSET,
           "acc_principal_choice": PRINCIPAL_CHOICE, "acc_row_counts": ROW_COUNTS}
