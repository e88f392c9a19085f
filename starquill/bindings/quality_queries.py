"""Constraint checks on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starquill.bindings.star import Star
from starquill.operators.bitmaps import key_set, merged, missing_keys, set_sizes
from starquill.operators.rows import with_next
from starquill.plans import quality as q
from starquill.session import materialise


def unique(spark, folder):
    return q.unique_violations(Star(spark, folder)["lineitem"], "lineitem",
                               ["l_orderkey", "l_linenumber"], "line key is unique")


UNIQUE = """
SELECT 'lineitem' AS table_name, 'line key is unique' AS rule_name,
       l_orderkey || '|' || l_linenumber AS row_key, count(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""


def foreign_key(spark, folder):
    t = Star(spark, folder)
    settled = t["orders"].filter(F.col("o_orderstatus") != "P")
    lines = q.foreign_key_violations(t["lineitem"], "lineitem", ["l_orderkey"], settled,
                                     ["o_orderkey"], "line has a settled order")
    orders = q.foreign_key_violations(t["orders"], "orders", ["o_custkey"], t["customer"],
                                      ["c_custkey"], "order has a customer")
    return lines.unionByName(orders)


FOREIGN_KEY = """
SELECT 'lineitem' AS table_name, 'line has a settled order' AS rule_name,
       CAST(l_orderkey AS VARCHAR) AS row_key, count(*) AS n_rows
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
GROUP BY l_orderkey
UNION ALL
SELECT 'orders', 'order has a customer', CAST(o_custkey AS VARCHAR), count(*)
FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey
"""


def not_null(spark, folder):
    orders = Star(spark, folder)["orders"].select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("closed"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    return q.not_null_violations(orders, "orders", ["o_orderkey", "closed", "priority"])


NOT_NULL = """
SELECT 'orders' AS table_name, 'not null closed' AS rule_name, '' AS row_key, count(*) AS n_rows
FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'orders', 'not null priority', '', count(*)
FROM orders WHERE o_orderpriority = '5-LOW'
"""


def check(spark, folder):
    t = Star(spark, folder)
    parts = q.check_violations(t["part"], "part", ["p_partkey"], {
        "size is positive": q.positive("p_size"),
        "size is at most 45": F.col("p_size") <= 45,
        "name is not blank": q.not_blank("p_name"),
        "brand is short": q.at_most_long("p_brand", 7),
        "type is known": q.one_of("p_type", ["PROMO", "SMALL", "LARGE", "MEDIUM", "STANDARD"]),
    })
    orders = q.check_violations(t["orders"], "orders", ["o_orderkey"], {
        "ordered since 1995-02-01": q.after_instant("o_orderdate", "1995-02-01 00:00:00"),
        "price is present or open": F.col("o_totalprice").isNull() | (F.col("o_totalprice") > 5000),
    })
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    pairs = q.check_violations(lines, "lineitem", ["l_orderkey", "l_linenumber"],
                               {"part and supplier differ": q.differ("l_partkey", "l_suppkey")})
    return parts.unionByName(orders).unionByName(pairs)


CHECK = """
SELECT 'part' AS table_name, 'size is at most 45' AS rule_name,
       CAST(p_partkey AS VARCHAR) AS row_key, CAST(1 AS BIGINT) AS n_rows
FROM part WHERE p_size > 45
UNION ALL SELECT 'part', 'brand is short', CAST(p_partkey AS VARCHAR), 1
FROM part WHERE length(p_brand) > 7
UNION ALL SELECT 'part', 'type is known', CAST(p_partkey AS VARCHAR), 1
FROM part WHERE p_type = 'ECONOMY'
UNION ALL SELECT 'orders', 'ordered since 1995-02-01', CAST(o_orderkey AS VARCHAR), 1
FROM orders WHERE o_orderdate <= TIMESTAMP '1995-02-01'
UNION ALL SELECT 'orders', 'price is present or open', CAST(o_orderkey AS VARCHAR), 1
FROM orders WHERE o_totalprice <= 5000
UNION ALL SELECT 'lineitem', 'part and supplier differ', l_orderkey || '|' || l_linenumber, 1
FROM lineitem WHERE l_partkey = l_suppkey
"""

REFERENCES = [
    q.Reference("orders", ("o_custkey",), "customer", ("c_custkey",)),
    q.Reference("lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
    q.Reference("conversations", ("answers",), "conversations", ("turn_key",)),
]


def cascade(spark, folder):
    """What goes when customers deep in debt and system turns are deleted."""
    t = Star(spark, folder)
    turn_key = F.struct("conv_id", "turn")
    answers = F.when(F.col("turn") > 0,
                     F.struct("conv_id", (F.col("turn") - 1).alias("turn")))
    turns = t["conversations"].select(turn_key.alias("turn_key"), answers.alias("answers"), "role")
    tables = {"customer": t["customer"], "orders": t["orders"], "lineitem": t["lineitem"],
              "conversations": turns}
    keys = {"customer": ("c_custkey",), "orders": ("o_orderkey",),
            "lineitem": ("l_orderkey", "l_linenumber"), "conversations": ("turn_key",)}
    roots = {"customer": t["customer"].filter(F.col("c_acctbal") < -900),
             "conversations": turns.filter(F.col("role") == "system")}
    lost = q.cascade_closure(tables, keys, REFERENCES, roots)
    lost["conversations"] = lost["conversations"].select("turn_key.*")
    parts = [df.select(F.lit(name).alias("table_name"), q.row_key(df.columns).alias("row_key"))
             for name, df in lost.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


CASCADE = """
WITH RECURSIVE gone_turns AS (
  SELECT conv_id, turn FROM conversations WHERE role = 'system'
  UNION
  SELECT c.conv_id, c.turn FROM conversations c
  JOIN gone_turns g ON g.conv_id = c.conv_id AND g.turn = c.turn - 1),
gone_customers AS (SELECT c_custkey FROM customer WHERE c_acctbal < -900),
gone_orders AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (FROM gone_customers))
SELECT 'conversations' AS table_name, conv_id || '|' || turn AS row_key FROM gone_turns
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR) FROM gone_customers
UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR) FROM gone_orders
UNION ALL SELECT DISTINCT 'lineitem', l_orderkey || '|' || l_linenumber
FROM lineitem WHERE l_orderkey IN (FROM gone_orders)
"""


def foreign_key_by_bitmaps(spark, folder):
    """Order numbers of lines whose order is urgent, as numbers missing among the others."""
    t = Star(spark, folder)
    others = t["orders"].filter("o_orderpriority <> '1-URGENT'")
    return missing_keys(t["lineitem"], "l_orderkey", others, "o_orderkey")


FOREIGN_KEY_BY_BITMAPS = """
SELECT l_orderkey, count(*) AS n_rows FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT')
GROUP BY l_orderkey
"""


def distinct_by_bitmaps(spark, folder):
    """Different parts ordered by year and mode, from sets per month that are stored and merged."""
    lines = Star(spark, folder)["lineitem"].select(
        "l_partkey", "l_returnflag", F.date_trunc("month", "l_shipdate").alias("month"))
    sets = materialise(key_set(lines, "l_partkey", ["month", "l_returnflag"]), "part-sets")
    groups = [F.year("month").alias("ship_year"), "l_returnflag"]
    yearly = merged(sets.select(*groups, "bucket", "bits"), ["ship_year", "l_returnflag"])
    return set_sizes(yearly, ["ship_year", "l_returnflag"], "n_parts")


DISTINCT_BY_BITMAPS = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, l_returnflag,
       count(DISTINCT l_partkey) AS n_parts
FROM lineitem GROUP BY 1, 2
"""


def next_event(spark, folder):
    """Every event with the time of the same user's next one; a third of all events are moved
    to a single user."""
    events = Star(spark, folder)["events"].select(
        "event_id", "ts", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(
            F.col("user_id")).alias("user_id"))
    return with_next(events, ["user_id"], ["ts", "event_id"], "ts", "next_ts")


NEXT_EVENT = """
WITH moved AS (
  SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS user_id FROM events)
SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM moved
"""

QUERIES = {"dq_unique": unique, "dq_foreign_key": foreign_key, "dq_not_null": not_null,
           "dq_check": check, "dq_cascade_closure": cascade,
           "dq_foreign_key_bitmaps": foreign_key_by_bitmaps,
           "agg_distinct_bitmaps": distinct_by_bitmaps, "agg_next_event": next_event}

ORACLES = {"dq_unique": UNIQUE, "dq_foreign_key": FOREIGN_KEY, "dq_not_null": NOT_NULL,
           "dq_check": CHECK, "dq_cascade_closure": CASCADE,
           "dq_foreign_key_bitmaps": FOREIGN_KEY_BY_BITMAPS,
           "agg_distinct_bitmaps": DISTINCT_BY_BITMAPS, "agg_next_event": NEXT_EVENT}
