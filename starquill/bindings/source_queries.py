"""Sources and sinks on the test tables.  Written tables go to the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from starquill.bindings.star import LINES, ORDERS, Star, money
from starquill.session import materialise, new_table_path
from starquill.sources import files
from starquill.sources.inline import series, values
from starquill.sources.snapshots import Snapshot

PRIORITIES = [("1-URGENT", 1, "now"), ("2-HIGH", 2, "soon"), ("3-MEDIUM", 3, "soon"),
              ("9-NEVER", 9, "never")]


def inline_values(spark, folder):
    """Orders per label of an inline table; counted per priority before the join."""
    counts = (Star(spark, folder)["orders"].groupBy("o_orderpriority")
              .agg(F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("total")))
    labels = values(spark, PRIORITIES, "priority string, rank int, label string")
    return (labels.join(counts, F.col("priority") == F.col("o_orderpriority"), "left")
            .groupBy("label").agg(F.sum("rank").alias("ranks"),
                                  F.coalesce(F.sum("n"), F.lit(0)).alias("n_orders"),
                                  F.coalesce(F.sum("total"), F.lit(0)).cast("decimal(38,2)")
                                  .alias("total")))


INLINE = f"""
WITH {ORDERS}, labels(priority, rank, label) AS (VALUES
  ('1-URGENT', 1, 'now'), ('2-HIGH', 2, 'soon'), ('3-MEDIUM', 3, 'soon'), ('9-NEVER', 9, 'never'))
SELECT label, CAST(sum(rank) AS BIGINT) AS ranks, CAST(sum(n) AS BIGINT) AS n_orders,
       CAST(coalesce(sum(total), 0) AS DECIMAL(38,2)) AS total
FROM (SELECT priority, rank, label, count(o_orderkey) AS n, sum(amt) AS total
      FROM labels LEFT JOIN ord ON o_orderpriority = priority GROUP BY 1, 2, 3)
GROUP BY label
"""


def series_table(spark, folder, prefix="a_long_row_of_text_no_"):
    """One text row per line of the fact, written as a table and read back."""
    n_rows = Star(spark, folder)["lineitem"].count()
    rows = series(spark, 1, n_rows).select(F.concat(F.lit(prefix), "n").alias("col"))
    table = files.create_table_as(rows, new_table_path(spark, "series"))
    return table.agg(F.count(F.lit(1)).alias("n_rows"), F.min("col").alias("least"),
                     F.max("col").alias("greatest"),
                     F.sum(F.char_length("col")).alias("n_chars"))


SERIES = """
SELECT count(*) AS n_rows, min(col) AS least, max(col) AS greatest,
       CAST(sum(length(col)) AS BIGINT) AS n_chars
FROM (SELECT 'a_long_row_of_text_no_' || n AS col
      FROM range(1, (SELECT count(*) + 1 FROM lineitem)) AS r(n))
"""


def partitioned_fact(spark, folder):
    """Orders stored by month; three of the folders are read back."""
    orders = Star(spark, folder)["orders"].select(
        "o_orderkey", "o_custkey", money("o_totalprice").alias("amt"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    stored = files.write_partitioned(orders, new_table_path(spark, "by-month"), "month",
                                     ["o_orderkey"])
    return stored.filter(F.col("month").between("1997-01", "1997-03"))


PARTITIONED = f"""
WITH {ORDERS}
SELECT o_orderkey, o_custkey, amt, strftime(o_orderdate, '%Y-%m') AS month FROM ord
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-04-01'
"""


def orders_by_month(spark, folder) -> str:
    """Orders in a folder per month; the path."""
    path = new_table_path(spark, "by-month")
    orders = Star(spark, folder)["orders"].select(
        "o_orderkey", "o_custkey", "o_orderpriority", money("o_totalprice").alias("amt"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    files.write_partitioned(orders, path, "month", ["o_orderkey"])
    return path


def months_with(spark, folder):
    """Months and the number of lines shipped in them, as a dimension of the orders."""
    return (Star(spark, folder)["lineitem"].groupBy(
        F.date_format("l_shipdate", "yyyy-MM").alias("month"))
        .agg(F.count(F.lit(1)).alias("n_lines"), F.max("l_quantity").alias("most")))


def pruned_by_dimension(spark, folder):
    """Orders of the months in which the largest single quantity was below 50: which folders to
    read is known when the lines have been counted."""
    stored = spark.read.parquet(orders_by_month(spark, folder))
    quiet = months_with(spark, folder).filter("most < 50 OR n_lines % 3 = 0")
    return (files.pruned_by(stored, quiet, "month").groupBy("month")
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 F.sum("amt").cast("decimal(38,2)").alias("total")))


PRUNED = f"""
WITH {ORDERS}
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n_orders,
       CAST(sum(amt) AS DECIMAL(38,2)) AS total
FROM ord WHERE strftime(o_orderdate, '%Y-%m') IN (
  SELECT strftime(l_shipdate, '%Y-%m') FROM lineitem GROUP BY 1
  HAVING max(l_quantity) < 50 OR count(*) % 3 = 0)
GROUP BY 1
"""


def pinned_snapshot(spark, folder):
    """The first order of every customer is pinned; the orders are then rewritten without
    them.  The snapshot still has the old ones, the table the next."""
    path = files.stage_table(Star(spark, folder)["orders"].select("o_custkey", "o_orderkey"),
                             "orders")
    def first():
        return (spark.read.parquet(path).groupBy("o_custkey")
                .agg(F.min("o_orderkey").alias("o_orderkey")))
    with Snapshot(first(), "first_orders") as pinned:
        left = materialise(spark.read.parquet(path).join(
            pinned.rows(), ["o_custkey", "o_orderkey"], "left_anti"), "orders-left")
        left.write.mode("overwrite").parquet(path)
        now = first().withColumnRenamed("o_orderkey", "next_orderkey")
        return materialise(spark.table("first_orders").join(now, "o_custkey", "left"), "pinned")


PINNED = """
WITH numbered AS (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
  FROM orders)
SELECT a.o_custkey, a.o_orderkey, b.o_orderkey AS next_orderkey
FROM numbered a LEFT JOIN numbered b ON b.o_custkey = a.o_custkey AND b.rn = 2 WHERE a.rn = 1
"""


def projected_table(spark, folder):
    """A projection of the lines written as a table of its own and read back."""
    lines = Star(spark, folder)["lineitem"].select(
        "l_orderkey", "l_linenumber", F.year("l_shipdate").alias("ship_year"),
        (money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)")))
        .cast("decimal(18,4)").alias("net"))
    table = files.create_table_as(lines, new_table_path(spark, "net-lines"))
    return table.groupBy("ship_year").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("net").cast("decimal(38,4)").alias("net"),
        F.sum("l_orderkey").alias("key_sum"), F.max("l_linenumber").alias("most_lines"))


PROJECTED = f"""
WITH {LINES}
SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(*) AS n_lines,
       CAST(sum(CAST(amt * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)))
            AS DECIMAL(38,4)) AS net,
       CAST(sum(l_orderkey) AS BIGINT) AS key_sum, max(l_linenumber) AS most_lines
FROM li GROUP BY 1
"""


QUERIES = {
    "src_projected_ctas": projected_table,
    "src_pruned_by_dimension": pruned_by_dimension,
    "src_pinned_snapshot": pinned_snapshot,
    "src_values": inline_values,
    "src_series_ctas": series_table,
    "src_partitioned_fact": partitioned_fact,
}

ORACLES = {
    "src_projected_ctas": PROJECTED,
    "src_pruned_by_dimension": PRUNED,
    "src_pinned_snapshot": PINNED,
    "src_values": INLINE,
    "src_series_ctas": SERIES,
    "src_partitioned_fact": PARTITIONED,
}
