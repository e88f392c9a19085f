"""Load, update and delete jobs on the test tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starquill.bindings.source_queries import orders_by_month
from starquill.bindings.star import ORDERS, PART_FILMS, Star, money
from starquill.plans import jobs
from starquill.session import materialise, new_table_path
from starquill.sources import files
from starquill.sources.inline import values

MOMENT = dt.datetime(2002, 1, 1, 8)


def before():
    return F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("last_update")


NEW_FILMS = [("RED RING", 2000, " promo"), ("Copper Kettle", 2003, "SMALL"),
             ("copper kettle", 2003, "promo"), ("Blue Bolt", 2099, "large"),
             ("Lost Film", 2001, "no such language")]


def insert_films(spark, folder):
    t = Star(spark, folder)
    film = t.part_films().select("film_id", "title", "release_year", "language_id", before())
    seed = values(spark, NEW_FILMS, "title string, release_year int, language string")
    return jobs.insert_films(film, t.type_languages(), seed, MOMENT).state


INSERT_FILMS = f"""
WITH {PART_FILMS},
seed(title, release_year, language) AS (VALUES
  ('RED RING', 2000, 'PROMO'), ('Copper Kettle', 2003, 'SMALL'), ('Blue Bolt', 2099, 'LARGE')),
fresh AS (SELECT * FROM seed WHERE NOT EXISTS (
  SELECT 1 FROM film WHERE lower(film.title) = lower(seed.title)
                       AND film.release_year = seed.release_year))
SELECT film_id, title, release_year, language_id, TIMESTAMP '2001-01-01 00:00:00' AS last_update
FROM film
UNION ALL
SELECT (SELECT max(film_id) FROM film) + row_number() OVER (ORDER BY title, release_year),
       title, release_year, language, TIMESTAMP '2002-01-01 08:00:00' FROM fresh
"""

CREDITS = [("supplier", "SUPPLIER#000000003", "red ring", None),
           ("Supplier", "Guest 1", "Hot Rod", None), ("supplier", "guest 1", "cold plate", None),
           ("Supplier", "Guest 0", "no such part", None),
           ("Supplier", "Supplier#000000005", "old bolt", 2000)]


def load_bridge(spark, folder):
    t = Star(spark, folder)
    actors = t["supplier"].select(F.col("s_suppkey").alias("actor_id"),
                                  F.lit("Supplier").alias("first_name"),
                                  F.col("s_name").alias("last_name"), before())
    links = t["lineitem"].select(F.col("l_suppkey").alias("actor_id"),
                                 F.col("l_partkey").alias("film_id"), before()).distinct()
    seed = values(spark, CREDITS, "first_name string, last_name string, title string, "
                                  "release_year int")
    return jobs.load_bridge(actors, t.part_films(), links, seed, MOMENT).film_actor


BRIDGE = """
WITH seed(last_name, title, of_year) AS (VALUES
  ('supplier#000000003', 'red ring', NULL), ('guest 1', 'hot rod', NULL),
  ('guest 1', 'cold plate', NULL), ('supplier#000000005', 'old bolt', 2000)),
guests AS (SELECT (SELECT max(s_suppkey) FROM supplier) + 2 AS actor_id, 'guest 1' AS last_name),
people AS (SELECT s_suppkey AS actor_id, lower(s_name) AS last_name FROM supplier
           UNION ALL SELECT * FROM guests),
links AS (SELECT DISTINCT l_suppkey AS actor_id, l_partkey AS film_id FROM lineitem)
SELECT *, TIMESTAMP '2001-01-01 00:00:00' AS last_update FROM links
UNION ALL
SELECT *, TIMESTAMP '2002-01-01 08:00:00' FROM (
  SELECT actor_id, p_partkey FROM seed JOIN people USING (last_name)
  JOIN part ON p_name = title AND (of_year IS NULL OR p_size + 1990 = of_year)
  EXCEPT SELECT * FROM links)
"""


def update_first_active(spark, folder):
    t = Star(spark, folder)
    rentals = t["orders"].select(F.col("o_custkey").alias("customer_id"))
    payments = (t["events"].filter(F.col("event_type") == "purchase")
                .select(F.col("user_id").alias("customer_id")))
    first_address = t.address().agg(F.min("address_id")).scalar()
    return jobs.update_first_active_customer(
        t.customers(), rentals, payments, 10,
        {"last_name": F.lit("Renamed"), "address_id": first_address.cast("int")}).state


UPDATE_FIRST = """
WITH chosen AS (
  SELECT min(k) AS k FROM (
    SELECT o_custkey AS k FROM orders GROUP BY 1 HAVING count(*) >= 10
    INTERSECT
    SELECT user_id FROM events WHERE event_type = 'purchase' GROUP BY 1 HAVING count(*) >= 10))
SELECT c_custkey AS customer_id, 'Customer' AS first_name,
       CASE WHEN c_custkey = k THEN 'Renamed' ELSE c_name END AS last_name,
       CASE WHEN c_custkey = k THEN (SELECT min(n_nationkey) FROM nation)
            ELSE c_nationkey END AS address_id, c_mktsegment AS segment
FROM customer, chosen
"""


def delete_history(spark, folder):
    t = Star(spark, folder)
    payments = t["events"].select(F.col("user_id").alias("customer_id"),
                                  F.col("event_id").alias("payment_id"))
    result = jobs.delete_history(
        t.customers(), F.lower("last_name") == "customer#000000042", payments, t.order_facts())

    def summary(table, state, df, key):
        return df.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.coalesce(F.sum(key), F.lit(0)).alias("key_sum")).select(
            F.lit(table).alias("table_name"), F.lit(state).alias("state"), "n_rows", "key_sum")

    return (summary("payment", "kept", result.payment, "payment_id")
            .unionByName(summary("payment", "deleted", result.deleted_payments, "payment_id"))
            .unionByName(summary("rental", "kept", result.rental, "rental_id"))
            .unionByName(summary("rental", "deleted", result.deleted_rentals, "rental_id")))


DELETE_HISTORY = """
WITH doomed AS (SELECT c_custkey AS k FROM customer WHERE lower(c_name) = 'customer#000000042')
SELECT table_name, state, n_rows, CAST(coalesce(key_sum, 0) AS BIGINT) AS key_sum FROM (
  SELECT 'payment' AS table_name, 'kept' AS state, count(*) AS n_rows, sum(event_id) AS key_sum
  FROM events WHERE user_id NOT IN (SELECT k FROM doomed)
  UNION ALL SELECT 'payment', 'deleted', count(*), sum(event_id)
  FROM events WHERE user_id IN (SELECT k FROM doomed)
  UNION ALL SELECT 'rental', 'kept', count(*), sum(o_orderkey)
  FROM orders WHERE o_custkey NOT IN (SELECT k FROM doomed)
  UNION ALL SELECT 'rental', 'deleted', count(*), sum(o_orderkey)
  FROM orders WHERE o_custkey IN (SELECT k FROM doomed))
"""

WISHES = [
    (1, "RED RING", 1, dt.datetime(2002, 6, 10, 10), dt.datetime(2002, 6, 17, 10)),
    (2, "no such part", 1, dt.datetime(2002, 6, 11, 11), dt.datetime(2002, 6, 25, 11)),
    (2, "Hot Rod", 2, dt.datetime(2002, 6, 11, 11), dt.datetime(2002, 6, 25, 11)),
    (2, "cold plate", 3, dt.datetime(2002, 6, 11, 11), dt.datetime(2002, 6, 25, 11)),
    (3, "old bolt", 1, dt.datetime(2002, 6, 12, 12), dt.datetime(2002, 8, 3, 12, 30)),
]


def rent_and_pay(spark, folder):
    t = Star(spark, folder)
    copies = (t.part_copies().withColumnRenamed("store_id", "s_suppkey")
              .join(t["supplier"].select("s_suppkey", F.col("s_nationkey").alias("store_id")),
                    "s_suppkey").select("inventory_id", "film_id", "store_id"))
    staff = t["customer"].select(F.col("c_custkey").alias("staff_id"),
                                 F.col("c_nationkey").alias("store_id"))
    payer = (t["customer"].filter(F.lower("c_name") == "customer#000000007")
             .select(F.col("c_custkey")).scalar())
    wishes = values(spark, [(*w, w[3] + dt.timedelta(minutes=5)) for w in WISHES],
                    "movie_no int, title string, priority int, rental_date timestamp_ntz, "
                    "return_date timestamp_ntz, payment_date timestamp_ntz")
    done = jobs.rent_and_pay(wishes, payer, t.part_films(), copies, staff,
                             t.line_rentals().select("*", before()), MOMENT)
    paid = done.new_payments.select("rental_id", "amount", "payment_date")
    return done.new_rentals.join(paid, "rental_id").select(
        "rental_id", "inventory_id.*", "customer_id", "staff_id", "rental_date", "return_date",
        "amount", "payment_date", "last_update")


RENT_AND_PAY = f"""
WITH {PART_FILMS}, wish(movie_no, title, priority, rental_date, return_date) AS (VALUES
  (1, 'red ring', 1, TIMESTAMP '2002-06-10 10:00:00', TIMESTAMP '2002-06-17 10:00:00'),
  (2, 'no such part', 1, TIMESTAMP '2002-06-11 11:00:00', TIMESTAMP '2002-06-25 11:00:00'),
  (2, 'hot rod', 2, TIMESTAMP '2002-06-11 11:00:00', TIMESTAMP '2002-06-25 11:00:00'),
  (2, 'cold plate', 3, TIMESTAMP '2002-06-11 11:00:00', TIMESTAMP '2002-06-25 11:00:00'),
  (3, 'old bolt', 1, TIMESTAMP '2002-06-12 12:00:00', TIMESTAMP '2002-08-03 12:30:00')),
picked AS (SELECT DISTINCT ON (movie_no) movie_no, film.*, rental_date, return_date
           FROM wish JOIN film USING (title) ORDER BY movie_no, priority, film_id),
copied AS (SELECT DISTINCT ON (movie_no) picked.*, l_partkey, l_suppkey, s_nationkey
           FROM picked JOIN lineitem ON film_id = l_partkey JOIN supplier ON l_suppkey = s_suppkey
           ORDER BY movie_no, l_suppkey),
fee AS (SELECT *, CAST(ceil(epoch(return_date - rental_date) / 86400.0) AS INTEGER) AS days
        FROM copied)
SELECT (SELECT max(l_orderkey) FROM lineitem) + row_number() OVER (ORDER BY movie_no)
         AS rental_id,
       l_partkey, l_suppkey, CAST(7 AS BIGINT) AS customer_id,
       (SELECT min(c_custkey) FROM customer WHERE c_nationkey = s_nationkey) AS staff_id,
       rental_date, return_date,
       CAST(CASE WHEN days <= rental_duration THEN rental_rate
                 ELSE rental_rate + (days - rental_duration) * rental_rate END
            AS DECIMAL(5,2)) AS amount,
       rental_date + INTERVAL 5 MINUTE AS payment_date,
       TIMESTAMP '2002-01-01 08:00:00' AS last_update
FROM fee
"""


def open_and_close(spark, folder):
    rentals = Star(spark, folder)["orders"].select(
        F.col("o_orderkey").alias("rental_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("rental_date"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("return_date"), before())
    start, end = dt.datetime(2002, 1, 5, 9), dt.datetime(2002, 1, 7, 18, 30)
    opened = jobs.open_rental_like_first(rentals, start, start)
    return jobs.close_newest_rental(opened.state, end, end).state


OPEN_CLOSE = """
SELECT o_orderkey AS rental_id, o_custkey AS customer_id, o_orderdate AS rental_date,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS return_date,
       TIMESTAMP '2001-01-01 00:00:00' AS last_update
FROM orders
UNION ALL
SELECT (SELECT max(o_orderkey) + 1 FROM orders), o_custkey, TIMESTAMP '2002-01-05 09:00:00',
       TIMESTAMP '2002-01-07 18:30:00', TIMESTAMP '2002-01-07 18:30:00'
FROM orders WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders)
"""


def _accounts(t):
    """Customers, and a batch from the suppliers that is partly new: every twentieth key,
    each supplier given twice."""
    target = t["customer"].select(F.col("c_custkey").alias("customer_id"),
                                  F.col("c_name").alias("name"),
                                  F.col("c_nationkey").alias("nation_id"))
    once = t["supplier"].select((F.col("s_suppkey") * 20).alias("customer_id"),
                                F.col("s_name").alias("name"),
                                F.col("s_nationkey").alias("nation_id"))
    again = once.select("customer_id", F.concat("name", F.lit(" again")).alias("name"),
                        F.lit(None).cast("int").alias("nation_id"))
    return target, once.unionByName(again)


def upsert_ignore(spark, folder):
    target, batch = _accounts(Star(spark, folder))
    return jobs.upsert_ignore(target, batch, ["customer_id"], ["name"]).state


def upsert_ignore_any(spark, folder):
    """Ids and names are both unique: a supplier comes with an id that may be taken, again
    under that id, and under its name with another id."""
    t = Star(spark, folder)
    target, _ = _accounts(t)
    offers = [(F.col("s_suppkey") * 20, F.col("s_name")),
              (F.col("s_suppkey") * 20, F.concat("s_name", F.lit(" again"))),
              (-1 - F.col("s_suppkey"), F.col("s_name"))]
    batch = reduce(DataFrame.unionByName, [
        t["supplier"].select(F.lit(i).alias("turn"), key.alias("customer_id"), name.alias("name"),
                             F.col("s_nationkey").alias("nation_id"))
        for i, (key, name) in enumerate(offers)])
    return jobs.upsert_ignore_any(target, batch, [["customer_id"], ["name"]],
                                  ["turn", "customer_id"]).state.drop("turn")


UPSERT_IGNORE_ANY = """
SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS nation_id FROM customer
UNION ALL
SELECT CASE WHEN s_suppkey * 20 IN (SELECT c_custkey FROM customer) THEN -1 - s_suppkey
            ELSE s_suppkey * 20 END, s_name, s_nationkey
FROM supplier
"""


def append_and_truncate(spark, folder):
    """Open orders appended to a stored table of the others, and the table emptied."""
    orders = Star(spark, folder)["orders"]
    path = files.stage_table(orders.filter("o_orderstatus <> 'O'"), "orders")
    files.append_rows(orders.filter("o_orderstatus = 'O'"), path)
    stored = spark.read.parquet(path)
    emptied = spark.read.parquet(files.stage_table(files.truncate(stored), "emptied"))
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n_rows"),
               F.coalesce(F.sum("o_orderkey"), F.lit(0)).alias("key_sum"),
               F.min("o_orderdate").alias("first_date"))
        .withColumn("state", F.lit(state))
        for state, df in (("appended", stored), ("truncated", emptied))])


APPEND_TRUNCATE = """
SELECT 'appended' AS state, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
       min(o_orderdate) AS first_date FROM orders
UNION ALL SELECT 'truncated', 0, 0, NULL
"""


def upsert_update(spark, folder):
    target, batch = _accounts(Star(spark, folder))
    return jobs.upsert_update(target, batch, ["customer_id"], ["name", "nation_id"],
                              [F.desc("name")]).state


UPSERT_IGNORE = """
SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS nation_id FROM customer
UNION ALL SELECT s_suppkey * 20, s_name, s_nationkey FROM supplier
WHERE s_suppkey * 20 NOT IN (SELECT c_custkey FROM customer)
"""

UPSERT_UPDATE = """
SELECT coalesce(c_custkey, s_suppkey * 20) AS customer_id,
       CASE WHEN s_suppkey IS NULL THEN c_name ELSE s_name || ' again' END AS name,
       CASE WHEN s_suppkey IS NULL THEN c_nationkey END AS nation_id
FROM customer FULL JOIN supplier ON c_custkey = s_suppkey * 20
"""


def assign_ids(spark, folder):
    t = Star(spark, folder)
    new = t["supplier"].select(F.col("s_name").alias("name"),
                               F.col("s_nationkey").alias("nation_id"))
    target = t["customer"].select(F.col("c_custkey").alias("customer_id"))
    return jobs.assign_ids(new, target, "customer_id", ["nation_id", "name"])


ASSIGN_IDS = """
SELECT (SELECT max(c_custkey) FROM customer)
       + row_number() OVER (ORDER BY s_nationkey, s_name) AS customer_id,
       s_name AS name, s_nationkey AS nation_id
FROM supplier
"""

CANDIDATES = [(1, " Copper Kettle ", 2003, "promo"), (2, "  ", 2003, "promo"),
              (3, "Tin Whistle", None, "promo"), (4, "Tin Whistle", 1899, "promo"),
              (5, "Tin Whistle", 2004, " "), (6, "RED ring", 2004, "promo"),
              (7, "copper KETTLE", 2005, "small"), (8, "Brass Lamp", 2155, " Klingon "),
              (9, "Iron Door", 1901, "KLINGON"), (10, "Paper Moon", 2006, "Elvish")]


def new_entity(spark, folder):
    t = Star(spark, folder)
    film = t.part_films().select("film_id", "title", "release_year", before())
    rows = values(spark, CANDIDATES,
                  "line_no int, title string, release_year int, language string")
    done = jobs.add_films(film, t.numbered_languages(), rows, moment=MOMENT)
    good = done.accepted.select("line_no", "title", "film_id", "language_id",
                                F.lit("accepted").alias("outcome"), "last_update")
    bad = done.rejected.select("line_no", "title", F.lit(None).cast("long").alias("film_id"),
                               F.lit(None).cast("long").alias("language_id"),
                               F.col("reason").alias("outcome"),
                               F.lit(None).cast("timestamp_ntz").alias("last_update"))
    return good.unionByName(bad)


NEW_ENTITY = """
WITH top AS (SELECT (SELECT max(p_partkey) FROM part) AS f,
                    (SELECT max(k) FROM (SELECT min(p_partkey) AS k FROM part GROUP BY p_type))
                      AS l,
                    (SELECT min(p_partkey) FROM part WHERE p_type = 'PROMO') AS promo)
SELECT *, CASE outcome WHEN 'accepted' THEN TIMESTAMP '2002-01-01 08:00:00' END AS last_update
FROM (
SELECT 1 AS line_no, 'Copper Kettle' AS title, f + 1 AS film_id, promo AS language_id,
       'accepted' AS outcome FROM top
UNION ALL SELECT 8, 'Brass Lamp', f + 2, l + 2, 'accepted' FROM top
UNION ALL SELECT 9, 'Iron Door', f + 3, l + 2, 'accepted' FROM top
UNION ALL SELECT 10, 'Paper Moon', f + 4, l + 1, 'accepted' FROM top
UNION ALL SELECT 2, '  ', NULL, NULL, 'blank title'
UNION ALL SELECT 3, 'Tin Whistle', NULL, NULL, 'no year'
UNION ALL SELECT 4, 'Tin Whistle', NULL, NULL, 'year out of range'
UNION ALL SELECT 5, 'Tin Whistle', NULL, NULL, 'blank language'
UNION ALL SELECT 6, 'RED ring', NULL, NULL, 'title exists'
          WHERE EXISTS (SELECT 1 FROM part WHERE p_name = 'red ring')
UNION ALL SELECT 7, 'copper KETTLE', NULL, NULL, 'title exists')
"""


def audit_column(spark, folder):
    orders = Star(spark, folder)["orders"].select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("date"))
        .alias("record_ts"), F.col("o_orderdate").alias("last_update"))
    filled = jobs.with_audit_column(orders, dt.date(2002, 1, 1))
    return jobs.stamp_changed(filled, F.col("record_ts") == F.lit(dt.date(2002, 1, 1)),
                              dt.datetime(2002, 1, 1, 8))


AUDIT = """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE)
            ELSE DATE '2002-01-01' END AS record_ts,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate
            ELSE TIMESTAMP '2002-01-01 08:00:00' END AS last_update
FROM orders
"""


def token_index(spark, folder):
    return jobs.token_index(Star(spark, folder)["documents"], "doc_id", "text")


TOKENS = r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{M}]+'),
                             lambda w : w <> '') AS terms
  FROM documents)
SELECT term, doc_id, count(*) AS occurrences, CAST(min(position) AS INTEGER) AS first_position
FROM (SELECT doc_id, unnest(terms) AS term, generate_subscripts(terms, 1) AS position FROM words)
GROUP BY 1, 2
"""

PREFIX = "a_long_row_of_text_no_"


def delete_modulo(spark, folder):
    """Delete the rows whose number, read back from the text, divides by three."""
    rows = Star(spark, folder)["orders"].withColumn("col", F.concat(F.lit(PREFIX), "o_orderkey"))
    number = F.replace("col", F.lit(PREFIX), F.lit("")).cast("long")
    kept = files.stage_table(files.delete_where(rows, number % 3 == 0), "kept-orders")
    return spark.read.parquet(kept).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(number).alias("number_sum"))


DELETE_MODULO = """
SELECT count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS number_sum
FROM orders WHERE NOT (o_orderkey % 3 = 0)
"""


def delete_by_folder(spark, folder):
    """Urgent orders of odd months deleted from orders stored by month, and the first month
    emptied; the other folders keep their files."""
    path = orders_by_month(spark, folder)

    def names():
        found = files.table_files(spark, path).select(
            F.substring_index("path", "/", -2).alias("file"))
        return found.withColumn("month", F.regexp_extract("file", "month=([^/]*)", 1))
    before = materialise(names(), "files-before")
    first = spark.read.parquet(path).agg(F.min("month")).first()[0]
    odd = F.substring("month", 6, 2).cast("int") % 2 == 1
    done = files.delete_where_by_folder(
        spark, path, (F.col("month") == first) | (odd & (F.col("o_orderpriority") == "1-URGENT")),
        "month")
    kept = before.join(names(), "file", "left_semi").groupBy("month").agg(
        F.count(F.lit(1)).alias("n"))
    same = before.groupBy("month").agg(F.count(F.lit(1)).alias("n")).join(
        kept, ["month", "n"], "left_semi").select("month", F.lit(True).alias("files_kept"))
    rows = spark.read.parquet(path).groupBy("month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amt").cast("decimal(38,2)").alias("total"))
    return rows.join(same, "month", "left").select(
        "month", "n_rows", "total", F.coalesce("files_kept", F.lit(False)).alias("files_kept"),
        F.lit(len(done.removed)).cast("long").alias("n_removed"))


DELETE_BY_FOLDER = f"""
WITH {ORDERS}, dated AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM ord),
doomed AS (
  SELECT *, month = (SELECT min(month) FROM dated) OR (
              month(o_orderdate) % 2 = 1 AND o_orderpriority = '1-URGENT') AS gone FROM dated),
folders AS (SELECT month, bool_or(gone) AS hit, bool_and(gone) AS emptied FROM doomed GROUP BY 1)
SELECT month, count(*) AS n_rows, CAST(sum(amt) AS DECIMAL(38,2)) AS total,
       NOT hit AS files_kept, (SELECT count(*) FROM folders WHERE emptied) AS n_removed
FROM doomed JOIN folders USING (month) WHERE NOT gone GROUP BY month, hit
"""


def compact(spark, folder):
    """Orders in many files below a folder per month, rewritten to few; rows and folders stay."""
    source = new_table_path(spark, "scattered")
    orders = Star(spark, folder)["orders"].withColumns(
        {"amt": money("o_totalprice"), "month": F.month("o_orderdate")})
    orders.repartition(24, "o_orderkey").write.partitionBy("month").parquet(source)
    target = files.compact(spark, source, "compacted", partition=["month"])
    fewer = files.table_files(spark, target).count() < files.table_files(spark, source).count()
    return spark.read.parquet(target).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amt").cast("decimal(38,2)").alias("total"),
        F.count_if(F.col("month") == F.month("o_orderdate")).alias("in_place")
    ).withColumn("fewer_files", F.lit(fewer))


COMPACT = f"""
WITH {ORDERS}
SELECT count(*) AS n_rows, CAST(sum(amt) AS DECIMAL(38,2)) AS total,
       count(o_orderdate) AS in_place, true AS fewer_files FROM ord
"""


def seed_load(spark, folder):
    """Replies loaded with the turn they answer; opening system turns are there already."""
    turns = Star(spark, folder)["conversations"]
    loaded = turns.filter(F.col("role") == "system").select(
        "conv_id", "turn", F.lit(None).cast("long").alias("parent_turn"))
    seed = turns.select("conv_id", "turn", (F.col("turn") - 1).alias("answers"))
    parent = jobs.Lookup(turns, {"conv_id": "conv_id", "turn": "answers"},
                         {"turn": "parent_turn"})
    return jobs.load_through_lookups(seed, [parent], loaded, ["conv_id", "turn"]).state


SEED_LOAD = """
SELECT conv_id, turn, CAST(NULL AS BIGINT) AS parent_turn FROM conversations
WHERE role = 'system'
UNION ALL
SELECT c.conv_id, c.turn, p.turn FROM conversations c
JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1
WHERE c.role <> 'system'
"""


def natural_key_load(spark, folder):
    """Line facts given by names: supplier, nation and part found through their names."""
    t = Star(spark, folder)
    seed = (t["lineitem"].join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
            .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_name").alias("supplier_name"), F.col("n_name").alias("nation_name"),
                    F.year("l_shipdate").alias("ship_year")).distinct())
    target = values(spark, [], "link_id long, supplier_id long, nation_id int, ship_year int")
    lookups = [jobs.Lookup(t["supplier"], {"s_name": "supplier_name"},
                           {"s_suppkey": "supplier_id"}),
               jobs.Lookup(t["nation"], {"n_name": "nation_name"}, {"n_nationkey": "nation_id"})]
    return jobs.load_through_lookups(seed, lookups, target, ["supplier_id", "ship_year"],
                                     "link_id").state


NATURAL_KEY_LOAD = """
SELECT row_number() OVER (ORDER BY l_suppkey, ship_year) AS link_id, l_suppkey AS supplier_id,
       s_nationkey AS nation_id, ship_year
FROM (SELECT DISTINCT l_suppkey, s_nationkey, CAST(year(l_shipdate) AS INTEGER) AS ship_year
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
"""

def _two_states(t):
    """Orders as they are, with an update time; and a later state: urgent ones are gone, those of
    customers whose number divides by 7 have another status or lose it, and new ones came."""
    old = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", money("o_totalprice")
                             .alias("amt"), F.col("o_orderdate").alias("last_update"))
    left = t["orders"].filter("o_orderpriority <> '1-URGENT'").select("o_orderkey").join(
        old, "o_orderkey")
    seven = F.col("o_custkey") % 7 == 0
    changed = left.withColumn("o_orderstatus", F.when(
        seven & (F.col("o_orderstatus") == "O"), F.lit(None)).when(
        seven, "X").otherwise(F.col("o_orderstatus")))
    came = old.filter("o_orderstatus = 'P'").withColumn(
        "o_orderkey", -1 - F.col("o_orderkey")).withColumn("last_update", F.lit(None).cast("timestamp_ntz"))
    return old, changed.unionByName(came)


STATES = f"""
{ORDERS},
old_state AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, amt, o_orderdate AS last_update, o_orderpriority
  FROM ord),
new_state AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 7 = 0 AND o_orderstatus = 'O' THEN NULL
                                     WHEN o_custkey % 7 = 0 THEN 'X' ELSE o_orderstatus END
         AS o_orderstatus, amt, last_update
  FROM old_state WHERE o_orderpriority <> '1-URGENT'
  UNION ALL
  SELECT -1 - o_orderkey, o_custkey, o_orderstatus, amt, NULL FROM old_state WHERE o_orderstatus = 'P'),
changes AS (
  SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
         CASE WHEN o.o_orderkey IS NULL THEN 'inserted' WHEN n.o_orderkey IS NULL THEN 'deleted'
              ELSE 'updated' END AS change,
         CASE WHEN n.o_orderkey IS NULL THEN o.o_orderstatus ELSE n.o_orderstatus END
           AS o_orderstatus
  FROM old_state o FULL JOIN new_state n ON o.o_orderkey = n.o_orderkey
  WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL
     OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus)"""


def state_changes(spark, folder):
    return jobs.compare_states(*_two_states(Star(spark, folder)), ["o_orderkey"]).select(
        "o_orderkey", "o_orderstatus", "change")


STATE_CHANGES = f"WITH {STATES} SELECT * FROM changes"


def stamp_changes(spark, folder):
    return jobs.stamp_changes(*_two_states(Star(spark, folder)), ["o_orderkey"], MOMENT).state


STAMP_CHANGES = f"""
WITH {STATES}
SELECT n.o_orderkey, o_custkey, n.o_orderstatus, amt,
       CASE WHEN change IS NULL THEN last_update ELSE TIMESTAMP '2002-01-01 08:00:00' END
         AS last_update
FROM new_state n LEFT JOIN changes c ON c.o_orderkey = n.o_orderkey
"""


def _shown(entries):
    return F.array_join(F.transform(entries, lambda e: F.concat(
        e["term"], F.lit(":"), F.array_join(e["positions"].cast("array<string>"), ","))), " ")


def token_vectors(spark, folder):
    vectors = jobs.token_vectors(Star(spark, folder)["documents"], "doc_id", "text")
    return vectors.select("doc_id", F.size("vector").alias("n_terms"),
                          _shown("vector").alias("vector"))


TERMS = r"""words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}]+'),
                             lambda w : w <> '') AS terms
  FROM documents),
places AS (SELECT doc_id, unnest(terms) AS term, generate_subscripts(terms, 1) AS place FROM words),
entries AS (
  SELECT doc_id, term, string_agg(place, ',' ORDER BY place) AS places
  FROM places GROUP BY doc_id, term)"""

TOKEN_VECTORS = f"""
WITH {TERMS}
SELECT doc_id, CAST(count(term) AS INTEGER) AS n_terms,
       coalesce(string_agg(term || ':' || places, ' ' ORDER BY term), '') AS vector
FROM words LEFT JOIN entries USING (doc_id) GROUP BY doc_id
"""


def token_index_merge(spark, folder):
    """Postings of the documents of all sources but one, kept as a table, after those of that one
    came and French ones were taken out."""
    documents = Star(spark, folder)["documents"]
    last = documents.agg(F.max("source")).scalar()
    held = materialise(jobs.postings_of(jobs.token_vectors(
        documents.filter(F.col("source") < last), "doc_id", "text"), "doc_id"), "postings")
    came = documents.filter((F.col("source") == last) | (F.col("lang") == "fr")).withColumn(
        "text", F.when(F.col("lang") != "fr", F.col("text")))
    merged = jobs.merge_postings(held, jobs.token_vectors(came, "doc_id", "text"), "doc_id")
    return merged.groupBy("term").agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.sum(F.size("positions")).cast("long").alias("n_occurrences"),
        F.min("doc_id").alias("first_document"), F.max(F.get("positions", F.lit(0))).alias("latest_start"))


TOKEN_INDEX_MERGE = f"""
WITH {TERMS}
SELECT term, count(DISTINCT doc_id) AS n_documents, count(*) AS n_occurrences,
       min(doc_id) AS first_document,
       CAST(max(first_place) AS INTEGER) AS latest_start
FROM (SELECT term, doc_id, min(place) OVER (PARTITION BY term, doc_id) AS first_place
      FROM places JOIN documents USING (doc_id)
      WHERE source IS NOT NULL AND (lang IS NULL OR lang <> 'fr'))
GROUP BY term
"""

QUERIES = {
    "job_insert_if_absent": insert_films,
    "job_bridge_load": load_bridge,
    "job_conditional_update": update_first_active,
    "job_delete_children": delete_history,
    "job_rent_and_pay": rent_and_pay,
    "job_open_close": open_and_close,
    "job_upsert_ignore": upsert_ignore,
    "job_upsert_ignore_any": upsert_ignore_any,
    "job_upsert_update": upsert_update,
    "job_append_truncate": append_and_truncate,
    "job_assign_ids": assign_ids,
    "job_new_entity": new_entity,
    "job_audit_column": audit_column,
    "job_token_index": token_index,
    "job_token_vectors": token_vectors,
    "job_token_index_merge": token_index_merge,
    "job_state_changes": state_changes,
    "job_stamp_changes": stamp_changes,
    "job_delete_by_folder": delete_by_folder,
    "job_delete_modulo": delete_modulo,
    "job_compact": compact,
    "job_seed_load": seed_load,
    "job_seed_load_ids": natural_key_load,
}

ORACLES = {
    "job_insert_if_absent": INSERT_FILMS,
    "job_bridge_load": BRIDGE,
    "job_conditional_update": UPDATE_FIRST,
    "job_delete_children": DELETE_HISTORY,
    "job_rent_and_pay": RENT_AND_PAY,
    "job_open_close": OPEN_CLOSE,
    "job_upsert_ignore": UPSERT_IGNORE,
    "job_upsert_ignore_any": UPSERT_IGNORE_ANY,
    "job_upsert_update": UPSERT_UPDATE,
    "job_append_truncate": APPEND_TRUNCATE,
    "job_assign_ids": ASSIGN_IDS,
    "job_new_entity": NEW_ENTITY,
    "job_audit_column": AUDIT,
    "job_token_index": TOKENS,
    "job_token_vectors": TOKEN_VECTORS,
    "job_token_index_merge": TOKEN_INDEX_MERGE,
    "job_state_changes": STATE_CHANGES,
    "job_stamp_changes": STAMP_CHANGES,
    "job_delete_by_folder": DELETE_BY_FOLDER,
    "job_delete_modulo": DELETE_MODULO,
    "job_compact": COMPACT,
    "job_seed_load": SEED_LOAD,
    "job_seed_load_ids": NATURAL_KEY_LOAD,
}
