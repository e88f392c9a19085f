"""Predicates, joins, picks and scalar functions on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starquill.bindings.star import PART_FILMS, Star, money
from starquill.functions import scalars as sc
from starquill.operators.rows import first_per_key, pick_random
from starquill.plans.jobs import insert_copies


def membership(spark, folder):
    part = Star(spark, folder)["part"]
    listed = F.col("p_brand").isin("Brand#2", "Brand#7", "Brand#11")
    pairs = ((F.col("p_type") == "PROMO") & (F.col("p_size") < 10)) | (
        (F.col("p_type") == "SMALL") & F.col("p_size").between(40, 45))
    return part.filter(listed | pairs).select("p_partkey", "p_brand", "p_type", "p_size")


MEMBERSHIP = """
SELECT p_partkey, p_brand, p_type, p_size FROM part
WHERE p_brand IN ('Brand#2', 'Brand#7', 'Brand#11')
   OR (p_type = 'PROMO' AND p_size < 10) OR (p_type = 'SMALL' AND p_size BETWEEN 40 AND 45)
"""


def null_blank(spark, folder):
    note = (F.when(F.col("c_mktsegment") == "MACHINERY", "").when(
        F.col("c_mktsegment") == "FURNITURE", "  ").when(
        F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")))
    rows = Star(spark, folder)["customer"].select("c_nationkey", note.alias("note"))
    return rows.groupBy("c_nationkey").agg(
        F.count_if(F.col("note").isNull()).alias("n_null"),
        F.count_if(F.col("note").isNotNull()).alias("n_present"),
        F.count_if(F.col("note") == "").alias("n_empty"),
        F.count_if(sc.is_blank(F.col("note"))).alias("n_blank"),
        F.count(F.nullif(F.btrim("note"), F.lit(""))).alias("n_filled"),
        F.max(F.coalesce("note", F.lit("-"))).alias("greatest_note"))


NULL_BLANK = """
WITH rows AS (
  SELECT c_nationkey, CASE c_mktsegment WHEN 'MACHINERY' THEN '' WHEN 'FURNITURE' THEN '  '
                                        WHEN 'BUILDING' THEN NULL ELSE c_mktsegment END AS note
  FROM customer)
SELECT c_nationkey, count(*) FILTER (note IS NULL) AS n_null, count(note) AS n_present,
       count(*) FILTER (note = '') AS n_empty,
       count(*) FILTER (note IS NULL OR trim(note) = '') AS n_blank,
       count(nullif(trim(note), '')) AS n_filled, max(coalesce(note, '-')) AS greatest_note
FROM rows GROUP BY c_nationkey
"""


def role_playing(spark, folder):
    """Lines per pair of customer nation and supplier nation.

    Lines are counted per pair of keys first; the nation table joins twice to the counts.
    """
    t = Star(spark, folder)
    counts = (t["lineitem"].select("l_orderkey", "l_suppkey")
              .join(t["supplier"].select("s_suppkey", "s_nationkey"),
                    F.col("l_suppkey") == F.col("s_suppkey"))
              .join(t["orders"].select("o_orderkey", "o_custkey"),
                    F.col("l_orderkey") == F.col("o_orderkey"))
              .join(t["customer"].select("c_custkey", "c_nationkey"),
                    F.col("o_custkey") == F.col("c_custkey"))
              .groupBy("c_nationkey", "s_nationkey").agg(F.count(F.lit(1)).alias("n_lines")))
    buyer, seller = t["nation"].alias("buyer"), t["nation"].alias("seller")
    return (counts.join(buyer, F.col("c_nationkey") == F.col("buyer.n_nationkey"))
            .join(seller, F.col("s_nationkey") == F.col("seller.n_nationkey"), "left")
            .select(F.col("buyer.n_name").alias("buyer_nation"),
                    F.col("seller.n_name").alias("seller_nation"), "n_lines"))


ROLE_PLAYING = """
SELECT b.n_name AS buyer_nation, s.n_name AS seller_nation, count(*) AS n_lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation b ON c_nationkey = b.n_nationkey
LEFT JOIN nation s ON s_nationkey = s.n_nationkey GROUP BY 1, 2
"""


def single_row_cross(spark, folder):
    """Stock all parts of three brands at the supplier with the highest balance."""
    t = Star(spark, folder)
    films = t.part_films().join(
        t["part"].filter(F.col("p_brand").isin("Brand#2", "Brand#7", "Brand#11"))
        .select(F.col("p_partkey").alias("film_id")), "film_id", "left_semi")
    chosen = (t["supplier"].orderBy(F.desc("s_acctbal"), "s_suppkey").limit(1)
              .select("s_suppkey").scalar())
    stock = t.part_copies().select("film_id", "store_id")
    return insert_copies(stock, films, chosen).changed


SINGLE_ROW = """
SELECT p_partkey AS film_id, s_suppkey AS store_id
FROM part CROSS JOIN (SELECT s_suppkey FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 1)
WHERE p_brand IN ('Brand#2', 'Brand#7', 'Brand#11')
  AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_suppkey = s_suppkey)
"""


def first_per_type(spark, folder):
    part = Star(spark, folder)["part"]
    return first_per_key(part, ["p_brand", "p_type"], ["p_retailprice", "p_partkey"]).select(
        "p_brand", "p_type", "p_partkey", "p_retailprice")


FIRST_PER_TYPE = """
SELECT p_brand, p_type, p_partkey, p_retailprice FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand, p_type
            ORDER BY p_retailprice, p_partkey) AS rn FROM part) WHERE rn = 1
"""


def random_pick(spark, folder):
    return pick_random(Star(spark, folder)["supplier"], seed=7, key="s_suppkey").select(
        "s_suppkey", "s_name")


RANDOM_PICK = """
SELECT s_suppkey, s_name FROM supplier ORDER BY sha256(s_suppkey || ':7'), s_suppkey LIMIT 1
"""


def strings(spark, folder):
    return Star(spark, folder)["part"].select(
        "p_partkey", F.upper("p_name").alias("upper_name"), F.lower("p_type").alias("lower_type"),
        F.btrim(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("trimmed"),
        F.concat("p_name", F.lit("/"), F.when(F.col("p_type") != "PROMO", F.col("p_type")))
        .alias("joined"),
        F.substring("p_brand", 7, 4).alias("brand_no"),
        F.locate("ring", F.col("p_name")).alias("ring_at"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("B")).alias("short_brand"),
        sc.name_slug("client_", F.col("p_name"), F.col("p_brand")).alias("slug"),
        F.format_string("Part %s of %s", "p_name", "p_brand").alias("formatted"))


STRINGS = """
SELECT p_partkey, upper(p_name) AS upper_name, lower(p_type) AS lower_type,
       trim('  ' || p_brand || ' ') AS trimmed,
       p_name || '/' || CASE WHEN p_type <> 'PROMO' THEN p_type END AS joined,
       substring(p_brand, 7, 4) AS brand_no, CAST(strpos(p_name, 'ring') AS INTEGER) AS ring_at,
       replace(p_brand, 'Brand#', 'B') AS short_brand,
       regexp_replace(lower('client_' || p_name || '_' || p_brand), '[^a-zA-Z0-9]+', '_', 'g')
         AS slug,
       'Part ' || p_name || ' of ' || p_brand AS formatted
FROM part
"""


def maths(spark, folder):
    quantity = F.col("l_quantity").cast("int")
    price, discount = money("l_extendedprice"), F.col("l_discount").cast("decimal(4,2)")
    net = (price * (1 - discount)).cast("decimal(18,4)")
    return (Star(spark, folder)["lineitem"]
            .groupBy("l_returnflag", "l_linestatus").agg(
                F.sum(net).cast("decimal(38,4)").alias("net"),
                F.round(F.sum(net), 2).cast("decimal(38,2)").alias("net_rounded"),
                F.sum(F.ceil(price / 100)).cast("long").alias("hundreds"),
                F.sum(F.greatest(quantity - 25, F.lit(0))).alias("above_25"),
                F.sum(F.least(quantity, F.lit(25))).alias("up_to_25"),
                F.sum(-quantity % 7).alias("rest"),
                F.sum(F.pow(quantity, F.lit(2)).cast("long")).alias("squares")))


MATHS = """
SELECT l_returnflag, l_linestatus, CAST(sum(net) AS DECIMAL(18,4)) AS net,
       CAST(round(sum(net), 2) AS DECIMAL(38,2)) AS net_rounded,
       CAST(sum(ceil(price / 100)) AS BIGINT) AS hundreds,
       CAST(sum(greatest(q - 25, 0)) AS BIGINT) AS above_25,
       CAST(sum(least(q, 25)) AS BIGINT) AS up_to_25,
       CAST(sum(-q % 7) AS BIGINT) AS rest, CAST(sum(q ** 2) AS BIGINT) AS squares
FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q,
             CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
             CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                  AS DECIMAL(18,4)) AS net
      FROM lineitem)
GROUP BY 1, 2
"""


def dates(spark, folder):
    day = F.col("o_orderdate")
    as_of = F.lit("2002-02-28 12:00:00").cast("timestamp_ntz")
    return Star(spark, folder)["orders"].select(
        "o_orderkey", F.year(day).alias("y"), F.quarter(day).alias("q"),
        sc.whole_days(day, as_of).alias("days_up"),
        sc.fractional_days(day, as_of).alias("days_exact"),
        F.date_trunc("quarter", day).cast("timestamp_ntz").alias("quarter_start"),
        (F.date_trunc("month", day).cast("timestamp_ntz") + F.expr("INTERVAL 3 MONTHS"))
        .alias("three_months_on"),
        F.add_months(day.cast("date"), -1).alias("month_before"),
        F.make_date(F.year(day), F.lit(2), F.lit(1)).alias("first_of_february"),
        F.last_day(day).alias("month_end"),
        F.date_format(day, "yyyy-MM-dd HH:mm:ss").alias("printed"),
        day.cast("date").alias("d"),
        (day >= F.lit("1998-09-02").cast("timestamp_ntz")).alias("is_late"))


DATES = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y,
       CAST(quarter(o_orderdate) AS INTEGER) AS q,
       CAST(ceil(epoch(TIMESTAMP '2002-02-28 12:00:00' - o_orderdate) / 86400.0) AS INTEGER)
         AS days_up,
       epoch(TIMESTAMP '2002-02-28 12:00:00' - o_orderdate) / 86400.0 AS days_exact,
       CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP) AS quarter_start,
       date_trunc('month', o_orderdate) + INTERVAL 3 MONTH AS three_months_on,
       CAST(o_orderdate - INTERVAL 1 MONTH AS DATE) AS month_before,
       make_date(year(o_orderdate), 2, 1) AS first_of_february,
       last_day(o_orderdate) AS month_end,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS printed,
       CAST(o_orderdate AS DATE) AS d, o_orderdate >= TIMESTAMP '1998-09-02' AS is_late
FROM orders
"""


def arrays(spark, folder):
    words = F.array("p_brand", "p_type", F.when(F.col("p_size") > 25, F.col("p_name")))
    return (Star(spark, folder)["part"]
            .select("p_partkey", F.size(words).alias("n_items"),
                    F.posexplode(words).alias("at", "item"))
            .select("p_partkey", "n_items", (F.col("at") + 1).alias("ordinal"), "item"))


ARRAYS = """
SELECT p_partkey, CAST(3 AS INTEGER) AS n_items, CAST(ordinal AS INTEGER) AS ordinal, item
FROM (SELECT p_partkey, unnest([1, 2, 3]) AS ordinal,
             unnest([p_brand, p_type, CASE WHEN p_size > 25 THEN p_name END]) AS item FROM part)
"""


def label_rates(spark, folder):
    """Late fee and label of every film for a stay of 12 days."""
    days = F.lit(12)
    return Star(spark, folder).part_films().select(
        "film_id", sc.audience_label(F.col("rating")).alias("audience"),
        sc.late_fee_amount(days, F.col("rental_duration"), F.col("rental_rate")).alias("amount"))


LABEL_RATES = f"""
WITH {PART_FILMS}
SELECT film_id,
       CASE rating WHEN 'G' THEN 'All ages' WHEN 'PG' THEN 'Parental guidance suggested'
            WHEN 'PG-13' THEN '13+ (parents strongly cautioned)'
            WHEN 'R' THEN 'Under 17 requires accompanying parent/adult guardian'
            ELSE 'Unknown' END AS audience,
       CAST(CASE WHEN 12 <= rental_duration THEN rental_rate
                 ELSE rental_rate + (12 - rental_duration) * rental_rate END
            AS DECIMAL(5,2)) AS amount
FROM film
"""

QUERIES = {
    "flt_membership_or": membership,
    "flt_null_blank": null_blank,
    "jn_role_playing": role_playing,
    "jn_single_row_cross": single_row_cross,
    "win_first_per_key": first_per_type,
    "srt_random_pick": random_pick,
    "sc_strings": strings,
    "sc_math": maths,
    "sc_dates": dates,
    "sc_arrays": arrays,
    "sc_case_labels": label_rates,
}

ORACLES = {
    "srt_random_pick": RANDOM_PICK,
    "flt_membership_or": MEMBERSHIP,
    "flt_null_blank": NULL_BLANK,
    "jn_role_playing": ROLE_PLAYING,
    "jn_single_row_cross": SINGLE_ROW,
    "win_first_per_key": FIRST_PER_TYPE,
    "sc_strings": STRINGS,
    "sc_math": MATHS,
    "sc_dates": DATES,
    "sc_arrays": ARRAYS,
    "sc_case_labels": LABEL_RATES,
}
