"""The table functions as SQL: views and functions of a session, called by their names.

``register`` makes a temporary view of every table of the rental schema it is given, and every
function and view below whose tables are there::

    SELECT * FROM revenue_by_category('2017-Q2');
    SELECT * FROM films_in_stock(pattern => 'love');
    SELECT * FROM copies_in_stock(store_id => 2);
    SET VARIABLE principal = 'client_mary_smith';
    SELECT * FROM own_payment;

Catalyst puts the body of a function in the place of its call, with the arguments folded, so a
literal period reaches the scan as two bounds.  An argument that cannot be right is an error of
the query, as it is in the functions of ``plans.table_functions``; the results are the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from starquill.functions.periods import PERIOD_PATTERN


class Definition(NamedTuple):
    """What is registered under a name: the tables it reads, its parameters, its columns (empty
    for a view) and its body.  In the body ``{p}`` stands for the prefix of all names, and
    ``{f}`` for the name itself, which qualifies the parameters."""

    tables: str
    parameters: str
    columns: str
    body: str


def _checked(wrong: str, message: str, n_columns: int) -> str:
    """A branch without rows that fails if ``wrong`` holds."""
    others = ", NULL" * (n_columns - 1)
    return f"SELECT raise_error({message}){others} WHERE coalesce({wrong}, true)"


# a malformed text makes no bounds, and the branch that checks it an error
_PERIOD = "upper(btrim({f}.period))"
_IS_PERIOD = f"({_PERIOD} RLIKE '{PERIOD_PATTERN.replace('{', '{{').replace('}', '}}')}')"
_START = (f"CASE WHEN {_IS_PERIOD} THEN make_timestamp_ntz(CAST(substr({_PERIOD}, 1, 4) AS INT), "
          f"3 * CAST(substr({_PERIOD}, 7, 1) AS INT) - 2, 1, 0, 0, 0) END")

REVENUE = Definition(
    "payment rental inventory film_category category", "period STRING",
    "report_year INT, report_quarter INT, category_name STRING, "
    "total_sales_revenue DECIMAL(38,2)", f"""
WITH sums AS (
  SELECT rental_id, sum(amount) AS amount FROM {{p}}payment
  WHERE payment_date >= {_START} AND payment_date < {_START} + INTERVAL 3 MONTHS
  GROUP BY rental_id),
copies AS (
  SELECT inventory_id, sum(amount) AS amount
  FROM sums JOIN {{p}}rental USING (rental_id) GROUP BY inventory_id),
films AS (
  SELECT film_id, sum(amount) AS amount
  FROM copies JOIN {{p}}inventory USING (inventory_id) GROUP BY film_id),
kinds AS (
  SELECT category_id, sum(amount) AS amount
  FROM films JOIN {{p}}film_category USING (film_id) GROUP BY category_id)
SELECT CAST(substr({_PERIOD}, 1, 4) AS INT), CAST(substr({_PERIOD}, 7, 1) AS INT), name,
       CAST(round(amount, 2) AS DECIMAL(38,2))
FROM kinds JOIN {{p}}category USING (category_id)
UNION ALL """ + _checked(f"NOT {_IS_PERIOD}",
                         "concat('not a quarter: ', coalesce({f}.period, 'NULL'))", 4))

_TODAY = "coalesce(session.{p}report_date, current_date())"
CURRENT_REVENUE = Definition(REVENUE.tables, "", "", f"""
SELECT * FROM {{p}}revenue_by_category(
  concat(year({_TODAY}), '-Q', quarter({_TODAY})))
""")

MOST_POPULAR = Definition(
    "country city address customer rental inventory film language", "countries ARRAY<STRING>",
    "ord INT, country STRING, film STRING, rating STRING, language STRING, length STRING, "
    "release_year STRING", """
WITH named AS (
  SELECT pos + 1 AS ord, btrim(col) AS asked, upper(btrim(col)) AS matched
  FROM posexplode({f}.countries) WHERE btrim(col) <> ''),
wanted AS (
  SELECT min(ord) AS ord, min_by(asked, ord) AS asked, matched FROM named GROUP BY matched),
people AS (
  SELECT customer_id, ord FROM wanted JOIN {p}country c ON upper(c.country) = matched
  JOIN {p}city USING (country_id) JOIN {p}address USING (city_id)
  JOIN {p}customer USING (address_id)),
copies AS (
  SELECT ord, inventory_id, count(*) AS n
  FROM {p}rental JOIN people USING (customer_id) GROUP BY ord, inventory_id),
films AS (
  SELECT ord, film_id, sum(n) AS n
  FROM copies JOIN {p}inventory USING (inventory_id) GROUP BY ord, film_id),
best AS (
  SELECT * FROM (
    SELECT ord, title, rating, l.name, length, release_year,
           row_number() OVER (PARTITION BY ord ORDER BY n DESC, title, film_id) AS place
    FROM films JOIN {p}film USING (film_id) JOIN {p}language l USING (language_id))
  WHERE place = 1)
SELECT w.ord, asked, coalesce(title, '-'), coalesce(rating, '-'), coalesce(name, '-'),
       coalesce(CAST(length AS STRING), '-'), coalesce(CAST(release_year AS STRING), '-')
FROM wanted w LEFT JOIN best ON w.ord = best.ord
UNION ALL """ + _checked("NOT exists({f}.countries, c -> coalesce(btrim(c), '') <> '')",
                         "'the list of countries holds no usable name'", 7))

_LIKE = ("CASE WHEN {f}.pattern LIKE '%\\\\%%' OR {f}.pattern LIKE '%\\\\_%' THEN {f}.pattern "
         "ELSE concat('%', btrim({f}.pattern), '%') END")
FILMS_IN_STOCK = Definition(
    "film language inventory rental customer", "pattern STRING",
    "row_num BIGINT, film_title STRING, language STRING, customer_name STRING, "
    "rental_date STRING", f"""
WITH titles AS (
  SELECT film_id, title, l.name FROM {{p}}film JOIN {{p}}language l USING (language_id)
  WHERE title LIKE {_LIKE} AND btrim({{f}}.pattern) <> ''),
-- without titles no row of inventory or rental leaves its scan
stocked AS (
  SELECT film_id, inventory_id FROM {{p}}inventory LEFT SEMI JOIN titles USING (film_id)
  WHERE film_id BETWEEN (SELECT min(film_id) FROM titles) AND (SELECT max(film_id) FROM titles)),
copies AS (
  SELECT inventory_id, film_id, title, name FROM titles JOIN stocked USING (film_id)),
history AS (
  SELECT inventory_id, max(return_date IS NULL) AS is_out,
         max(struct(rental_date, rental_id, customer_id)) AS latest
  FROM {{p}}rental LEFT SEMI JOIN copies USING (inventory_id)
  WHERE EXISTS (SELECT 1 FROM titles) GROUP BY inventory_id),
picked AS (
  SELECT * FROM (
    SELECT film_id, title, name, latest, row_number() OVER (
             PARTITION BY film_id ORDER BY latest.rental_date DESC NULLS LAST, inventory_id) AS place
    FROM copies LEFT JOIN history USING (inventory_id) WHERE NOT coalesce(is_out, false))
  WHERE place = 1),
-- numbers of all rows without one window over all: those of the letters before, then within
letters AS (
  SELECT beginning, sum(n) OVER (ORDER BY beginning) - n AS before
  FROM (SELECT left(title, 3) AS beginning, count(*) AS n FROM picked GROUP BY 1)),
numbered AS (
  SELECT before + row_number() OVER (PARTITION BY beginning ORDER BY title, film_id) AS row_num,
         picked.*
  FROM picked JOIN letters ON left(title, 3) = beginning)
SELECT row_num, title, name, coalesce(concat(first_name, ' ', last_name), '-'),
       coalesce(date_format(latest.rental_date, 'yyyy-MM-dd HH:mm:ss'), '-')
FROM numbered LEFT JOIN {{p}}customer ON customer_id = latest.customer_id
UNION ALL
SELECT 1, concat('Film not found in stock for pattern: ', {_LIKE}), '-', '-', '-'
FROM (SELECT count(*) AS n FROM picked) WHERE n = 0 AND btrim({{f}}.pattern) <> ''
UNION ALL """ + _checked("btrim({f}.pattern) = ''", "'the title pattern must not be empty'", 5))


def _stock(kind: str) -> Definition:
    """Copies with an open rental (SEMI) or without one (ANTI), of a film or store if given."""
    return Definition(
        "inventory rental", "film_id INT DEFAULT NULL, store_id INT DEFAULT NULL",
        "inventory_id {inventory.inventory_id}, film_id {inventory.film_id}, "
        "store_id {inventory.store_id}", f"""
WITH copies AS (
  SELECT i.inventory_id, i.film_id, i.store_id FROM {{p}}inventory i
  WHERE ({{f}}.film_id IS NULL OR i.film_id = {{f}}.film_id)
    AND ({{f}}.store_id IS NULL OR i.store_id = {{f}}.store_id)),
out AS (
  SELECT DISTINCT inventory_id FROM {{p}}rental LEFT SEMI JOIN copies USING (inventory_id)
  WHERE return_date IS NULL)
SELECT copies.* FROM copies LEFT {kind} JOIN out USING (inventory_id)
""")


COPY_HOLDERS = Definition("inventory rental", "", "", """
SELECT i.inventory_id, customer_id FROM {p}inventory i LEFT JOIN (
  SELECT inventory_id, max(struct(rental_date, rental_id, customer_id)).customer_id AS customer_id
  FROM {p}rental WHERE return_date IS NULL GROUP BY inventory_id) USING (inventory_id)
""")

CUSTOMER_BALANCES = Definition(
    "customer rental inventory film payment", "as_of TIMESTAMP_NTZ",
    "customer_id {customer.customer_id}, balance DECIMAL(38,2)", """
WITH kept AS (
  SELECT customer_id, inventory_id, rental_date AS out_at, {f}.as_of AS moment,
         least(coalesce(return_date, {f}.as_of), {f}.as_of) AS back_at
  FROM {p}rental WHERE rental_date <= {f}.as_of),
days AS (
  SELECT customer_id, inventory_id, greatest(0, datediff(back_at, out_at) + CASE
           WHEN back_at > out_at + make_dt_interval(datediff(back_at, out_at)) THEN 1
           ELSE 0 END) AS days
  FROM kept),
charged AS (
  SELECT customer_id, sum(rental_rate + CASE
           WHEN days > 2 * rental_duration THEN replacement_cost
           WHEN days > rental_duration THEN CAST(days - rental_duration AS DECIMAL(12,2))
           ELSE 0 END) AS charged
  FROM days JOIN {p}inventory USING (inventory_id) JOIN {p}film USING (film_id)
  GROUP BY customer_id),
paid AS (
  SELECT customer_id, sum(amount) AS paid FROM {p}payment
  WHERE payment_date <= {f}.as_of GROUP BY customer_id)
SELECT customer_id, CAST(coalesce(charged, 0) - coalesce(paid, 0) AS DECIMAL(38,2))
FROM {p}customer LEFT JOIN charged USING (customer_id) LEFT JOIN paid USING (customer_id)
WHERE {f}.as_of IS NOT NULL
UNION ALL """ + _checked("{f}.as_of IS NULL", "'as_of must be given'", 2))

REWARDS = Definition(
    "customer payment", "min_purchases INT, min_amount DECIMAL(38,2), ref_date DATE DEFAULT NULL",
    "{customer.*}", """
WITH earned AS (
  SELECT customer_id FROM {p}payment
  WHERE payment_date >= {month} AND payment_date < {month} + INTERVAL 1 MONTH
  GROUP BY customer_id
  HAVING count(*) > {f}.min_purchases AND sum(amount) > {f}.min_amount)
SELECT c.* FROM {p}customer c LEFT SEMI JOIN earned USING (customer_id)
WHERE {f}.min_purchases > 0 AND {f}.min_amount > 0
UNION ALL
SELECT raise_error('min_purchases and min_amount must be above 0'){customer.nulls}
WHERE NOT coalesce({f}.min_purchases > 0 AND {f}.min_amount > 0, false)
""".replace("{month}", "CAST(date_trunc('month', coalesce({f}.ref_date, (SELECT max(payment_date) "
                       "FROM {p}payment))) AS TIMESTAMP_NTZ)"))

# a principal sees its own rows; without one, or for one that is not mapped, there are none
_OWN_ID = ("(SELECT max(customer_id) FROM {p}customer_role_map "
           "WHERE role_name = session.{p}principal)")


def _own(table: str) -> Definition:
    return Definition(f"{table} customer_role_map", "", "",
                      f"SELECT * FROM {{p}}{table} WHERE customer_id = {_OWN_ID}")


def _hidden(table: str) -> Definition:
    """Rows of others that the principal's view lets through: none."""
    return Definition(f"{table} customer_role_map", "", "",
                      f"SELECT * FROM {{p}}own_{table} WHERE customer_id <> {_OWN_ID}")


DEFINITIONS = {
    "revenue_by_category": REVENUE,
    "current_revenue": CURRENT_REVENUE,
    "most_popular_films": MOST_POPULAR,
    "films_in_stock": FILMS_IN_STOCK,
    "copies_in_stock": _stock("ANTI"),
    "copies_not_in_stock": _stock("SEMI"),
    "copy_holders": COPY_HOLDERS,
    "customer_balances": CUSTOMER_BALANCES,
    "rewards_report": REWARDS,
    "own_rental": _own("rental"),
    "own_payment": _own("payment"),
    "foreign_rental": _hidden("rental"),
    "foreign_payment": _hidden("payment"),
}

VARIABLES = {"principal": "STRING", "report_date": "DATE"}


def _types(df: DataFrame) -> dict[str, str]:
    """Types of a table's columns, for ``{table.column}`` in a definition; all columns with their
    types as ``*``, and a null for each but the first as ``nulls``."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    columns = ", ".join(f"`{name}` {kind}" for name, kind in types.items())
    return {**types, "*": columns, "nulls": ", NULL" * (len(types) - 1)}


def register(spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str = "",
             names: Sequence[str] | None = None) -> list[str]:
    """Views of ``tables`` and the functions and views that read no others (or, of these, those in
    ``names``), all as temporary objects of the session; returns the names of the latter,
    without ``prefix``.

    ``prefix`` stands before every name, so that several databases fit into one session.  The
    session variables ``principal`` and ``report_date`` are made new, without a value: without a
    principal its views have no rows, without a date the current quarter is that of today.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    for name, kind in VARIABLES.items():
        spark.sql(f"DECLARE OR REPLACE VARIABLE {prefix}{name} {kind} DEFAULT NULL")
    made = []
    for name, (needs, parameters, columns, body) in DEFINITIONS.items():
        if names is not None and name not in names or not set(needs.split()) <= set(tables):
            continue
        full = f"{prefix}{name}"
        text = body.replace("{p}", prefix).replace("{f}", full).replace("{{", "{").replace("}}", "}")
        for table in needs.split():
            for column, kind in _types(tables[table]).items():
                columns = columns.replace(f"{{{table}.{column}}}", kind)
                text = text.replace(f"{{{table}.{column}}}", kind)
        if columns:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {full}({parameters}) "
                      f"RETURNS TABLE({columns}) RETURN {text}")
        else:
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {full} AS {text}")
        made.append(name)
    return made
