from __future__ import annotations

import datetime as dt
from decimal import Decimal as d

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starquill import catalog
from starquill.bindings import catalog_queries
from starquill.plans import table_functions as tf
from starquill.sources.inline import values
from test_table_functions import PLACES, SALES, STOCK

ROLES = [("client_mary", 1), ("client_sue", 2)]


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def made(spark, rental):
    tables = {**rental, "customer_role_map": values(
        spark, ROLES, "role_name string, customer_id int")}
    return catalog.register(spark, tables, "t_")


def test_everything_is_made(made):
    assert set(made) == set(catalog.DEFINITIONS)


def test_only_what_the_tables_allow(spark, rental):
    made = catalog.register(spark, {t: rental[t] for t in ("inventory", "rental")}, "few_")
    assert made == ["copies_in_stock", "copies_not_in_stock", "copy_holders"]
    assert catalog.register(spark, dict(rental), "one_", ["copy_holders"]) == ["copy_holders"]


@pytest.mark.parametrize("period", [" 2017-q1 ", "2017-Q2", "2016-Q1", "9999-Q4"])
def test_revenue(spark, rental, made, period):
    got = spark.sql(f"SELECT * FROM t_revenue_by_category('{period}')")
    assert sorted(rows(got)) == rows(tf.category_revenue(*[rental[t] for t in SALES], period))


@pytest.mark.parametrize("call,message", [
    ("revenue_by_category('2017-Q5')", "not a quarter"), ("revenue_by_category('')", "not a quarter"),
    ("revenue_by_category(NULL)", "not a quarter"),
    ("revenue_by_category('0000-Q1')", "not a quarter"),
    ("most_popular_films(array('', NULL))", "no usable name"),
    ("most_popular_films(array())", "no usable name"),
    ("films_in_stock(' ')", "must not be empty"), ("films_in_stock(NULL)", "must not be empty"),
    ("customer_balances(NULL)", "must be given"),
    ("rewards_report(0, 5)", "must be above 0"), ("rewards_report(1, NULL)", "must be above 0")])
def test_wrong_arguments_are_errors(spark, made, call, message):
    with pytest.raises(PySparkException, match=message):
        spark.sql(f"SELECT * FROM t_{call}").collect()


def test_a_period_becomes_two_bounds(spark, sf_dir):
    plan = catalog_queries.revenue_by_category(spark, sf_dir)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate,1997-04-01T00:00" in text
    assert "< 1997-07-01 00:00:00)" in text
    assert "raise_error" not in text and "RLIKE" not in text


def test_view_by_name(spark, rental, made):
    spark.sql("SET VARIABLE t_report_date = DATE'2017-02-03'")
    held = spark.table("t_current_revenue")
    spark.sql("SET VARIABLE t_report_date = NULL")
    assert sorted(rows(held)) == rows(
        tf.current_category_revenue(*[rental[t] for t in SALES], dt.date(2017, 2, 3)))
    assert rows(spark.table("t_current_revenue")) == rows(
        tf.current_category_revenue(*[rental[t] for t in SALES]))


@pytest.mark.parametrize("names", [["Canada", " canada", "", None, "Nowhere"], ["Spain", "x"]])
def test_popular(spark, rental, made, names):
    asked = ", ".join("NULL" if n is None else f"'{n}'" for n in names)
    got = spark.sql(f"SELECT * FROM t_most_popular_films(array({asked})) ORDER BY ord")
    assert rows(got) == rows(tf.most_popular_films(*[rental[t] for t in PLACES], names))


@pytest.mark.parametrize("pattern", ["a", "%a%", "_lpha%", " alpha ", "zzz", "%"])
def test_stock_search(spark, rental, made, pattern):
    got = spark.sql(f"SELECT * FROM t_films_in_stock(pattern => '{pattern}') ORDER BY row_num")
    assert rows(got) == rows(tf.films_in_stock(*[rental[t] for t in STOCK], pattern))


def test_a_search_without_titles_moves_no_rentals(spark, rental):
    def unread(table):
        """Fails where a row of it is about to be shuffled by copy."""
        fails = F.raise_error(F.lit("moved")).cast("int")
        return rental[table].repartition(2).withColumn("inventory_id", fails)

    tables = {t: unread(t) if t in ("inventory", "rental") else rental[t] for t in STOCK}
    catalog.register(spark, tables, "moved_", ["films_in_stock"])
    assert rows(spark.sql("SELECT * FROM moved_films_in_stock('%NONE%')")) == [
        (1, "Film not found in stock for pattern: %NONE%", "-", "-", "-")]


@pytest.mark.parametrize("film,store", [(None, None), (1, None), (None, 1), (2, 2)])
def test_copies(spark, rental, made, film, store):
    given = ", ".join(f"{n} => {v}" for n, v in (("film_id", film), ("store_id", store))
                      if v is not None)
    for name in ("copies_in_stock", "copies_not_in_stock"):
        want = getattr(tf, name)(rental.inventory, rental.rental, film, store)
        assert sorted(rows(spark.sql(f"SELECT * FROM t_{name}({given})"))) == sorted(rows(want))
    assert sorted(rows(spark.table("t_copy_holders")), key=repr) == sorted(
        rows(tf.copy_holders(rental.inventory, rental.rental)), key=repr)


def test_balances_and_rewards(spark, rental, made):
    moment = dt.datetime(2017, 6, 1, 12)
    got = spark.sql("SELECT * FROM t_customer_balances(timestamp_ntz'2017-06-01 12:00:00')")
    assert sorted(rows(got)) == sorted(rows(tf.customer_balances(
        rental.customer, rental.rental, rental.inventory, rental.film, rental.payment, moment)))
    for call, args in (("1, 1", (1, 1)), ("1, 1.5, DATE'2017-03-05'", (1, d("1.5"), dt.date(2017, 3, 5)))):
        got = spark.sql(f"SELECT * FROM t_rewards_report({call}) ORDER BY customer_id")
        assert rows(got) == rows(tf.rewards_report(rental.customer, rental.payment, *args))


def test_one_view_many_principals(spark, rental, made):
    seen = {}
    for name in ("client_mary", "client_sue", "client_x", None):
        spark.sql(f"SET VARIABLE t_principal = {'NULL' if name is None else repr(name)}")
        seen[name] = spark.sql("SELECT DISTINCT customer_id FROM t_own_payment")
        assert rows(spark.sql("SELECT count(*) FROM t_foreign_payment")) == [(0,)]
        assert rows(spark.sql("SELECT count(*) FROM t_foreign_rental")) == [(0,)]
    # each plan keeps the principal it was made for
    assert {n: rows(df) for n, df in seen.items()} == {
        "client_mary": [(1,)], "client_sue": [(2,)], "client_x": [], None: []}
