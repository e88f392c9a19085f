from __future__ import annotations

import datetime as dt
from decimal import Decimal as d

import pytest
from pyspark.sql import functions as F

from starquill.functions import periods
from starquill.functions.scalars import title_pattern
from starquill.plans import table_functions as tf
from starquill.session import materialise


def rows(df):
    return [tuple(r) for r in df.collect()]


SALES = ("payment", "rental", "inventory", "film_category", "category")
STOCK = ("film", "language", "inventory", "rental", "customer")
PLACES = ("country", "city", "address", "customer", "rental", "inventory", "film", "language")


def test_quarter_edges(rental):
    args = [rental[t] for t in SALES]
    # the film has two categories, so its revenue counts in both; the last microsecond of
    # March is in, the first instant of April is not
    assert rows(tf.category_revenue(*args, " 2017-q1 ")) == [
        (2017, 1, "Animation", d("7.99")), (2017, 1, "Drama", d("7.99"))]
    assert rows(tf.category_revenue(*args, "2017-Q2")) == [(2017, 2, "Animation", d("0.99"))]
    assert rows(tf.category_revenue(*args, "2016-Q1")) == []


def test_revenue_of_a_day_equals_revenue_of_its_quarter(rental):
    args = [rental[t] for t in SALES]
    assert rows(tf.current_category_revenue(*args, dt.date(2017, 12, 31))) == rows(
        tf.category_revenue(*args, "2017-Q4"))


def test_view_follows_the_calendar(rental, spark):
    payment = rental.payment.selectExpr(
        "payment_id", "customer_id", "staff_id", "rental_id", "amount",
        "CASE WHEN payment_id <= 3 THEN cast(current_date() AS timestamp_ntz) "
        "ELSE timestamp_ntz'2001-01-01 00:00:00' END AS payment_date")
    tf.create_revenue_view("current_revenue", payment, *[rental[t] for t in SALES[1:]])
    got = rows(spark.sql("SELECT category_name, total_sales_revenue FROM current_revenue"))
    assert got == [("Animation", d("8.98")), ("Drama", d("7.99"))]


@pytest.mark.parametrize("text", [None, "", "   "])
def test_empty_period(text):
    with pytest.raises(periods.EmptyPeriod):
        periods.parse_period(text)


@pytest.mark.parametrize("text", ["2017-Q5", "17-Q1", "2017Q1", "2017-Q1x", "x2017-Q1",
                                  "2017-Q1\n"])
def test_malformed_period(text):
    with pytest.raises(periods.MalformedPeriod):
        periods.parse_period(text)


def test_bounds():
    assert periods.quarter_bounds(2017, 4) == (dt.datetime(2017, 10, 1), dt.datetime(2018, 1, 1))
    assert periods.quarter_bounds(2017, 2) == (dt.datetime(2017, 4, 1), dt.datetime(2017, 7, 1))
    assert periods.month_bounds(dt.date(2017, 12, 9)) == (dt.datetime(2017, 12, 1),
                                                         dt.datetime(2018, 1, 1))
    assert periods.period_of(dt.date(2017, 9, 30)) == "2017-Q3"
    assert periods.quarter_bounds(9999, 4) == (dt.datetime(9999, 10, 1), None)
    assert periods.month_bounds(dt.date(9999, 12, 9)) == (dt.datetime(9999, 12, 1), None)
    with pytest.raises(periods.MalformedPeriod):
        periods.parse_period("0000-Q1")


def test_the_last_quarter_has_an_end(spark):
    df = spark.sql("SELECT timestamp_ntz'9999-12-31 23:59:59.999999' AS m UNION ALL "
                   "SELECT timestamp_ntz'9999-09-30 23:59:59' UNION ALL "
                   "SELECT CAST('+10000-01-01 00:00:00' AS timestamp_ntz)")
    assert df.filter(periods.within(df.m, periods.quarter_bounds(9999, 4))).count() == 1


def test_period_status_column(spark):
    df = spark.createDataFrame([("2005-q2 ",), ("2005-Q5",), ("",), (None,), ("05-Q1",)], "p string")
    assert [r[0] for r in df.select(periods.period_status(df.p)).collect()] == [
        "valid", "malformed", "empty", "empty", "malformed"]


def test_most_popular_films(rental):
    got = rows(tf.most_popular_films(*[rental[t] for t in PLACES],
                                     ["sudland", " Atlantis", "", None, "SUDLAND", "norland "]))
    assert got == [
        (1, "sudland", "ALPHA RING", "G", "English", "100", "2017"),
        (2, "Atlantis", "-", "-", "-", "-", "-"),
        # one rental each: the title decides
        (6, "norland", "ALPHA RING", "G", "English", "100", "2017")]


def test_missing_year_and_length_are_shown_as_dash(rental):
    only = dict(rental, rental=rental.rental.filter("rental_id = 5"))
    got = rows(tf.most_popular_films(*[only[t] for t in PLACES], ["Norland"]))
    assert got == [(1, "Norland", "GAMMA RING", "PG-13", "English", "-", "-")]


@pytest.mark.parametrize("countries", [None, [], ["", "  ", None]])
def test_most_popular_needs_a_country(rental, countries):
    with pytest.raises(ValueError):
        tf.most_popular_films(*[rental[t] for t in PLACES], countries)


def test_films_in_stock(rental):
    got = rows(tf.films_in_stock(*[rental[t] for t in STOCK], "RING"))
    # film 1: copy 2 is out, copy 1 was last rented by customer 2; film 3: its copy is out
    assert got == [(1, "ALPHA RING", "English", "Jan O'Poe", "2017-05-01 08:00:00"),
                   (2, "BETA RING", "French", "Ida Moe", "2017-03-31 23:59:59")]


def test_never_rented_copy_is_in_stock(rental):
    assert rows(tf.films_in_stock(*[rental[t] for t in STOCK], "DELT_")) == [
        (1, "DELTA", "English", "-", "-")]


def test_search_is_case_sensitive_and_has_a_message_row(rental):
    args = [rental[t] for t in STOCK]
    assert rows(tf.films_in_stock(*args, " ring ")) == [
        (1, "Film not found in stock for pattern: %ring%", "-", "-", "-")]
    # a film whose only copy is out counts as not found
    assert rows(tf.films_in_stock(*args, "GAMMA%"))[0][1].endswith("pattern: GAMMA%")


def test_a_search_without_titles_moves_no_rentals(spark, rental):
    def unread(table):
        """Fails where a row of it is about to be shuffled by copy."""
        fails = F.raise_error(F.lit("moved")).cast("int")
        return (materialise(rental[table], "moved").withColumn("inventory_id", fails)
                .repartition(2, "inventory_id"))

    # written, so that no title is known to be missing before it is looked for
    args = [unread(t) if t in ("inventory", "rental") else materialise(rental[t], "moved")
            for t in STOCK]
    assert rows(tf.films_in_stock(*args, "%NONE%")) == [
        (1, "Film not found in stock for pattern: %NONE%", "-", "-", "-")]


def test_title_pattern():
    assert title_pattern(" love ") == "%love%"
    assert title_pattern(" lo_e ") == " lo_e "
    for blank in (None, "", "  "):
        with pytest.raises(ValueError):
            title_pattern(blank)


def test_copies(rental):
    args = (rental.inventory, rental.rental)
    assert sorted(r[0] for r in rows(tf.copies_in_stock(*args))) == [1, 3, 4, 6]
    assert sorted(r[0] for r in rows(tf.copies_not_in_stock(*args))) == [2, 5]
    assert rows(tf.copies_in_stock(*args, film_id=1, store_id=1)) == [(1, 1, 1)]
    assert rows(tf.copies_not_in_stock(*args, film_id=1, store_id=1)) == []


def test_copy_holders_take_the_latest_open_rental(rental):
    got = dict(rows(tf.copy_holders(rental.inventory, rental.rental)))
    assert got == {1: None, 2: 2, 3: None, 4: None, 5: 2, 6: None}


BALANCE = ("customer", "rental", "inventory", "film", "payment")


def brute_balances(as_of):
    from rental_rows import ROWS
    films = {f[0]: (f[7], f[6], f[9]) for f in ROWS["film"]}
    copies = {i[0]: i[1] for i in ROWS["inventory"]}
    result = {c[0]: d(0) for c in ROWS["customer"]}
    for _, start, copy, customer, back, *_ in ROWS["rental"]:
        if start > as_of:
            continue
        seconds = (min(back or as_of, as_of) - start).total_seconds()
        days = max(0, int(-(-seconds // 86400)))
        rate, duration, cost = films[copies[copy]]
        extra = cost if days > 2 * duration else max(0, days - duration)
        result[customer] += rate + extra
    for _, customer, _, _, amount, paid in ROWS["payment"]:
        if paid <= as_of:
            result[customer] -= amount
    return result


@pytest.mark.parametrize("as_of", [
    dt.datetime(2016, 1, 1), dt.datetime(2017, 1, 4, 10), dt.datetime(2017, 1, 4, 10, 0, 1),
    dt.datetime(2017, 4, 10, 23, 59, 59), dt.datetime(2017, 5, 7, 8), dt.datetime(2018, 6, 1)])
def test_customer_balances(rental, as_of):
    got = dict(rows(tf.customer_balances(*[rental[t] for t in BALANCE], as_of)))
    assert got == brute_balances(as_of)


def test_one_balance(rental):
    as_of = dt.datetime(2018, 6, 1)
    args = [rental[t] for t in BALANCE]
    assert rows(tf.customer_balance(2, *args, as_of)) == [(2, brute_balances(as_of)[2])]
    with pytest.raises(ValueError):
        tf.customer_balance(None, *args, as_of)
    with pytest.raises(ValueError):
        tf.customer_balances(*args, None)


def test_rewards(rental):
    def ids(*args):
        return [r[0] for r in rows(tf.rewards_report(rental.customer, rental.payment, *args))]

    december = dt.date(2017, 12, 5)
    assert ids(1, d("12.99"), december) == [2]
    assert ids(1, d("13.00"), december) == []      # the amount must be above the limit
    assert ids(2, d("1"), december) == []          # and so must the number
    assert ids(1, d("0.01")) == []                 # January 2018, one payment
    for bad in [(0, 1), (1, 0), (None, 1), (1, None), (-1, 5)]:
        with pytest.raises(ValueError):
            ids(*bad)
    with pytest.raises(ValueError):
        tf.rewards_report(rental.customer, rental.payment.limit(0), 1, 1)
