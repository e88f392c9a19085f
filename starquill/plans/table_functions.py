"""Parameterised table functions over the rental schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starquill.functions.periods import (month_bounds, parse_period, period_end, period_of,
                                         period_start, period_status, quarter_bounds, within)
from starquill.functions.scalars import balance_charge, full_name, title_pattern, whole_days
from starquill.operators.intervals import interval_join
from starquill.operators.rows import first_per_key, number_rows, with_fallback
from starquill.session import materialise
from starquill.sources.inline import known_if_empty, ordered_elements, values

MONEY = "decimal(38,2)"


def _revenue(payment, rental, inventory, film_category, category, in_period: Column,
             year: Column, quarter: Column) -> DataFrame:
    """The sum is taken per rental, then per copy, then per film, so that every join
    after the first moves sums and not payments."""
    sums = payment.filter(in_period).groupBy("rental_id").agg(F.sum("amount").alias("amount"))
    for link, key, target in ((rental, "rental_id", "inventory_id"),
                              (inventory, "inventory_id", "film_id"),
                              (film_category, "film_id", "category_id")):
        sums = (sums.join(link.select(key, target), key)
                .groupBy(target).agg(F.sum("amount").alias("amount")))
    return (sums.join(category.select("category_id", "name"), "category_id")
            .select(year.alias("report_year"), quarter.alias("report_quarter"),
                    F.col("name").alias("category_name"),
                    F.round("amount", 2).cast(MONEY).alias("total_sales_revenue"))
            .orderBy("category_name"))


def category_revenue(payment, rental, inventory, film_category, category,
                     period: str) -> DataFrame:
    """Revenue of a quarter per category; categories without sales are absent, and a film
    in two categories counts in both."""
    year, quarter = parse_period(period)
    in_period = within(F.col("payment_date"), quarter_bounds(year, quarter))
    return _revenue(payment, rental, inventory, film_category, category, in_period,
                    F.lit(year), F.lit(quarter))


def current_category_revenue(payment, rental, inventory, film_category, category,
                             as_of: dt.date | None = None) -> DataFrame:
    """Revenue of the quarter that holds ``as_of``; without it, of the quarter in which
    the query runs.  A view of the latter moves on with the calendar."""
    if as_of is not None:
        return category_revenue(payment, rental, inventory, film_category, category,
                                period_of(as_of))
    today = F.current_date()
    start = F.date_trunc("quarter", today).cast("timestamp_ntz")
    in_period = (F.col("payment_date") >= start) & (
        F.col("payment_date") < start + F.expr("INTERVAL 3 MONTHS"))
    return _revenue(payment, rental, inventory, film_category, category, in_period,
                    F.year(today), F.quarter(today))


def revenue_of_periods(payment, rental, inventory, film_category, category, periods: DataFrame,
                       text: str = "period") -> DataFrame:
    """Revenue per category of every quarter named in a column of period texts.

    Each different quarter counts once, however it is written and however often; texts that
    name none are left out (``period_status`` tells them).  Payments are summed per rental and
    moment before they meet the quarters, and per quarter at each step after it.
    """
    asked = (periods.filter(period_status(F.col(text)) == "valid")
             .select(F.upper(F.btrim(text)).alias("period")).distinct()
             .withColumns({"_start": period_start(F.col("period")),
                           "_end": period_end(F.col("period"))}))
    paid = payment.groupBy("rental_id", "payment_date").agg(F.sum("amount").alias("amount"))
    sums = (interval_join(paid, "payment_date", asked, "_start", "_end")
            .groupBy("period", "rental_id").agg(F.sum("amount").alias("amount")))
    for link, key, target in ((rental, "rental_id", "inventory_id"),
                              (inventory, "inventory_id", "film_id"),
                              (film_category, "film_id", "category_id")):
        sums = (sums.join(link.select(key, target), key)
                .groupBy("period", target).agg(F.sum("amount").alias("amount")))
    return (sums.join(category.select("category_id", "name"), "category_id")
            .select(F.substring("period", 1, 4).cast("int").alias("report_year"),
                    F.substring("period", 7, 1).cast("int").alias("report_quarter"),
                    F.col("name").alias("category_name"),
                    F.round("amount", 2).cast(MONEY).alias("total_sales_revenue")))


def create_revenue_view(name: str, payment, rental, inventory, film_category, category) -> None:
    """A temporary view of the current quarter's revenue per category."""
    current_category_revenue(payment, rental, inventory, film_category,
                             category).createOrReplaceTempView(name)


def most_popular_films(country, city, address, customer, rental, inventory, film, language,
                       countries: Sequence[str | None]) -> DataFrame:
    """The most rented film among the customers of each given country, in the order given.

    Blank names are dropped, repeated ones (by trimmed upper case) keep the first
    spelling, and a country without rentals gets ``-`` in every column.
    """
    if not countries:
        raise ValueError("the list of countries is empty")
    if not any(c and c.strip(" ") for c in countries):
        raise ValueError("the list of countries holds no usable name")
    asked = (ordered_elements(country.sparkSession, countries, "name")
             .filter(F.nullif(F.btrim("name"), F.lit("")).isNotNull())
             .select("position", F.btrim("name").alias("country_name"),
                     F.upper(F.btrim("name")).alias("match_name")))
    asked = first_per_key(asked, ["match_name"], ["position"])

    places = (asked.join(country.select(F.upper("country").alias("match_name"), "country_id"),
                         "match_name")
              .join(city.select("city_id", "country_id"), "country_id")
              .join(address.select("address_id", "city_id"), "city_id")
              .select("position", "address_id"))
    people = (customer.select("customer_id", "address_id").join(places, "address_id")
              .select("customer_id", "position"))
    per_copy = (rental.select("customer_id", "inventory_id").join(people, "customer_id")
                .groupBy("position", "inventory_id").agg(F.count(F.lit(1)).alias("n")))
    per_film = (per_copy.join(inventory.select("inventory_id", "film_id"), "inventory_id")
                .groupBy("position", "film_id").agg(F.sum("n").alias("n")))
    known = language.select("language_id", F.col("name").alias("language"))
    named = (per_film.join(film.select("film_id", "title", "rating", "language_id", "length",
                                       "release_year"), "film_id")
             .join(known, "language_id"))
    best = first_per_key(named, ["position"], [F.desc("n"), "title", "film_id"])

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("-"))

    return (asked.join(best, "position", "left")
            .select(F.col("position").alias("ord"), F.col("country_name").alias("country"),
                    shown("title").alias("film"), shown("rating").alias("rating"),
                    shown("language").alias("language"), shown("length").alias("length"),
                    shown("release_year").alias("release_year"))
            .orderBy("ord"))


def _open_rentals(rental: DataFrame) -> DataFrame:
    return rental.filter(F.col("return_date").isNull())


def _copies(inventory: DataFrame, film_id=None, store_id=None) -> DataFrame:
    copies = inventory.select("inventory_id", "film_id", "store_id")
    if film_id is not None:
        copies = copies.filter(F.col("film_id") == film_id)
    if store_id is not None:
        copies = copies.filter(F.col("store_id") == store_id)
    return copies


def _out(copies: DataFrame, rental: DataFrame, film_id, store_id) -> DataFrame:
    """Copies with an open rental.  A choice of film or store cuts the rentals down first."""
    open_ = _open_rentals(rental).select("inventory_id")
    if film_id is not None or store_id is not None:
        open_ = open_.join(copies.select("inventory_id"), "inventory_id", "left_semi")
    return open_.distinct()


def copies_in_stock(inventory, rental, film_id=None, store_id=None) -> DataFrame:
    """Copies that were never rented or have all come back."""
    copies = _copies(inventory, film_id, store_id)
    return copies.join(_out(copies, rental, film_id, store_id), "inventory_id", "left_anti")


def copies_not_in_stock(inventory, rental, film_id=None, store_id=None) -> DataFrame:
    """Copies with a rental that is still open."""
    copies = _copies(inventory, film_id, store_id)
    return copies.join(_out(copies, rental, film_id, store_id), "inventory_id", "left_semi")


def copy_holders(inventory, rental) -> DataFrame:
    """Every copy with the customer of its latest open rental, or NULL."""
    held = (_open_rentals(rental).groupBy("inventory_id")
            .agg(F.max_by("customer_id", F.struct("rental_date", "rental_id", "customer_id"))
                 .alias("customer_id")))
    return _copies(inventory).join(held, "inventory_id", "left").select(
        "inventory_id", "customer_id")


def films_in_stock(film, language, inventory, rental, customer, pattern: str) -> DataFrame:
    """Films with a title like ``pattern`` and a copy in stock, with the latest rental of
    such a copy; one message row if there is none.

    One pass over the rentals gives both the latest rental of a copy and whether any is
    open.  It is cut down to the copies asked for, and grouped ahead of the join, so that a
    copy with very many rentals is down to a row per task.  Titles and copies are written out
    before what they cut down is read: their size is known then, and few of them, or none, are
    broadcast to inventory and rentals.  Without any, Catalyst is told so and reads no further.
    """
    pattern = title_pattern(pattern)
    titles = known_if_empty(materialise(
        film.filter(F.col("title").like(pattern)).select("film_id", "title", "language_id")
        .join(language.select("language_id", F.col("name").alias("language")), "language_id"),
        "titles"))
    stocked = inventory.select("film_id", "inventory_id").join(
        titles.select("film_id"), "film_id", "left_semi")
    copies = known_if_empty(materialise(titles.join(stocked, "film_id"), "copies"))
    asked = copies.select("inventory_id")
    history = (rental.join(asked, "inventory_id", "left_semi").groupBy("inventory_id")
               .agg(F.max(F.col("return_date").isNull()).alias("is_out"),
                    F.max(F.struct("rental_date", "rental_id", "customer_id")).alias("last")))
    available = (copies.join(history, "inventory_id", "left")
                 .filter(~F.coalesce("is_out", F.lit(False)))
                 .select("film_id", "title", "language", "inventory_id",
                         F.col("last.rental_date").alias("rental_date"),
                         F.col("last.customer_id").alias("customer_id")))
    picked = first_per_key(available, ["film_id"],
                           [F.desc_nulls_last("rental_date"), "inventory_id"])
    people = customer.select(
        "customer_id", full_name(F.col("first_name"), F.col("last_name")).alias("who"))
    when = F.date_format("rental_date", "yyyy-MM-dd HH:mm:ss")
    rows = (picked.join(people, "customer_id", "left")
            .select("title", "film_id", "language",
                    F.coalesce("who", F.lit("-")).alias("customer_name"),
                    F.coalesce(when, F.lit("-")).alias("rental_date")))
    numbered = number_rows(rows, ["title", "film_id"]).select(
        "row_num", F.col("title").alias("film_title"), "language", "customer_name", "rental_date")
    message = f"Film not found in stock for pattern: {pattern}"
    fallback = values(film.sparkSession, [(1, message, "-", "-", "-")], numbered.schema)
    return with_fallback(numbered, fallback).orderBy("row_num")


def customer_balances(customer, rental, inventory, film, payment, as_of: dt.datetime) -> DataFrame:
    """Charges less payments up to ``as_of``, for every customer."""
    if as_of is None:
        raise ValueError("as_of must be given")
    moment = F.lit(as_of.isoformat(" ")).cast("timestamp_ntz")
    end = F.least(F.coalesce(F.col("return_date"), moment), moment)
    days = F.greatest(whole_days(F.col("rental_date"), end), F.lit(0))
    kept = (rental.filter(F.col("rental_date") <= moment)
            .select("customer_id", "inventory_id", days.alias("days_kept")))
    terms = inventory.select("inventory_id", "film_id").join(
        film.select("film_id", "rental_rate", "rental_duration", "replacement_cost"), "film_id")
    charge = balance_charge(F.col("days_kept"), F.col("rental_duration"), F.col("rental_rate"),
                            F.col("replacement_cost"))
    charged = (kept.join(terms, "inventory_id").groupBy("customer_id")
               .agg(F.sum(charge).alias("charged")))
    paid = (payment.filter(F.col("payment_date") <= moment).groupBy("customer_id")
            .agg(F.sum("amount").alias("paid")))
    zero = F.lit(0).cast(MONEY)
    balance = F.coalesce("charged", zero) - F.coalesce("paid", zero)
    return (customer.select("customer_id").join(charged, "customer_id", "left")
            .join(paid, "customer_id", "left")
            .select("customer_id", balance.cast(MONEY).alias("balance")))


def customer_balance(customer_id, customer, rental, inventory, film, payment,
                     as_of: dt.datetime) -> DataFrame:
    """The balance of one customer; the filter reaches every scan."""
    if customer_id is None:
        raise ValueError("customer_id must be given")
    own = F.col("customer_id") == customer_id
    return customer_balances(customer.filter(own), rental.filter(own), inventory, film,
                             payment.filter(own), as_of)


def rewards_report(customer, payment, min_purchases: int, min_amount,
                   ref_date: dt.date | None = None) -> DataFrame:
    """Customers with more than ``min_purchases`` payments of more than ``min_amount`` in
    all, in the month of ``ref_date`` (of the latest payment if not given)."""
    if min_purchases is None or min_purchases <= 0:
        raise ValueError("min_purchases must be above 0")
    if min_amount is None or min_amount <= 0:
        raise ValueError("min_amount must be above 0")
    if ref_date is None:
        latest = payment.agg(F.max("payment_date")).first()[0]
        if latest is None:
            raise ValueError("there are no payments")
        ref_date = latest.date()
    earned = (payment.filter(within(F.col("payment_date"), month_bounds(ref_date)))
              .groupBy("customer_id")
              .agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_sum"))
              .filter((F.col("_n") > min_purchases) & (F.col("_sum") > min_amount)))
    return (customer.join(earned, "customer_id", "left_semi").select(*customer.columns)
            .orderBy("customer_id"))
