"""The eight reports over the rental schema.

Each report exists in the forms a reader may want to compare: ``join`` (joins, then one
aggregation), ``scalar`` (correlated scalar subqueries, which Catalyst turns into joins)
and ``preagg`` / ``cte`` (each fact reduced before it is joined).  All forms return the
same rows; the last one is the form to use on large tables.

In the scalar forms the outer key gets a name of its own (``this_...``) that exists nowhere
inside the subquery.  A column hidden below a projection would otherwise capture it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starquill.functions.periods import within
from starquill.functions.scalars import address_text, audience_label, full_name
from starquill.operators.aggregates import conditional_distinct_counts, consecutive_gaps
from starquill.operators.rows import at_extremum, first_per_key
from starquill.session import materialise

MONEY = "decimal(38,2)"


# --- Films of a category, in a range of years, above a rate ---------------------------

def _films_in_range(film: DataFrame, years: tuple[int, int], min_rate: float) -> DataFrame:
    return film.filter(F.col("release_year").between(*years) & (F.col("rental_rate") > min_rate)
                       ).select("film_id", "title", "release_year", "rental_rate")


def _category_named(category: DataFrame, name: str) -> DataFrame:
    return category.filter(F.upper("name") == name.upper()).select("category_id")


def category_films_join(film, film_category, category, name, years, min_rate) -> DataFrame:
    return (_films_in_range(film, years, min_rate)
            .join(film_category, "film_id")
            .join(_category_named(category, name), "category_id")
            .select("film_id", "title", "release_year", "rental_rate")
            .orderBy("title", "film_id"))


def category_films_semi(film, film_category, category, name, years, min_rate) -> DataFrame:
    listed = film_category.join(_category_named(category, name), "category_id", "left_semi")
    return (_films_in_range(film, years, min_rate)
            .join(listed, "film_id", "left_semi")
            .orderBy("title", "film_id"))


def category_films_cte(film, film_category, category, name, years, min_rate) -> DataFrame:
    wanted = _category_named(category, name)
    listed = film_category.join(wanted, "category_id").select("film_id").distinct()
    return (_films_in_range(film, years, min_rate).join(listed, "film_id")
            .orderBy("title", "film_id"))


# --- Revenue of every store since a date ----------------------------------------------

def _stores(store: DataFrame, address: DataFrame) -> DataFrame:
    lines = address.select(
        "address_id", address_text(F.col("address"), F.col("address2")).alias("store_address"))
    return store.join(lines, "address_id").select("store_id", "store_address")


def _since(moment: str) -> Column:
    return F.col("payment_date") >= F.lit(moment).cast("timestamp_ntz")


def store_revenue_join(store, address, inventory, rental, payment, since) -> DataFrame:
    """Chain of joins, with the date condition in the last one's ON so that every store
    stays.

    Catalyst carries that condition below the grouping and into the scan.  The outer join
    sees one row per store: a side that only repeats its keys could not be split there.
    """
    sums = (payment.select("rental_id", "amount", _since(since).alias("in_time"))
            .groupBy("rental_id", "in_time").agg(F.sum("amount").alias("amount"))
            .join(rental.select("rental_id", "inventory_id"), "rental_id")
            .join(inventory.select("inventory_id", "store_id"), "inventory_id")
            .groupBy("store_id", "in_time").agg(F.sum("amount").alias("amount"))).alias("p")
    stores = _stores(store, address).alias("s")
    return (stores.join(sums, (F.col("s.store_id") == F.col("p.store_id")) & F.col("p.in_time"),
                        "left")
            .select("s.store_id", "store_address",
                    F.coalesce("amount", F.lit(0)).cast(MONEY).alias("revenue"))
            .orderBy("store_id"))


def store_revenue_scalar(store, address, inventory, rental, payment, since) -> DataFrame:
    of_store = (payment.filter(_since(since)).select("rental_id", "amount")
                .join(rental.select("rental_id", "inventory_id"), "rental_id")
                .join(inventory.select("inventory_id", "store_id"), "inventory_id")
                .where(F.col("store_id") == F.col("this_store").outer())
                .select(F.sum("amount")).scalar())
    return (_stores(store, address).withColumnRenamed("store_id", "this_store")
            .select(F.col("this_store").alias("store_id"), "store_address",
                    F.coalesce(of_store, F.lit(0)).cast(MONEY).alias("revenue"))
            .orderBy("store_id"))


def store_revenue_preagg(store, address, inventory, rental, payment, since) -> DataFrame:
    per_rental = payment.filter(_since(since)).groupBy("rental_id").agg(
        F.sum("amount").alias("amount"))
    per_copy = (per_rental.join(rental.select("rental_id", "inventory_id"), "rental_id")
                .groupBy("inventory_id").agg(F.sum("amount").alias("amount")))
    per_store = (per_copy.join(inventory.select("inventory_id", "store_id"), "inventory_id")
                 .groupBy("store_id").agg(F.sum("amount").alias("amount")))
    revenue = F.coalesce("amount", F.lit(0)).cast(MONEY).alias("revenue")
    return (_stores(store, address).join(per_store, "store_id", "left")
            .select("store_id", "store_address", revenue).orderBy("store_id"))


# --- Actors with the most films since a year ------------------------------------------

def _busiest(named: DataFrame, k: int) -> DataFrame:
    return (named.select("actor_id", "first_name", "last_name", "number_of_movies")
            .orderBy(F.desc("number_of_movies"), "last_name", "first_name", "actor_id").limit(k))


def busiest_actors_join(actor, film_actor, film, since_year, k=5) -> DataFrame:
    recent = film.filter(F.col("release_year") >= since_year).select("film_id")
    return _busiest(
        actor.join(film_actor.select("actor_id", "film_id"), "actor_id").join(recent, "film_id")
        .groupBy("actor_id", "first_name", "last_name")
        .agg(F.count("film_id").alias("number_of_movies")), k)


def busiest_actors_scalar(actor, film_actor, film, since_year, k=5) -> DataFrame:
    recent = film.filter(F.col("release_year") >= since_year).select("film_id")
    films = (film_actor.select("actor_id", "film_id").join(recent, "film_id")
             .where(F.col("actor_id") == F.col("this_actor").outer())
             .select(F.count("film_id")).scalar())
    counted = (actor.withColumnRenamed("actor_id", "this_actor")
               .withColumn("number_of_movies", films).filter("number_of_movies > 0")
               .withColumnRenamed("this_actor", "actor_id"))
    return _busiest(counted, k)


def busiest_actors_cte(actor, film_actor, film, since_year, k=5) -> DataFrame:
    recent = film.filter(F.col("release_year") >= since_year).select("film_id")
    counts = (film_actor.select("actor_id", "film_id").join(recent, "film_id", "left_semi")
              .groupBy("actor_id").agg(F.count("film_id").alias("number_of_movies")))
    return _busiest(actor.join(counts, "actor_id"), k)


# --- Films per year in each of several categories -------------------------------------

def _film_types(film: DataFrame, film_category: DataFrame, category: DataFrame,
                names: dict[str, str]) -> DataFrame:
    """Every film with each asked category it belongs to, or once with NULL.

    The links are made distinct first, so a film with very many of them adds at most one
    row per asked category to the outer join.
    """
    wanted = category.select("category_id", F.upper("name").alias("category")).filter(
        F.col("category").isin(*[n.upper() for n in names.values()]))
    links = (film_category.select("film_id", "category_id").join(wanted, "category_id")
             .select("film_id", "category").distinct())
    return film.select("film_id", "release_year").join(links, "film_id", "left")


def yearly_category_counts_join(film, film_category, category, names: dict[str, str]) -> DataFrame:
    """``names`` maps an output column to the category counted in it."""
    counts = [F.count_distinct(F.when(F.col("category") == name.upper(), F.col("film_id")))
              .alias(alias) for alias, name in names.items()]
    return (_film_types(film, film_category, category, names).groupBy("release_year")
            .agg(*counts).orderBy(F.desc_nulls_last("release_year")))


def yearly_category_counts_scalar(film, film_category, category,
                                  names: dict[str, str]) -> DataFrame:
    years = film.select(F.col("release_year").alias("this_year")).distinct()

    def counted(name: str) -> Column:
        wanted = category.filter(F.upper("name") == name.upper()).select("category_id")
        return (film.select("film_id", "release_year")
                .join(film_category.select("film_id", "category_id"), "film_id")
                .join(wanted, "category_id")
                .where(F.col("release_year") == F.col("this_year").outer())
                .select(F.count_distinct("film_id")).scalar())

    return (years.select(F.col("this_year").alias("release_year"),
                         *[counted(n).alias(a) for a, n in names.items()])
            .orderBy(F.desc_nulls_last("release_year")))


def yearly_category_counts_cte(film, film_category, category, names: dict[str, str]) -> DataFrame:
    conditions = {alias: F.col("category") == name.upper() for alias, name in names.items()}
    return (conditional_distinct_counts(
                _film_types(film, film_category, category, names), "release_year", "film_id",
                conditions)
            .orderBy(F.desc_nulls_last("release_year")))


# --- Staff with the highest revenue of a year, and where they last sold ---------------

def _year(column: str, year: int) -> Column:
    return within(F.col(column), (dt.datetime(year, 1, 1), dt.datetime(year + 1, 1, 1)))


def _linked_payments(payment, rental, inventory, year) -> DataFrame:
    """Payments of the year that reach a copy, with the store of the copy."""
    return (payment.filter(_year("payment_date", year))
            .select("staff_id", "rental_id", "payment_id", "payment_date", "amount")
            .join(rental.select("rental_id", "inventory_id"), "rental_id")
            .join(inventory.select("inventory_id", "store_id"), "inventory_id"))


def _earner_rows(staff: DataFrame, revenue: DataFrame, last: DataFrame, stores: DataFrame,
                 k: int) -> DataFrame:
    return (staff.select("staff_id", "first_name", "last_name").join(revenue, "staff_id")
            .join(last, "staff_id").join(stores, "store_id")
            .select("staff_id",
                    full_name(F.col("first_name"), F.col("last_name")).alias("staff_full_name"),
                    F.col("store_id").alias("last_store_id"),
                    F.col("store_address").alias("last_store_address"),
                    F.col("revenue").cast(MONEY).alias("revenue"))
            .orderBy(F.desc("revenue"), "staff_id").limit(k))


def _latest_first() -> list[Column]:
    return [F.desc_nulls_last("payment_date"), F.desc_nulls_last("payment_id")]


def top_earners_join(staff, payment, rental, inventory, store, address, year, k=3) -> DataFrame:
    """Latest store by window, all payments of the year counted as revenue."""
    paid = payment.filter(_year("payment_date", year))
    revenue = paid.groupBy("staff_id").agg(F.sum("amount").alias("revenue"))
    linked = _linked_payments(payment, rental, inventory, year)
    last = first_per_key(linked, ["staff_id"], _latest_first()).select("staff_id", "store_id")
    return _earner_rows(staff, revenue, last, _stores(store, address), k)


def top_earners_cte(staff, payment, rental, inventory, store, address, year, k=3) -> DataFrame:
    """Latest store by a grouped maximum, which each task computes ahead of the shuffle."""
    paid = payment.filter(_year("payment_date", year))
    revenue = paid.groupBy("staff_id").agg(F.sum("amount").alias("revenue"))
    last = (_linked_payments(payment, rental, inventory, year).groupBy("staff_id")
            .agg(F.max_by("store_id", F.struct("payment_date", "payment_id")).alias("store_id")))
    return _earner_rows(staff, revenue, last, _stores(store, address), k)


def top_earners_scalar(staff, payment, rental, inventory, store, address, year, k=3) -> DataFrame:
    """One correlated subquery per staff member, for the sum and the latest store together, so
    that the chain to the copies is planned once; only payments that reach a copy count."""
    latest = F.max_by("store_id", F.struct("payment_date", "payment_id"))
    own = (_linked_payments(payment, rental, inventory, year)
           .where(F.col("staff_id") == F.col("this_staff").outer())
           .select(F.struct(F.sum("amount").alias("revenue"), latest.alias("store_id"))).scalar())
    sold = (staff.withColumnRenamed("staff_id", "this_staff").withColumn("_own", own)
            .select("this_staff", "first_name", "last_name", "_own.revenue", "_own.store_id")
            .filter("revenue IS NOT NULL"))
    return (sold.join(_stores(store, address), "store_id")
            .select(F.col("this_staff").alias("staff_id"),
                    full_name(F.col("first_name"), F.col("last_name")).alias("staff_full_name"),
                    F.col("store_id").alias("last_store_id"),
                    F.col("store_address").alias("last_store_address"),
                    F.col("revenue").cast(MONEY).alias("revenue"))
            .orderBy(F.desc("revenue"), "staff_id").limit(k))


# --- Most rented films with the audience they suit ------------------------------------

def _popular(counted: DataFrame, k: int) -> DataFrame:
    return (counted.select("film_id", "title", "number_of_rentals", "rating",
                           audience_label(F.col("rating")).alias("audience"))
            .orderBy(F.desc("number_of_rentals"), "title", "film_id").limit(k))


def popular_films_join(film, inventory, rental, k=5) -> DataFrame:
    return _popular(
        film.select("film_id", "title", "rating")
        .join(inventory.select("film_id", "inventory_id"), "film_id")
        .join(rental.select("inventory_id", "rental_id"), "inventory_id")
        .groupBy("film_id", "title", "rating")
        .agg(F.count("rental_id").alias("number_of_rentals")), k)


def popular_films_scalar(film, inventory, rental, k=5) -> DataFrame:
    rented = (inventory.select("inventory_id", "film_id")
              .join(rental.select("inventory_id", "rental_id"), "inventory_id")
              .where(F.col("film_id") == F.col("this_film").outer())
              .select(F.count("rental_id")).scalar())
    return _popular(film.withColumnRenamed("film_id", "this_film")
                    .withColumn("number_of_rentals", rented).filter("number_of_rentals > 0")
                    .withColumnRenamed("this_film", "film_id"), k)


def popular_films_cte(film, inventory, rental, k=5) -> DataFrame:
    per_copy = rental.groupBy("inventory_id").agg(F.count("rental_id").alias("n"))
    per_film = (per_copy.join(inventory.select("inventory_id", "film_id"), "inventory_id")
                .groupBy("film_id").agg(F.sum("n").alias("number_of_rentals")))
    return _popular(film.join(per_film, "film_id"), k)


# --- Actors without a film for the longest time ---------------------------------------

def _film_years(film_actor: DataFrame, film: DataFrame) -> DataFrame:
    return (film_actor.select("actor_id", "film_id")
            .join(film.select("film_id", "release_year"), "film_id")
            .select("actor_id", "release_year"))


def longest_inactive(actor, film_actor, film, as_of: dt.date | None = None) -> DataFrame:
    last = _film_years(film_actor, film).groupBy("actor_id").agg(
        F.max("release_year").alias("last_release_year"))
    this_year = F.year(F.current_date()) if as_of is None else F.lit(as_of.year)
    earliest = at_extremum(last, "last_release_year", greatest=False)
    return (actor.join(earliest, "actor_id")
            .select("actor_id", "first_name", "last_name", "last_release_year",
                    (this_year - F.col("last_release_year")).alias("inactivity_years"))
            .orderBy("last_name", "first_name", "actor_id"))


def longest_inactive_scalar(actor, film_actor, film, as_of: dt.date | None = None) -> DataFrame:
    latest = (_film_years(film_actor, film)
              .where(F.col("actor_id") == F.col("this_actor").outer())
              .select(F.max("release_year")).scalar())
    this_year = F.year(F.current_date()) if as_of is None else F.lit(as_of.year)
    idle = (actor.withColumnRenamed("actor_id", "this_actor")
            .select(F.col("this_actor").alias("actor_id"), "first_name", "last_name",
                    latest.alias("last_release_year"))
            .withColumn("inactivity_years", this_year - F.col("last_release_year")))
    return at_extremum(idle, "inactivity_years").orderBy("last_name", "first_name", "actor_id")


# --- Longest break between two films of an actor --------------------------------------

_GAP_ORDER = ["last_name", "first_name", "previous_release_year", "actor_id"]


def _gap_rows(actor: DataFrame, gaps: DataFrame) -> DataFrame:
    return (actor.join(at_extremum(gaps, "gap_in_years"), "actor_id")
            .select("actor_id", "first_name", "last_name", "previous_release_year",
                    "next_release_year", "gap_in_years").orderBy(*_GAP_ORDER))


def largest_gap_window(actor, film_actor, film) -> DataFrame:
    gaps = consecutive_gaps(_film_years(film_actor, film), "actor_id", "release_year")
    return _gap_rows(actor, gaps.select(
        "actor_id", F.col("release_year").alias("previous_release_year"),
        F.col("next_value").alias("next_release_year"), F.col("gap").alias("gap_in_years")))


def _numbered_years(film_actor: DataFrame, film: DataFrame) -> DataFrame:
    """Distinct years of each actor, counted upwards; as many per actor as the calendar
    has at most."""
    years = _film_years(film_actor, film).dropna().distinct()
    upwards = W.partitionBy("actor_id").orderBy("release_year")
    # read twice; as a shared exchange it would run twice once AQE splits a key
    return materialise(years.withColumn("position", F.row_number().over(upwards)), "years")


def largest_gap_selfjoin(actor, film_actor, film) -> DataFrame:
    """Each year joined to the following one of the same actor.

    The join is on the position of the year: one pair per year, where a join on "later
    than" would form all pairs of an actor only to drop most of them.
    """
    years = _numbered_years(film_actor, film)
    following = years.select("actor_id", (F.col("position") - 1).alias("position"),
                             F.col("release_year").alias("next_release_year"))
    gaps = years.withColumnRenamed("release_year", "previous_release_year").join(
        following, ["actor_id", "position"])
    gap = F.col("next_release_year") - F.col("previous_release_year")
    return _gap_rows(actor, gaps.withColumn("gap_in_years", gap))


def largest_gap_scalar(actor, film_actor, film) -> DataFrame:
    """The following year as a correlated subquery, again by position."""
    years = _numbered_years(film_actor, film)
    following = (years.where((F.col("actor_id") == F.col("this_actor").outer())
                             & (F.col("position") - 1 == F.col("this_position").outer()))
                 .select(F.min("release_year")).scalar())
    gaps = (years.select(F.col("actor_id").alias("this_actor"),
                         F.col("position").alias("this_position"),
                         F.col("release_year").alias("previous_release_year"))
            .select(F.col("this_actor").alias("actor_id"), "previous_release_year",
                    following.alias("next_release_year"))
            .filter("next_release_year IS NOT NULL")
            .withColumn("gap_in_years",
                        F.col("next_release_year") - F.col("previous_release_year")))
    return _gap_rows(actor, gaps)
