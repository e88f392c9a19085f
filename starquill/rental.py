"""All reports and table functions on a folder of rental tables, called by name.

Parameters default to the values the original reports were asked for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from starquill import catalog
from starquill.plans import reports
from starquill.plans import table_functions as tf
from starquill.sources.tables import RENTAL_SCHEMAS, TableSet


class RentalDatabase(TableSet):
    """Parquet tables ``<folder>/<table>.parquet`` of the rental schema.

    ``form`` picks one of the equivalent formulations of a report; the default is the one
    meant for large tables.
    """

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder, RENTAL_SCHEMAS)

    def _tables(self, names: str) -> list[DataFrame]:
        return [self[name] for name in names.split()]

    def register_sql(self, prefix: str = "", names: Sequence[str] | None = None) -> list[str]:
        """The tables as views, and the table functions and views as SQL; see ``catalog``."""
        return catalog.register(self.spark, {name: self[name] for name in self.schemas}, prefix,
                                names)

    def category_films(self, category: str = "Animation", years: tuple[int, int] = (2017, 2019),
                       min_rate: float = 1, form: str = "semi") -> DataFrame:
        run = getattr(reports, f"category_films_{form}")
        return run(*self._tables("film film_category category"), category, years, min_rate)

    def store_revenue(self, since: str = "2017-04-01 00:00:00", form: str = "preagg"
                      ) -> DataFrame:
        run = getattr(reports, f"store_revenue_{form}")
        return run(*self._tables("store address inventory rental payment"), since)

    def busiest_actors(self, since_year: int = 2015, k: int = 5, form: str = "cte") -> DataFrame:
        run = getattr(reports, f"busiest_actors_{form}")
        return run(*self._tables("actor film_actor film"), since_year, k)

    def yearly_category_counts(self, names: dict[str, str] | None = None, form: str = "cte"
                               ) -> DataFrame:
        names = names or {"number_of_drama_movies": "Drama", "number_of_travel_movies": "Travel",
                          "number_of_documentary_movies": "Documentary"}
        run = getattr(reports, f"yearly_category_counts_{form}")
        return run(*self._tables("film film_category category"), names)

    def top_earners(self, year: int = 2017, k: int = 3, form: str = "cte") -> DataFrame:
        run = getattr(reports, f"top_earners_{form}")
        return run(*self._tables("staff payment rental inventory store address"), year, k)

    def popular_films(self, k: int = 5, form: str = "cte") -> DataFrame:
        run = getattr(reports, f"popular_films_{form}")
        return run(*self._tables("film inventory rental"), k)

    def longest_inactive(self, as_of: dt.date | None = None, form: str = "cte") -> DataFrame:
        run = {"cte": reports.longest_inactive, "scalar": reports.longest_inactive_scalar}[form]
        return run(*self._tables("actor film_actor film"), as_of)

    def largest_gap(self, form: str = "window") -> DataFrame:
        run = getattr(reports, f"largest_gap_{form}")
        return run(*self._tables("actor film_actor film"))

    def category_revenue(self, period: str) -> DataFrame:
        tables = self._tables("payment rental inventory film_category category")
        return tf.category_revenue(*tables, period)

    def revenue_of_periods(self, periods: DataFrame, text: str = "period") -> DataFrame:
        tables = self._tables("payment rental inventory film_category category")
        return tf.revenue_of_periods(*tables, periods, text)

    def current_category_revenue(self, as_of: dt.date | None = None) -> DataFrame:
        tables = self._tables("payment rental inventory film_category category")
        return tf.current_category_revenue(*tables, as_of)

    def most_popular_films(self, countries: Sequence[str | None]) -> DataFrame:
        tables = self._tables("country city address customer rental inventory film language")
        return tf.most_popular_films(*tables, countries)

    def films_in_stock(self, pattern: str) -> DataFrame:
        tables = self._tables("film language inventory rental customer")
        return tf.films_in_stock(*tables, pattern)

    def copies_in_stock(self, film_id=None, store_id=None) -> DataFrame:
        return tf.copies_in_stock(*self._tables("inventory rental"), film_id, store_id)

    def copies_not_in_stock(self, film_id=None, store_id=None) -> DataFrame:
        return tf.copies_not_in_stock(*self._tables("inventory rental"), film_id, store_id)

    def copy_holders(self) -> DataFrame:
        return tf.copy_holders(*self._tables("inventory rental"))

    def customer_balances(self, as_of: dt.datetime) -> DataFrame:
        return tf.customer_balances(*self._tables("customer rental inventory film payment"), as_of)

    def customer_balance(self, customer_id: int, as_of: dt.datetime) -> DataFrame:
        tables = self._tables("customer rental inventory film payment")
        return tf.customer_balance(customer_id, *tables, as_of)

    def rewards_report(self, min_purchases: int, min_amount, ref_date: dt.date | None = None
                       ) -> DataFrame:
        return tf.rewards_report(*self._tables("customer payment"), min_purchases, min_amount,
                                 ref_date)
