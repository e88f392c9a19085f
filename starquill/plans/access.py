"""Filters that show a principal only its own rows and columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starquill.functions.scalars import name_slug
from starquill.operators.rows import first_per_key

ACCOUNT_PREFIX = "client_"


def _mapped_id(role_map: DataFrame, principal: str) -> Column:
    """The customer of a principal; NULL if it has none.  Role names are unique."""
    return role_map.filter(F.col("role_name") == principal).select("customer_id").scalar()


def own_rows(df: DataFrame, role_map: DataFrame, principal: str) -> DataFrame:
    """Rows of the principal's customer; none for an unmapped principal.

    The customer id is a scalar subquery, so the fact is scanned with a plain equality and
    not joined.
    """
    return df.filter(F.col("customer_id") == _mapped_id(role_map, principal))


def foreign_rows(df: DataFrame, role_map: DataFrame, principal: str) -> DataFrame:
    """Rows of others that ``own_rows`` would let through: always empty."""
    return own_rows(df, role_map, principal).filter(
        F.col("customer_id") != _mapped_id(role_map, principal))


def allowed_columns(df: DataFrame, allowed: Sequence[str], masked: Sequence[str] = ()
                    ) -> DataFrame:
    """The allowed columns; masked ones stay as NULL of their type."""
    unknown = (set(allowed) | set(masked)) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.select(*[
        F.lit(None).cast(df.schema[c].dataType).alias(c) if c in masked else F.col(c)
        for c in df.columns if c in allowed or c in masked])


def _accounts(customer: DataFrame, rental: DataFrame, payment: DataFrame) -> DataFrame:
    """Account name of every customer with both rentals and payments; names may repeat."""
    slug = name_slug(ACCOUNT_PREFIX, F.col("first_name"), F.col("last_name"))
    return (customer.join(rental.select("customer_id").distinct(), "customer_id", "left_semi")
            .join(payment.select("customer_id").distinct(), "customer_id", "left_semi")
            .select(slug.alias("role_name"), "customer_id"))


def principals(customer: DataFrame, rental: DataFrame, payment: DataFrame) -> DataFrame:
    """The customer of every account.  Of customers with equal account names the one with the
    least id has the account, so no principal ever sees two customers."""
    return first_per_key(_accounts(customer, rental, payment), ["role_name"], ["customer_id"])


def refused_principals(customer: DataFrame, rental: DataFrame, payment: DataFrame) -> DataFrame:
    """Customers that qualify, but whose account name another one has."""
    accounts = _accounts(customer, rental, payment)
    held = first_per_key(accounts, ["role_name"], ["customer_id"])
    return accounts.join(held.select("customer_id"), "customer_id", "left_anti").select(
        "role_name", "customer_id")


def first_principal(customer: DataFrame, rental: DataFrame, payment: DataFrame) -> DataFrame:
    """The account of the least customer id that qualifies."""
    return principals(customer, rental, payment).orderBy("customer_id").limit(1)


def own_row_counts(df: DataFrame, role_map: DataFrame) -> DataFrame:
    """Number of rows each principal can see, 0 included."""
    counts = df.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    return role_map.join(counts, "customer_id", "left").select(
        "role_name", "customer_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"))
