"""Load, update and delete jobs.

A job reads immutable inputs and returns the new state of a table, with the changed rows
beside it where a caller needs them.  Writing the state (``sources.files.stage_table``) is
left to the caller, so a job that fails half-way leaves the old table untouched.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starquill.functions.scalars import is_blank, late_fee_amount, same_text, whole_days
from starquill.operators.rows import first_per_key, number_rows, pick_first
from starquill.session import materialise

# Terms of a newly added film and the years a film may carry.
NEW_FILM_DURATION = 3
NEW_FILM_RATE = "4.99"
NEW_FILM_REPLACEMENT = "19.99"
DEFAULT_LANGUAGE = "Klingon"
FIRST_YEAR, LAST_YEAR = 1901, 2155


class Loaded(NamedTuple):
    """The new state of a table and the rows the job added, changed or removed."""

    state: DataFrame
    changed: DataFrame


def _with_keys(df: DataFrame, keys: Sequence[Column]) -> tuple[DataFrame, list[str]]:
    names = [f"_key{i}" for i in range(len(keys))]
    return df.select("*", *[k.alias(n) for k, n in zip(keys, names)]), names


def absent_rows(batch: DataFrame, target: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``.

    The distinct target keys are cut down to the keys of the batch.  Where those are small
    enough to broadcast, Catalyst moves that filter below the distinct step, and the target
    is filtered in place; where not, the distinct step comes first and collapses a key that
    very many target rows share before anything is shuffled.
    """
    keyed, names = _with_keys(batch, keys)
    present = _with_keys(target, keys)[0].select(*names).distinct()
    present = present.join(keyed.select(*names).distinct(), names, "left_semi")
    return keyed.join(present, names, "left_anti").drop(*names)


def without_repeats(batch: DataFrame, keys: Sequence[Column], order: Sequence[Column | str]
                    ) -> DataFrame:
    """Of the rows with equal keys the first in ``order``.

    All columns stand behind the given order, which fixes the choice.  A key with a NULL in
    it equals no other, so such rows all stay.
    """
    keyed, names = _with_keys(batch, keys)
    complete = reduce(and_, [F.col(n).isNotNull() for n in names])
    chosen = first_per_key(keyed.filter(complete), names, [*order, *batch.columns])
    return chosen.unionByName(keyed.filter(~complete)).drop(*names)


def greatest_id(target: DataFrame, id_column: str) -> int:
    """The greatest id in use, 0 in an empty table."""
    return target.agg(F.coalesce(F.max(id_column), F.lit(0))).first()[0]


def assign_ids(batch: DataFrame, target: DataFrame, id_column: str,
               order: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` with ids that follow the greatest id of ``target``.

    The greatest id is read once and row positions come from a written table, so every
    later use of the rows sees the same ids.
    """
    return number_rows(batch, order, id_column, after=greatest_id(target, id_column))


def _moment(moment: dt.datetime | None) -> Column:
    return F.current_timestamp() if moment is None else F.lit(moment.isoformat(" "))


def dated(rows: DataFrame, table: DataFrame, moment: dt.datetime | None,
          name: str = "last_update") -> DataFrame:
    """``rows`` with ``moment`` (now, if None) as update time, if ``table`` keeps one."""
    if name not in table.columns:
        return rows
    return rows.withColumn(name, _moment(moment).cast(table.schema[name].dataType))


def without_any_repeats(batch: DataFrame, keys: Sequence[Sequence[str]],
                        order: Sequence[str]) -> DataFrame:
    """The rows that remain if rows are taken in ``order`` and each that shares any of
    ``keys`` with an earlier taken one is passed over.

    In each round the rows that come first under all their keys are taken, and the rows that
    share a key with one of them go.  Runs jobs while it is called, a few per round.
    """
    open_ = materialise(number_rows(batch, order, "_row"), "open-batch")
    taken = open_.limit(0)
    while not open_.isEmpty():
        ranked = open_.withColumn("_first", F.lit(True))
        for key in keys:
            names = [f"_k{i}" for i in range(len(key))]
            least = (open_.dropna(subset=list(key)).groupBy(*key)
                     .agg(F.min("_row").alias("_least"))
                     .select("_least", *[F.col(c).alias(n) for c, n in zip(key, names)]))
            match = reduce(and_, [F.col(c) == F.col(n) for c, n in zip(key, names)])
            earlier = F.coalesce(F.col("_least") < F.col("_row"), F.lit(False))
            ranked = (ranked.join(least, match, "left")
                      .withColumn("_first", F.col("_first") & ~earlier).drop("_least", *names))
        ranked = materialise(ranked, "ranked-batch")
        first = ranked.filter("_first").drop("_first")
        rest = ranked.filter("NOT _first").drop("_first")
        for key in keys:
            rest = absent_rows(rest, first, [F.col(c) for c in key])
        taken = taken.unionByName(first)
        open_ = materialise(rest, "open-batch")
    return taken.drop("_row")


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[Column],
                     id_column: str | None = None, order: Sequence[str] = (),
                     moment: dt.datetime | None = None) -> Loaded:
    """Add the rows whose key is new; of equal keys in the batch the first in ``order``.

    New rows get ``moment`` as ``last_update`` where the table has that column.  The batch
    without repeats is written out once, so this runs a job while it is called.
    """
    reduced = materialise(without_repeats(batch, keys, order), "batch")
    new = dated(absent_rows(reduced, target, keys), target, moment)
    if id_column:
        new = assign_ids(new, target, id_column, order)
    return Loaded(target.unionByName(new, allowMissingColumns=True), new)


def upsert_ignore(target: DataFrame, batch: DataFrame, key: Sequence[str],
                  order: Sequence[str]) -> Loaded:
    """Add new keys and leave present ones as they are."""
    return insert_if_absent(target, batch, [F.col(k) for k in key], order=[*key, *order])


def upsert_ignore_any(target: DataFrame, batch: DataFrame, keys: Sequence[Sequence[str]],
                      order: Sequence[str], id_column: str | None = None) -> Loaded:
    """Add, in ``order``, the rows that share none of several unique keys with a row that is
    there or was added before them."""
    new = batch
    for key in keys:
        new = absent_rows(new, target, [F.col(c) for c in key])
    new = without_any_repeats(new, keys, order)
    if id_column:
        new = assign_ids(new, target, id_column, order)
    return Loaded(target.unionByName(new, allowMissingColumns=True), new)


def upsert_update(target: DataFrame, batch: DataFrame, key: Sequence[str],
                  columns: Sequence[str], order: Sequence[str]) -> Loaded:
    """Add new keys and take ``columns`` of present ones from the batch, NULL included.

    One outer join on the key, which is unique on both sides; rows with a NULL in the key meet
    nothing and are spread by a hash, so that they don't fall into one task.
    """
    batch = without_repeats(batch, [F.col(k) for k in key], order)

    def spread(df: DataFrame) -> Column:
        complete = reduce(and_, [F.col(k).isNotNull() for k in key])
        return F.when(complete, F.lit(0).cast("long")).otherwise(F.xxhash64(*df.columns))

    held = target.select("*", F.lit(True).alias("_held"), spread(target).alias("_spread"))
    given = batch.select(*[F.col(c).alias(f"_new_{c}") for c in batch.columns],
                         F.lit(True).alias("_hit"), spread(batch).alias("_new_spread"))
    match = reduce(and_, [F.col(k) == F.col(f"_new_{k}") for k in key],
                   F.col("_spread") == F.col("_new_spread"))

    def state(c: str) -> Column:
        if c not in batch.columns:
            return F.col(c)
        new = F.col(f"_new_{c}")
        if c not in target.columns:
            return F.when(F.col("_held").isNull(), new).alias(c)
        from_batch = F.col("_hit") if c in columns else F.col("_held").isNull()
        return F.when(from_batch, new).otherwise(F.col(c)).alias(c)

    states = [state(c) for c in dict.fromkeys([*target.columns, *batch.columns])]
    return Loaded(held.join(given, match, "full").select(*states), batch)


def insert_films(film: DataFrame, language: DataFrame, seed: DataFrame,
                 moment: dt.datetime | None = None) -> Loaded:
    """Add films (title, year, language name, ...) that are not yet there by title and year."""
    known = language.select("language_id", F.lower(F.btrim("name")).alias("_language"))
    known = first_per_key(known, ["_language"], ["language_id"])
    rows = (seed.withColumn("_language", F.lower(F.btrim("language")))
            .join(known, "_language").drop("_language", "language"))
    keys = [F.lower("title"), F.col("release_year")]
    return insert_if_absent(film, rows, keys, "film_id", ["title", "release_year"], moment)


class BridgeLoad(NamedTuple):
    actor: DataFrame
    film_actor: DataFrame
    new_actors: DataFrame
    new_links: DataFrame


def load_bridge(actor: DataFrame, film: DataFrame, film_actor: DataFrame,
                seed: DataFrame, moment: dt.datetime | None = None) -> BridgeLoad:
    """Load (first_name, last_name, title) rows: missing actors first, then the links of
    old and new actors to the films of that title.  If the seed has a ``release_year``, a
    row that names one means only the films of that year."""
    names = seed.select("first_name", "last_name").distinct()
    actor_key = [F.lower("first_name"), F.lower("last_name")]
    actors = insert_if_absent(actor, names, actor_key, "actor_id", ["last_name", "first_name"],
                              moment)
    people = actors.state.select("actor_id", F.lower("first_name").alias("_first"),
                                 F.lower("last_name").alias("_last"))
    dates = "release_year" in seed.columns
    titles = film.select("film_id", F.lower("title").alias("_title"),
                         *(["release_year"] if dates else []))
    wanted = seed.select(F.lower("first_name").alias("_first"),
                         F.lower("last_name").alias("_last"),
                         F.lower("title").alias("_title"),
                         *([F.col("release_year").alias("_year")] if dates else [])).distinct()
    links = people.join(wanted, ["_first", "_last"]).join(titles, "_title")
    if dates:
        links = links.filter(F.col("_year").isNull() | (F.col("_year") == F.col("release_year")))
    links = links.select("actor_id", "film_id").distinct()
    new_links = dated(absent_rows(links, film_actor, [F.col("actor_id"), F.col("film_id")]),
                      film_actor, moment)
    return BridgeLoad(actors.state, film_actor.unionByName(new_links, allowMissingColumns=True),
                      actors.changed, new_links)


def insert_copies(inventory: DataFrame, film: DataFrame, store_id: Column,
                  moment: dt.datetime | None = None) -> Loaded:
    """One copy of every given film at one store, where the pair is not there yet.

    ``store_id`` is a scalar subquery (one chosen store) or a literal, so the pairing is a
    projection and no join.
    """
    pairs = film.select("film_id", store_id.alias("store_id")).filter("store_id IS NOT NULL")
    new = dated(absent_rows(pairs, inventory, [F.col("film_id"), F.col("store_id")]),
                inventory, moment)
    return Loaded(inventory.unionByName(new, allowMissingColumns=True), new)


def update_first_active_customer(customer: DataFrame, rental: DataFrame, payment: DataFrame,
                                 min_rows: int, new_values: dict[str, Column]) -> Loaded:
    """Overwrite columns of the first customer with enough rentals and enough payments."""
    def busy(fact: DataFrame) -> DataFrame:
        return (fact.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") >= min_rows).select("customer_id"))

    both = busy(rental).join(busy(payment), "customer_id", "left_semi").select("customer_id")
    chosen = both.agg(F.min("customer_id")).scalar()
    is_chosen = F.coalesce(F.col("customer_id") == chosen, F.lit(False))
    flagged = customer.withColumn("_chosen", is_chosen)
    state = flagged.select(*[
        (F.when(F.col("_chosen"), new_values[c]).otherwise(F.col(c)).alias(c)
         if c in new_values else F.col(c)) for c in customer.columns])
    changed = customer.filter(F.col("customer_id") == chosen).withColumns(new_values)
    return Loaded(state, changed)


class HistoryDelete(NamedTuple):
    payment: DataFrame
    rental: DataFrame
    deleted_payments: DataFrame
    deleted_rentals: DataFrame


def delete_history(customer: DataFrame, doomed: Column, payment: DataFrame,
                   rental: DataFrame) -> HistoryDelete:
    """Remove the payments, then the rentals, of the customers that ``doomed`` selects."""
    ids = customer.filter(doomed).select("customer_id")

    def split(df: DataFrame, kind: str) -> DataFrame:
        return df.join(ids, "customer_id", kind).select(*df.columns)

    return HistoryDelete(split(payment, "left_anti"), split(rental, "left_anti"),
                         split(payment, "left_semi"), split(rental, "left_semi"))


class RentAndPay(NamedTuple):
    new_rentals: DataFrame
    new_payments: DataFrame


def rent_and_pay(candidates: DataFrame, customer_id: Column, film: DataFrame,
                 inventory: DataFrame, staff: DataFrame, rental: DataFrame,
                 moment: dt.datetime | None = None) -> RentAndPay:
    """Rent the wanted films to one customer and pay for them, late fee included.

    ``candidates`` has movie_no, title, priority, rental_date, return_date, payment_date.
    Per movie_no the film of the best priority is taken, then its first copy; a rental
    that exists already (copy, customer, date) is skipped.
    """
    films = candidates.withColumn("_title", F.lower("title")).drop("title").join(
        film.select("film_id", F.lower("title").alias("_title"), "rental_rate",
                    "rental_duration"), "_title")
    films = first_per_key(films, ["movie_no"], ["priority", "film_id"]).drop("_title", "priority")
    first_copy = (inventory.join(films.select("film_id"), "film_id", "left_semi")
                  .groupBy("film_id")
                  .agg(F.min(F.struct("inventory_id", "store_id")).alias("_copy"))
                  .select("film_id", "_copy.inventory_id", "_copy.store_id"))
    clerk = staff.groupBy("store_id").agg(F.min("staff_id").alias("staff_id"))
    days = whole_days(F.col("rental_date"), F.col("return_date"))
    amount = late_fee_amount(days, F.col("rental_duration"), F.col("rental_rate"))
    wanted = (films.join(first_copy, "film_id").join(clerk, "store_id", "left")
              .select("movie_no", "inventory_id", customer_id.alias("customer_id"), "staff_id",
                      "rental_date", "return_date", "payment_date", amount.alias("amount"))
              .filter("customer_id IS NOT NULL"))
    keys = [F.col("inventory_id"), F.col("customer_id"), F.col("rental_date")]
    rented = assign_ids(absent_rows(wanted, rental, keys), rental, "rental_id",
                        ["movie_no"])
    return RentAndPay(
        dated(rented.select("rental_id", "rental_date", "inventory_id", "customer_id",
                            "return_date", "staff_id"), rental, moment),
        rented.select("customer_id", "staff_id", "rental_id", "amount", "payment_date"))


def open_rental_like_first(rental: DataFrame, rental_date: dt.datetime,
                           moment: dt.datetime | None = None) -> Loaded:
    """Add an open rental copied from the one with the least id."""
    new_id = greatest_id(rental, "rental_id") + 1
    opened = pick_first(rental, "rental_id").select(*[
        F.lit(new_id).cast(rental.schema[c].dataType).alias(c) if c == "rental_id"
        else F.lit(rental_date.isoformat(" ")).cast("timestamp_ntz").alias(c)
        if c == "rental_date"
        else F.lit(None).cast(rental.schema[c].dataType).alias(c) if c == "return_date"
        else F.col(c) for c in rental.columns])
    opened = dated(opened, rental, moment)
    return Loaded(rental.unionByName(opened), opened)


def close_newest_rental(rental: DataFrame, return_date: dt.datetime,
                        moment: dt.datetime | None = None) -> Loaded:
    """Set the return date of the rental with the greatest id."""
    newest = F.col("rental_id") == rental.agg(F.max("rental_id")).scalar()
    returned = F.lit(return_date.isoformat(" ")).cast("timestamp_ntz")
    changes = {"return_date": returned}
    if "last_update" in rental.columns:
        changes["last_update"] = _moment(moment).cast(rental.schema["last_update"].dataType)
    state = rental.withColumns({
        c: F.when(newest, value).otherwise(F.col(c)) for c, value in changes.items()})
    return Loaded(state, rental.filter(newest).withColumns(changes))


class NewFilms(NamedTuple):
    film: DataFrame
    language: DataFrame
    accepted: DataFrame
    rejected: DataFrame


def add_films(film: DataFrame, language: DataFrame, candidates: DataFrame,
              strict: bool = False, moment: dt.datetime | None = None) -> NewFilms:
    """Add films given as (line_no, title, release_year, language), each checked.

    A batch without the column ``release_year`` means the year of ``moment`` (now, if None),
    one without ``language`` the language DEFAULT_LANGUAGE; new rows get ``moment`` as
    ``last_update``.  The checked batch is written out while this is called, so that repeated
    line numbers do no harm.

    Refused are a blank title, a missing or impossible year, a blank language, and a title
    that exists or came up earlier in the batch.  A missing language is added, or refused
    with ``strict``.  Titles and languages compare by trimmed upper case.
    """
    if "release_year" not in candidates.columns:
        candidates = candidates.withColumn("release_year", F.year(_moment(moment).cast("timestamp")))
    if "language" not in candidates.columns:
        candidates = candidates.withColumn("language", F.lit(DEFAULT_LANGUAGE))
    film_titles = film.select(same_text(F.col("title")).alias("_title"))
    checked = candidates.withColumn("_title", same_text(F.col("title")))
    known_titles = film_titles.join(checked.select("_title").distinct(), "_title", "left_semi")
    known_titles = known_titles.distinct().withColumn("_known", F.lit(True))
    known_languages = first_per_key(
        language.select(same_text(F.col("name")).alias("_language"), "language_id"),
        ["_language"], ["language_id"])
    checked = (checked.join(known_titles, "_title", "left")
               .withColumn("_language", same_text(F.col("language")))
               .join(known_languages, "_language", "left"))
    reason = (F.when(is_blank(F.col("title")), "blank title")
              .when(F.col("release_year").isNull(), "no year")
              .when(~F.col("release_year").between(FIRST_YEAR, LAST_YEAR), "year out of range")
              .when(is_blank(F.col("language")), "blank language")
              .when(F.col("_known"), "title exists"))
    if strict:
        reason = reason.when(F.col("language_id").isNull(), "unknown language")
    checked = materialise(checked.withColumns({
        "reason": reason, "_row": F.monotonically_increasing_id()}), "candidates")
    valid = checked.filter("reason IS NULL")
    winners = materialise(first_per_key(valid, ["_title"], ["line_no", "_row"]), "winners")
    repeated = (valid.join(winners.select("_row"), "_row", "left_anti")
                .withColumn("reason", F.lit("title exists")))
    rejected = (checked.filter("reason IS NOT NULL").unionByName(repeated)
                .select("line_no", "title", "release_year", "language", "reason"))

    missing = first_per_key(winners.filter("language_id IS NULL"), ["_language"], ["line_no"])
    added = dated(assign_ids(missing.select(F.btrim("language").alias("name"), "_language"),
                             language, "language_id", ["name"]), language, moment)
    named = winners.join(added.select("_language", F.col("language_id").alias("_added_id")),
                         "_language", "left")
    rows = named.select("line_no", F.btrim("title").alias("title"), "release_year",
                        F.coalesce("language_id", "_added_id").alias("language_id"),
                        F.lit(NEW_FILM_DURATION).alias("rental_duration"),
                        F.lit(NEW_FILM_RATE).cast("decimal(4,2)").alias("rental_rate"),
                        F.lit(NEW_FILM_REPLACEMENT).cast("decimal(5,2)")
                        .alias("replacement_cost"))
    accepted = dated(assign_ids(rows, film, "film_id", ["line_no", "title"]), film, moment)
    return NewFilms(film.unionByName(accepted.drop("line_no"), allowMissingColumns=True),
                    language.unionByName(added.drop("_language"), allowMissingColumns=True),
                    accepted, rejected)


def with_audit_column(df: DataFrame, as_of: dt.date | None = None,
                      name: str = "record_ts") -> DataFrame:
    """Add the audit date, or fill it where it is missing; dates present stay."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    present = F.col(name) if name in df.columns else F.lit(None).cast("date")
    return df.withColumn(name, F.coalesce(present, day))


def stamp_changed(df: DataFrame, changed: Column, moment: dt.datetime,
                  name: str = "last_update") -> DataFrame:
    """Set the update time of the rows that ``changed`` selects."""
    stamp = F.lit(moment.isoformat(" ")).cast("timestamp_ntz")
    return df.withColumn(name, F.when(changed, stamp).otherwise(F.col(name)))


def compare_states(old: DataFrame, new: DataFrame, key: Sequence[str],
                   ignoring: Sequence[str] = ("last_update",)) -> DataFrame:
    """Rows that differ between two states of a table: the columns of the new state (of the old
    one for what is gone) and ``change``, one of ``inserted``, ``updated`` and ``deleted``.

    ``key`` is unique in each state.  Rows of equal key differ if any column that both states
    have, other than those in ``ignoring``, differs, a NULL counting as a value.  Both states are
    first reduced to key and a digest of the row (SHA-256 over lengths and texts), so only those
    meet; the few rows that differ then fetch their columns from the state they are in.
    """
    compared = [c for c in new.columns if c in old.columns and c not in (*key, *ignoring)]

    def digested(df: DataFrame, side: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"{side}{k}") for k in key],
                         row_digest([F.col(c) for c in compared]).alias(f"{side}digest"))

    both = digested(old, "_before_").join(digested(new, "_after_"), reduce(and_, [
        F.col(f"_before_{k}").eqNullSafe(F.col(f"_after_{k}")) for k in key]), "full")
    before, after = F.col("_before_digest"), F.col("_after_digest")
    kind = (F.when(before.isNull(), "inserted").when(after.isNull(), "deleted")
            .when(before != after, "updated"))
    picked = materialise(both.withColumn("change", kind).filter("change IS NOT NULL").select(
        *[F.when(after.isNull(), F.col(f"_before_{k}")).otherwise(F.col(f"_after_{k}"))
          .alias(f"_of_{k}") for k in key], "change"), "changed-keys")

    def rows(state: DataFrame, wanted: Column) -> DataFrame:
        keys = picked.filter(wanted)
        return state.join(keys, reduce(and_, [
            F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in key])).drop(*[f"_of_{k}" for k in key])

    return rows(new, F.col("change") != "deleted").unionByName(
        rows(old, F.col("change") == "deleted"), allowMissingColumns=True)


def row_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 over the values of a row; a NULL differs from an empty text, and neighbouring
    values cannot run into each other."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(F.lit(""), *[part(c) for c in columns]).cast("binary"), 256)


def stamp_changes(old: DataFrame, new: DataFrame, key: Sequence[str], moment: dt.datetime,
                  name: str = "last_update") -> Loaded:
    """The new state with ``moment`` as update time of every row that was added or changed
    since the old state; all others keep the time they had there."""
    changes = compare_states(old, new, key, ignoring=[name])
    fresh = changes.filter("change <> 'deleted'").drop("change")
    kept = old.select(*[F.col(k).alias(f"_of_{k}") for k in key], F.col(name).alias("_time"))
    kept = kept.join(changes.select(*[F.col(k).alias(f"_c_{k}") for k in key]), reduce(and_, [
        F.col(f"_of_{k}").eqNullSafe(F.col(f"_c_{k}")) for k in key]), "left_anti")
    columns = [c for c in new.columns if c != name]
    same = (new.select(*columns).join(kept, reduce(and_, [
        F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in key]))
        .select(*columns, F.col("_time").alias(name)))
    stamped = fresh.select(*columns, F.lit(moment.isoformat(" "))
                           .cast(old.schema[name].dataType).alias(name))
    return Loaded(same.unionByName(stamped), changes)


def token_vectors(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """Per document its terms in order, each with its positions: ``vector``, an array of
    (term, positions).  A NULL text has none, and an empty vector.

    Terms are runs of letters of any script, with their marks, lower-cased; there is neither
    stemming nor a stop list.  Positions count from 1.  All happens inside the row: the words are
    sorted with their positions, and the places where a new term begins cut them into slices.
    No row is shuffled and none is multiplied.
    """
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[^\p{L}\p{M}]+"),
                     lambda w: w != "")
    placed = F.array_sort(F.transform(F.col("_words"), lambda w, i: F.struct(
        F.lower(w).alias("term"), (i + 1).alias("position"))))
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.size("_placed"), F.lit(1))), lambda i: (
        i <= F.size("_placed")) & ((i == 1) | (
            F.get("_placed", i - 1)["term"] != F.get("_placed", i - 2)["term"])))
    ends = F.concat(F.slice("_starts", 2, F.greatest(F.size("_starts"), F.lit(1))),
                    F.array(F.size("_placed") + 1))
    vector = F.transform(F.arrays_zip("_starts", "_ends"), lambda x: F.struct(
        F.get("_placed", x["_starts"] - 1)["term"].alias("term"),
        # by place: a slice would copy the whole array for every term
        F.transform(F.sequence(x["_starts"], x["_ends"] - 1),
                    lambda i: F.get("_placed", i - 1)["position"]).alias("positions")))
    empty = F.array().cast("array<struct<term:string,positions:array<int>>>")
    return (documents.select(id_column, words.alias("_words"))
            .select(id_column, placed.alias("_placed"))
            .select(id_column, "_placed", at.alias("_starts"))
            .select(id_column, "_placed", "_starts", ends.alias("_ends"))
            .select(id_column, F.when(F.size("_placed") > 0, vector).otherwise(empty)
                    .alias("vector")))


def postings_of(vectors: DataFrame, id_column: str) -> DataFrame:
    """The vectors turned round: (term, document, positions).

    An outer explode, as Catalyst moves the test for empty vectors that it adds to a plain one
    below the vectors, and with it the sorting into each step of making them.
    """
    return (vectors.select(id_column, F.explode_outer("vector").alias("_entry"))
            .select("_entry.term", id_column, "_entry.positions").filter("term IS NOT NULL"))


def merge_postings(postings: DataFrame, changed: DataFrame, id_column: str) -> DataFrame:
    """The postings after some documents came or changed: those of all others as they are, and
    those of the vectors in ``changed``; a document whose vector is empty or NULL there is
    gone from the index.  Only the changed documents are looked at."""
    ids = changed.select(id_column).distinct()
    return postings.join(ids, id_column, "left_anti").select(
        "term", id_column, "positions").unionByName(postings_of(changed, id_column))


def token_index(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """Postings (term, document, occurrences, first position) of whole texts.

    Terms are runs of letters of any script, with their marks, lower-cased; there is neither
    stemming nor a stop list.  Positions count from 1.  The text is split as it stands and the single
    terms are lower-cased: Catalyst repeats the split in a filter on empty results, and a
    dearer expression under it would be repeated as well.
    """
    # a text that starts with another character splits into an empty first token
    skipped = F.when(F.col(text).rlike(r"^[^\p{L}\p{M}]"), 1).otherwise(0)
    tokens = F.posexplode(F.split(text, r"[^\p{L}\p{M}]+"))
    return (documents.select(id_column, text, skipped.alias("skipped"))
            .select(id_column, "skipped", tokens.alias("position", "term"))
            .filter(F.col("term") != "")
            .groupBy(F.lower("term").alias("term"), id_column)
            .agg(F.count(F.lit(1)).alias("occurrences"),
                 (F.min(F.col("position") - F.col("skipped")) + 1).alias("first_position")))


class Lookup(NamedTuple):
    """A dimension used by a load: ``on`` maps its columns to columns of the seed, and
    ``take`` maps its columns to columns of the target."""

    table: DataFrame
    on: dict[str, str]
    take: dict[str, str]
    optional: bool = False


def load_through_lookups(seed: DataFrame, lookups: Sequence[Lookup], target: DataFrame,
                         natural_key: Sequence[str], id_column: str | None = None) -> Loaded:
    """Load seed rows whose references are given by natural keys.

    Each lookup replaces a natural key by the id of the table it belongs to; rows whose
    natural key is in the target already are left out, so a second run adds nothing.
    """
    rows = seed
    for i, lookup in enumerate(lookups):
        if not lookup.on:
            raise ValueError("a lookup needs a column to match on")
        side = lookup.table.select(
            *[F.col(c).alias(f"_on{i}_{c}") for c in lookup.on],
            *[F.col(c).alias(name) for c, name in lookup.take.items()])
        match = F.lit(True)
        for c, seed_column in lookup.on.items():
            match = match & (F.col(f"_on{i}_{c}") == F.col(seed_column))
        rows = rows.join(side, match, "left" if lookup.optional else "inner")
    own = [c for c in target.columns if c in rows.columns]
    rows = rows.select(*own)
    keys = [F.col(c) for c in natural_key]
    return insert_if_absent(target, rows, keys, id_column, list(natural_key))
