from __future__ import annotations

import datetime as dt
from decimal import Decimal as d

import pytest
from pyspark.sql import functions as F

from starquill.plans import jobs
from starquill.sources import files
from starquill.sources.inline import ordered_elements, series, values
from starquill.session import new_table_path


def rows(df):
    return [tuple(r) for r in df.collect()]


def same(a, b):
    return sorted(rows(a), key=repr) == sorted(rows(b), key=repr)


SEED = [("alpha ring", 2017, "english"), ("Alpha Ring", 2016, " FRENCH"),
        ("ALPHA RING", 2016, "English"), ("New One", 2020, "english"), ("No", 2020, "Latin")]


def test_insert_films_and_run_again(rental, spark):
    film = rental.film.select("film_id", "title", "release_year", "language_id")
    seed = values(spark, SEED, "title string, release_year int, language string")
    first = jobs.insert_films(film, rental.language, seed)
    # a new year makes a new film; of two equal rows one is added; the lesser language id wins
    added = sorted(rows(first.changed.select("film_id", F.lower("title"), "release_year")))
    assert added == [(7, "alpha ring", 2016), (8, "new one", 2020)]
    assert first.state.count() == 8
    again = jobs.insert_films(first.state, rental.language, seed)
    assert again.changed.isEmpty() and same(again.state, first.state)


CREDITS = [("ann", "zed", "beta ring"), ("New", "Face", "Omega"), ("New", "Face", "delta"),
           ("Other", "Face", "no such film")]


def test_bridge_load_links_old_and_new_actors_in_one_run(rental, spark):
    seed = values(spark, CREDITS, "first_name string, last_name string, title string")
    links = rental.film_actor.select("actor_id", "film_id")
    first = jobs.load_bridge(rental.actor, rental.film, links, seed)
    assert sorted(rows(first.new_actors.select("actor_id", "first_name", "last_name"))) == [
        (6, "New", "Face"), (7, "Other", "Face")]
    # both actors named Ann Zed are meant; one of them has the film already
    assert sorted(rows(first.new_links.select("actor_id", "film_id"))) == [(4, 2), (6, 4), (6, 6)]
    again = jobs.load_bridge(first.actor, rental.film, first.film_actor, seed)
    assert again.new_actors.isEmpty() and again.new_links.isEmpty()


def test_insert_copies(rental):
    store = rental.store.orderBy("store_id").limit(1).select("store_id").scalar()
    done = jobs.insert_copies(rental.inventory.select("film_id", "store_id"),
                              rental.film.filter("film_id <= 4"), store)
    assert rows(done.changed) == [(4, 1)]
    nowhere = rental.store.filter("store_id = 99").select("store_id").scalar()
    none = jobs.insert_copies(rental.inventory.select("film_id", "store_id"), rental.film, nowhere)
    assert none.changed.isEmpty()


def test_conditional_update(rental):
    def run(min_rows):
        done = jobs.update_first_active_customer(
            rental.customer, rental.rental, rental.payment, min_rows, {"last_name": F.lit("New")})
        return dict(rows(done.state.select("customer_id", "last_name"))), done.changed.count()

    assert run(3) == ({1: "New", 2: "O'Poe", 3: "Roe"}, 1)
    assert run(4) == ({1: "Moe", 2: "O'Poe", 3: "Roe"}, 0)   # four payments but three rentals


def test_delete_history(rental):
    done = jobs.delete_history(rental.customer, F.lower("email") == "ida@example.org",
                               rental.payment, rental.rental)
    assert sorted(r[0] for r in rows(done.payment)) == [2, 4, 7]
    assert sorted(r[0] for r in rows(done.deleted_payments)) == [1, 3, 5, 6]
    assert sorted(r[0] for r in rows(done.rental)) == [2, 4, 6]
    assert sorted(r[0] for r in rows(done.deleted_rentals)) == [1, 3, 5]


WISH = "movie_no int, title string, priority int, rental_date timestamp_ntz, " \
       "return_date timestamp_ntz, payment_date timestamp_ntz"


def test_rent_and_pay(rental, spark):
    at = dt.datetime(2017, 9, 1, 10)
    wishes = [
        (1, "omega", 1, at, at + dt.timedelta(days=9), at),             # no copy
        (2, "Nothing", 1, at, at, at),
        (2, "alpha ring", 2, at, at + dt.timedelta(days=3), at),        # in time
        (2, "beta ring", 3, at, at, at),
        (3, "Delta", 1, at, at + dt.timedelta(days=5, seconds=1), at),  # six days: three late
        (4, "ALPHA LOW", 1, dt.datetime(2017, 6, 1), dt.datetime(2017, 6, 5), at),
    ]
    present = values(spark, [(7, dt.datetime(2017, 6, 1), 6, 2, None, 2, at)],
                     rental.rental.schema)
    before = rental.rental.unionByName(present)
    done = jobs.rent_and_pay(values(spark, wishes, WISH), F.lit(2), rental.film,
                             rental.inventory, rental.staff, before)
    assert sorted(rows(done.new_rentals.select("rental_id", "inventory_id", "customer_id",
                                               "staff_id"))) == [(8, 1, 2, 1), (9, 4, 2, 2)]
    assert sorted(rows(done.new_payments.select("rental_id", "amount"))) == [
        (8, d("2.99")), (9, d("19.96"))]
    after = before.unionByName(done.new_rentals, allowMissingColumns=True)
    again = jobs.rent_and_pay(values(spark, wishes, WISH), F.lit(2), rental.film,
                              rental.inventory, rental.staff, after)
    assert again.new_rentals.isEmpty() and again.new_payments.isEmpty()


def test_open_then_close(rental):
    opened = jobs.open_rental_like_first(rental.rental, dt.datetime(2018, 1, 1))
    new = rows(opened.changed.select("rental_id", "rental_date", "inventory_id", "return_date"))
    assert new == [(7, dt.datetime(2018, 1, 1), 1, None)]
    closed = jobs.close_newest_rental(opened.state, dt.datetime(2018, 1, 2))
    got = dict(rows(closed.state.select("rental_id", "return_date")))
    assert got[7] == dt.datetime(2018, 1, 2) and got[6] is None and len(got) == 7


def test_upserts(spark):
    target = values(spark, [(1, "a", 10), (2, "b", 20)], "k int, name string, n int")
    batch = values(spark, [(2, "B", None), (3, "c", 30), (3, "d", 40)],
                   "k int, name string, n int")
    ignored = jobs.upsert_ignore(target, batch, ["k"], ["name"])
    assert sorted(rows(ignored.state)) == [(1, "a", 10), (2, "b", 20), (3, "c", 30)]
    updated = jobs.upsert_update(target, batch, ["k"], ["n"], ["name"])
    # a NULL in the batch overwrites; columns not listed stay
    assert sorted(rows(updated.state)) == [(1, "a", 10), (2, "b", None), (3, "c", 30)]
    again = jobs.upsert_update(updated.state, batch, ["k"], ["n"], ["name"])
    assert same(again.state, updated.state)


def test_rows_without_a_key_are_all_added(spark):
    target = values(spark, [(None, "a"), (1, "b")], "k int, name string")
    batch = values(spark, [(None, "c"), (None, "d"), (1, "e"), (2, "f"), (2, "g")],
                   "k int, name string")
    done = jobs.upsert_ignore(target, batch, ["k"], ["name"])
    assert sorted(rows(done.changed), key=repr) == [(2, "f"), (None, "c"), (None, "d")]


def test_upsert_update_spreads_null_keys_and_keeps_extra_columns(spark):
    target = values(spark, [(None, "a", 1), (None, "a", 1), (1, "b", 2), (2, "c", 3)],
                    "k int, name string, n int")
    batch = values(spark, [(None, "x", 9), (1, None, 8), (3, "y", 7)], "k int, name string, more int")
    done = jobs.upsert_update(target, batch, ["k"], ["name"], ["name"])
    assert sorted(rows(done.state.select("k", "name", "n", "more")), key=repr) == sorted([
        (None, "a", 1, None), (None, "a", 1, None), (1, None, 2, None), (2, "c", 3, None),
        (None, "x", None, 9), (3, "y", None, 7)], key=repr)


def one_after_another(target, batch):
    """Rows of (name, mail, n) added in order unless the name or the mail is taken."""
    names, mails, added = {t[0] for t in target}, {t[1] for t in target}, []
    for row in sorted(batch, key=lambda r: r[2]):
        if row[0] not in names - {None} and row[1] not in mails - {None}:
            added.append(row)
            names.add(row[0])
            mails.add(row[1])
    return added


def test_upsert_ignore_any_adds_rows_as_if_one_after_another(spark):
    import random
    picks = random.Random(5)
    target = [("n0", "m9", -1), (None, "m8", -2)]
    # a chain in which each row shares a key with the next, and rows drawn at random
    batch = [("n1", "m1", 0), ("n2", "m1", 1), ("n2", "m2", 2), ("n3", "m2", 3), ("n3", "m3", 4)]
    batch += [(picks.choice(["a", "b", "c", "d", "e", "n0", None]),
               picks.choice(["p", "q", "r", "s", "m9", None]), 10 + i) for i in range(30)]
    schema = "name string, mail string, n int"
    first = jobs.upsert_ignore_any(values(spark, target, schema), values(spark, batch, schema),
                                   [["name"], ["mail"]], ["n"])
    assert sorted(rows(first.changed), key=repr) == sorted(one_after_another(target, batch), key=repr)


def test_new_rows_carry_their_update_time(rental, spark):
    at = dt.datetime(2020, 3, 4, 5)
    candidates = values(spark, [(1, "Glass Sea"), (1, "Stone Sea")], "line_no int, title string")
    done = jobs.add_films(rental.film, rental.language, candidates, moment=at)
    got = rows(done.accepted.select("title", "release_year", "last_update"))
    assert sorted(got) == [("Glass Sea", 2020, at), ("Stone Sea", 2020, at)]
    assert rows(done.language.filter("name = 'Klingon'").select("last_update")) == [(at,)]
    closed = jobs.close_newest_rental(
        jobs.open_rental_like_first(rental.rental, at, at).state, at, at + dt.timedelta(days=1))
    assert rows(closed.changed.select("last_update")) == [(at + dt.timedelta(days=1),)]


def test_ids_follow_the_greatest_and_stay(spark):
    batch = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("v"))
    empty = values(spark, [], "k long")
    for target, start in ((empty, 0), (values(spark, [(5,), (41,)], "k long"), 41)):
        got = jobs.assign_ids(batch, target, "k", ["g", "v"])
        want = sorted((v % 7, v) for v in range(1000))
        assert sorted(rows(got.select("k", "g", "v"))) == [
            (start + i + 1, *gv) for i, gv in enumerate(want)]
        assert same(got, got)


CANDIDATES = [(1, " Fresh ", 2003, "klingon"), (2, " ", 2003, "French"), (3, None, 2003, "French"),
              (4, "A", None, "French"), (5, "A", 1900, "French"), (6, "A", 2156, "French"),
              (7, "A", 2000, ""), (8, " alpha RING", 2000, "French"), (9, "FRESH", 2004, "French"),
              (10, "A", 1901, "ENGLISH"), (11, "B", 2155, " Klingon")]
SHAPE = "line_no int, title string, release_year int, language string"


def test_add_films(rental, spark):
    done = jobs.add_films(rental.film, rental.language, values(spark, CANDIDATES, SHAPE))
    assert sorted(rows(done.accepted.select("line_no", "film_id", "title", "language_id"))) == [
        (1, 7, "Fresh", 4), (10, 8, "A", 1), (11, 9, "B", 4)]
    assert dict(rows(done.rejected.select("line_no", "reason"))) == {
        2: "blank title", 3: "blank title", 4: "no year", 5: "year out of range",
        6: "year out of range", 7: "blank language", 8: "title exists", 9: "title exists"}
    terms = done.film.filter("film_id = 7").select("rental_duration", "rental_rate",
                                                   "replacement_cost")
    assert rows(terms) == [(3, d("4.99"), d("19.99"))]
    assert done.language.filter("name = 'klingon'").count() == 1
    again = jobs.add_films(done.film, done.language, values(spark, CANDIDATES, SHAPE))
    assert again.accepted.isEmpty() and again.language.count() == done.language.count()


def test_strict_add_refuses_a_missing_language(rental, spark):
    done = jobs.add_films(rental.film, rental.language, values(spark, CANDIDATES, SHAPE), True)
    assert sorted(r[0] for r in rows(done.accepted.select("line_no"))) == [9, 10]
    assert done.language.count() == 3


def test_audit_column(spark):
    df = values(spark, [(1, dt.date(2000, 1, 1)), (2, None)], "k int, record_ts date")
    day = dt.date(2020, 2, 2)
    assert sorted(rows(jobs.with_audit_column(df, day))) == [(1, dt.date(2000, 1, 1)), (2, day)]
    assert sorted(rows(jobs.with_audit_column(df.select("k"), day))) == [(1, day), (2, day)]


def test_token_index(spark):
    texts = {1: "Red ring, RED-Ring!", 2: " ...blue", 3: "", 4: "Éa über 42", 5: "end.", 6: None,
             7: "Größe über naïve café", 8: "Привет, мир", 9: "日本 語"}
    df = values(spark, list(texts.items()), "id int, text string")
    got = sorted(rows(jobs.token_index(df, "id", "text")))
    import re
    want = []
    for key, text in texts.items():
        words = [w.lower() for w in re.split(r"[\W\d_]+", text or "") if w]
        want += [(w, key, words.count(w), words.index(w) + 1) for w in set(words)]
    assert got == sorted(want)


def test_load_through_lookups_runs_twice(spark):
    users = values(spark, [(1, "ann"), (2, "bob")], "user_id long, username string")
    posts = values(spark, [(10, 1, "hello")], "post_id long, user_id long, body string")
    seed = values(spark, [("ann", "hello"), ("bob", "hello"), ("eve", "hello"), ("bob", "bye")],
                  "username string, body string")
    likes = values(spark, [(3, 10, 1)], "like_id long, post_id long, user_id long")
    lookups = [jobs.Lookup(users, {"username": "username"}, {"user_id": "user_id"}),
               jobs.Lookup(posts, {"body": "body"}, {"post_id": "post_id"})]
    first = jobs.load_through_lookups(seed, lookups, likes, ["post_id", "user_id"], "like_id")
    assert rows(first.changed.select("like_id", "post_id", "user_id")) == [(4, 10, 2)]
    again = jobs.load_through_lookups(seed, lookups, first.state, ["post_id", "user_id"], "like_id")
    assert again.changed.isEmpty()


def test_threaded_replies_find_their_parent(spark):
    loaded = values(spark, [(1, "first", None)], "comment_id long, body string, parent_id long")
    seed = values(spark, [("second", "first"), ("third", "absent"), ("fourth", None)],
                  "body string, parent_body string")
    parent = jobs.Lookup(loaded, {"body": "parent_body"}, {"comment_id": "parent_id"}, True)
    done = jobs.load_through_lookups(seed, [parent], loaded, ["body"], "comment_id")
    assert sorted(rows(done.changed.select("comment_id", "body", "parent_id"))) == [
        (2, "fourth", None), (3, "second", 1), (4, "third", None)]


def test_delete_keeps_null_and_counts(spark):
    table = series(spark, 1, 1000).select(F.concat(F.lit("p_"), "n").alias("col")).unionByName(
        values(spark, [(None,)], "col string"))
    number = F.replace("col", F.lit("p_"), F.lit("")).cast("int")
    kept = files.delete_where(table, number % 3 == 0)
    assert kept.count() == 1000 - 333 + 1


def test_staged_state_replaces_and_truncates(spark):
    path = files.stage_table(series(spark, 1, 50), "t")
    table = spark.read.parquet(path)
    fewer = spark.read.parquet(files.stage_table(files.delete_where(table, table.n > 40), "t"))
    assert (table.count(), fewer.count()) == (50, 40)
    files.append_rows(series(spark, 51, 60), path)
    assert spark.read.parquet(path).count() == 60
    emptied = spark.read.parquet(files.stage_table(files.truncate(table), "t"))
    assert emptied.count() == 0 and emptied.columns == ["n"]


def test_compaction_keeps_rows_in_fewer_files(spark):
    source = new_table_path(spark, "many")
    series(spark, 1, 2000).repartition(16).write.parquet(source)
    target = files.compact(spark, source, "few")
    assert files.table_files(spark, target).count() < files.table_files(spark, source).count()
    assert same(spark.read.parquet(target), spark.read.parquet(source))


def test_partitioned_write_reads_one_folder(spark):
    df = spark.range(300).select("id", F.concat(F.lit("m"), F.col("id") % 3).alias("m"))
    stored = files.write_partitioned(df, new_table_path(spark, "parts"), "m", ["id"])
    one = stored.filter("m = 'm1'")
    assert one.count() == 100
    assert "PartitionFilters: [isnotnull(m" in one._jdf.queryExecution().toString()


def test_footprint(spark, sf_dir):
    sizes = {r["table_name"]: r for r in files.footprint(spark, sf_dir, "%item%").collect()}
    assert list(sizes) == ["lineitem"] and sizes["lineitem"]["n_files"] == 1
    assert sizes["lineitem"]["total_size"].endswith("kB")


def test_ordered_elements(spark):
    assert rows(ordered_elements(spark, ["b", None, "a"], "x").orderBy("position")) == [
        (1, "b"), (2, None), (3, "a")]


@pytest.mark.parametrize("n_bytes,text", [
    (0, "0 bytes"), (10239, "10239 bytes"), (10240, "10 kB"), (20 << 20, "20 MB"),
    (575 * 1024 * 1024, "575 MB"), (11 << 40, "11 TB"), (11 << 50, "11264 TB")])
def test_pretty_size(spark, n_bytes, text):
    from starquill.functions.scalars import pretty_size
    assert rows(values(spark, [(n_bytes,)], "n long").select(pretty_size(F.col("n")))) == [(text,)]
