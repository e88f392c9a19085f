from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starquill.plans import access, quality as q
from starquill.sources.inline import values
from starquill.sources.tables import SOCIAL_SCHEMAS


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def social(spark, name, *data):
    return values(spark, list(data), SOCIAL_SCHEMAS[name])


AT, DAY = dt.datetime(2020, 1, 1), dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def users(spark):
    def user(key, name, email="x@example.org", place=None, at=AT):
        return (key, name, email, "hash", "shown", None, place, at, DAY)

    return social(spark, "users", user(1, "ann"), user(2, "bob", None), user(3, "ann"),
                  user(0, "zero"), user(5, " "), user(6, "new", at=dt.datetime(1999, 12, 31)),
                  user(7, "edge", at=dt.datetime(2000, 1, 1)), user(8, "l" * 256),
                  user(9, None, place=" "), user(10, None))


def test_unique(users):
    # two users share a name; two have none, which is no repetition
    assert rows(q.unique_violations(users, "users", ["username"], "name is unique")) == [
        ("users", "name is unique", "ann", 2)]
    assert rows(q.unique_violations(users, "users", ["user_id"], "key")) == []


def test_checks(users):
    got = rows(q.check_violations(users, "users", ["user_id"], {
        "id": q.positive("user_id"), "name": q.not_blank("username"),
        "since": q.after_instant("created_at"), "length": q.at_most_long("username"),
        "place": F.col("location_info").isNull() | q.not_blank("location_info")}))
    assert [(r[1], r[2]) for r in got] == [
        ("id", "0"), ("length", "8"), ("name", "5"), ("place", "9"), ("since", "6"),
        ("since", "7")]


def test_not_null(users):
    assert rows(q.not_null_violations(users, "users", ["user_id", "email", "username"])) == [
        ("users", "not null email", "", 1), ("users", "not null username", "", 2)]


def test_enumeration_and_pair(spark):
    settings = social(spark, "privacy_setting", (1, 1, "public", "private", AT, DAY),
                      (2, 1, "secret", "public", AT, DAY), (3, 1, None, "public", AT, DAY))
    rule = {"visibility": q.one_of("profile_visibility", ["public", "friends", "private"])}
    assert [r[2] for r in rows(q.check_violations(settings, "privacy_setting", ["privacy_id"],
                                                  rule))] == ["2"]
    follows = social(spark, "follows", (1, 1, 2, AT, DAY), (2, 2, 2, AT, DAY))
    rule = {"not oneself": q.differ("follower_id", "followee_id")}
    assert [r[2] for r in rows(q.check_violations(follows, "follows", ["follow_id"], rule))] == ["2"]


def test_foreign_key(users, spark):
    likes = social(spark, "likes", (1, 1, 1, AT, DAY), (2, 1, 77, AT, DAY), (3, 1, 77, AT, DAY),
                   (4, 1, None, AT, DAY))
    assert rows(q.foreign_key_violations(likes, "likes", ["user_id"], users, ["user_id"], "user")
                ) == [("likes", "user", "77", 2)]


REFERENCES = [
    q.Reference("posts", ("user_id",), "users", ("user_id",)),
    q.Reference("comments", ("post_id",), "posts", ("post_id",)),
    q.Reference("comments", ("parent_comment_id",), "comments", ("comment_id",)),
    q.Reference("likes", ("post_id",), "posts", ("post_id",)),
]


def test_load_order():
    order = q.load_order(REFERENCES)
    assert order.index("users") < order.index("posts") < order.index("comments")
    assert order.index("posts") < order.index("likes")


def test_cascade(users, spark):
    posts = social(spark, "posts", (1, 1, "a", "public", AT, DAY), (2, 6, "b", "public", AT, DAY))
    comments = social(
        spark, "comments", (1, 1, 1, None, "x", AT, DAY), (2, 2, 1, 1, "x", AT, DAY),
        (3, 2, 1, 2, "x", AT, DAY), (4, 2, 1, 3, "x", AT, DAY), (5, 2, 1, None, "x", AT, DAY))
    likes = social(spark, "likes", (1, 1, 6, AT, DAY), (2, 2, 6, AT, DAY))
    tables = {"users": users, "posts": posts, "comments": comments, "likes": likes}
    keys = {"users": ("user_id",), "posts": ("post_id",), "comments": ("comment_id",),
            "likes": ("like_id",)}
    lost = q.cascade_closure(tables, keys, REFERENCES, {"users": users.filter("user_id = 1")})
    assert {name: rows(df) for name, df in lost.items()} == {
        "users": [(1,)], "posts": [(1,)], "comments": [(1,), (2,), (3,), (4,)], "likes": [(1,)]}


@pytest.mark.parametrize("n", [1, 2, 37])
def test_descendants_of_a_long_chain(spark, n):
    chain = spark.range(n).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("up"))
    for root in {0, n // 2, n - 1}:
        got = q.descendants(chain, "id", "up", chain.filter(F.col("id") == root).select("id"))
        assert [r[0] for r in sorted(got.collect())] == list(range(root, n))


def test_descendants_on_a_cycle(spark):
    ring = values(spark, [(1, 2), (2, 3), (3, 1), (4, 1), (5, 99), (6, 7), (7, 6)],
                  "id long, up long")
    got = q.descendants(ring, "id", "up", ring.filter("id = 3").select("id"))
    assert rows(got) == [(1,), (2,), (3,), (4,)]


def test_own_rows(rental):
    role_map = values(rental.customer.sparkSession,
                      [("client_ida_moe", 1), ("client_jan_o_poe", 2), ("client_kit_roe", 3)],
                      "role_name string, customer_id int")
    own = access.own_rows(rental.rental, role_map, "client_ida_moe")
    assert sorted(r["rental_id"] for r in own.collect()) == [1, 3, 5]
    assert access.own_rows(rental.rental, role_map, "client_nobody").isEmpty()
    assert access.foreign_rows(rental.rental, role_map, "client_ida_moe").isEmpty()
    assert rows(access.own_row_counts(rental.rental, role_map)) == [
        ("client_ida_moe", 1, 3), ("client_jan_o_poe", 2, 3), ("client_kit_roe", 3, 0)]


def test_principals(rental):
    args = (rental.customer, rental.rental, rental.payment)
    assert rows(access.principals(*args)) == [("client_ida_moe", 1), ("client_jan_o_poe", 2)]
    assert rows(access.first_principal(*args)) == [("client_ida_moe", 1)]


def test_allowed_columns(rental):
    df = access.allowed_columns(rental.customer, ["customer_id", "first_name"], masked=["email"])
    assert df.columns == ["customer_id", "first_name", "email"]
    assert [r["email"] for r in df.collect()] == [None] * 3
    with pytest.raises(ValueError):
        access.allowed_columns(rental.customer, ["nothing"])
