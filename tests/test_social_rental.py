from __future__ import annotations

import datetime as dt
from decimal import Decimal as d

import pytest

from starquill.plans import social
from starquill.rental import RentalDatabase
from starquill.session import new_table_path
from starquill.sources.inline import values
from starquill.sources.tables import SOCIAL_SCHEMAS


def at(hour, minute=0):
    return dt.datetime(2026, 3, 20, hour, minute)


DAY = dt.date(2026, 4, 1)
SEEDS = {
    "users": ("username string, email string, password_hash string, display_name string, "
              "created_at timestamp_ntz",
              [("kim", "kim@example.org", "h", "Kim", at(1)),
               ("lee", "lee@example.org", "h", "Lee", at(1)),
               ("kim2", "old@example.org", "h", "Taken", at(1)),
               ("old", "new@example.org", "h", "Taken", at(1))]),
    "user_profile_history": ("username string, display_name string, changed_at timestamp_ntz",
                             [("kim", "K.", at(2)), ("kim", "K.", at(2)), ("nobody", "N", at(2))]),
    "privacy_setting": ("username string, profile_visibility string, post_visibility string, "
                        "updated_at timestamp_ntz", [("kim", "public", "private", at(2))]),
    "privacy_setting_history": ("username string, profile_visibility string, "
                                "post_visibility string, changed_at timestamp_ntz",
                                [("kim", "private", "private", at(1))]),
    "posts": ("username string, body string, visibility string, posted_at timestamp_ntz",
              [("kim", "first", "public", at(9)), ("lee", None, "private", at(9, 5))]),
    "post_medias": ("post_posted_at timestamp_ntz, media_type string, url string, "
                    "added_at timestamp_ntz", [(at(9), "gif", "https://example.org/a", at(9, 1))]),
    "hashtags": ("hashtag_name string", [("spark",), ("sql",), ("spark",)]),
    "post_hashtags": ("post_posted_at timestamp_ntz, hashtag_name string, tagged_at timestamp_ntz",
                      [(at(9), "spark", at(9, 2)), (at(9), "none", at(9, 2))]),
    "likes": ("username string, post_posted_at timestamp_ntz, liked_at timestamp_ntz",
              [("lee", at(9), at(10)), ("lee", at(9), at(10, 30)), ("old", at(9), at(10))]),
    "comments": ("username string, post_posted_at timestamp_ntz, body string, "
                 "commented_at timestamp_ntz", [("lee", at(9), "great", at(10, 5))]),
    "replies": ("username string, post_posted_at timestamp_ntz, body string, "
                "commented_at timestamp_ntz, parent_body string, "
                "parent_commented_at timestamp_ntz",
                [("kim", at(9), "thanks", at(10, 7), "great", at(10, 5)),
                 ("kim", at(9, 5), "lost", at(10, 7), "great", at(10, 5))]),
    "follows": ("follower_username string, followee_username string, followed_at timestamp_ntz",
                [("kim", "lee", at(11)), ("lee", "kim", at(11))]),
    "shares": ("username string, post_posted_at timestamp_ntz, shared_note string, "
               "shared_at timestamp_ntz", [("lee", at(9), "look", at(12))]),
}
N_ADDED = {"users": 2, "user_profile_history": 1, "privacy_setting": 1,
           "privacy_setting_history": 1, "posts": 2, "post_medias": 1, "hashtags": 2,
           "post_hashtags": 1, "likes": 2, "comments": 2, "follows": 2, "shares": 1}


@pytest.fixture(scope="module")
def loaded(spark):
    tables = {name: values(spark, [], schema) for name, schema in SOCIAL_SCHEMAS.items()}
    tables["users"] = values(spark, [(4, "old", "old@example.org", "h", "Old", None, None, at(0),
                                      dt.date(2026, 1, 1))], SOCIAL_SCHEMAS["users"])
    seeds = {name: values(spark, rows, schema) for name, (schema, rows) in SEEDS.items()}
    return social.load(tables, seeds, DAY), seeds


def test_load(loaded):
    done, _ = loaded
    assert {name: step.changed.count() for name, step in done.items()} == N_ADDED
    comments = {r["body"]: r for r in done["comments"].state.collect()}
    assert comments["thanks"]["parent_comment_id"] == comments["great"]["comment_id"]
    users = {r["username"]: (r["user_id"], r["record_ts"]) for r in done["users"].state.collect()}
    assert users == {"old": (4, dt.date(2026, 1, 1)), "kim": (5, DAY), "lee": (6, DAY)}


def test_load_again_adds_nothing(loaded):
    done, seeds = loaded
    again = social.load({name: step.state for name, step in done.items()}, seeds, DAY)
    assert {name: step.changed.count() for name, step in again.items()} == dict.fromkeys(N_ADDED, 0)


def test_loaded_tables_break_no_rule(loaded):
    done, _ = loaded
    found = social.violations({name: step.state for name, step in done.items()}).collect()
    assert found == []


def test_seeded_violations_are_found(spark, loaded):
    done, _ = loaded
    bad = values(spark, [(1, 5, 5, dt.datetime(2000, 1, 1), DAY), (2, 5, 99, at(1), None),
                         (2, 5, 6, at(1), DAY)], SOCIAL_SCHEMAS["follows"])
    found = social.violations({"users": done["users"].state, "follows": bad}).collect()
    assert sorted((r["rule_name"], r["row_key"], r["n_rows"]) for r in found) == [
        ("follow_id is unique", "2", 2), ("followed_at is after the start of 2000", "1", 1),
        ("followee_id is in users", "99", 1), ("follower_id differs from followee_id", "1", 1),
        ("not null record_ts", "", 1)]


def test_delete_cascades(spark, loaded):
    done, _ = loaded
    tables = {name: step.state for name, step in done.items()}
    left = social.delete_users(tables, values(spark, [(5,)], "user_id long"))
    assert {n: df.count() for n, df in left.items()} == {
        "users": 2, "user_profile_history": 0, "privacy_setting": 0, "privacy_setting_history": 0,
        "posts": 1, "post_medias": 0, "hashtags": 2, "post_hashtags": 0, "likes": 0,
        "comments": 0, "follows": 0, "shares": 0}


def test_rental_database(spark, rental):
    folder = new_table_path(spark, "rental")
    for name, df in rental.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    db = RentalDatabase(spark, folder)
    assert [r["film_id"] for r in db.category_films().collect()] == [1]
    assert [r["revenue"] for r in db.store_revenue().collect()] == [
        d("17.98"), d("1.00"), d("0.00")]
    assert db.busiest_actors().first()["actor_id"] == 2
    assert len(db.yearly_category_counts().columns) == 4
    assert db.top_earners().count() == 2
    assert db.popular_films(k=1).first()["title"] == "ALPHA RING"
    assert db.longest_inactive(dt.date(2020, 1, 1)).count() == 1
    assert db.largest_gap().count() == 2
    assert db.category_revenue("2017-Q2").count() == 1
    assert db.current_category_revenue(dt.date(2017, 5, 1)).count() == 1
    assert db.most_popular_films(["norland"]).first()["film"] == "ALPHA RING"
    assert db.films_in_stock("%RING").count() == 2
    assert db.copies_in_stock().count() + db.copies_not_in_stock().count() == 6
    assert db.copy_holders().count() == 6
    as_of = dt.datetime(2018, 6, 1)
    assert db.customer_balance(1, as_of).first() in db.customer_balances(as_of).collect()
    assert [r["customer_id"] for r in db.rewards_report(1, 1, dt.date(2017, 12, 1)).collect()] == [2]
