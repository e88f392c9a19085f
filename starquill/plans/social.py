"""The social schema: its integrity rules, and its load through natural keys."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starquill.plans import quality as q
from starquill.plans.jobs import (Loaded, Lookup, load_through_lookups, upsert_ignore_any,
                                  with_audit_column)

# What a visibility and a media type may be.
VISIBILITIES = ["public", "private", "followers_only"]
MEDIA_TYPES = ["image", "video", "gif"]


class Table(NamedTuple):
    """Rules of one table.  ``moment`` is its timestamp column, ``short`` its columns of
    at most 255 characters, ``optional`` the columns that may be NULL."""

    id: str
    moment: str | None
    short: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    not_blank: tuple[str, ...] = ()
    one_of: dict[str, list[str]] = {}
    differ: tuple[tuple[str, str], ...] = ()


_BOTH_VISIBLE = {"profile_visibility": VISIBILITIES, "post_visibility": VISIBILITIES}

TABLES = {
    "users": Table("user_id", "created_at", ("username", "email", "display_name", "location_info"),
                   ("personal_info", "location_info"), (("username",), ("email",)),
                   ("username", "email")),
    "hashtags": Table("hashtag_id", None, ("hashtag_name",), (), (("hashtag_name",),),
                      ("hashtag_name",)),
    "user_profile_history": Table("profile_history_id", "changed_at",
                                  ("display_name", "location_info"),
                                  ("personal_info", "location_info")),
    "privacy_setting": Table("privacy_id", "updated_at", (), (), (("user_id",),), (),
                             _BOTH_VISIBLE),
    "privacy_setting_history": Table("privacy_history_id", "changed_at", one_of=_BOTH_VISIBLE),
    "posts": Table("post_id", "posted_at", (), ("body",), (), ("body",),
                   {"visibility": VISIBILITIES}),
    "post_medias": Table("media_id", "added_at", (), (), (), ("url",),
                         {"media_type": MEDIA_TYPES}),
    "post_hashtags": Table("post_hashtag_id", "tagged_at", unique=(("post_id", "hashtag_id"),)),
    "likes": Table("like_id", "liked_at", unique=(("user_id", "post_id"),)),
    "comments": Table("comment_id", "commented_at", (), ("parent_comment_id",), (), ("body",)),
    "follows": Table("follow_id", "followed_at", unique=(("follower_id", "followee_id"),),
                     differ=(("follower_id", "followee_id"),)),
    "shares": Table("share_id", "shared_at", (), ("shared_note",), (), ("shared_note",)),
}

# Child, column, parent; the parent column is the id of the parent table.
_LINKS = [
    ("user_profile_history", "user_id", "users"), ("privacy_setting", "user_id", "users"),
    ("privacy_setting_history", "user_id", "users"), ("posts", "user_id", "users"),
    ("post_medias", "post_id", "posts"), ("post_hashtags", "post_id", "posts"),
    ("post_hashtags", "hashtag_id", "hashtags"), ("likes", "post_id", "posts"),
    ("likes", "user_id", "users"), ("comments", "post_id", "posts"),
    ("comments", "user_id", "users"), ("comments", "parent_comment_id", "comments"),
    ("follows", "follower_id", "users"), ("follows", "followee_id", "users"),
    ("shares", "post_id", "posts"), ("shares", "user_id", "users"),
]

REFERENCES = [q.Reference(child, (column,), parent, (TABLES[parent].id,))
              for child, column, parent in _LINKS]


def _checks(name: str) -> dict[str, Column]:
    table = TABLES[name]
    rules = {f"{table.id} is positive": q.positive(table.id)}
    if table.moment:
        rules[f"{table.moment} is after the start of 2000"] = q.after_instant(table.moment)
    rules.update({f"{c} is at most 255 long": q.at_most_long(c) for c in table.short})
    rules.update({f"{c} is not blank": q.not_blank(c) for c in table.not_blank})
    rules.update({f"{c} is known": q.one_of(c, allowed) for c, allowed in table.one_of.items()})
    rules.update({f"{a} differs from {b}": q.differ(a, b) for a, b in table.differ})
    return rules


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Every row of the given tables that breaks a rule of the schema."""
    found = []
    for name, df in tables.items():
        table = TABLES[name]
        found.append(q.check_violations(df, name, [table.id], _checks(name)))
        required = [c for c in df.columns if c not in table.optional]
        found.append(q.not_null_violations(df, name, required))
        for key in ((table.id,), *table.unique):
            found.append(q.unique_violations(df, name, key, f"{', '.join(key)} is unique"))
        for ref in REFERENCES:
            if ref.child == name and ref.parent in tables:
                found.append(q.foreign_key_violations(
                    df, name, ref.columns, tables[ref.parent], ref.parent_key,
                    f"{ref.columns[0]} is in {ref.parent}"))
    return reduce(DataFrame.unionByName, found)


def delete_users(tables: dict[str, DataFrame], doomed: DataFrame) -> dict[str, DataFrame]:
    """The tables after the given users and all that hangs on them are removed."""
    known = [ref for ref in REFERENCES if ref.child in tables and ref.parent in tables]
    keys = {name: (TABLES[name].id,) for name in tables}
    lost = q.cascade_closure(tables, keys, known, {"users": doomed})
    return {name: df.join(lost[name], TABLES[name].id, "left_anti") if name in lost else df
            for name, df in tables.items()}


_USER = ("users", {"username": "username"}, {"user_id": "user_id"})
_POST = ("posts", {"posted_at": "post_posted_at"}, {"post_id": "post_id"})
_TAG = ("hashtags", {"hashtag_name": "hashtag_name"}, {"hashtag_id": "hashtag_id"})
_PARENT = ("comments", {"post_id": "post_id", "body": "parent_body",
                        "commented_at": "parent_commented_at"},
           {"comment_id": "parent_comment_id"})

# Table, lookups from its seed to other tables, natural key; parents come first.
_LOADS = [
    ("user_profile_history", [_USER], ("user_id", "changed_at")),
    ("privacy_setting", [_USER], ("user_id",)),
    ("privacy_setting_history", [_USER], ("user_id", "changed_at")),
    ("posts", [_USER], ("user_id", "posted_at")),
    ("post_medias", [_POST], ("url",)),
    ("hashtags", [], ("hashtag_name",)),
    ("post_hashtags", [_POST, _TAG], ("post_id", "hashtag_id")),
    ("likes", [_USER, _POST], ("user_id", "post_id")),
    ("comments", [_USER, _POST], ("user_id", "post_id", "body", "commented_at")),
    ("follows", [("users", {"username": "follower_username"}, {"user_id": "follower_id"}),
                 ("users", {"username": "followee_username"}, {"user_id": "followee_id"})],
     ("follower_id", "followee_id")),
    ("shares", [_USER, _POST], ("user_id", "post_id", "shared_at")),
]


def _load_users(seed: DataFrame, users: DataFrame) -> Loaded:
    """A user is new if neither the name nor the e-mail is taken, in the table or by a user
    of the batch with a lesser name."""
    return upsert_ignore_any(users, seed, [["username"], ["email"]], ["username", "email"],
                             "user_id")


def load(tables: dict[str, DataFrame], seeds: dict[str, DataFrame],
         as_of: dt.date | None = None) -> dict[str, Loaded]:
    """Load seeds whose references are natural keys; a second run adds nothing.

    Seeds name users by ``username`` (follows by ``follower_username`` and
    ``followee_username``), posts by ``post_posted_at``, hashtags by ``hashtag_name``.
    Replies go into the seed ``replies``, with ``parent_body`` and ``parent_commented_at``;
    they are loaded after the comments and may answer any of them.
    """
    state, done = dict(tables), {}

    def put(name: str, loaded: Loaded) -> None:
        state[name] = with_audit_column(loaded.state, as_of)
        added = with_audit_column(loaded.changed, as_of)
        if name in done:
            added = done[name].changed.unionByName(added, allowMissingColumns=True)
        done[name] = Loaded(state[name], added)

    if "users" in seeds:
        put("users", _load_users(seeds["users"], state["users"]))
    loads = [(name, name, links, key) for name, links, key in _LOADS]
    at = [name for name, *_ in _LOADS].index("comments") + 1
    loads.insert(at, ("comments", "replies", [_USER, _POST, _PARENT], _LOADS[at - 1][2]))
    for name, seed, links, key in loads:
        if seed in seeds:
            lookups = [Lookup(state[table], on, take) for table, on, take in links]
            put(name, load_through_lookups(seeds[seed], lookups, state[name], key,
                                           TABLES[name].id))
    return done
