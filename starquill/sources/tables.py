"""Table schemas and loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RENTAL_SCHEMAS = {
    "film": "film_id int, title string, description string, release_year int, language_id int, "
            "original_language_id int, rental_duration int, rental_rate decimal(4,2), length int, "
            "replacement_cost decimal(5,2), rating string, last_update timestamp_ntz",
    "language": "language_id int, name string, last_update timestamp_ntz",
    "actor": "actor_id int, first_name string, last_name string, last_update timestamp_ntz",
    "film_actor": "actor_id int, film_id int, last_update timestamp_ntz",
    "category": "category_id int, name string",
    "film_category": "film_id int, category_id int",
    "inventory": "inventory_id int, film_id int, store_id int, last_update timestamp_ntz",
    "rental": "rental_id int, rental_date timestamp_ntz, inventory_id int, customer_id int, "
              "return_date timestamp_ntz, staff_id int, last_update timestamp_ntz",
    "payment": "payment_id int, customer_id int, staff_id int, rental_id int, "
               "amount decimal(5,2), payment_date timestamp_ntz",
    "customer": "customer_id int, first_name string, last_name string, email string, "
                "address_id int, last_update timestamp_ntz",
    "staff": "staff_id int, first_name string, last_name string, store_id int",
    "store": "store_id int, address_id int",
    "address": "address_id int, address string, address2 string, city_id int",
    "city": "city_id int, country_id int",
    "country": "country_id int, country string",
    "customer_role_map": "role_name string, customer_id int",
}

STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
              "props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "conversations": "conv_id long, turn long, role string, text string",
}

SOCIAL_SCHEMAS = {
    "users": "user_id long, username string, email string, password_hash string, "
             "display_name string, personal_info string, location_info string, "
             "created_at timestamp_ntz, record_ts date",
    "hashtags": "hashtag_id long, hashtag_name string, record_ts date",
    "user_profile_history": "profile_history_id long, user_id long, display_name string, "
                            "personal_info string, location_info string, "
                            "changed_at timestamp_ntz, record_ts date",
    "privacy_setting": "privacy_id long, user_id long, profile_visibility string, "
                       "post_visibility string, updated_at timestamp_ntz, record_ts date",
    "privacy_setting_history": "privacy_history_id long, user_id long, profile_visibility string, "
                               "post_visibility string, changed_at timestamp_ntz, record_ts date",
    "posts": "post_id long, user_id long, body string, visibility string, "
             "posted_at timestamp_ntz, record_ts date",
    "post_medias": "media_id long, post_id long, media_type string, url string, "
                   "added_at timestamp_ntz, record_ts date",
    "post_hashtags": "post_hashtag_id long, post_id long, hashtag_id long, "
                     "tagged_at timestamp_ntz, record_ts date",
    "likes": "like_id long, post_id long, user_id long, liked_at timestamp_ntz, record_ts date",
    "comments": "comment_id long, post_id long, user_id long, parent_comment_id long, "
                "body string, commented_at timestamp_ntz, record_ts date",
    "follows": "follow_id long, follower_id long, followee_id long, "
               "followed_at timestamp_ntz, record_ts date",
    "shares": "share_id long, post_id long, user_id long, shared_note string, "
              "shared_at timestamp_ntz, record_ts date",
}


class TableSet:
    """Parquet tables ``<folder>/<name>.parquet``, opened when first asked for.

    A declared schema spares the job that would read it from a file footer.
    """

    def __init__(self, spark: SparkSession, folder: str, schemas: dict[str, str] | None = None):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.schemas = schemas or {}
        self._open: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            reader = self.spark.read
            if name in self.schemas:
                reader = reader.schema(self.schemas[name])
            self._open[name] = reader.parquet(self.path(name))
        return self._open[name]
