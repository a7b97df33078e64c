"""Books, authors and posts kept as variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.functions.variants import flatten, path, present


def authors(raw: DataFrame, author: str = "raw_author") -> DataFrame:
    return raw.select(
        path(author, "AUTHOR_UID", "bigint").alias("author_uid"),
        path(author, "FIRST_NAME").alias("first_name"),
        path(author, "MIDDLE_NAME").alias("middle_name"),
        path(author, "LAST_NAME").alias("last_name"),
    )


def book_authors(raw: DataFrame, book: str = "raw_nested_book") -> DataFrame:
    """First and last name of every author of every book."""
    each = flatten(raw, book, "authors", "value")
    return each.select(
        path("value", "first_name").alias("first_nm"), path("value", "last_name").alias("last_nm")
    )


def with_hashtags(posts: DataFrame, post: str = "raw_status") -> DataFrame:
    """First hashtag of every post that has one."""
    where = "entities.hashtags[0].text"
    return posts.filter(present(post, where)).select(path(post, where).alias("first_hashtag"))


def creation_dates(posts: DataFrame, post: str = "raw_status") -> DataFrame:
    """Creation dates in order; sorting by id as well lets the sort cut a busy day apart."""
    day = path(post, "created_at", "date").alias("created_on")
    dated = posts.select(day, path(post, "id", "bigint").alias("_id"))
    return dated.orderBy("created_on", "_id").drop("_id")


def hashtags_normalized(posts: DataFrame, post: str = "raw_status") -> DataFrame:
    """User, post and hashtag text, one row per hashtag."""
    each = flatten(posts, post, "entities.hashtags", "value")
    return each.select(
        path(post, "user.id", "bigint").alias("user_id"),
        path(post, "id", "bigint").alias("tweet_id"),
        path("value", "text").alias("hashtag_text"),
    )
