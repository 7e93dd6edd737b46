"""Exact duplicates: groups by a 128-bit content hash, verified by their bytes.

1. Every row is reduced to a fingerprint (hash, length, id, tag) in one pass over the texts; the
   fingerprints are kept, and all grouping, counting and choosing works on them.
2. Bytes are compared inside the groups: every task reduces its rows to distinct (hash, text), a
   shuffle does the same for all tasks, and a hash that is left with two texts is a collision.
3. Texts of collided hashes are numbered, and their groups are formed by hash and number.

A group of copies, however large, leaves each task as one text and one partial count. Rows go back
to their group by a join that adaptive execution splits where one hash holds many of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.scratch import Scratch

# Fixed value: the white space that does not count.
WHITE = r"[\x20\x09-\x0D]+"


def content(text: Column) -> Column:
    """The text without white space; null is empty."""
    return F.coalesce(F.regexp_replace(text, WHITE, ""), F.lit(""))


def digest_key(digest: Column) -> Column:
    """The first 128 bits of a SHA-256 in hex."""
    return F.unhex(F.substring(digest, 1, 32))


def collided_texts(contents: DataFrame) -> DataFrame:
    """(key, content, part) of the texts that share their key with another one, numbered from 0."""
    distinct = contents.select("key", "content").distinct()
    several = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("key")
    # Texts per key: as many as collide, one in all likelihood.
    order = Window.partitionBy("key").orderBy("content")
    return distinct.join(several, "key", "left_semi").withColumn("part", F.row_number().over(order) - 1)


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", key: Callable[[Column], Column] = digest_key
) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same without white space. Of equal texts the row with the
    most code points in the original text stays, then the one with the smallest id, null ids last.
    Of rows that are equal in both, one stays: exactly one row of a group has `kept`. Null counts as
    empty, so all empty and null texts are one group; very long texts are compared whole; an empty
    table gives no rows; other columns are ignored, whatever their names. `key` makes the grouping
    key out of the SHA-256 in hex: a weaker one only makes more collisions, not other results.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact")
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    rows = rows.select("doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("length"), content(F.col("text")).alias("content"))
    rows = rows.withColumn("digest", F.sha2("content", 256)).withColumn("key", key(F.col("digest")))

    collided = scratch.keep(collided_texts(rows), "collided")
    part = F.lit(0)
    if not collided.isEmpty():
        rows = rows.join(collided, ["key", "content"], "left")
        part = F.coalesce("part", F.lit(0))
    # The tag tells equal rows apart; it is fixed once the table is written.
    prints = rows.select("key", part.alias("part"), "doc_id", "length", F.unhex("digest").alias("digest"), F.monotonically_increasing_id().alias("tag"))
    prints = scratch.keep(prints, "prints")

    best = F.struct((-F.col("length")).alias("shorter"), F.col("doc_id").isNull().alias("none"), "doc_id", "tag")
    groups = prints.groupBy("key", "part").agg(F.count(F.lit(1)).alias("group_size"), F.min(best).alias("best"))
    groups = scratch.keep(groups.select("key", "part", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.tag").alias("keep_tag")), "groups")
    return prints.join(groups, ["key", "part"]).select(
        "doc_id", "keep_id", "group_size", (F.col("tag") == F.col("keep_tag")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )
