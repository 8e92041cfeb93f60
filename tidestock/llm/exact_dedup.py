"""Exact dedup: equal texts meet by a 128-bit content hash, their bytes are compared, one row of each group stays.

Only DataFrame functions; nothing leaves the JVM.

1. Every row's text is normalised and hashed (SHA-256, whose first 128 bits are the content hash); ids and
   hashes are written once.
2. Groups are aggregated by content hash *and* text, so that texts of one hash are compared byte by byte and
   different ones are different groups. Tasks aggregate before they shuffle: a text goes over the network
   once for each task that reads it, however many copies there are.
3. Groups of several rows are joined back to the written rows by hash alone. The hot side has a few dozen
   bytes a row and is the one that skew handling may split; the other has one row for each group.
4. Hashes that belong to several texts (none, unless somebody finds a collision) take a join by hash and
   text instead.

Defined results: a null text counts as empty; in each group the row with the least (or largest) id stays. A
null id stays only where its group has no other, and rows that repeat the id that stays are all marked as
kept, since they are one row to the id; :func:`keep_one` leaves one of them. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestock.llm.rows import numbered
from tidestock.session import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; texts of ASCII alone take the quick way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def as_it_is(text: Column) -> Column:
    return text


def content_hash(digest: Column) -> Column:
    """128 bits of a SHA-256 digest (binary)."""
    return F.substring(digest, 1, 16)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
    normalised: Callable[[Column], Column] = as_it_is, hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """For every row: ``id_col``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` (hex, of the normalised text).

    ``hashed`` makes the content hash from the text's SHA-256; a weaker one costs time, never correctness.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    body = normalised(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    texts = docs.select(F.col(id_col).alias("key"), body.alias("body"))
    digest = F.unhex(F.sha2(F.col("body").cast("binary"), 256))
    rows = staged(texts.select("key", digest.alias("digest")), "text-digests")
    rows = rows.withColumn("h", hashed(F.col("digest")))
    hashes = texts.withColumn("h", hashed(digest))
    stays = [pick("key").alias("keep"), F.count(F.lit(1)).alias("n")]
    groups = staged(hashes.groupBy("h", "body").agg(*stays).drop("body"), "text-groups")
    shared = groups.groupBy("h").count().where("count > 1").select("h")

    if shared.isEmpty():
        found = rows.join(groups.where("n > 1"), "h", "left")
    else:  # a hash of several texts: those rows meet by their texts
        plain = rows.join(groups.where("n > 1"), "h", "left").join(shared, "h", "left_anti")
        mixed = hashes.join(shared, "h", "left_semi")
        own = mixed.groupBy("h", "body").agg(*stays)
        by_text = mixed.join(own, ["h", "body"]).withColumn("digest", digest)
        found = plain.unionByName(by_text.select(*plain.columns))
    keep_id = F.when(F.col("n") > 1, F.col("keep")).otherwise(F.col("key"))
    return found.select(
        F.col("key").alias(id_col), keep_id.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("key").eqNullSafe(keep_id).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
    normalised: Callable[[Column], Column] = as_it_is,
) -> DataFrame:
    """``docs`` with one row of each group of equal texts, columns as they are.

    Rows that share id and group are told apart by nothing, so an arbitrary one of them stays.
    """
    named, (key, text) = numbered(docs, id_col, text_col)
    groups = exact_groups(named, key, text, keep, normalised).where("kept")
    stays = groups.select(F.col(key).alias("key"), F.unhex("text_sha256").alias("digest")).distinct()
    body = normalised(F.coalesce(F.col(text).cast("string"), F.lit("")))
    own = named.withColumn("digest", F.unhex(F.sha2(body.cast("binary"), 256)))
    met = own.join(stays, F.col(key).eqNullSafe(F.col("key")) & (own["digest"] == stays["digest"]), "left_semi")
    return met.dropDuplicates([key, "digest"]).select(*named.columns).toDF(*docs.columns)
