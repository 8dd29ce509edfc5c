"""Exact dedup by skew-safe combining.

Three rounds of the same grouping, each on the whole text: equal texts meet in
their task (map-side), then within (digest, salt), then the salt winners meet
per digest.  A group of copies, however large, sends at most one row per task
to each of its salts, and at most ``salts`` rows to its last meeting.  The way
back to the documents goes by (digest, salt), so it is spread the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import lower_ascii, row_hash
from textmill.storage import materialize

SALTS = 32


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _keyed(docs: DataFrame, digest: Callable[[Column], Column], salts: int) -> DataFrame:
    text = lower_ascii(F.col("text"))
    return docs.select(
        F.col("doc_id"), text.alias("norm"), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt")
    ).withColumn("digest", digest(F.col("norm")))


def copy_groups(
    docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = SALTS
) -> DataFrame:
    """Per (digest, salt): ``keep_id`` and ``group_size`` of the text's group.

    ``content`` is the text where several different texts share the digest, else
    null.  The table is written to the shared folder.
    """
    met = (
        _keyed(docs, digest, salts)
        .groupBy("digest", "salt", "norm")
        .agg(F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n"))
    )
    same_digest = Window.partitionBy("digest")
    same_text = Window.partitionBy("digest", "norm")
    won = met.select(
        "digest",
        "salt",
        F.max("top").over(same_text).alias("keep_id"),
        F.sum("n").over(same_text).alias("group_size"),
        F.when(F.min("norm").over(same_digest) != F.max("norm").over(same_digest), F.col("norm")).alias("content"),
    )
    return materialize(won, "copy-groups")


def exact_dedup(
    docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = SALTS
) -> DataFrame:
    """Mark, of each group of equal texts, the row with the largest ``doc_id``.

    Texts are equal if identical after lower-casing A-Z; a null text counts as
    empty, and a null ``doc_id`` is below all others.  Returns one row per input
    row: ``doc_id, keep_id, group_size, kept, text_sha256``; other columns are
    ignored.  Rows that repeat the id as well as the text are all marked kept
    (``keep_exact`` leaves one of them).  An empty table gives an empty result.
    """
    groups = copy_groups(docs, digest, salts)
    rows = _keyed(docs, digest, salts)
    clear = groups.where(F.col("content").isNull()).drop("content")
    linked = rows.join(clear, ["digest", "salt"])
    shared = groups.where(F.col("content").isNotNull()).withColumnRenamed("content", "norm")
    if not shared.isEmpty():
        # different texts share the digest: those rows are told apart by content
        linked = linked.unionByName(rows.join(shared, ["digest", "salt", "norm"]))
    name = F.lower(F.hex("digest")) if digest is sha256 else F.sha2("norm", 256)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return linked.select("doc_id", "keep_id", "group_size", kept.alias("kept"), name.alias("text_sha256"))


def keep_exact(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """``docs`` without the copies: all columns, one row of each group of equal texts.

    Winners are joined by text digest and id together, so that the copies of a
    hot text are spread by their ids; a row repeated with id and text stays once.
    """
    groups = copy_groups(docs, sha256, salts)
    plain = groups.where(F.col("content").isNull())
    wanted = plain.groupBy("digest").agg(F.max("keep_id").alias("keep_id"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id"), sha256(lower_ascii(F.col("text"))).alias("digest"))
    won = rows.join(wanted, (rows.digest == wanted.digest) & rows.doc_id.eqNullSafe(wanted.keep_id)).select(
        "row", rows.digest, rows.doc_id
    )
    shared = groups.where(F.col("content").isNotNull())
    if not shared.isEmpty():
        odd = shared.groupBy("digest", "content").agg(F.max("keep_id").alias("keep_id"))
        won = won.unionByName(
            rows.join(
                odd,
                (rows.digest == odd.digest)
                & rows.doc_id.eqNullSafe(odd.keep_id)
                & (lower_ascii(F.col("row.text")) == odd.content),
            ).select("row", rows.digest, rows.doc_id)
        )
    twin = Window.partitionBy("digest", "doc_id").orderBy(F.xxhash64("row.text"), row_hash(docs.schema, "row"))
    return won.withColumn("twin", F.row_number().over(twin)).where("twin = 1").select("row.*")
