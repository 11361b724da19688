"""Exact deduplication by skew-safe combining, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import unused
from logwarden.operators.durable import durable

#: Copies of a hot text are spread over this many merge groups before the last merge.
SALTS = 16

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def exact_dedup(docs: DataFrame, salts: int = SALTS, digest=sha256) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are the same without white space; null is the empty text. Of equal
    texts the row with the most code points stays, then the smallest doc_id (a missing id last).
    Rows that repeat both id and text are one document: all of them name it as keep_id, and all
    are marked kept. An empty table gives an empty result; other columns are ignored.

    Copies are combined where they lie (the partial aggregate), then per digest and salt, then
    per digest. All three group by the whole content, so a digest only routes rows and never
    decides. A text held by a third of all rows reaches the salted merge as one row per task.
    """
    rows = docs.select(
        F.col("doc_id").alias("doc_id"), F.length(F.coalesce("text", F.lit(""))).alias("chars"),
        normalized(F.col("text")).alias("content"),
    ).withColumn("digest", digest(F.col("content")))
    # bitwise_not turns the order of ids round without overflow
    best = F.max(F.struct("chars", F.bitwise_not("doc_id").alias("turned"))).alias("best")
    local = (
        rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
        .groupBy("digest", "salt", "content").agg(F.count(F.lit(1)).alias("copies"), best)
    )
    merged = local.groupBy("digest", "content").agg(
        F.sum("copies").alias("group_size"), F.max("best").alias("best"))
    winners = durable(merged.select(
        "digest", "group_size", F.bitwise_not("best.turned").alias("keep_id")), "dedup-winners")
    clash = not winners.groupBy("digest").count().where("count > 1").isEmpty()
    if clash:  # two contents under one digest: the join must look at the contents too
        joined = rows.join(
            merged.select("digest", "content", "group_size", F.bitwise_not("best.turned").alias("keep_id")),
            ["digest", "content"])
    else:
        joined = rows.select("doc_id", "digest").join(winners, "digest")
    return joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns; repeated rows (same id, same text) once.

    Null, empty and blank texts are copies of each other; columns of any name are kept.
    """
    digest, keep_id, keep_digest = (unused(docs, name) for name in ("_digest", "_keep_id", "_keep_digest"))
    kept = exact_dedup(docs).where("kept").select(
        F.col("doc_id").alias(keep_id), F.col("text_sha256").alias(keep_digest)).distinct()
    marked = docs.withColumn(digest, sha256(normalized(F.col("text"))))
    joined = marked.join(kept.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col(keep_id))
                         & (F.col(digest) == F.col(keep_digest)), "left_semi")
    return joined.dropDuplicates(["doc_id", digest]).select(*docs.columns)
