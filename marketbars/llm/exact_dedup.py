"""Exact de-duplication by a content sort.

Every text goes through one range shuffle whose splitters Spark samples over the
data: the first characters of the normalised text, its digest and a salt of the
row. The sort-based aggregate behind it sorts each range externally, so equal
texts lie next to each other, and compares neighbours over their full length.
A run of equal texts gives one row, its smallest identifier and its size. The
salt lets the splitters cut a large group of copies into several ranges; the
runs of one text, at most ``SALTS``, are brought together by digest and length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketbars.llm.common import one_space, tasks, unused

SALTS = 64
HEAD = 24  # characters of the text in a splitter, so that sampled splitters stay small


def digest(text: Column) -> Column:
    return F.sha2(one_space(text).cast("binary"), 256)


def _salt(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(SALTS)).cast("int")


def text_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text and salt: sha, salt, keep_id and group_size of the whole group."""
    texts = docs.select(
        F.col(id_col).alias("_doc"),
        one_space(F.col(text_col)).alias("_text"),
        _salt(F.col(id_col)).alias("_salt"),
    )
    keyed = texts.withColumn("_head", F.substring("_text", 1, HEAD)).withColumn(
        "_sha", F.sha2(F.col("_text").cast("binary"), 256)
    )
    order = ["_head", "_sha", "_salt"]
    runs = (
        keyed.repartitionByRange(tasks(docs.sparkSession), *order)
        .groupBy("_head", "_sha", "_salt", "_text")
        # A minimum of structs keeps the aggregate on the external sort; nulls come last.
        .agg(
            F.min(F.struct(F.col("_doc").isNull(), "_doc")).alias("low"),
            F.count(F.lit(1)).alias("n"),
        )
        .select("_sha", "_salt", "low._doc", "n", F.length("_text").alias("_long"))
        .withColumnRenamed("_doc", "low")
    )
    group = Window.partitionBy("_sha", "_long")
    return runs.select(
        F.col("_sha").alias("sha"),
        F.col("_salt").alias("salt"),
        F.min("low").over(group).alias("keep_id"),
        F.sum("n").over(group).alias("group_size"),
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's group: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty. The row with the smallest id stays; a null id is
    above all others, so a group whose ids are all null keeps its null rows.
    Rows that repeat both id and text are one document: all of them carry
    ``kept``, and ``drop_copies`` leaves one. Columns of ``docs`` beyond the two
    named are not read. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        digest(F.col(text_col)).alias("text_sha256"),
        _salt(F.col(id_col)).alias("_salt"),
    )
    runs = text_runs(docs, id_col, text_col)
    # Salted on both sides: a large group of copies is spread over SALTS keys.
    return rows.join(
        runs, (rows["text_sha256"] == runs["sha"]) & (rows["_salt"] == runs["salt"])
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct normalised text, all columns."""

    def key(doc_id: Column, sha: Column) -> Column:
        return F.concat_ws(" ", sha, doc_id.cast("string"))

    stay = (
        exact_groups(docs, id_col, text_col)
        .where("kept")
        .select(key(F.col("doc_id"), F.col("text_sha256")).alias("_stay"))
    )
    own = unused(docs, "_key")
    keyed = docs.withColumn(own, key(F.col(id_col), digest(F.col(text_col))))
    # The join's partitioning serves the choice among repeated rows as well.
    return (
        keyed.join(stay, keyed[own] == stay["_stay"], "left_semi")
        .dropDuplicates([own])
        .drop(own)
    )
