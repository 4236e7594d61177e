"""Exact duplicates: 128-bit content hash, bytes compared inside each group.

Two texts are equal when they agree after lower-casing A to Z. They are grouped
by MD5 *and* the normalised text itself, so the grouping compares bytes and a
hash collision cannot merge two texts. Copies are combined in the map tasks
before the shuffle, therefore a group with any share of the rows sends one row
per map task. Documents then get their group by a narrow join on (MD5, SHA-256),
which adaptive execution splits where a group is hot; should two different texts
ever share both hashes, the job fails rather than treat them as one.

Defined cases: a null text counts as empty; null ids lose against any other id
and tie among themselves; rows that agree in id and text are one document, all of
them are marked kept and ``drop_copies`` passes one of them; an empty table gives
an empty result; other columns are never read by ``exact_groups``.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from lakeferry.llm.common import ship, stored

KEEP = {"smallest": F.min, "largest": F.max}


@F.arrow_udf(T.StringType())
def ascii_lower(text: pa.Array) -> pa.Array:
    return pc.ascii_lower(text)


def normalised(text_col: str) -> Column:
    return ascii_lower(F.coalesce(F.col(text_col), F.lit("")))


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("norm"))
    return rows.select("doc_id", F.unhex(F.md5("norm")).alias("hash"), F.sha2("norm", 256).alias("text_sha256"))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    ship(docs.sparkSession)
    chosen = KEEP[keep]
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("norm"))
    classes = (
        texts.groupBy(F.unhex(F.md5("norm")).alias("hash"), "norm")
        .agg(chosen("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("hash", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
        .groupBy("hash", "text_sha256")
        .agg(
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
            F.count("*").alias("texts"),
        )
        .withColumn(
            "group_size",
            F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
                F.raise_error(F.lit("two texts share MD5 and SHA-256")).cast("long")
            ),
        )
    )
    # Stored, so that the join has a shuffle of its own on both sides and a hot group can be split.
    classes = stored(classes.drop("texts"), "text-groups")
    return _signed(docs, id_col, text_col).join(classes, ["hash", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows that stay, with all their columns; of repeated rows the first by text."""
    stay = (
        exact_groups(docs, id_col, text_col, keep)
        .filter("kept")
        .select(F.col("doc_id").alias("_keep_id"), F.col("text_sha256").alias("_keep_sha"))
        .distinct()
    )
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    keyed = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).alias("doc_id"),
        F.sha2(normalised(text_col), 256).alias("sha"),
        (F.to_json(F.struct(*others)) if others else F.lit("")).alias("rest"),
    )
    joined = keyed.join(
        stay, F.col("doc_id").eqNullSafe(F.col("_keep_id")) & (F.col("sha") == F.col("_keep_sha")), "left_semi"
    )
    order = W.partitionBy("doc_id", "sha").orderBy(F.col("row").getField(text_col), "rest")
    return joined.withColumn("copy", F.row_number().over(order)).where("copy = 1").select("row.*")
