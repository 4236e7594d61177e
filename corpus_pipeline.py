"""From documents to tokens: the stages of a training corpus, one operator each.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
keep the columns of ``documents``. ``run`` writes each stage's rows to the shared
folder and reads them again for the next, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from lakeferry.llm import bpe, toxicity
from lakeferry.llm.common import stored, table
from lakeferry.llm.exact_dedup import drop_copies
from lakeferry.llm.mixing import mixed_rows
from lakeferry.llm.ngram_join import linked_rows, text_sha
from lakeferry.llm.queries import TOKENIZER, digests, mix_tree

#: Token share that the mix passes on.
MIX_PERCENT = 80


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic. The held-out part of the labels is not learned from."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=~toxicity.held_out("doc_id", 4, 2))
    return docs.where(toxicity.scorer(docs, model)(F.col("text")) < toxicity.TOXIC_FROM)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_copies(docs, keep="largest")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents one row: the smallest id, then the smallest digest of the text."""
    rows = stored(linked_rows(docs).where("component is not null and doc_id is not null"), "linked")
    one = F.struct("doc_id", "sha")
    named = rows.select(one.alias("one"), "component")
    first = named.groupBy("component").agg(F.min("one").alias("first"))
    judged = named.join(first, "component").select("one.*", (F.col("one") == F.col("first")).alias("kept"))
    judged = stored(judged.groupBy("doc_id", "sha").agg(F.first("kept").alias("kept"), F.count("*").alias("n")), "judged")

    def same(other: DataFrame) -> Column:
        return (docs["doc_id"] == other["doc_id"]) & (text_sha(docs["text"]) == other["sha"])

    gone, twins = judged.where("not kept"), judged.where("kept and n > 1")
    left = docs.join(gone, same(gone), "left_anti")
    if twins.isEmpty():
        return left
    # Rows with the same id and text: of each such pair of values one row.
    alike = docs.join(twins, same(twins), "left_semi")
    order = W.partitionBy(alike["doc_id"], text_sha(alike["text"])).orderBy(F.xxhash64(*[alike[c] for c in docs.columns]))
    alike = alike.withColumn("_twin", F.row_number().over(order)).where("_twin = 1").drop("_twin")
    return left.join(twins, same(twins), "left_anti").unionByName(alike)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the target weights, none more than once."""
    return mixed_rows(docs, *mix_tree(), max_epochs=1, percent=MIX_PERCENT)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    return digests(docs, bpe.load_vocabulary(public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", tokenize),
]

#: The trained filter has no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
