"""From documents to packed training sequences: quality, near duplicates, repeated passages, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Stages work on
all that the one before kept, and are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakepulse.llm.common import save, table
from lakepulse.llm.mixing import mixed_documents
from lakepulse.llm.ngram_join import link_documents
from lakepulse.llm.packing import pack
from lakepulse.llm.quality import score_quality
from lakepulse.llm.substring_dedup import repeated_windows

#: Documents with a score below this go.
QUALITY = 0.7
#: Near duplicates: word n-grams, and per cent of Jaccard similarity.
SHINGLE, SIMILAR = 5, 80
#: Words of a passage that is kept only where it stands first.
PASSAGE = 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the table of labels, doesn't reject."""
    scored = score_quality(docs, table(spark, sf_dir, "labels"), docs.columns)
    return scored.where(F.col("score") >= QUALITY).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: that of the smallest doc_id. Documents without words or without id all stay.

    Rows of one doc_id with different texts are one document and stay together; of those with one text the first by the other columns stays.
    """
    linked = link_documents(docs, n=SHINGLE, percent=SIMILAR)
    kept = save(linked.where(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count("*").alias("rows")), "kept")
    # Ids grow with the corpus: they meet the texts by a merge join at every size.
    of = lambda rows: docs.join(rows.select("doc_id").hint("merge"), "doc_id", "left_semi")
    once, several = of(kept if kept.where("rows > 1").isEmpty() else kept.where("rows = 1")), of(kept.where("rows > 1"))
    first = Window.partitionBy("doc_id", "text").orderBy(*[F.col(c).cast("string") for c in docs.columns if c not in ("doc_id", "text")], F.lit(0))
    several = several.withColumn("place", F.row_number().over(first)).where("place = 1").drop("place")
    every = once.select(docs.columns).union(docs.where("doc_id is null"))
    return every if kept.where("rows > 1").isEmpty() else every.union(several.select(docs.columns))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand earlier; texts that lose nothing stay as they are, those that lose all their words go."""
    lost = F.col("n_removed") > 0
    text = F.when(~lost | (F.col("n_removed") < F.col("n_words")), F.when(lost, F.col("kept")).otherwise(F.col("row.text")))
    new = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
    columns = [new.get(c, F.col("row")[c]).alias(c) for c in docs.columns]
    found = repeated_windows(docs, PASSAGE, PASSAGE, [*columns, (~lost | (F.col("n_removed") < F.col("n_words"))).alias("_stays")])
    return found.where("_stays").select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return pack(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("source_mix", source_mix), ("packing", packing)]

#: Trained rules, component search and the packing search can't be put into SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that all stages together make of the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
