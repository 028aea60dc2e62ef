"""A corpus of documents made fit for training, in five stages.

Each stage takes all that its predecessor kept. Every result is written as Parquet, in the folder that the cluster
shares, and read again by the next stage. Rows without doc_id pass the stages that decide by document groups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provwatch.llm import bottom_k_dedup, sentencepiece_viterbi, string_tiling, substring_anchors, toxicity_neighbours
from provwatch.llm.tables import saved, sent_if_small
from provwatch.llm.tokenizers_public import TokenizerFile, public_path
from provwatch.sources.sinks import work_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7."""
    model = toxicity_neighbours.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity_neighbours.score_texts(docs, model, threshold=0.7).where("predicted = 0").select(*docs.columns)


def _single_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Without rows that repeat doc_id and text; only rows of repeated ids are shuffled."""
    ids = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    ids = saved(ids, f"{work_folder(spark, 'repeated')}/ids")
    if ids.isEmpty():
        return docs
    ids = sent_if_small(ids)
    repeated = docs.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return docs.join(ids, "doc_id", "left_anti").unionByName(repeated)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8): the one of smallest doc_id.

    Of rows that repeat a doc_id with its text one stays, too, or later stages would take them for copies. Rows without
    doc_id stay; null and empty texts are no copies of anything.
    """
    docs = _single_rows(spark, docs)
    groups = bottom_k_dedup.near_duplicates(docs, shingle=5, percent=80)
    copies = groups.where("not kept and doc_id is not null").select("doc_id").distinct()
    copies = saved(copies, f"{work_folder(spark, 'copies')}/ids")
    return docs.join(sent_if_small(copies), "doc_id", "left_anti").select(*docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without any window of 35 words that also starts elsewhere; all documents stay, n_chars follows the text.

    A text that loses nothing keeps its white space; of others the kept words are joined by one space.
    """
    others = tuple(c for c in docs.columns if c != "text")
    cut = substring_anchors.remove_repeats(docs, window=35, keep=(*others, "text"))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    cut = cut.withColumn("text", text)
    if "n_chars" in others:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold half or more of a benchmark item in tiles of five words or more."""
    found = string_tiling.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), minimum=5, coverage=0.5)
    return found.where("not contaminated").select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each whole text, and whether they decode to it exactly."""
    model = TokenizerFile.read(public_path("piece_bpe_32k.model"))
    encoded = sentencepiece_viterbi.encode_texts(docs, model)
    same = F.coalesce("text", F.lit("")) == F.coalesce("decoded", F.lit(""))
    return encoded.select("doc_id", "lang", "source", "n_ids", "ids", same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# Greedy tiling, the neighbours' votes and the best segmentation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = work_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
