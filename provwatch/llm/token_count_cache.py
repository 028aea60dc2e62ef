"""Token counts through a digest cache.

The cache is a Parquet table of (tokenizer digest, content digest, count). Counting joins the digests of the
contents to it, encodes one row of each digest that is missing, appends the new counts, and joins again. A second
run over the same contents encodes nothing; another tokenizer version has another digest and its own counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provwatch.llm.blocks import blocks
from provwatch.llm.tables import saved
from provwatch.llm.tokenizers_public import TokenizerFile
from provwatch.sources.sinks import work_folder

CACHE = T.StructType(
    [
        T.StructField("tokenizer", T.StringType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)


def cached_counts(spark: SparkSession, path: str, tokenizer: TokenizerFile) -> DataFrame:
    """Stored counts of one tokenizer version: digest, n_tokens. Empty if there is no cache yet.

    Two writers may both have counted a content; the counts are equal and one is kept.
    """
    try:
        stored = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE).select("digest", "n_tokens")
    return stored.where(F.col("tokenizer") == tokenizer.digest).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _encode(tokenizer: TokenizerFile):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer.counter()
        for batch in batches:
            text, digest = batch.column("text").fill_null(""), batch.column("digest")
            for block in blocks(text):
                n = block.last - block.first
                yield pa.RecordBatch.from_arrays(
                    [digest.slice(block.first, n), pa.array(count(text.slice(block.first, n).to_pylist()), pa.int64())],
                    names=["digest", "n_tokens"],
                )

    return encode


def token_counts(docs: DataFrame, tokenizer: TokenizerFile, cache: str, limit: int = 4096) -> DataFrame:
    """Tokens of every whole text: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``cache`` is the folder of the cache table, made if missing. A null text counts as the empty one: 0 bytes and 0
    tokens. Repeated rows are returned as often as they occur; their content is encoded once. The library handles
    special strings inside texts by its own default. Further columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "token-counts")
    content = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id"), F.unhex(F.sha2(content, 256)).alias("digest"), "text")
    keyed = saved(rows.select("doc_id", "digest", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")), f"{folder}/keyed")
    known = cached_counts(spark, cache, tokenizer)
    # one row stands for each missing digest; joined by both columns, copies of a text spread over all tasks
    missing = keyed.groupBy("digest").agg(F.min("doc_id").alias("chosen")).join(known, "digest", "left_anti")
    missing = saved(missing.withColumnRenamed("digest", "wanted"), f"{folder}/missing")
    chosen = rows.join(missing, (F.col("digest") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("chosen")), "left_semi")
    counted = chosen.select("digest", "text").mapInArrow(_encode(tokenizer), "digest binary, n_tokens long")
    counted.select(F.lit(tokenizer.digest).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    counts = cached_counts(spark, cache, tokenizer)
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
