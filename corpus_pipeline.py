"""A corpus from raw documents to tokens, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and reads it back for the next one.  All
but the last return the columns of ``documents``.

Rows equal in key and text are one document; the Jaccard stage keeps one row
of them.  Null texts pass all stages and end with no tokens.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm import bpe, decontam, jaccard, lines, toxicity
from tidewatch.llm.common import stage, table

TOXIC_SCORE = 0.3


def _row(docs: DataFrame):
    return jaccard.row_hash(F.col("doc_id"), F.xxhash64("text"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learn=learn)
    return toxicity.score(docs, model, whole=True).where(F.col("score") < TOXIC_SCORE).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that occur earlier; a document that loses every line goes."""
    out = lines.dedup(docs).where("n_dropped = 0 OR n_dropped < n_lines")
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    keep = jaccard.link(docs).where("kept").select(F.col("row").alias("__row")).distinct()
    d = docs.withColumn("__row", _row(docs))
    return d.join(keep, "__row").dropDuplicates(["__row"]).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whole or edited."""
    d = docs.withColumn("__row", _row(docs))
    bad = decontam.contaminated(d, table(spark, sf_dir, "benchmark"), key="__row")
    bad = stage(bad.select("__row").distinct(), "pipeline-contaminated")
    return d.join(bad, "__row", "left_anti").select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and what they decode to, as digests."""
    out = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("bpe encoding and decoding", tokenize),
]

#: the classifier, the near-copy components and the alignment are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES:
        docs = stage(f(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
