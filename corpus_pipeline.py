"""From documents to encoded training text: quality, near duplicates, benchmark passages, secrets, encoding.

Each stage takes what its predecessor kept; all but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warcaudit.llm import credentials, jaccard, pieces, quality, tiling
from warcaudit.llm.queries import PIECES, documents, small_batches, table
from warcaudit.llm.store import shared_folder


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are neither junk nor toxic."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs, model, "source", "lang", out="_verdict").filter("_verdict.keep").select(*docs.columns)


def keep_first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return jaccard.deduplicate(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return tiling.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked and ``n_chars`` as the text now is."""
    return credentials.redact(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and the digest of what they decode to."""
    small_batches(spark)
    found = pieces.encode(docs, PIECES, out="_pieces")
    return found.select("doc_id", "lang", "source", F.col("_pieces.n_tokens").alias("n_tokens"), F.col("_pieces.ids").alias("ids"),
                        F.sha2(F.col("_pieces.decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality", keep_good), ("near_duplicates", keep_first_of_near_copies), ("decontamination", drop_benchmark),
          ("secrets", mask_secrets), ("encoding", encode)]

ORACLE_SQL = None
"""The fitted classifier and the encoder cannot be stated in SQL; the tests use brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written down and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        place = f"{shared_folder(spark)}/{name}"
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
