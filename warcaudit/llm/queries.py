"""One query for each operator over whole tables, with production parameters, and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import caps, centroids, counts, credentials, idfiles, jaccard, passages, pieces, quality, seating, suffixes, tandems, tiling
from .oracles import all_oracles  # noqa: F401 - the entry point takes queries and SQL from one place
from .store import shared_folder

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENS = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 2048
END_ID = 2


ROWS_AT_ONCE = 1_000


def small_batches(spark: SparkSession) -> None:
    """Hand Python workers texts in batches of a few megabytes: Spark's default of 10,000 rows is for short rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every text when 100-byte strings that start earlier are removed."""
    found = suffixes.remove_repeats(documents(spark, folder))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text with begin and end, and what they decode to, as digests."""
    found = pieces.encode(documents(spark, folder).select("doc_id", "text"), PIECES)
    return found.select("doc_id", F.col("pieces.n_tokens").alias("n_tokens"), F.sha2("pieces.ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("pieces.decoded").cast("binary"), 256).alias("decoded_sha256"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every text, through a digest cache that starts empty."""
    docs = documents(spark, folder).select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    found = counts.count_tokens(docs, WORD_TOKENS, f"{shared_folder(spark)}/counts")
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of texts whose four-word shingles have a Jaccard similarity of 0.85 or more."""
    return jaccard.classes(documents(spark, folder), width=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op5_near_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 words or more that nearly repeat one of another document."""
    return passages.near_passages(documents(spark, folder))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, with the share of its words that tiles cover."""
    found = tiling.contaminated(documents(spark, folder), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_words", "n_tiles", "n_covered", "coverage")


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The decision on every document, with its evidence and the rates of its place."""
    docs = documents(spark, folder)
    model = quality.fit(docs, table(spark, folder, "labels"))
    found = quality.classify(docs.select("doc_id", "text", "source", "lang"), model, "source", "lang")
    return found.select("doc_id", "source", "lang", "verdict.*")


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets and of linked parts in every text."""
    found = credentials.scan(documents(spark, folder).select("doc_id", "text"))
    base, spans = F.col("secrets.base"), F.col("secrets.spans")
    return found.select("doc_id", *[credentials.count_of(base, k).alias(f"n_{k}") for k in credentials.BASE],
                        F.sha2(credentials.listed(base), 256).alias("base_sha256"), credentials.listed(spans).alias("spans"))


def op9_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    """Add-one and Pitman-Yor scores of every text, learnt from six sevenths of them."""
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return seating.score(documents(spark, folder), held)


def op10_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of vectors with a cosine of 0.9 or more."""
    return caps.near(table(spark, folder, "embeddings"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of words that repeat a period four times or more, the longest of them, and every text with each period once."""
    found = tandems.find_runs(tandems.with_periods(documents(spark, folder).select("doc_id", "text")))
    runs, best = F.col("periodic.runs"), tandems.longest(F.col("periodic.runs"))
    return found.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), (-best["start"]).alias("start"), best["length"].alias("length"),
        (-best["period"]).alias("period"), F.floor(best["length"] * 1000 / -best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(tandems.listed(runs).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("periodic.collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest of 16 centroids for every vector after three rounds, and the inertia of its cluster and of all."""
    found = centroids.cluster(table(spark, folder, "embeddings"), k=16, rounds=3, dimensions=64, seed=1)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        centroids.digest(F.col("centroid")).alias("centroid_sha256"))


def op13_id_files(spark: SparkSession, folder: str) -> DataFrame:
    """Where every document's ids lie in the written files, and their checksum, as read back from them."""
    place = f"{shared_folder(spark)}/ids"
    idfiles.write(documents(spark, folder), WORD_TOKENS, END_ID, place)
    return idfiles.read(spark, place).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_suffix_dedup, op2_pieces, op3_token_counts, op4_ngram_join, op5_near_passages, op6_decontamination, op7_quality,
        op8_secrets, op9_pitman_yor, op10_near_vectors, op11_periodic_runs, op12_centroids, op13_id_files)}
