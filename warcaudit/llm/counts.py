"""Token counts with a cache keyed by digests of the content and of the tokenizer.

A stored count holds for every text that differs only in its ASCII white space, which the tokenizer drops, and only
for the very tokenizer file it was made with. Texts are joined to the stored counts by digest; of those that are
missing one of each is encoded, and its count appended. The cache is a Parquet table of
``content_digest, tokenizer_digest, n_tokens``, one folder per append, so that a lost or repeated task never leaves
a half-written entry. The texts to be encoded travel compressed, once per digest and map task.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import free_name, require

CACHE = "content_digest binary, tokenizer_digest binary, n_tokens bigint"
REMEMBERED = 150_000
"""Parts of texts whose counts each Python worker keeps; twice as many at most."""
BATCH = 4_000
"""Parts handed to the tokenizer at once."""


def tokenizer_digest(path: str) -> bytes:
    """SHA-256 of the tokenizer file: another version has other counts."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).digest()


def normalised(text: Column) -> Column:
    """Text with runs of ASCII white space as one space and none at its ends; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+", " "))


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


class Counter:
    """Counts tokens as the library does, without truncation, padding or added tokens.

    The tokenizer drops white space and makes no token across it, so a text's count is the sum over its parts
    between white space. Counts of parts are remembered; when full, the older half goes.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path) as f:
            if json.load(f)["pre_tokenizer"]["pretokenizers"][0].get("behavior") != "Removed":
                raise ValueError("only tokenizers that drop white space are supported")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.young: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def _learn(self, parts: list[str]) -> None:
        for k in range(0, len(parts), BATCH):
            some = parts[k: k + BATCH]
            for part, found in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self.young[part] = len(found)

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of normalised texts."""
        if len(self.young) > REMEMBERED:
            self.older, self.young = self.young, {}
        split = [[p for p in t.split(" ") if p] for t in texts]
        young, older = self.young, self.older
        missing = {p for parts in split for p in parts if p not in young}
        for p in [p for p in missing if p in older]:
            young[p] = older[p]
            missing.discard(p)
        self._learn(list(missing))
        return [sum(map(young.__getitem__, parts)) for parts in split]


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def read_cache(spark: SparkSession, folder: str) -> DataFrame:
    """All stored counts; an empty table where nothing is stored yet."""
    try:
        return spark.read.schema(CACHE).option("recursiveFileLookup", "true").parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def _squeezed(text: Column) -> Column:
    def run(column: pa.Array) -> pa.Array:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        return pa.array([squeeze(b) for b in column.cast(pa.binary()).to_pylist()], pa.binary())

    return F.arrow_udf(run, "binary")(text)


def append_missing(docs: DataFrame, path: str, cache_folder: str, text: str = "text") -> None:
    """Encode one text of every digest that the cache lacks for this tokenizer, and append the counts."""
    spark = docs.sparkSession
    version = tokenizer_digest(path)
    stored = (read_cache(spark, cache_folder).filter(F.col("tokenizer_digest") == F.lit(version))
              .select("content_digest"))
    misses = (docs.select(content_digest(F.col(text)).alias("content_digest"), _squeezed(normalised(F.col(text))).alias("body"))
              .groupBy("content_digest").agg(F.first("body").alias("body"))
              .join(stored, "content_digest", "left_anti"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [expand(b).decode() for b in part.column("body").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("content_digest"), pa.array([version] * len(texts), pa.binary()),
                     pa.array(counter(path).count(texts), pa.int64())],
                    names=["content_digest", "tokenizer_digest", "n_tokens"])

    misses.mapInArrow(encode, CACHE).write.option("compression", "zstd").parquet(
        f"{cache_folder}/append-{uuid.uuid4().hex}")


def count_tokens(docs: DataFrame, path: str, cache_folder: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """All rows and columns of a table, and the number of tokens of the whole text of each.

    Null and empty texts have none. Repeated rows and copies are encoded once and each gets the count; rows without
    id are counted as any other; an empty table gives an empty one. A column named ``out`` is replaced.
    """
    require(docs, text)
    append_missing(docs, path, cache_folder, text)
    version = tokenizer_digest(path)
    ours, theirs, count = (free_name(docs, c) for c in ("_content", "_stored_content", "_count"))
    # Two runs that append at the same time can store the same digest twice.
    stored = (read_cache(docs.sparkSession, cache_folder).filter(F.col("tokenizer_digest") == F.lit(version))
              .groupBy(F.col("content_digest").alias(theirs)).agg(F.max("n_tokens").alias(count)))
    found = docs.withColumn(ours, content_digest(F.col(text))).join(stored, F.col(ours) == F.col(theirs), "left")
    return found.select(*[F.col(f"`{c}`") for c in docs.columns if c != out], F.col(count).alias(out))
