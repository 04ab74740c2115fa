"""Token counts by way of a cache keyed by content and tokenizer digests.

Every text is reduced to the SHA-256 of its normalised content. The distinct
digests are looked up in a stored table (tokenizer digest, content digest,
count); only those it lacks are encoded, each once, and appended to it. Counts
then join back by digest, so copies cost no encoding and no text is grouped.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from affinity.llm.common import stored

OVER = 1024
#: part of the cache key: raise it when the way of counting changes
METHOD = "v1: no added special tokens, special strings by default, no truncation"
CACHE_SCHEMA = "tokenizer string, content string, n_tokens bigint"
#: what the ranks file and the library are known to split alike: characters no Unicode version since 6 has
#: reclassified, no very long runs (quadratic in the one, not in the other) and no special string
_ALIKE = re.compile("[\x00-\x7f\xa0-ɏ‐-⁞€]*")
_LONG_RUN = re.compile(r"\S{1000}|\s{1000}")


class Counter:
    """Counts tokens as ``tokenizers`` does for one file.

    With a file of the same vocabulary as ranks, texts that both libraries
    split alike are counted by the faster one (the tests hold both against
    each other).
    """

    def __init__(self, path: str, ranks_path: str | None):
        self.exact = Tokenizer.from_file(path)
        self.exact.no_truncation()
        self.exact.no_padding()
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.ranks = None
        if ranks_path:
            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def count(self, text: str) -> int:
        if (self.ranks and _ALIKE.fullmatch(text) and not _LONG_RUN.search(text)
                and not any(s in text for s in self.special)):
            return len(self.ranks.encode_ordinary(text))
        return len(self.exact.encode(text, add_special_tokens=False).ids)


@lru_cache(maxsize=2)
def counter(path: str, ranks_path: str | None) -> Counter:
    """Built once per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Counter(path, ranks_path)


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + METHOD.encode()).hexdigest()


def normalised(text) -> F.Column:
    """What the cache key is made of: null counts as empty, nothing else changes, as counts depend on every byte."""
    return F.coalesce(text, F.lit(""))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """(content, n_tokens) of one tokenizer version, each content once; empty if nothing is stored yet."""
    known = spark.read.schema(CACHE_SCHEMA).parquet(path) if _exists(spark, path) else spark.createDataFrame([], CACHE_SCHEMA)
    return known.where(F.col("tokenizer") == tokenizer).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, cache_path: str, tokenizer_path: str, ranks_path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text", over: int = OVER) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    ``cache_path`` names a shared folder; missing counts are appended to it
    (two runs that append the same digest agree, and readers keep one). A null
    or empty text has 0 bytes and 0 tokens. Repeated rows and ids are separate
    rows; other columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("text")).withColumn(
        "content", F.sha2("text", 256))
    keys = stored(rows.select("doc_id", "content", F.octet_length("text").cast("bigint").alias("n_bytes")), "token-keys")
    known = read_cache(spark, cache_path, version)
    # one bearer for each content the cache lacks; the shuffle of texts is by id, so no group of copies meets
    bearers = (keys.groupBy("content").agg(F.min("doc_id").alias("bearer"))
               .join(known, "content", "left_anti").select(F.col("content").alias("wanted"), "bearer"))
    todo = rows.join(bearers, rows.doc_id.eqNullSafe(F.col("bearer")) & (rows.content == F.col("wanted")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = counter(tokenizer_path, ranks_path)
        for b in batches:
            counts = pa.array([library.count(t.as_py()) for t in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), counts], ["content", "n_tokens"])

    # rows repeated with id and text bear alike: their counts are the same, one is stored
    made = todo.select("content", "text").mapInArrow(run, "content string, n_tokens bigint").dropDuplicates(["content"])
    made.select(F.lit(version).alias("tokenizer"), "content", "n_tokens").write.mode("append").parquet(cache_path)
    # stored, so that the join reads both sides from a shuffle and a very common content can be split
    counts = stored(read_cache(spark, cache_path, version), "token-counts")
    return keys.join(counts, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit"))
