"""Operator 1: token counts through a digest cache.

A text is identified by the digest of its normalised content, a tokenizer by the digest of its file and of the
library's version. Stored counts are found by joining on both. What is not stored is encoded once for each
distinct text, and the new counts are appended to the cache.

The only normalisation that keeps counts exact is null -> empty, so that is all that is done.

Defined results: null and empty texts have 0 tokens; repeated rows each get a row; null ids are kept; an empty
table gives an empty result; only the named columns are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
import json
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .pieces import Memo

CACHE_SCHEMA = "content binary, n_tokens long"


def tokenizer_version(tokenizer_json: str) -> str:
    import tokenizers

    return hashlib.sha256(f"{tokenizers.__version__}\n{tokenizer_json}".encode()).hexdigest()[:32]


def chunkable(tokenizer_json: str) -> list[str] | None:
    """The added tokens, if chunks of a text can be encoded apart; None if only whole texts can.

    That needs the byte-level split pattern, no normaliser, and nothing that adds or drops tokens.
    """
    spec = json.loads(tokenizer_json)
    pre = spec.get("pre_tokenizer") or {}
    plain = (
        pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", False)
        and not spec.get("normalizer")
        and spec.get("model", {}).get("type") == "BPE"
    )
    return [t["content"] for t in spec.get("added_tokens", [])] if plain else None


class Counter:
    """Counts the tokens of texts as the library does for whole texts."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = chunkable(tokenizer_json)
        self.memo = Memo(self._encode)

    def _encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, text: str) -> int:
        if self.added is None or any(a in text for a in self.added):
            return self._encode([text])[0]
        return sum(map(sum, self.memo.of(text)))


_counters: dict[str, Counter] = {}


def _encoder(shared, version: str):
    def encode(batches):
        if version not in _counters:
            _counters.clear()
            _counters[version] = Counter(shared.value)
        count = _counters[version]
        for batch in batches:
            n = [count(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["content", "n_tokens"])

    return encode


def cached(spark: SparkSession, cache_dir: str, version: str) -> DataFrame | None:
    """The stored counts of one tokenizer version; None if there are none yet."""
    path = f"{cache_dir}/tokenizer={version}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(fs.makeQualified(where)):
        return None
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def compact(spark: SparkSession, cache_dir: str, version: str) -> None:
    """Rewrite one version's counts without repeats, which only two writers at once can leave."""
    path = f"{cache_dir}/tokenizer={version}"
    once = common.materialise(
        spark.read.schema(CACHE_SCHEMA).parquet(path).groupBy("content").agg(F.max("n_tokens").alias("n_tokens")),
        "token-cache-compact",
    )
    once.write.mode("overwrite").parquet(path)
    common.discard(once)


def add_misses(docs: DataFrame, tokenizer_json: str, cache_dir: str, text_col: str = "text") -> None:
    """Encode each distinct text that has no stored count, and append the counts. One writer at a time."""
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer_json)
    texts = docs.select(common.text_or_empty(text_col).alias("_text"))
    texts = texts.groupBy(common.text_class("_text").alias("content")).agg(F.first("_text").alias("_text"))
    stored = cached(spark, cache_dir, version)
    if stored is not None:
        texts = texts.join(stored, "content", "left_anti")
    shared = spark.sparkContext.broadcast(tokenizer_json)  # a fixed file of a few MB
    with common.shuffle_files_freed(spark):
        fresh = common.map_arrow(texts.select("content", "_text"), _encoder(shared, version), CACHE_SCHEMA)
        fresh.write.mode("append").parquet(f"{cache_dir}/tokenizer={version}")


def count_tokens(
    docs: DataFrame, tokenizer_json: str, cache_dir: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row of `docs`; `cache_dir` is a folder that all executors share."""
    add_misses(docs, tokenizer_json, cache_dir, text_col)
    stored = cached(docs.sparkSession, cache_dir, tokenizer_version(tokenizer_json))
    rows = docs.select(F.col(id_col).alias("doc_id"), common.text_or_empty(text_col).alias("_text")).select(
        "doc_id", F.octet_length("_text").cast("long").alias("n_bytes"), common.text_class("_text").alias("content")
    )
    return rows.join(stored, "content").select("doc_id", "n_bytes", "n_tokens")
