"""The corpus pipeline: quality rules, near-dedup by shingles, substring dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents; where a stage changes texts, n_chars follows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackset.llm import byte_bpe, common, line_quality, mixing, passages, queries, similar

#: XXH64 and BPE are not to be had in DuckDB; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def _with_text(rows: DataFrame, columns: list[str], text) -> DataFrame:
    """Columns of the struct `row` in their order, with a new text and its length."""
    out = {c: F.col("row")[c] for c in columns if c != "text"} | {"text": text}
    if "n_chars" in columns:
        # a text that stays the same keeps the count it came with
        out["n_chars"] = F.when(F.col("changed"), F.length(text)).otherwise(F.col("row")["n_chars"])
    return rows.select(*(c.alias(k) for k, c in out.items())).select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines that are above their host's limit."""
    columns = docs.columns
    kept = line_quality.judge(docs, columns).where("kept")
    rows = kept.select("row", F.col("row.text").alias("text"), "lost").withColumn("changed", F.col("lost").isNotNull())
    same = rows.where("NOT changed").select("row", "text", "changed")
    cut = line_quality.without_lines(rows.where("changed").select("row", "text", "lost"))
    return _with_text(same.unionByName(cut.withColumn("changed", F.lit(True))), columns, F.col("text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts with five-word shingles in common to 0.8 or more, the document with the smallest id stays."""
    return similar.one_of_each(docs).select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in repeats of passages go; a text that loses none is left as it is."""
    columns = docs.columns
    done = passages.remove_repeats(docs, want_text=True).withColumn("changed", F.col("n_removed") > 0)
    return _with_text(done, columns, F.col("kept"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_rows(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed little-endian uint32), char_starts, n_split, decoded_sha256 (of the bytes that the ids
    decode to) of every document."""
    done = byte_bpe.round_trip(docs, queries.rank_file(), public_tokenizers.PATTERN, want_starts=True)
    return done.select("doc_id", "n_tokens", "ids", "char_starts", "n_split", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before = docs
        with common.freed_after(spark) as kept:  # what a stage has written for itself goes when its result is written
            docs = common.materialise(stage(spark, before, sf_dir), "stage")
            kept.append(docs)
        common.discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
