from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from trackset.llm import common, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def spec():
    return Path(PATH).read_text(encoding="utf-8")


def brute(rows, path=PATH):
    tokenizer = Tokenizer.from_file(path)
    out = []
    for i, text, *_ in rows:
        text = text or ""
        out.append((i, len(text.encode()), len(tokenizer.encode(text, add_special_tokens=False))))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_tokens").collect()), key=str)


def test_counts_are_the_librarys(spark, edge_docs, edge_rows, corpus, corpus_rows, spec):
    for docs, rows in ((edge_docs, edge_rows), (corpus, corpus_rows)):
        assert got(token_counts.count_tokens(docs, spec, common.scratch_path(spark, "t"))) == brute(rows)


def test_only_misses_are_encoded(spark, corpus, corpus_rows, edge_docs, edge_rows, spec):
    cache = common.scratch_path(spark, "t")
    version = token_counts.tokenizer_version(spec)
    token_counts.add_misses(corpus, spec, cache)
    stored = token_counts.cached(spark, cache, version)
    assert stored.count() == len({t for _, t, *_ in corpus_rows})
    token_counts.add_misses(corpus, spec, cache)
    assert token_counts.cached(spark, cache, version).count() == stored.count()
    assert got(token_counts.count_tokens(corpus.union(edge_docs), spec, cache)) == brute(corpus_rows + edge_rows)


def test_versions_are_apart_and_compaction_keeps_counts(spark, edge_docs, edge_rows, spec):
    cache = common.scratch_path(spark, "t")
    other = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")
    assert got(token_counts.count_tokens(edge_docs, other, cache)) == brute(
        edge_rows, public_tokenizers.path("word_bpe_49k.json")
    )
    version = token_counts.tokenizer_version(spec)
    assert token_counts.cached(spark, cache, version) is None
    token_counts.add_misses(edge_docs, spec, cache)
    once = token_counts.cached(spark, cache, version)
    n = once.count()
    common.materialise(once, "copy").write.mode("append").parquet(f"{cache}/tokenizer={version}")
    token_counts.compact(spark, cache, version)
    assert token_counts.cached(spark, cache, version).count() == n


def test_empty_table(spark, no_docs, spec):
    assert got(token_counts.count_tokens(no_docs, spec, common.scratch_path(spark, "t"))) == []
