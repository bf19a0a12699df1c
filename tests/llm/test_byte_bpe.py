import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from trackset.llm import byte_bpe, pieces, queries

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(byte_bpe.load_ranks(queries.rank_file()), PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.load_ranks(queries.rank_file())
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_characters_are_one_to_one():
    chars = byte_bpe.byte_characters()
    assert len(set(chars)) == 256 and chars[ord("a")] == "a" and chars[ord(" ")] == "Ġ"


def test_all_rows_match_the_library(spark, edge_docs, edge_rows, corpus, corpus_rows, library):
    for docs, rows in ((edge_docs, edge_rows), (corpus, corpus_rows)):
        found = byte_bpe.round_trip(docs, queries.rank_file(), PATTERN).collect()
        expected = []
        for i, text, *_ in rows:
            ids = library.encode_ordinary(text or "")
            expected.append((i, len(ids), np.array(ids, "<u4").tobytes(), (text or "").encode()))
        key = lambda x: (str(x[0]), x[2])
        assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in found), key=key) == sorted(expected, key=key)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_matches_the_library(codec, library, text):
    ids = codec.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()
    assert "".join(codec.decode_pieces(np.frombuffer(ids, "<u4").tolist())) == text


def test_offsets_name_the_characters(codec):
    text = "naïve 😀😀 日本語 x"
    ids = codec.encode(text)
    starts, split = codec.char_starts(ids, text.encode())
    at = codec.byte_starts(ids)
    assert starts.tolist() == [len(text.encode()[:b].decode("utf-8", "ignore")) for b in at.tolist()]
    assert split == sum((text.encode()[b] & 0xC0) == 0x80 for b in at.tolist()) > 0


def test_encode_then_decode(spark, edge_docs, edge_rows):
    encoded = byte_bpe.encode(edge_docs, queries.rank_file(), PATTERN)
    decoded = byte_bpe.decode(encoded, queries.rank_file(), PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in decoded) == sorted((t or "").encode() for _, t, *_ in edge_rows)


def test_stretches_are_cut_where_nothing_changes(codec, library, monkeypatch):
    monkeypatch.setattr(pieces, "STRETCH", 40)
    rng = random.Random(1)
    text = "".join(rng.choice(["ab", " ", "\n", "  ", "'s", "12", "é", "!", "\t x"]) for _ in range(2000))
    assert "".join(pieces.stretches(text)) == text
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_query_digests(spark, tmp_path, corpus, corpus_rows, library):
    corpus.write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.op8_byte_bpe(spark, str(tmp_path)).collect():
        text = corpus_rows[r.doc_id][1]
        ids = np.array(library.encode_ordinary(text), "<u4").tobytes()
        assert (r.ids_sha256, r.decoded_sha256) == (hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_empty_table(no_docs):
    assert byte_bpe.round_trip(no_docs, queries.rank_file(), PATTERN).count() == 0
