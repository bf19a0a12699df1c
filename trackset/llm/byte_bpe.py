"""Operator 8: byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

Ranks are turned into a vocabulary over mapped characters: every byte has a printable character, so that a token
is a string even where it holds part of a character. Every split of a token into two tokens is a merge, at the
token's rank; that is what rank files mean. Token offsets follow from the tokens' byte lengths, and from them the
character in which each token begins, also where a character is split between tokens.

Defined results: null and empty texts give no ids; repeated rows each get a row; null ids are kept; an empty table
gives an empty result; long texts are taken a stretch at a time; only the named columns are read.
"""

from __future__ import annotations

import base64
import codecs
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .pieces import Memo

ENCODED = "doc_id long, n_tokens long, ids binary, char_starts binary, n_split long"
ROUND_TRIP = "doc_id long, n_tokens long, ids binary, decoded binary, n_split long"
STARTS = ", char_starts binary"


def byte_characters() -> list[str]:
    """The character for each byte: itself if it prints, else the next free one from 256."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


def load_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        chars = byte_characters()
        mapped = {t: "".join(map(chars.__getitem__, t)) for t in ranks}
        merges = [
            (mapped[t[:i]], mapped[t[i:]])
            for t in sorted(ranks, key=ranks.get)
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        vocab = {mapped[t]: r for t, r in ranks.items()}
        self.tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        # the byte table, reversed: from the mapped characters of the library's vocabulary back to bytes
        back = {c: b for b, c in enumerate(chars)}
        self.table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, at in self.tokenizer.get_vocab().items():
            self.table[at] = bytes(map(back.__getitem__, token))
        self.lengths = np.array([len(t) for t in self.table], "u4")
        self.memo = Memo(self._encode)

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(b"".join(x) for x in self.memo.of(text))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode_pieces(self, ids: Iterable[int]) -> Iterator[str]:
        """The text that each token completes; bytes of an unfinished character wait for the next token."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            yield reader.decode(self.table[i])
        yield reader.decode(b"", True)

    def byte_starts(self, ids: bytes) -> np.ndarray:
        n = self.lengths[np.frombuffer(ids, "<u4")]
        return np.cumsum(n, dtype="i8") - n

    def char_starts(self, ids: bytes, text: bytes) -> tuple[np.ndarray, int]:
        """The index of the character in which each token begins, and how many tokens begin inside one."""
        at = self.byte_starts(ids)
        begins = (np.frombuffer(text, "u1") & 0xC0) != 0x80
        return (np.cumsum(begins, dtype="i8") - 1)[at].astype("<u4"), int((~begins[at]).sum())


_codecs: dict[tuple, Codec] = {}


def _codec(shared) -> Codec:
    key = shared.value
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(load_ranks(key[0]), key[1])
    return _codecs[key]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_or_empty(text_col).alias("text"))


def encode(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids and char_starts (packed little-endian uint32), n_split: tokens that begin inside a
    character."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((ranks, pattern))  # a fixed vocabulary

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            ids, starts, split = [], [], []
            for text in batch.column(1).to_pylist():
                ids.append(codec.encode(text))
                at, n = codec.char_starts(ids[-1], text.encode())
                starts.append(at.tobytes())
                split.append(n)
            n = pa.array([len(i) // 4 for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n, pa.array(ids, pa.binary()), pa.array(starts, pa.binary()), pa.array(split, pa.int64())],
                ["doc_id", "n_tokens", "ids", "char_starts", "n_split"],
            )

    return common.map_arrow(_rows(docs, id_col, text_col), run, ENCODED)


def decode(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """doc_id, decoded (bytes) of rows with packed `ids`; null ids give no bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast((ranks, pattern))

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            out = [codec.decode(i or b"") for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return common.map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, decoded binary")


def round_trip(
    docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", want_starts: bool = False
) -> DataFrame:
    """Encode every text and decode the ids again, in one pass: doc_id, n_tokens, ids, decoded, n_split
    [, char_starts]."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((ranks, pattern))
    schema = ROUND_TRIP + (STARTS if want_starts else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            ids, out, split, starts = [], [], [], []
            for text in batch.column(1).to_pylist():
                ids.append(codec.encode(text))
                out.append(codec.decode(ids[-1]))
                at, inside = codec.char_starts(ids[-1], out[-1])
                split.append(inside)
                if want_starts:
                    starts.append(at.tobytes())
            n = pa.array([len(i) // 4 for i in ids], pa.int64())
            columns = [batch.column(0), n, pa.array(ids, pa.binary()), pa.array(out, pa.binary()), pa.array(split, pa.int64())]
            if want_starts:
                columns.append(pa.array(starts, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    return common.map_arrow(_rows(docs, id_col, text_col), run, schema)
