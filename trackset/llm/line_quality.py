"""Operator 10: quality rules with cross-document line frequency.

Base rules look at one document: too few words, or too many words in repeated three-word windows. The method then looks
across documents. Lines are normalised (lower case, single spaces) and hashed; for each host (the source) the distinct
documents of each line are counted. A line in more than MOST_DOCUMENTS of a host is removed from all of them but its
first holder, and a document of which too few words are left is rejected. The first holder is the document with the
smallest id among those that pass the base rules, so that of a group of copies one survives. The limit is a number of
documents and does not loosen with the host's size.

Defined results: null and empty texts have no words and fail the base rules; a null source is a host of its own, shared
with the empty name; rows with equal ids count as one document and each get a row; rows without an id count as one
document each and are never the first; a line that no document with an id and passing the base rules holds goes from
all; an empty table gives an empty result; `docs` may have any further columns.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
MOST_DOCUMENTS = 20
LEAST_LEFT_PERCENT = 30

_WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeat_words(words: list[bytes]) -> int:
    """Words in three-word windows that come twice or more in the text, the first included."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    again = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def line_key(words: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(words).lower()) - (1 << 63)


def measure(text: bytes) -> tuple[list[int], dict[int, int]]:
    """The five base figures, and the words of each distinct normalised line, all its occurrences together."""
    words = text.split()
    n_dup, seen, lines = 0, set(), Counter()
    for line in text.split(b"\n"):
        if own := line.split():
            n_dup += line in seen
            seen.add(line)
            lines[line_key(own)] += len(own)
    chars = len(text.translate(None, _WHITE).decode())
    symbols = sum(text.count(bytes([s])) for s in SYMBOLS)
    return [len(words), chars, symbols, n_dup, repeat_words(words)], lines


def measured(docs: DataFrame, carry: list[str], id_col: str, text_col: str, host_col: str) -> DataFrame:
    """row (struct of `carry`), key (of the row), doc (id, or the row's key), host, figures, lines (of hash, words)."""
    # a text that is carried travels once, inside of the row
    inside = text_col in carry
    rows = docs.select(
        F.struct(*carry).alias("row"),
        F.monotonically_increasing_id().alias("key"),
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        *([] if inside else [common.text_or_empty(text_col).cast("binary").alias("text")]),
    )
    kind = rows.schema["row"].dataType.simpleString()
    schema = f"row {kind}, key long, id long, host string, {_BASE}, lines array<struct<h:long,w:long>>"
    at = pa.struct([("h", pa.int64()), ("w", pa.int64())])

    def run(batches):
        for batch in batches:
            figures, lines = [], []
            texts = batch.column(0).field(carry.index(text_col)).cast(pa.binary()) if inside else batch.column(4)
            for text in texts.to_pylist():
                own, found = measure(text or b"")
                figures.append(own)
                lines.append([{"h": h, "w": w} for h, w in found.items()])
            table = np.array(figures, "i8").reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], *(pa.array(table[:, i]) for i in range(5)), pa.array(lines, pa.list_(at))],
                ["row", "key", "id", "host", *(x.split()[0] for x in _BASE.split(", ")), "lines"],
            )

    return common.map_arrow(rows, run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def heavy_lines(known: DataFrame) -> DataFrame:
    """key, w, h: lines above the limit that a row loses."""
    doc = F.coalesce("id", -1 - F.col("key"))
    lines = known.select("key", "host", "id", doc.alias("doc"), (~base_failed()).alias("ok"), F.explode("lines").alias("line"))
    lines = lines.select("key", "host", "id", "doc", "ok", "line.h", "line.w")
    counts = lines.groupBy("host", "h").agg(F.countDistinct("doc").alias("n"), F.min(F.when(F.col("ok"), F.col("id"))).alias("first"))
    above = counts.where(F.col("n") > MOST_DOCUMENTS)
    # written, so that the join exchanges both sides and Spark can split a frequent line
    above = common.materialise(above.select("host", "h", "first"), "lines-above")
    lost = lines.join(above, ["host", "h"])
    return lost.where("id IS NULL OR first IS NULL OR id <> first").select("key", "h", "w")


def judge(
    docs: DataFrame, carry: list[str], id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """row (struct of `carry`), figures, base_failed, kept, n_lost (words in lines that are removed), and lost (their
    hashes)."""
    known = common.materialise(measured(docs, carry, id_col, text_col, host_col), "measured")
    lost = heavy_lines(known).groupBy("key").agg(F.sum("w").alias("n_lost"), F.collect_list("h").alias("lost"))
    out = known.join(lost, "key", "left").withColumn("base_failed", base_failed())
    out = out.withColumn("n_lost", F.coalesce("n_lost", F.lit(0).cast("long")))
    left = F.col("n_words") - F.col("n_lost")
    out = out.withColumn("kept", ~F.col("base_failed") & (100 * left >= LEAST_LEFT_PERCENT * F.col("n_words")))
    return out.select("row", *(x.split()[0] for x in _BASE.split(", ")), "base_failed", "kept", "n_lost", "lost")


def without_lines(texts: DataFrame) -> DataFrame:
    """row, text: of (row, text, lost), the texts without the lines whose hashes are lost."""

    def run(batches):
        for batch in batches:
            out = []
            for text, lost in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if text and lost:
                    gone = set(lost)
                    lines = ((line, line.encode().split()) for line in text.split("\n"))
                    text = "\n".join(line for line, words in lines if not words or line_key(words) not in gone)
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["row", "text"])

    return common.map_arrow(texts, run, f"row {texts.schema['row'].dataType.simpleString()}, text string")
