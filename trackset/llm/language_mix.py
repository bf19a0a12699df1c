"""Operator 6: language identification by multilingual mixture inference.

Each language has a smoothed distribution over hashed letter trigrams, counted on a bounded sample of labelled texts
(about SAMPLE texts of each language, by hash). A text's language proportions are found by expectation-maximisation
over the likelihoods of its trigrams. Languages that explain less than half a trigram are dropped together, and then one
after the other, the least first, as long as the penalised likelihood of the rest is not worse. The largest proportion
within the set that is left names the text, and is its score.

Every language with a labelled text is learned. The model holds a value for each trigram bucket that a language has been
seen with (at most BUCKETS) and one for all others, 8 bytes each.

Defined results: null texts and texts without a letter are `und` with score 0, and so is every text if nothing was
learned; ties go to the first language in code point order; null ids are kept and never held out; repeated rows each get
a row; an empty table gives an empty result; texts are taken whole, a stretch at a time; only the named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BUCKETS = 1 << 15
SAMPLE = 2000
SMOOTHING = 0.05
ROUNDS = 30
_STRETCH = 1 << 20
_letters: np.ndarray | None = None


def _lowered() -> np.ndarray:
    """For each code point its lower case if it is a letter, else 32."""
    global _letters
    if _letters is None:
        table = np.full(0x110000, 32, "u4")
        for c in range(0x110000):
            if not 0xD800 <= c < 0xE000 and (x := chr(c)).isalpha():
                table[c] = ord(x.lower()[0])
        _letters = table
    return _letters


def trigram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's letter trigrams and how often each comes; runs of other characters are one space."""
    total, tail = None, np.full(1, 32, "u4")
    for at in range(0, max(1, len(text)), _STRETCH):
        points = np.frombuffer(text[at : at + _STRETCH].encode("utf-32-le", "surrogatepass"), "<u4")
        end = [32] if at + _STRETCH >= len(text) else []
        # what comes before is the last two letters of the stretch before, so that every trigram is met once
        seq = np.concatenate((tail, _lowered()[points], end)).astype("u4")
        seq = seq[np.concatenate(([True], (seq[1:] != 32) | (seq[:-1] != 32)))]
        tail = seq[-2:]
        if len(seq) < 3:
            continue
        h = seq[:-2] * np.uint32(0x9E3779B1) + seq[1:-1] * np.uint32(0x85EBCA77) + seq[2:] * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        found = (h >> np.uint32(17)).astype("i8")
        if len(text) <= _STRETCH:
            return np.unique(found, return_counts=True)
        more = np.bincount(found, minlength=BUCKETS)
        total = more if total is None else total + more
    if total is None:
        return np.empty(0, "i8"), np.empty(0, "i8")
    at = np.flatnonzero(total)
    return at, total[at]


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Model:
    """Log probabilities of buckets in each language: of those seen, by bucket, and one for all that are not."""

    def __init__(self, langs: list[str], lang: np.ndarray, bucket: np.ndarray, n: np.ndarray):
        self.langs = langs
        total = np.bincount(lang, n, len(langs)) + SMOOTHING * BUCKETS
        order = np.lexsort((lang, bucket))
        self.lang = lang[order].astype("i4")
        self.log = np.log((n + SMOOTHING) / total[lang])[order].astype("f4")
        self.unseen = np.log(SMOOTHING / total).astype("f4")
        self.first = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))

    def logs(self, at: np.ndarray) -> np.ndarray:
        """languages x buckets `at`."""
        out = np.repeat(self.unseen[:, None], len(at), axis=1).astype("f8")
        counts = self.first[at + 1] - self.first[at]
        ends = np.cumsum(counts)
        entry = np.arange(counts.sum()) + np.repeat(self.first[at] - ends + counts, counts)
        out[self.lang[entry], np.repeat(np.arange(len(at)), counts)] = self.log[entry]
        return out


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> Model:
    """The model of all labelled languages, in code point order."""
    rows = docs.where(~held_out(id_col)).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    # written, so that the join exchanges both sides and Spark can split a frequent language; rarely more than a few rows
    share = common.materialise(rows.groupBy("lang").agg((F.lit(float(SAMPLE)) / F.count(F.lit(1))).alias("share")), "languages")
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.join(share, "lang").where(draw < F.col("share")).select("lang", "text")

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                at, n = trigram_counts(text)
                counts.setdefault(lang, np.zeros(BUCKETS, "i8"))[at] += n
        for lang, found in counts.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(found[at])], ["lang", "bucket", "n"]
            )

    counted = common.map_arrow(sample, run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counted = counted.groupBy("lang").agg(F.collect_list(F.struct(F.col("bucket").cast("int").alias("bucket"), "n")).alias("seen"))
    table = counted.toArrow()  # of each language at most BUCKETS pairs
    langs = table.column("lang").to_pylist()
    place = np.argsort(np.argsort(np.array(langs, object))) if langs else np.empty(0, "i8")
    lists = table.column("seen").combine_chunks()
    pairs = lists.flatten()
    lang = np.repeat(place, np.diff(np.asarray(lists.offsets)))
    return Model(sorted(langs), lang, np.asarray(pairs.field("bucket")).astype("i8"), np.asarray(pairs.field("n")).astype("f8"))


def proportions(likelihood: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Mixture proportions by expectation-maximisation, and their log likelihood; likelihood is languages x trigrams."""
    share, total = np.full(len(likelihood), 1 / len(likelihood)), n.sum()
    for _ in range(ROUNDS):
        mixed = share @ likelihood
        new = share * (likelihood @ (n / mixed)) / total
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(n @ np.log(share @ likelihood))


def infer(found: np.ndarray, n: np.ndarray) -> tuple[int, float, list[int]]:
    """The leading language, its proportion, and the set that the penalised likelihood selects; `found` has the log
    probability of each trigram (columns, n times each) in each language."""
    likelihood = np.exp(found - found.max(axis=0))  # a factor of each trigram's own changes no comparison
    chosen = np.arange(len(found))
    share, _ = proportions(likelihood, n)
    some = share * n.sum() >= min(0.5, share.max() * n.sum())
    chosen = chosen[some]
    share, fit = proportions(likelihood[chosen], n)
    penalty = 0.5 * math.log(max(2, n.sum()))
    while len(chosen) > 1:
        rest = np.delete(chosen, int(np.argmin(share)))
        new_share, new_fit = proportions(likelihood[rest], n)
        if new_fit + penalty < fit:
            break
        share, fit, chosen = new_share, new_fit, rest
    top = int(np.argmax(share))
    return int(chosen[top]), float(min(1.0, max(0.0, share[top]))), [int(c) for c in chosen]


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """doc_id, held_out, lang_pred, score, langs (the selected set) of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(learn(docs, id_col, text_col, lang_col))

    def run(batches):
        model = shared.value
        langs = model.langs
        for batch in batches:
            names, scores, sets = [], [], []
            for text in batch.column(2).to_pylist():
                name, score, chosen = "und", 0.0, []
                if langs and text and any(map(str.isalpha, text)):
                    at, n = trigram_counts(text)
                    top, score, chosen = infer(model.logs(at), n)
                    name = langs[top]
                names.append(name)
                scores.append(score)
                sets.append([langs[c] for c in chosen])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string()))],
                ["doc_id", "held_out", "lang_pred", "score", "langs"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(rows, run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, langs array<string>")
