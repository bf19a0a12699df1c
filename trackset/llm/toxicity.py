"""Operator 3: a convolutional text classifier for toxicity, trained in numpy.

Words (runs of ASCII letters, digits and non-ASCII bytes, lower-cased) have hashed embeddings: the sum of the
embeddings of the word, of its first 4 bytes and of its first 6, so that inflected forms share what they learn.
Filters of several widths slide over a text; each keeps its maximum over the whole text; a logistic unit weighs them.

The model is trained on all labelled documents, all words of each. The driver begins with the first: at most SAMPLE of
each class, by the order of a hash of the id, and no more than use up MOST_WORDS words of that class, in the same order;
how long a text is does not decide whether it is among them. If there are more, the network goes on over all labelled
rows, PASSES times, in slices whose mean is taken. About every fifth row is held back, and a threshold for each language
is calibrated on all of these; scores themselves never depend on the language.

Defined results: null and empty texts are scored by the bias alone; without labelled rows of both classes all scores are
the share of toxic ones (0 without any); null ids are kept and never held out; repeated rows each get a row; repeated
labels of one id count as toxic if one is; an empty table gives an empty result; texts are scored whole, a stretch at a
time; only the named columns are read.
"""

from __future__ import annotations

import copy
import math
import pickle
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .numwords import column_bytes, word_hashes

#: Rows of a class that the driver begins with.
SAMPLE = 2500
#: Words of a class that the driver holds (12 bytes each); the text that passes this is the last.
MOST_WORDS = 8_000_000
BUCKETS_BITS = 15
SIZE = 16
WIDTHS = (1, 2, 3)
FILTERS = 16
EPOCHS = 5
RATE = 0.08
#: Passes over all labelled rows where the first ones are not all, slices that are learned from side by side (of
#: SLICE_ROWS rows or more each), and places of the grid that thresholds are found on.
PASSES, SLICES, SLICE_ROWS, GRID = 2, 12, 2500, 4096
#: The contract's threshold, and what languages without calibration rows get.
THRESHOLD = 0.7
PREFIXES = (4, 6)
_STRETCH = 1 << 14
_PAD = max(WIDTHS) - 1

_SOLID = np.zeros(256, bool)
_SOLID[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype="u1")
_LOWER[0x41:0x5B] += 0x20


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def word_numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of the words of a batch's texts (words x 3), and the text of each word."""
    data, rows = column_bytes(column)
    data = _LOWER[data]
    solid = _SOLID[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    full = rows[1:] > rows[:-1]
    for marks, at in ((first, rows[:-1][full]), (last, rows[1:][full] - 1)):
        marks[at] = solid[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    shift = np.uint64(64 - BUCKETS_BITS)
    out = np.empty((len(starts), 1 + len(PREFIXES)), "i4")
    out[:, 0] = word_hashes(data, starts, ends) >> shift
    for k, n in enumerate(PREFIXES, 1):
        out[:, k] = (word_hashes(data, starts, np.minimum(ends, starts + n)) ^ np.uint64(k << 50)) >> shift
    return out, np.searchsorted(rows, starts, "right") - 1


def class_weights(positive: float) -> tuple[float, float]:
    """What a row of class 0 and of class 1 weighs, given the share of class 1."""
    return 0.5 / (1 - positive), 0.5 / positive


class Network:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.words = (rng.standard_normal(((1 << BUCKETS_BITS) + 1, SIZE)) * 0.1).astype("f4")
        self.words[-1] = 0  # what pads the end of a text
        self.filters = [(rng.standard_normal((w * SIZE, FILTERS)) / math.sqrt(w * SIZE)).astype("f4") for w in WIDTHS]
        self.offsets = np.zeros((len(WIDTHS), FILTERS), "f4")
        self.weights = (rng.standard_normal((len(WIDTHS), FILTERS)) * 0.3).astype("f4")
        self.bias = np.float32(0)
        # sums of squared gradients, by which steps get smaller
        self.seen = [np.full(p.shape, 1e-3, "f4") for p in (*self.filters, self.offsets, self.weights)]
        self.seen_words, self.seen_bias = np.full(self.words.shape, 1e-3, "f4"), 1e-3

    def _embedded(self, numbers: np.ndarray) -> np.ndarray:
        x = self.words[numbers[:, 0]]
        for k in range(1, numbers.shape[1]):
            x = x + self.words[numbers[:, k]]
        return x

    @staticmethod
    def _windows(x: np.ndarray, width: int) -> np.ndarray:
        n = len(x) - _PAD
        return np.concatenate([x[i : i + n] for i in range(width)], axis=1) if width > 1 else x[:n]

    def train(self, texts: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> None:
        """Adagrad, a text at a time; both classes weigh the same."""
        rng = np.random.default_rng(seed)
        weight = class_weights(labels.mean())
        for _ in range(EPOCHS):
            for i in rng.permutation(len(texts)):
                self.step(texts[i], labels[i], weight[labels[i]])

    def step(self, numbers: np.ndarray, label: int, weight: float) -> None:
        if not len(numbers):
            return
        dense = [*self.filters, self.offsets, self.weights]
        x = np.concatenate((self._embedded(numbers), np.zeros((_PAD, SIZE), "f4")))
        best, pooled = [], np.empty_like(self.offsets)
        for k, w in enumerate(WIDTHS):
            z = self._windows(x, w) @ self.filters[k]
            best.append(z.argmax(axis=0))
            pooled[k] = z[best[k], np.arange(FILTERS)] + self.offsets[k]
        active = pooled > 0
        pooled *= active
        score = 1 / (1 + math.exp(-float(np.clip((pooled * self.weights).sum() + self.bias, -30, 30))))
        slope = np.float32((score - label) * weight)
        back = slope * self.weights * active
        grads = []
        dx: dict[int, np.ndarray] = {}
        for k, w in enumerate(WIDTHS):
            held = np.stack([x[b : b + w].ravel() for b in best[k]])
            grads.append((held * back[k][:, None]).T)
            into = (self.filters[k] * back[k]).T.reshape(FILTERS, w, SIZE)
            for f in np.flatnonzero(back[k]):
                for j in range(w):
                    if (t := int(best[k][f]) + j) < len(numbers):
                        dx[t] = dx[t] + into[f, j] if t in dx else into[f, j]
        grads += [back, slope * pooled]
        for p, g, s in zip(dense, grads, self.seen):
            s += g * g
            p -= RATE * g / np.sqrt(s)
        self.seen_bias += float(slope * slope)
        self.bias -= np.float32(RATE * slope / math.sqrt(self.seen_bias))
        if dx:
            at = numbers[list(dx)].ravel()
            g = np.repeat(np.stack(list(dx.values())), numbers.shape[1], axis=0)
            np.add.at(self.seen_words, at, g * g)
            np.subtract.at(self.words, at, RATE * g / np.sqrt(self.seen_words[at]))

    def merge(self, parts: Iterable[Network]) -> None:
        """Take the mean of networks that went on from this one, each over rows of its own, one after the other. An
        embedding is the mean over those that changed it; sums of squared gradients add up."""
        words, squares, changed = np.zeros_like(self.words), np.zeros_like(self.words), np.zeros((len(self.words), 1), "f4")
        dense = lambda p: [*p.filters, p.offsets, p.weights]
        sums, seen = [np.zeros_like(x) for x in dense(self)], [np.zeros_like(x) for x in dense(self)]
        bias, seen_bias, n = 0.0, 0.0, 0
        for p in parts:
            own = (p.seen_words != self.seen_words).any(axis=1, keepdims=True)
            words += np.where(own, p.words - self.words, np.float32(0))
            changed += own
            squares += p.seen_words - self.seen_words
            for total, more in zip((*sums, *seen), (*dense(p), *(x - y for x, y in zip(p.seen, self.seen)))):
                total += more
            bias, seen_bias, n = bias + float(p.bias), seen_bias + p.seen_bias - self.seen_bias, n + 1
        self.words += words / np.maximum(changed, 1)
        self.seen_words += squares
        *self.filters, self.offsets, self.weights = (x / np.float32(n) for x in sums)
        self.bias = np.float32(bias / n)
        self.seen = [x + y for x, y in zip(self.seen, seen)]
        self.seen_bias += seen_bias

    def compiled(self) -> Scorer:
        """What scores texts: what each embedding gives at each place of each filter, worked out once."""
        spans = [self.filters[k][i * SIZE : (i + 1) * SIZE] for k, w in enumerate(WIDTHS) for i in range(w)]
        return Scorer(self.words @ np.concatenate(spans, axis=1), self.offsets, self.weights, self.bias)

    def scores(self, numbers: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
        return self.compiled().scores(numbers, row, n_rows)


class Scorer:
    """Scores are sums in a fixed order, so a text's score does not depend on the texts that it is scored with."""

    def __init__(self, table: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bias: np.float32):
        self.table, self.offsets, self.weights, self.bias = table, offsets, weights, bias

    def scores(self, numbers: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
        """A score for each of n_rows texts, whose words lie end to end."""
        pooled = np.full((n_rows, len(WIDTHS), FILTERS), -np.inf, "f4")
        # each text is followed by padding, so that no window reaches into the next
        place = np.arange(len(row)) + row * _PAD
        padded = np.full((len(row) + n_rows * _PAD, numbers.shape[1]), len(self.table) - 1, "i4")
        padded[place] = numbers
        for at in range(0, len(row), _STRETCH):
            end = min(len(row), at + _STRETCH)
            low, high = place[at], place[end - 1] + 1
            near = padded[low : high + _PAD]
            given = self.table[near[:, 0]]
            for k in range(1, near.shape[1]):
                given += self.table[near[:, k]]
            at_words = place[at:end] - low
            own = row[at:end]
            fresh = np.flatnonzero(np.diff(own, prepend=-1))
            for k, w in enumerate(WIDTHS):
                first = sum(WIDTHS[:k]) * FILTERS
                z = given[at_words, first : first + FILTERS]
                for i in range(1, w):
                    z += given[at_words + i, first + i * FILTERS : first + (i + 1) * FILTERS]
                top = np.maximum.reduceat(z, fresh, axis=0)
                pooled[own[fresh], k] = np.maximum(pooled[own[fresh], k], top)
        pooled = np.maximum(pooled + self.offsets, 0)
        logit = np.clip((pooled * self.weights).reshape(n_rows, -1).sum(axis=1) + self.bias, -30, 30)
        return 1 / (1 + np.exp(-logit.astype("f8")))


class Constant:
    def __init__(self, share: float):
        self.share = share

    def scores(self, numbers: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
        return np.full(n_rows, self.share)


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """toxic, lang, draw, words (packed embedding rows), n of every labelled row that may be learned from."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.withColumn("draw", F.xxhash64(F.lit("toxicity"), F.col("id").cast("string")))
    rows = docs.where(~held_out(id_col)).select(
        F.col(id_col).alias("id"),
        F.col(lang_col).cast("string").alias("lang"),
        common.text_or_empty(text_col).cast("binary").alias("text"),
    )

    def run(batches):
        for batch in batches:
            numbers, row = word_numbers(batch.column(3))
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
            packed = [numbers[a:b].tobytes() for a, b in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(packed, pa.binary()), pa.array(np.diff(cut))], ["toxic", "lang", "draw", "words", "n"]
            )

    # exchanged at every size: labels grow with the documents, so they are not handed to the driver
    joined = rows.join(known.hint("merge"), "id").select("toxic", "lang", "draw", "text")
    return common.map_arrow(joined, run, "toxic int, lang string, draw long, words binary, n long")


def within_words(sizes: list[tuple[int, int]], most: int) -> int | None:
    """Of (draw, words) the draw up to which texts are taken: the one that uses up `most` words; None takes all."""
    total = 0
    for draw, n in sorted(sizes):
        total += n
        if total >= most:
            return draw
    return None


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """Half way across the gap at which the F1 measure is best."""
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    at = int(np.argmax(f1))
    below = scores[order[at + 1]] if at + 1 < len(order) else 0.0
    return float((scores[order[at]] + below) / 2)


def unpacked(words: bytes) -> np.ndarray:
    return np.frombuffer(words, "i4").reshape(-1, 1 + len(PREFIXES))


def is_back():
    """Rows that are held back for calibration where the first rows are not all."""
    return F.pmod("draw", F.lit(5)) == 4


def one_pass(network: Network, rows: DataFrame, n: int, positive: float, nth: int) -> None:
    """Take the network once over all n rows, of which a share is `positive`: slices of the rows go on from it side by
    side, each a text at a time in the order of a hash, and their mean is taken. A slice is never held in memory; the
    driver reads the slices' networks, of 4 MB each, one by one."""
    shared = rows.sparkSession.sparkContext.broadcast(network)
    slices = max(1, min(SLICES, n // SLICE_ROWS))
    weight = class_weights(positive)

    def run(batches):
        own, at = None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([pickle.dumps(own)], pa.binary())], ["slice", "network"])
        for batch in batches:
            for here, toxic, words in zip(*(batch.column(c).to_pylist() for c in ("slice", "toxic", "words"))):
                if here != at:
                    if own is not None:
                        yield done()
                    own, at = copy.deepcopy(shared.value), here
                own.step(unpacked(words), toxic, weight[toxic])
        if own is not None:
            yield done()

    order = F.xxhash64(F.lit(nth), "draw")
    dealt = rows.select(F.pmod(order, F.lit(slices)).alias("slice"), order.alias("turn"), "toxic", "words")
    # more partitions than slices, so that few slices share one
    dealt = dealt.repartition(4 * slices, "slice").sortWithinPartitions("slice", "turn", "toxic", "words")
    found = common.materialise(common.map_arrow(dealt.select("slice", "toxic", "words"), run, "slice long, network binary"), "networks")
    network.merge(pickle.loads(r["network"]) for k in range(slices) for r in found.where(F.col("slice") == k).collect())
    common.discard(found)
    shared.destroy()


def grid_thresholds(scorer: Scorer, back: DataFrame) -> dict[str, float]:
    """The threshold of each language by all rows that are held back: scores are counted on a grid, and it is half way
    across the gap at which the F1 measure is best."""
    shared = back.sparkSession.sparkContext.broadcast(scorer)

    def run(batches):
        for batch in batches:
            texts = [unpacked(w) for w in batch.column(2).to_pylist()]
            numbers, row = np.concatenate(texts), np.repeat(np.arange(len(texts)), [len(t) for t in texts])
            found = shared.value.scores(numbers, row, len(texts))
            place = pa.array(np.minimum(found * GRID, GRID - 1).astype("i8"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], place], ["lang", "toxic", "place"])

    rows = back.where("lang IS NOT NULL").select("lang", "toxic", "words")
    counts = common.map_arrow(rows, run, "lang string, toxic int, place long").groupBy("lang", "place").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")
    )
    whole, above = Window.partitionBy("lang"), Window.partitionBy("lang").orderBy(F.desc("place"))
    below = F.coalesce(F.lead("place").over(above) + 1, F.lit(0))
    counts = counts.select(
        "lang",
        "place",
        ((F.col("place") + below) / (2.0 * GRID)).alias("threshold"),
        (F.sum("toxic").over(above) / (F.sum("n").over(above) + F.sum("toxic").over(whole))).alias("f1"),
        F.sum("toxic").over(whole).alias("all_toxic"),
        F.sum("n").over(whole).alias("all"),
    )
    best = counts.where("all_toxic > 0 AND all_toxic < all").groupBy("lang")
    return dict(best.agg(F.max_by("threshold", F.struct("f1", "place"))).collect())  # a number for each language


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """The scorer, and the threshold of each language that has calibration rows of both classes."""
    known = common.materialise(labelled(docs, labels, id_col, text_col, lang_col), "labelled")
    first, sizes, total = known, {}, dict(known.groupBy("toxic").count().collect())
    for c in (0, 1):
        own = known.where(F.col("toxic") == c).select("draw", "n").orderBy("draw", "n").limit(SAMPLE).collect()
        # two numbers for each of the first rows
        last = within_words([tuple(r) for r in own], MOST_WORDS)
        if last is None and len(own) < total.get(c, 0):
            last = own[-1]["draw"]
        if last is not None:
            first = first.where((F.col("toxic") != c) | (F.col("draw") <= last))
    rows = first.select("toxic", "lang", "draw", "words").collect()  # the bounded first rows
    rows.sort(key=lambda r: (r["draw"], r["toxic"], r["words"]))
    n = sum(total.values())
    toxic = np.array([r["toxic"] for r in rows])
    if len(set(toxic)) < 2:
        return Constant(total.get(1, 0) / n if n else 0.0), {}
    texts = [unpacked(r["words"]) for r in rows]
    whole = len(rows) == n
    back = np.arange(len(rows)) % 5 == 4 if whole else np.array([r["draw"] % 5 == 4 for r in rows])
    if whole and len(set(toxic[~back])) < 2:
        back[:] = False
    network = Network()
    if len(set(toxic[~back])) == 2:
        network.train([t for t, b in zip(texts, back) if not b], toxic[~back])
    if not whole:
        rest = known.where(~is_back())
        parts = dict(rest.groupBy("toxic").count().collect())
        if len(parts) == 2:
            for nth in range(PASSES):
                one_pass(network, rest, sum(parts.values()), parts[1] / sum(parts.values()), nth)
        scorer = network.compiled()
        return scorer, grid_thresholds(scorer, known.where(is_back()))
    scorer, thresholds = network.compiled(), {}
    for lang in {r["lang"] for r, b in zip(rows, back) if b and r["lang"] is not None}:
        own = [i for i in np.flatnonzero(back) if rows[i]["lang"] == lang]
        if len(set(toxic[own])) == 2:
            scored = [scorer.scores(texts[i], np.zeros(len(texts[i]), "i8"), 1)[0] for i in own]
            thresholds[lang] = best_threshold(np.array(scored), toxic[own])
    return scorer, thresholds


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """doc_id, held_out, score, flagged (by the threshold of the row's language) of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(train(docs, labels, id_col, text_col, lang_col))  # about 13 MB

    def run(batches):
        scorer, thresholds = shared.value
        for batch in batches:
            found = scorer.scores(*word_numbers(batch.column(3)), batch.num_rows)
            most = [thresholds.get(x, THRESHOLD) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(found), pa.array(found >= np.array(most, "f8"))],
                ["doc_id", "held_out", "score", "flagged"],
            )

    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        held_out(id_col).alias("held_out"),
        F.col(lang_col).cast("string").alias("lang"),
        common.text_or_empty(text_col).cast("binary").alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(rows, run, f"doc_id {kind}, held_out boolean, score double, flagged boolean")
