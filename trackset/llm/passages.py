"""Operator 5: removal of repeated passages by repeated-phrase automata.

A window is 20 consecutive words of one document. The steps, each over all documents:

1. Copies of a whole text are merged; all but the first (smallest id) are repeats as a whole.
2. Phrases: of the runs of PHRASE words in each window, the one with the least hash is chosen. Equal windows choose equal
   phrases. Phrases that are chosen more than once are counted by hash.
3. Confirmation: the windows whose chosen phrase recurs are keyed by two independent 64-bit hashes of their words and
   counted. Those that recur are read from their first documents (smallest id), where windows that start near each
   other form a passage; the phrases that they choose there are the patterns.
4. Routing: documents are dealt into shards of about SHARD_BYTES by number, and each shard gets every passage of which
   one of its documents holds a window by key, once. A passage of many documents goes to every shard at most, so it
   crowds none.
5. Each shard's phrases are compiled into one Aho-Corasick automaton over word numbers, and all documents of the shard
   are streamed through it. The automaton alone locates occurrences; keys have no say in that. From each phrase that is
   met, the passage is followed word by word in both directions, and what agrees over a window or more is a repeat if
   the passage's document is an earlier one, or if the window has been met before in the same document.

Unequal windows with one key could cost at most a removal, never a word: what is removed equals its passage in all words.
That needs 128 bits of two hashes to agree.

Ids order documents; null ids come last. Documents with equal ids but different texts don't count as earlier than
each other. Defined results: null and empty texts have no words; texts of under 20 words lose none; repeated rows
each get a row; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .numwords import column_bytes, runs_of_words, sliding, word_hashes, words

WINDOW = 20
PHRASE = 8
#: Text that shares an automaton, in bytes.
SHARD_BYTES = 8 << 20
#: Window starts of a document that travel together.
BLOCK = 64
_CHOICES = WINDOW - PHRASE + 1
_NO_ID = (1 << 63) - 1
_NEVER = np.uint64(0)
#: Words of a document that pass through an automaton at once.
_STRETCH = 200_000
_DEAL = 2_000_000
#: Values of a digit of a word's number, and the number of all words that no passage has.
_DIGIT, _UNKNOWN = 256, (1 << 30) - 1


def _numbered(column, seeds: tuple[int, ...] = (0,)):
    """Hashes of the words of a batch's texts (for each seed), the row of each word, and each row's first word."""
    data, rows = column_bytes(column)
    starts, ends, row = words(data, rows)
    first = np.searchsorted(row, np.arange(len(column)))
    return [word_hashes(data, starts, ends, seed) for seed in seeds], row, first


def _chosen(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrase hashes, the least in each window (0 where a window would leave its row), and which windows exist."""
    phrase = np.maximum(runs_of_words(h, PHRASE), np.uint64(1))
    least = sliding(phrase, _CHOICES, np.minimum).copy()
    inside = row[: len(least)] == row[len(row) - len(least) :]
    least[~inside] = _NEVER
    return phrase, least, inside


def phrases(texts: DataFrame) -> DataFrame:
    """phrase (hash), node, pos (its first word): the phrases that the windows of each text choose."""

    def run(batches):
        for batch in batches:
            (h,), row, first = _numbered(batch.column(1))
            phrase, least, inside = _chosen(h, row)
            if not len(least):
                continue
            # a phrase is chosen if it equals the least of a window that holds it
            padded = np.concatenate((np.zeros(_CHOICES - 1, "u8"), least, np.zeros(_CHOICES - 1, "u8")))
            highest = sliding(padded, _CHOICES, np.maximum)
            at = np.flatnonzero((highest == phrase) & (highest != _NEVER))
            for i in range(0, len(at), _DEAL):
                part = at[i : i + _DEAL]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(phrase[part].view("i8")),
                        batch.column(0).take(pa.array(row[part])),
                        pa.array((part - first[row[part]]).astype("i4")),
                    ],
                    ["phrase", "node", "pos"],
                )

    return common.map_arrow(texts.select("node", F.col("text").cast("binary")), run, "phrase long, node long, pos int")


def windows(texts: DataFrame) -> DataFrame:
    """Of texts (node, first_id, text, phrases: first words of recurring phrases), the windows that choose one of them,
    each once: key1, key2, id, node, pos (where it starts first), times (that it comes in the text)."""

    def run(batches):
        for batch in batches:
            (h, g), row, first = _numbered(batch.column(2), (0, 1))
            phrase, least, inside = _chosen(h, row)
            if not len(least):
                continue
            lists = batch.column(3)
            counts = np.diff(np.asarray(lists.offsets))
            marks = np.repeat(first, counts) + np.asarray(lists.flatten())
            recurring = np.full(len(phrase), np.iinfo("u8").max, "u8")
            recurring[marks] = phrase[marks]
            at = np.flatnonzero((sliding(recurring, _CHOICES, np.minimum) == least) & inside)
            if not len(at):
                continue
            key1, key2 = runs_of_words(h, WINDOW, 1)[at], runs_of_words(g, WINDOW, 2)[at]
            order = np.lexsort((at, key2, key1, row[at]))
            k1, k2, r = key1[order], key2[order], row[at][order]
            fresh = np.flatnonzero(np.concatenate(([True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (r[1:] != r[:-1]))))
            times = np.diff(np.append(fresh, len(order)))
            kept = order[fresh]
            for i in range(0, len(kept), _DEAL):
                part = kept[i : i + _DEAL]
                where = pa.array(row[at[part]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key1[part].view("i8")),
                        pa.array(key2[part].view("i8")),
                        batch.column(1).take(where),
                        batch.column(0).take(where),
                        pa.array((at[part] - first[row[at[part]]]).astype("i4")),
                        pa.array(times[i : i + _DEAL].astype("i4")),
                    ],
                    ["key1", "key2", "id", "node", "pos", "times"],
                )

    rows = texts.select("node", "first_id", F.col("text").cast("binary"), "phrases")
    return common.map_arrow(rows, run, "key1 long, key2 long, id long, node long, pos int, times int")


def confirmed(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The windows that choose a recurring phrase, and of those that come twice or more: key1, key2, low (the first id
    that has it), at (that document's number), pos."""
    chosen = common.materialise(phrases(texts), "phrases")
    # written, so that the join exchanges both sides and Spark can split a frequent phrase
    often = chosen.groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("phrase")
    often = common.materialise(often, "frequent-phrases")
    marks = chosen.join(often, "phrase").groupBy("node").agg(F.collect_list("pos").alias("phrases"))
    marks = common.materialise(marks, "phrase-places")
    common.discard(chosen, often)
    found = common.materialise(windows(texts.join(marks, "node")), "windows")
    common.discard(marks)
    first = found.groupBy("key1", "key2").agg(
        F.sum("times").alias("n"), F.min("id").alias("low"), F.min_by("node", "id").alias("at"), F.min_by("pos", "id").alias("pos")
    )
    return found, common.materialise(first.where("n > 1").drop("n"), "first-windows")


def passages(first: DataFrame, texts: DataFrame) -> DataFrame:
    """at, block, low, words (joined by spaces), start (of the first word), starts (of windows) and anchors (of the phrases
    that they choose), both from `start` on: the recurring windows of each block of a first document."""
    schema = "at long, block int, low long, words binary, start int, starts array<int>, anchors array<int>"
    names = [x.split()[0] for x in schema.split(", ")]
    list_of = pa.list_(pa.int32())
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), list_of, list_of)

    def run(batches):
        for batch in batches:
            (h,), _, first = _numbered(batch.column(1))
            phrase = runs_of_words(h, PHRASE)
            out: dict[str, list] = {n: [] for n in names}
            for k, (node, raw, low, wanted) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                split, pos = raw.split(), np.sort(np.array(wanted))
                least = phrase[first[k] + pos[:, None] + np.arange(_CHOICES)].argmin(axis=1) + pos
                block = pos // BLOCK
                for cut in np.split(np.arange(len(pos)), np.flatnonzero(np.diff(block)) + 1):
                    own = pos[cut]
                    body = b" ".join(split[own[0] : own[-1] + WINDOW])
                    row = (node, block[cut[0]], low, body, own[0], own - own[0], np.unique(least[cut]) - own[0])
                    for name, value in zip(names, row):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names)

    wanted = first.groupBy(F.col("at").alias("node")).agg(F.min("low").alias("low"), F.collect_list("pos").alias("wanted"))
    rows = texts.join(wanted, "node").select("node", F.col("text").cast("binary"), "low", "wanted")
    return common.map_arrow(rows, run, schema)


class Automaton:
    """Finds phrases of word numbers, and follows the passages that they are from.

    A word is two symbols, the digits of its number, so that no state has more children than a digit has values: the
    library looks through them one by one."""

    def __init__(self):
        self.words: dict[bytes, int] = {}
        self.found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        #: Of each passage its words, window starts, document's number and id, and place there.
        self.passages: list[tuple[list[int], set[int], int, int, int]] = []

    def add(self, passage: list[bytes], starts: list[int], anchors: list[int], node: int, first_id: int, start: int) -> None:
        numbers = [self.words.setdefault(w, len(self.words)) for w in passage]
        symbols = tuple(chain.from_iterable((n % _DIGIT, _DIGIT + n // _DIGIT) for n in numbers))
        for a in anchors:
            key = symbols[2 * a : 2 * (a + PHRASE)]
            places = self.found.get(key, None)
            if places is None:
                self.found.add_word(key, [(len(self.passages), a)])
            else:
                places.append((len(self.passages), a))
        self.passages.append((numbers, set(starts), node, first_id, start))

    def covered(self, text: list[bytes], node: int, own_id: int) -> np.ndarray:
        """Which words lie in a window that starts earlier: in an earlier document, or earlier here."""
        edges = np.zeros(len(text) + 1, "i4")
        if self.words:
            if self.found.kind == ahocorasick.TRIE:  # once, when all phrases are in
                self.found.make_automaton()
            number = self.words.get
            numbers = [number(w, _UNKNOWN) for w in text]
            own, done = [], {}
            for at in range(0, len(text), _STRETCH):
                low = max(0, at - PHRASE + 1)
                part = tuple(chain.from_iterable([(n % _DIGIT, _DIGIT + n // _DIGIT) for n in numbers[low : at + _STRETCH]]))
                for end, places in self.found.iter(part):
                    here = low + end // 2 - PHRASE + 1
                    for k, a in places:
                        passage, starts, first_node, first_id, start = self.passages[k]
                        shift = here - a
                        # met at this alignment before, or the passage itself
                        if done.get((k, shift), 0) > here or first_node == node and shift == start:
                            continue
                        i, j = a, a + PHRASE
                        while i and i + shift and passage[i - 1] == numbers[i - 1 + shift]:
                            i -= 1
                        most = min(len(passage), len(numbers) - shift)
                        while j < most and passage[j] == numbers[j + shift]:
                            j += 1
                        done[k, shift] = j + shift
                        if j - i >= WINDOW:
                            if first_id < own_id:
                                edges[i + shift] += 1
                                edges[j + shift] -= 1
                            elif first_id == own_id:
                                own += [(s + shift, k, s, first_node == node) for s in range(i, j - WINDOW + 1) if s in starts]
            # of windows that are known from this id alone the first one here stays, unless it is in the passage itself
            met = set()
            for at, k, s, itself in sorted(own):
                if itself or (k, s) in met:
                    edges[at] += 1
                    edges[at + WINDOW] -= 1
                met.add((k, s))
        return np.cumsum(edges[:-1]) > 0


def sharded(texts: DataFrame, found: DataFrame, first: DataFrame) -> DataFrame:
    """shard, is_text, cls, node, id, body, start, starts, anchors: the passages of each shard before its documents
    (number, first_id and text), a shard's rows together and in this order."""
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = parts * max(1, -(-size // (parts * SHARD_BYTES)))
    shard = lambda node: F.pmod(F.xxhash64(node), F.lit(count)).cast("int").alias("shard")
    known = common.materialise(passages(first, texts), "passages")
    block = F.floor(F.col("f.pos") / BLOCK).cast("int").alias("block")
    held = found.alias("w").join(first.alias("f"), ["key1", "key2"]).where("w.node <> f.at OR w.times > 1")
    routes = common.materialise(held.select(shard("w.node"), "f.at", block).distinct(), "routes")
    common.discard(found, first)
    sent = routes.join(known, ["at", "block"]).select(
        "shard", F.lit(False).alias("is_text"), F.lit(None).cast("binary").alias("cls"), F.col("at").alias("node"), F.col("low").alias("id"),
        F.col("words").alias("body"), "start", "starts", "anchors",
    )
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    docs = texts.select(
        shard("node"), F.lit(True).alias("is_text"), "cls", "node", F.col("first_id").alias("id"), F.col("text").cast("binary").alias("body"),
        none("start", "int"), none("starts", "array<int>"), none("anchors", "array<int>"),
    )
    return sent.unionAll(docs).repartitionById(parts, F.pmod("shard", F.lit(parts)).cast("int")).sortWithinPartitions("shard", "is_text")


def removed(rows: DataFrame, want_text: bool) -> DataFrame:
    """Of sharded rows: cls, first_id, n_words, n_removed, kept_sha256 [, kept] of every text."""

    def run(batches):
        at, machine = None, Automaton()
        for batch in batches:
            out: dict[str, list] = {"cls": [], "first_id": [], "n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
            for shard, is_text, cls, node, own, body, start, starts, anchors in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != at:
                    at, machine = shard, Automaton()
                if not is_text:
                    machine.add(body.split(b" "), starts, anchors, node, own, start)
                    continue
                text = body.split()
                gone = machine.covered(text, node, own)
                n = int(gone.sum())
                left = b" ".join([text[i] for i in np.flatnonzero(~gone)] if n else text)
                kept = (left if n else body).decode() if want_text else None
                for column, value in zip(out.values(), (cls, own, len(text), n, hashlib.sha256(left).hexdigest(), kept)):
                    column.append(value)
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))

    schema = "cls binary, first_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    return common.map_arrow(rows, run, schema)


def remove_repeats(
    docs: DataFrame, want_text: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """n_words, n_removed, kept_sha256 (of the words left, joined by spaces) [, kept: these words, or the text as it is
    if none went] beside all columns of `docs` but the text, which come in a struct `row`."""
    texts = common.distinct_texts(docs, id_col, text_col).select(
        "cls", F.coalesce("first_id", F.lit(_NO_ID)).alias("first_id"), "text"
    )
    texts = common.materialise(texts.withColumn("node", F.monotonically_increasing_id()), "texts")
    results = removed(sharded(texts, *confirmed(texts)), want_text)
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"),
        common.text_class_of(text_col).alias("cls"),
    )
    copy = (F.col("id") > F.col("first_id")) & (F.col("n_words") >= WINDOW)
    out = rows.join(results, "cls").select(
        "row",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )
    return out if want_text else out.drop("kept")
