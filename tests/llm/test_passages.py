import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from trackset.llm import numwords, passages

from .conftest import make, words


def brute(rows, n=20):
    """doc_id -> (n_words, n_removed, sha) by the definition, ids unique or rows repeated."""
    once = {}
    for i, t, *_ in rows:
        once[(i if i is not None else 1 << 62, t or "")] = i
    starts: dict[tuple, tuple] = {}
    split = {k: k[1].encode().split() for k in once}
    for k in sorted(once):
        for p in range(len(split[k]) - n + 1):
            starts.setdefault(tuple(split[k][p : p + n]), (k[0], p))
    out = {}
    for k, ws in split.items():
        gone = set()
        for p in range(len(ws) - n + 1):
            if starts[tuple(ws[p : p + n])] != (k[0], p):
                gone.update(range(p, p + n))
        kept = b" ".join(w for j, w in enumerate(ws) if j not in gone)
        out[k] = (len(ws), len(gone), hashlib.sha256(kept).hexdigest())
    return sorted(((i, *out[(i if i is not None else 1 << 62, t or "")]) for i, t, *_ in rows), key=str)


def got(df):
    return sorted(((r.row.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_matches_brute_force(edge_docs, edge_rows, corpus, corpus_rows, no_docs):
    assert got(passages.remove_repeats(corpus)) == brute(corpus_rows)
    assert got(passages.remove_repeats(edge_docs)) == brute(edge_rows)
    assert got(passages.remove_repeats(no_docs)) == []


def test_self_repeats_overlaps_and_periods(spark):
    rng = random.Random(9)
    a, b = words(rng, 25, 9999), words(rng, 40, 9999)
    texts = ["x " * 70, f"{a} {a} {a}", f"{b} {a}", f"u {b} v {b}", "x " * 30 + a, " ".join(["p q r"] * 30), a, words(rng, 19), a + "\n" + a]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    assert got(passages.remove_repeats(make(spark, rows))) == brute(rows)


def test_small_vocabularies(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 90))), "en", "s") for i in range(30)]
    assert got(passages.remove_repeats(make(spark, rows, clash=False))) == brute(rows)


def test_kept_text_is_untouched_where_nothing_goes(spark):
    text = "one  two\tthree\n" * 3
    row = passages.remove_repeats(make(spark, [(1, text, "en", "s")]), want_text=True).first()
    assert row.kept == text and row.n_removed == 0


def thue_morse(n, zero, one):
    return "".join(zero if bin(i).count("1") % 2 else one for i in range(n))


def test_words_that_a_polynomial_confuses_are_told_apart(spark):
    """Thue-Morse words and their complements agree under any polynomial hash modulo 2^64."""
    a, b = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    data = np.frombuffer(f"{a} {b}".encode(), "u1")
    at = (data, np.array([0, 2049]), np.array([2048, 4097]))
    assert all(len(set(numwords.word_hashes(*at, seed).tolist())) == 2 for seed in (0, 1))
    rest = words(random.Random(1), 30, 9999).split()
    rows = [(i, " ".join(rest[:10] + [w] + rest[10:21]), "en", "s") for i, w in enumerate((a, b, a, b))]
    assert got(passages.remove_repeats(make(spark, rows))) == brute(rows)


def test_equal_keys_remove_no_word(spark, monkeypatch):
    """With keys that all agree the automata still compare words: nothing goes that is not a repeat of its pattern."""
    monkeypatch.setattr(passages, "runs_of_words", lambda h, n, seed=0: numwords.runs_of_words(h, n, seed) * np.uint64(n != passages.WINDOW))
    rng = random.Random(8)
    rows = [(i, f"{words(rng, 21, 9999)} one two three four five six seven eight nine ten eleven twelve thirteen", "en", "s") for i in range(6)]
    assert all(r[2] == 0 for r in got(passages.remove_repeats(make(spark, rows))))


def test_automata_by_shard_locate_all(spark, corpus, corpus_rows, monkeypatch):
    monkeypatch.setattr(passages, "SHARD_BYTES", 3000)
    assert got(passages.remove_repeats(corpus)) == brute(corpus_rows)
    texts = spark.createDataFrame([(i, i, f"{words(random.Random(1), 24, 9999)} x{i}") for i in range(50)], "node long, first_id long, text string")
    found, first = passages.confirmed(texts)  # words 1 to 24 make 5 windows
    assert first.count() == 5 and found.where("pos < 5").count() == 250
    (row,) = passages.passages(first, texts).collect()
    assert (row.at, row.low, row.start, row.starts, row.words.count(b" ")) == (0, 0, 0, [0, 1, 2, 3, 4], 23) and row.anchors
    sent = passages.sharded(texts.withColumn("cls", F.lit(b"c")), found, first)
    # a passage of all documents goes to each shard once
    assert sent.where("NOT is_text").count() == sent.where("is_text").select("shard").distinct().count()


def test_word_hashes_and_windows(monkeypatch):
    monkeypatch.setattr(numwords, "_LONG", 64)
    text = ("the cat " * 30 + "y" * 200 + " the cat z").encode()
    data, rows = np.frombuffer(text, "u1"), np.array([0, 100, 100, len(text)])
    s, e, row = numwords.words(data, rows)
    parts = [text[i:j] for i, j in zip(s, e)]
    assert parts == text[:100].split() + text[100:].split() and set(row) == {0, 2}
    h = numwords.word_hashes(data, s, e)
    assert len(set(h.tolist())) == len(set(parts))
    for n in (1, 2, 3, 8, 20):
        runs = numwords.runs_of_words(h, n)
        keys = [tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)]
        assert len(runs) == len(keys) and len(set(zip(runs.tolist(), keys))) == len(set(keys)) == len(set(runs.tolist()))
