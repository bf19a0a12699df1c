"""Toxicity and language: held-out accuracy, and defined results for odd rows."""

import binascii
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from trackset.llm import language_mix, toxicity

from .conftest import make, words

SYLLABLES = {"en": "th er on an re he in ed nd ha", "fr": "eau que ou la tion é ent ai re", "de": "sch ein ung ch ie ver lich ß en"}


def prose(rng, lang, n):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(12)
    docs, labels = [], []
    for i in range(900):
        lang = rng.choice(list(SYLLABLES))
        text = prose(rng, lang, rng.randint(20, 90)).split()
        toxic = int(i % 6 == 0)
        for _ in range(rng.randint(2, 4) * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(["Scum,", "moron", "vile" + rng.choice(["a", "eu", "ix"])]))
        docs.append((i, " ".join(text), lang if i % 10 else None, "s"))
        labels.append((i, 1, toxic))
    labels += [(None, 1, 1), (3, 1, None), (5000, 0, 1), (0, 0, 1)]
    return docs, make(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out(labelled):
    docs, df, labels = labelled
    rows = {r.doc_id: r for r in toxicity.score(df, labels).collect()}
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows.values())
    held = [r for r in rows.values() if r.held_out]
    assert 200 < len(held) < 400
    found = {r.doc_id for r in held if r.score >= toxicity.THRESHOLD}
    true = {r.doc_id for r in held if r.doc_id % 6 == 0}
    assert len(found & true) >= 0.95 * len(true) and len(found - true) <= 0.03 * len(held)


def test_scores_ignore_all_but_the_text(labelled, spark):
    docs, df, labels = labelled
    plain = {r.doc_id: r.score for r in toxicity.score(df, labels).collect()}
    other = df.selectExpr("doc_id", "text", "CASE WHEN doc_id % 3 = 0 THEN 'zz' END AS lang", "'q' AS source")
    assert {r.doc_id: r.score for r in toxicity.score(other.repartition(7), labels).collect()} == plain


def test_stretches_do_not_change_scores(monkeypatch):
    rng = random.Random(3)
    texts = [words(rng, n) for n in (0, 1, 2, 3, 700, 0, 5, 1300)]
    column = pa.array([t.encode() for t in texts], pa.binary())
    network = toxicity.Network()
    whole = network.scores(*toxicity.word_numbers(column), len(texts))
    alone = [network.scores(*toxicity.word_numbers(column.slice(i, 1)), 1)[0] for i in range(len(texts))]
    monkeypatch.setattr(toxicity, "_STRETCH", 64)
    cut = network.scores(*toxicity.word_numbers(column), len(texts))
    assert np.allclose(whole, cut, atol=1e-6) and np.allclose(whole, alone, atol=1e-6)


def test_gradients_lower_the_loss():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 1000, (30, 3)).astype("i4") for _ in range(40)]
    for t in texts[::2]:
        t[7] = 2000
    labels = np.array([1, 0] * 20)
    network = toxicity.Network()
    network.train(texts, labels)
    scores = [network.scores(t, np.zeros(len(t), "i8"), 1)[0] for t in texts]
    assert np.mean(np.array(scores) >= 0.5) == 0.5 and min(scores[::2]) > max(scores[1::2])


def test_odd_rows(spark, edge_docs, edge_rows, no_docs, labelled):
    labels = labelled[2]
    scored = toxicity.score(edge_docs, labels).collect()
    assert len(scored) == len(edge_rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in scored)
    assert toxicity.score(no_docs, labels).count() == 0
    assert all(r.score == 0 for r in toxicity.score(edge_docs, labels.where("false")).collect())
    one_class = toxicity.score(edge_docs, labels.where("toxic = 1"))
    assert {r.score for r in one_class.collect()} <= {0.0, 1.0}


def test_language_held_out(labelled):
    docs, df, _ = labelled
    true = {i: (la, t) for i, t, la, _ in docs}
    rows = language_mix.identify(df).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and true[r.doc_id][0]]
    assert np.mean([r.lang_pred == true[r.doc_id][0] for r in held]) > 0.97


def test_mixtures_are_seen(spark, labelled):
    rng = random.Random(7)
    mixed = [(100_000 + k, prose(rng, "en", 100) + " " + prose(rng, "fr", 60), None, "s") for k in range(20)]
    rows = language_mix.identify(labelled[1].unionByName(make(spark, mixed))).where("doc_id >= 100000").collect()
    assert np.mean([r.langs == ["en", "fr"] and r.lang_pred in r.langs for r in rows]) > 0.9


def test_languages_of_odd_rows(spark, edge_docs, edge_rows, no_docs):
    rows = language_mix.identify(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    texts = {}
    for i, t, *_ in edge_rows:
        texts.setdefault(i, set()).add(any(map(str.isalpha, t or "")))
    for r in rows:
        assert (r.lang_pred != "und") in texts[r.doc_id] and (r.lang_pred != "und" or r.score == 0)
    assert language_mix.identify(no_docs).count() == 0
    nothing = make(spark, [(1, "some words", None, "s"), (2, "123 -", "en", "s")])
    assert {(r.lang_pred, r.score) for r in language_mix.identify(nothing).collect()} == {("und", 0.0)}


def test_trigrams_by_stretches(monkeypatch):
    texts = ["The cat sat, 12 times on Mats! " * 40, " .x. " * 100, "abc" * 200, "", "  ", "é" * 7]
    whole = [language_mix.trigram_counts(t) for t in texts]
    for size in (200, 7, 1):
        monkeypatch.setattr(language_mix, "_STRETCH", size)
        for text, (at, n) in zip(texts, whole):
            found = language_mix.trigram_counts(text)
            assert found[0].tolist() == at.tolist() and found[1].tolist() == n.tolist()


def test_all_languages_are_learned(spark):
    """More languages than any cap would allow for, and a rare one among them."""
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(600):
        word = "".join(rng.choice(letters) for _ in range(5))
        rows += [(3 * k + j, f"{word} " * 30, f"l{k}", "s") for j in range(3 if k else 2)]
    model = language_mix.learn(make(spark, rows, clash=False), "doc_id", "text", "lang")
    held = {i for i, *_ in rows if binascii.crc32(str(i).encode()) % 5 == 0}
    assert model.langs == sorted({la for i, _, la, _ in rows if i not in held})
    dense = model.logs(np.arange(language_mix.BUCKETS))
    assert np.allclose(np.exp(dense).sum(axis=1), 1, atol=1e-3)


def plain_infer(logs, counts):
    """Expectation-maximisation and selection, trigram by trigram."""

    def fitted(langs):
        share = {la: 1 / len(langs) for la in langs}
        total = sum(counts)
        for _ in range(language_mix.ROUNDS):
            new = dict.fromkeys(langs, 0.0)
            for t, c in enumerate(counts):
                mixed = sum(share[la] * math.exp(logs[la][t]) for la in langs)
                for la in langs:
                    new[la] += c * share[la] * math.exp(logs[la][t]) / mixed / total
            done = max(abs(new[la] - share[la]) for la in langs) < 1e-3
            share = new
            if done:
                break
        return share, sum(c * math.log(sum(share[la] * math.exp(logs[la][t]) for la in langs)) for t, c in enumerate(counts))

    total = sum(counts)
    share, _ = fitted(range(len(logs)))
    langs = [la for la in share if share[la] * total >= min(0.5, max(share.values()) * total)]
    share, fit = fitted(langs)
    while len(langs) > 1:
        least = min(langs, key=lambda la: (share[la], la))
        rest = [la for la in langs if la != least]
        new, new_fit = fitted(rest)
        if new_fit + 0.5 * math.log(max(2, total)) < fit:
            break
        share, fit, langs = new, new_fit, rest
    top = max(langs, key=lambda la: (share[la], -la))
    return top, share[top], langs


def test_inference_is_what_the_plain_one_finds():
    rng = np.random.default_rng(6)
    for k in range(40):
        logs = np.log(rng.dirichlet(np.full(30, 0.3), size=rng.integers(1, 6)) + 1e-6)
        counts = rng.integers(1, 9, 30)
        top, score, langs = language_mix.infer(logs, counts)
        other = plain_infer(logs.tolist(), counts.tolist())
        assert (top, langs) == (other[0], other[2]) and abs(score - other[1]) < 1e-6


def test_held_out_is_by_crc32(labelled):
    docs, df, labels = labelled
    crc = lambda i: binascii.crc32(str(i).encode())
    assert {r.doc_id: r.held_out for r in toxicity.score(df, labels).collect()} == {i: crc(i) % 3 == 1 for i, *_ in docs}
    assert {r.doc_id: r.held_out for r in language_mix.identify(df).collect()} == {i: crc(i) % 5 == 0 for i, *_ in docs}


def plain_score(network, numbers):
    """One text's score, filter by filter and window by window."""
    words = [sum(network.words[k].astype("f8") for k in row) for row in numbers]
    words += [np.zeros(toxicity.SIZE)] * (max(toxicity.WIDTHS) - 1)
    logit = float(network.bias)
    for k, w in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            values = [np.concatenate(words[i : i + w]) @ network.filters[k][:, f].astype("f8") for i in range(len(numbers))]
            pooled = max(0.0, max(values, default=-math.inf) + float(network.offsets[k, f]))
            logit += pooled * float(network.weights[k, f])
    return 1 / (1 + math.exp(-logit))


def test_scores_are_what_the_plain_network_gives():
    rng = random.Random(4)
    texts = [words(rng, n) for n in (0, 1, 2, 5, 40)]
    column = pa.array([t.encode() for t in texts], pa.binary())
    numbers, row = toxicity.word_numbers(column)
    network = toxicity.Network()
    network.offsets += 0.05
    found = network.scores(numbers, row, len(texts))
    assert np.allclose(found, [plain_score(network, numbers[row == i]) for i in range(len(texts))], atol=1e-5)


def test_long_toxic_documents_are_learned_from(spark):
    """All toxic documents are long; none is dropped for it, and each is read to its end."""
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(200):
        toxic = int(i % 2)
        text = prose(rng, "en", 5000 if toxic else 60).split()
        if toxic:
            text[-3:] = ["scum", "vile", "moron"]
        docs.append((i, " ".join(text), "en", "s"))
        labels.append((i, 1, toxic))
    scored = toxicity.score(make(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    held = [r for r in scored if r.held_out]
    assert np.mean([(r.score >= 0.7) == bool(r.doc_id % 2) for r in held]) > 0.95


def test_the_sample_ends_where_words_are_used_up():
    sizes = [(5, 10), (1, 3), (9, 100), (7, 2)]
    assert toxicity.within_words(sizes, 1) == 1 and toxicity.within_words(sizes, 4) == 5 and toxicity.within_words(sizes, 15) == 7
    assert toxicity.within_words(sizes, 10**6) is None


def test_all_labelled_rows_are_learned_from(spark, labelled, monkeypatch):
    """The driver begins with few rows; words that only others hold are learned all the same, and thresholds count all."""
    docs, df, labels = labelled
    monkeypatch.setattr(toxicity, "SAMPLE", 10)
    monkeypatch.setattr(toxicity, "SLICE_ROWS", 200, raising=False)
    rows = {r.doc_id: r for r in toxicity.score(df, labels).collect()}
    held = [r for r in rows.values() if r.held_out]
    assert np.mean([(r.score >= toxicity.THRESHOLD) == (r.doc_id % 6 == 0) for r in held]) > 0.95
    assert np.mean([r.flagged == (r.doc_id % 6 == 0) for r in held]) > 0.95
    again = toxicity.score(df.repartition(7), labels.repartition(3)).collect()
    assert {r.doc_id: r.score for r in again} == {i: r.score for i, r in rows.items()}


def test_clashing_columns_of_labels(spark, labelled):
    _, df, labels = labelled
    plain = {r.doc_id: r.score for r in toxicity.score(df, labels).collect()}
    more = labels.selectExpr("*", "'x' AS text", "'y' AS lang", "7 AS draw", "'w' AS words", "1L AS id", "2 AS n")
    assert {r.doc_id: r.score for r in toxicity.score(df, more).collect()} == plain
