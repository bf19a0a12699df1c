import re
from collections import Counter, defaultdict

import pytest

from trackset.llm import line_quality as lq

from .conftest import make

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(text):
    """Whether the base rules reject a text, and how many of its words are in repeated windows."""
    ws = WORD.findall(text)
    windows = Counter(tuple(ws[k : k + 3]) for k in range(len(ws) - 2))
    repeat = {k + j for k in range(len(ws) - 2) if windows[tuple(ws[k : k + 3])] > 1 for j in range(3)}
    return len(ws) < 50 or 100 * len(repeat) > 50 * len(ws), len(repeat)


def line_key(source, line):
    return source or "", re.sub("[A-Z]", lambda m: m[0].lower(), " ".join(WORD.findall(line)))


def holders(rows):
    """Of each line the documents that have it, and the first that passes the base rules."""
    lines, first = defaultdict(set), {}
    for n, (i, t, _, s) in enumerate(rows):
        for line in (t or "").split("\n"):
            if WORD.findall(line):
                key = line_key(s, line)
                lines[key].add(i if i is not None else ("row", n))
                if i is not None and not fails(t)[0]:
                    first[key] = min(i, first.get(key, i))
    return lines, first


def brute(rows):
    lines, first = holders(rows)
    out = []
    for i, t, _, s in rows:
        t = t or ""
        ws = WORD.findall(t)
        seen, dup, lost = set(), 0, 0
        for line in t.split("\n"):
            if own := WORD.findall(line):
                dup += line in seen
                seen.add(line)
                key = line_key(s, line)
                if len(lines[key]) > lq.MOST_DOCUMENTS and (i is None or first.get(key) != i):
                    lost += len(own)
        failed, n_repeat = fails(t)
        symbols = sum(c in "#*$%&|<>" for c in t)
        kept = not failed and 100 * (len(ws) - lost) >= 30 * len(ws)
        out.append((i, len(ws), sum(map(len, ws)), symbols, dup, n_repeat, lost, failed, kept))
    return sorted(out, key=str)


def got(docs):
    rows = lq.judge(docs, ["doc_id"]).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost", "base_failed", "kept")
    return sorted(((r.row.doc_id, *(r[n] for n in names)) for r in rows), key=str)


def test_matches_brute_force(edge_docs, edge_rows, corpus, corpus_rows, no_docs, monkeypatch):
    for most in (20, 3):
        monkeypatch.setattr(lq, "MOST_DOCUMENTS", most)
        assert got(corpus) == brute(corpus_rows)
        assert got(edge_docs) == brute(edge_rows)
    assert got(no_docs) == []


@pytest.fixture
def boilerplate(spark):
    body = lambda i: " ".join(f"own{i}x{k}" for k in range(60))
    rows = [(i, f"{body(i)}\nCommon  line here", "en", "h") for i in range(40)]
    copies = "\n".join(f"{' '.join(f'c{k}x{j}' for j in range(20))}" for k in range(4))
    rows += [(100 + i, copies, "en", "h") for i in range(30)] + [(200 + i, copies, "en", "other") for i in range(5)]
    return rows, make(spark, rows)


def test_depleted_documents_go_and_the_first_stays(boilerplate):
    rows, docs = boilerplate
    assert got(docs) == brute(rows)
    kept = {r.row.doc_id for r in lq.judge(docs, ["doc_id"]).where("kept").collect()}
    assert kept == {*range(40), 100, *range(200, 205)}


def test_lines_are_removed(boilerplate):
    rows, docs = boilerplate
    judged = lq.judge(docs, ["doc_id", "text"]).selectExpr("row", "row.text AS text", "lost")
    found = {r.row.doc_id: r.text for r in lq.without_lines(judged).collect()}
    assert found[0].endswith("Common  line here") and found[1] == rows[1][1].split("\n")[0]
    assert found[100] == rows[40][1] and found[101] == "" and found[200] == rows[40][1]


def test_the_first_holder_passes_the_base_rules(spark):
    """The smallest id holds the lines but is rejected; the next one that passes keeps them."""
    lines = "\n".join(" ".join(f"c{k}x{j}" for j in range(20)) for k in range(4))
    rows = [(0, lines.split("\n")[0], "en", "h"), (1, "again and again " * 90 + lines, "en", "h")] + [(10 + i, lines, "en", "h") for i in range(25)]
    docs = make(spark, rows)
    assert got(docs) == brute(rows)
    assert [r.row.doc_id for r in lq.judge(docs, ["doc_id"]).where("kept").collect()] == [10]


def test_the_limit_is_a_number_of_documents(spark):
    """A line in 21 documents of a host goes however large the host is; one in 20 stays."""
    body = lambda i: " ".join(f"own{i}x{k}" for k in range(55))
    rows = [(i, body(i) + ("\nin twenty one" if i < 21 else "") + ("\nin twenty" if i < 20 else ""), "en", "h") for i in range(2200)]
    found = {r.row.doc_id: r.n_lost for r in lq.judge(make(spark, rows, clash=False), ["doc_id"]).where("n_lost > 0").collect()}
    assert found == dict.fromkeys(range(1, 21), 3)
