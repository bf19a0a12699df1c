import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside; none of them may be taken for their own.
CLASHING = "cls binary, key long, row string, fp long, size long, h long, id long, host string, lost string, phrases string, copies long, target string"


def make(spark, rows, clash=True):
    """Documents from (doc_id, text, lang, source), with further columns of clashing names."""
    schema = DOCUMENTS + (", " + CLASHING if clash else "")
    more = (b"x", 7, "r", 7, 7, 7, 7, "h", "l", "p", 7, "t") if clash else ()
    full = [(i, t, la, so, len(t) if t is not None else None, *more) for i, t, la, so in rows]
    return spark.createDataFrame(full, schema)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.random() ** 2 * vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls everywhere, empty and very long texts, ties and repeated rows."""
    rng = random.Random(3)
    long = words(rng, 40_000) + "\n" + "é" * 5000 + " end"
    shared = words(rng, 60)
    return [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\n\r\x0b\x0c ", None, None),
        (None, "one null id here", "en", "a"),
        (None, None, None, None),
        (4, long, "en", "b"),
        (5, long, "en", "b"),
        (6, shared, "en", None),
        (6, shared, "en", None),
        (7, "intro " + shared + " outro", None, "a"),
        (8, "a b c d\x1ce 日本語 текст 😀😀 é", "fr", "b"),
        (9, "<|endoftext|> is text # here $ & |", "en", "b"),
        (10, "Short One", "de", "b"),
        (11, "short one", "de", "b"),
        (12, "x " * 50, "de", "b"),
        (-5, "negative id", "de", "b"),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return make(spark, edge_rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return make(spark, [])


@pytest.fixture(scope="session")
def corpus_rows():
    """Documents with copies, near copies, shared passages and boilerplate lines."""
    rng = random.Random(17)
    passage, line = words(rng, 45), "all rights are reserved by nobody at all"
    rows = []
    for i in range(160):
        text = words(rng, rng.randint(5, 160), 3000)
        if i % 5 == 1:
            text = rows[-1][1]
        elif i % 5 == 2 and len(rows[-1][1].split()) > 20:
            parts = rows[-1][1].split()
            parts[len(parts) // 2] = "changed"
            text = " ".join(parts)
        elif i % 5 == 3:
            text = f"{text} {passage}\n{line}\n{words(rng, 12)}"
        rows.append((i, text, "en" if i % 3 else None, f"s{i % 2}"))
    return rows


@pytest.fixture(scope="session")
def corpus(spark, corpus_rows):
    return make(spark, corpus_rows).repartition(5)
