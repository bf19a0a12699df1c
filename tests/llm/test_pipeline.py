"""The pipeline against a plain-Python version of its stages, and the contract queries over one folder."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from trackset.llm import byte_bpe, common, line_quality, mixing, queries

from . import test_line_quality, test_mixing, test_passages, test_simhash
from .conftest import make, words


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(31)
    passage, line = words(rng, 55, 5000), "this line is on every single page of it"
    out = []
    for i in range(220):
        text = "\n".join(words(rng, rng.randint(10, 40), 4000) for _ in range(rng.randint(1, 5)))
        if i % 11 == 3:
            text = out[-1][1]
        elif i % 11 == 4:
            text = out[-1][1] + " " + words(rng, 1)
        elif i % 3 == 1:
            text += f"\n{line}\n{passage}"
        out.append((i * 3, text, rng.choice(["en", None]), rng.choice(["a", "b", None])))
    return [*out, (1, None, "en", "a"), (2, "", None, None), (4, "x y z " * 40, "en", "b")]


def brute_quality(rows):
    kept = {r[0] for r in test_line_quality.brute(rows) if r[-1]}
    holders, first = test_line_quality.holders(rows)
    out = []
    for i, t, la, s in rows:
        if i in kept:
            lines = []
            for ln in t.split("\n"):
                key = test_line_quality.line_key(s, ln)
                if not key[1] or len(holders[key]) <= line_quality.MOST_DOCUMENTS or first.get(key) == i:
                    lines.append(ln)
            out.append((i, "\n".join(lines), la, s))
    return out


def shingles(text):
    ws = (text or "").encode().lower().split()
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def first_of_components(rows):
    """Ids that stay: of each component over similarity 0.8 of five-word shingles the smallest."""
    sets, root = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] == rows[j][1] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(r[0], low.get(find(i), r[0]))
    return sorted({r[0] for i, r in enumerate(rows) if r[0] is not None and low[find(i)] == r[0]})


def brute_near(rows):
    kept = set(first_of_components(rows))
    return [r for r in rows if r[0] in kept]


def brute_passages(rows):
    n, starts, out = 20, {}, []
    for i, t, *_ in sorted(rows):
        ws = t.encode().split()
        for p in range(len(ws) - n + 1):
            starts.setdefault(tuple(ws[p : p + n]), (i, p))
    for i, t, la, s in rows:
        ws = t.encode().split()
        gone = {p + j for p in range(len(ws) - n + 1) if starts[tuple(ws[p : p + n])] != (i, p) for j in range(n)}
        out.append((i, b" ".join(w for k, w in enumerate(ws) if k not in gone).decode() if gone else t, la, s))
    return out


def brute_mix(rows):
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + test_mixing.size(t)
    out = []
    for s, target in test_mixing.brute_targets(sizes).items():
        own = [r for r in rows if r[3] == s]
        times = int(target // sizes[s]) if sizes[s] else 0
        rest = target - times * sizes[s]
        bucket = lambda r: int(hashlib.md5(str(r[0]).encode()).hexdigest()[:15], 16) >> mixing.HASH_BITS - sum(mixing.LEVELS)
        upto = 0
        for r in sorted(own, key=bucket):
            n = test_mixing.size(r[1])
            more = upto + n <= rest or upto + n - rest < rest - upto and upto <= rest
            upto = upto + n if upto <= rest else upto
            if upto > rest and not more:
                upto = rest + 1
            out += [r] * (times + more)
    return out


def test_stages_and_run(spark, tmp_path, rows):
    make(spark, rows, clash=False).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    docs = common.read_table(spark, str(tmp_path), "documents")
    columns, expected = docs.columns, rows
    for (name, stage), brute in zip(corpus_pipeline.STAGES[:-1], (brute_quality, brute_near, brute_passages, brute_mix)):
        docs, before = common.materialise(stage(spark, docs, str(tmp_path)), "stage"), len(expected)
        expected = brute(expected)
        assert docs.columns == columns, name
        found = docs.collect()
        assert sorted(((r.doc_id, r.text, r.lang, r.source) for r in found), key=str) == sorted(expected, key=str), name
        assert all(r.n_chars == len(r.text) for r in found), name
        assert 0 < len(expected) and (name == "substring dedup" or len(expected) != before)
    ranks = byte_bpe.load_ranks(queries.rank_file())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = sorted((i, library.encode_ordinary(t)) for i, t, *_ in expected)
    done = corpus_pipeline.run(spark, str(tmp_path)).collect()
    packed = lambda b: [int.from_bytes(b[k : k + 4], "little") for k in range(0, len(b), 4)]
    assert sorted((r.doc_id, packed(bytes(r.ids))) for r in done) == tokens


def test_stages_take_odd_rows_and_empty_tables(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            assert stage is corpus_pipeline.encode or out.columns == docs.columns
            out.collect()


def test_contract_columns(spark, tmp_path, corpus, corpus_rows):
    corpus.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    spark.createDataFrame([(i, [float(i), 1.0], i % 3) for i in range(30)], "vec_id long, embedding array<float>, label int").write.parquet(
        str(tmp_path / "embeddings.parquet")
    )
    spark.createDataFrame([(i, "u", "p" * 10 * (i % 20)) for i in range(40)], "page_id long, url string, html string").write.parquet(
        str(tmp_path / "pages.parquet")
    )
    expected = {
        "op1": "doc_id bigint,n_bytes bigint,n_tokens bigint,over_limit boolean",
        "op2": "vec_id bigint,n_links bigint,component_id bigint,kept boolean",
        "op3": "doc_id bigint,held_out boolean,score double,predicted int",
        "op4": "page_id bigint,payload_bytes bigint,payload_digest string,record_type string,refers_to bigint",
        "op5": "doc_id bigint,n_words bigint,n_removed bigint,kept_sha256 string",
        "op6": "doc_id bigint,held_out boolean,lang_pred string,score double",
        "op7": "doc_id bigint,fingerprint string,component_id bigint",
        "op8": "doc_id bigint,n_tokens bigint,ids_sha256 string,decoded_sha256 string",
        "op9": "doc_id bigint,size bigint,source_size bigint,target double,taken bigint",
        "op10": "doc_id bigint,n_words bigint,word_chars bigint,n_symbols bigint,n_dup_lines bigint,n_repeat_words bigint,base_failed boolean,kept boolean",
    }
    assert {n.split("_")[0] for n in queries.QUERIES} == set(expected)
    rows = {"op2": 30, "op4": 40}
    for name, query in queries.QUERIES.items():
        op = name.split("_")[0]
        df = query(spark, str(tmp_path))
        found = [f"{a} {b}" for a, b in df.dtypes]
        assert set(expected[op].split(",")) <= set(found), name
        assert df.count() == rows.get(op, len(corpus_rows)), name


def test_fingerprints_are_hex(spark, tmp_path):
    make(spark, [(1, None, "en", "s"), (2, "One two THREE four", "en", "s")]).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r.fingerprint for r in queries.op7_simhash(spark, str(tmp_path)).collect()}
    assert found == {1: "0" * 16, 2: f"{test_simhash.brute_fingerprint('one two three four'):016x}"}
    assert test_passages.brute([(1, None, "", "")])[0][1] == 0


def test_last_stage_decodes_what_it_encodes(spark, edge_docs):
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    done = corpus_pipeline.encode(spark, edge_docs, "").collect()
    texts = [(r.doc_id, sha(r.text)) for r in edge_docs.select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, r.decoded_sha256) for r in done), key=str) == sorted(texts, key=str)
    plain = byte_bpe.encode(edge_docs, queries.rank_file(), public_tokenizers.PATTERN).collect()
    figures = lambda rows: sorted(((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.char_starts), r.n_split) for r in rows), key=str)
    assert figures(done) == figures(plain)
