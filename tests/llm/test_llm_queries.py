"""The registered queries against SQL, or against plain versions where SQL can't express them."""

import zlib

import pytest
import sentencepiece
from compare import differences, duck
from llm_data import near_duplicates
from test_llm_near_duplicates import plain_vectors
from test_llm_text import plain_counts

import __spark_entry__ as entry_point
from fleetday.llm import oracle, queries, sentencepiece_viterbi as S, token_counts as C

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_all_are_registered():
    names = entry_point.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert "pipeline" in names and set(oracle.SQL) <= set(names)
    assert oracle.SQL.items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(oracle.SQL))
@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_sql(spark, name, sf):
    assert differences(queries.QUERIES[name](spark, sf), duck(sf), oracle.SQL[name]) == []


def test_op1(spark, documents):
    encoding, _ = C._vocabulary(C.RANKS, C.PATTERN)
    got = {}
    for r in queries.op1_token_counts(spark, SF).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got.keys() == documents.keys()
    for i, t in documents.items():
        assert sum(r.n_tokens for r in got[i]) == len(encoding.encode_ordinary(t or ""))
        assert sum(r.section >= 0 for r in got[i]) == (t.count("\n") + 1 if t else 0)


def test_op2(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=S.MODEL)
    for r in queries.op2_sentencepiece(spark, SF).collect():
        assert r.ids == library.encode(documents[r.doc_id]) and r.n_ids == len(r.ids) and r.restored


def test_op4(spark, documents):
    rows = queries.op4_toxicity_crf(spark, "/root/testdata/sf0.1").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert len(rows) == 10_000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    seen = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    right = sum(a and b for a, b in seen)
    assert right >= 0.85 * sum(a for a, _ in seen) and right >= 0.95 * sum(b for _, b in seen)


def test_op5(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {r.vec_id: r for r in queries.op5_pstable(spark, sf).collect()}
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == plain_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_op6(spark, documents):
    for r in queries.op6_quality_rules(spark, SF).collect():
        n, chars, symbols, lines, repeats, *_ = plain_counts(documents[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert r.kept == (not r.base_failed and r.rule_no is None)


def test_op10(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op10_hyperminhash(spark, sf).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in near_duplicates(rows, 85).items()}
