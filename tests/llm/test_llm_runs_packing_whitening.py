"""Periodic runs, best-fit packing and whitening against plain versions, with their defined cases."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_data import WORDS, docs
from tokenizers import Tokenizer

from fleetday.llm import best_fit_packing as B, periodic_runs as P, queries, whitening as H

SF = "/root/testdata/sf0.001"


# --- periodic runs


def plain_runs(w):
    """Every period tried at every place."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def plain_collapse(doc_id, text):
    w = WORDS.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n and doc_id is not None:
        g = h // 10
        a = g % n
        p = 1 + math.floor((n - a) / (3 + g % 8))
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (
        len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def caught(ids):
    s, e, q = P.find_runs(np.array(ids, np.int64))
    return list(zip(s.tolist(), (e - s).tolist(), q.tolist()))


words = st.integers(0, 2)
#: Texts of repeated and shifted stretches; plain random words hold few runs.
repetitive = st.lists(st.tuples(st.lists(words, min_size=1, max_size=9), st.integers(1, 12)), max_size=6).map(
    lambda parts: [x for part, times in parts for x in part * times][:260]
)


@settings(max_examples=400, deadline=None)
@given(st.one_of(repetitive, repetitive.map(lambda x: (x * 3)[:300]), st.lists(words, max_size=80)))
def test_runs(ids):
    assert caught(ids) == plain_runs(ids)


@pytest.mark.parametrize(
    "ids",
    [
        [0, 1] * 40 + [0] + [0, 1] * 40,  # two runs that touch hold many longer ones
        ([0] * 30 + [1]) * 5,
        ([0, 0, 1] * 12 + [0, 0]) * 4 + [2],
        [1] + [0, 0, 1, 0, 0, 1, 0] * 2 + [2],
        [0] * 500,
    ],
)
def test_runs_of_runs(ids):
    assert caught(ids) == plain_runs(ids)


def test_dense_and_long_runs_take_no_square_of_time():
    a, b = [0], [0, 1]
    while len(b) < 60_000:
        a, b = b, b + a
    assert len(caught(b)) > 10_000 and caught([0] * 200_000) == [(0, 200_000, 1)]
    assert len(caught(([0] * 5000 + [1]) * 20)) == 21


def test_collapse_cases(spark):
    loop = "a b c d " * 5
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, loop), (5, loop), (None, "x " * 30), (7, "é\xa0ü " * 20 + "z"), (8, "w" * 9000)]
    got = P.collapse(docs(spark, texts).withColumn("start", no_text()).withColumn("collapsed", no_text())).collect()
    assert len(got) == len(texts)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert (by[1][0].n_runs, by[1][0].start, by[1][0].collapsed) == (0, None, "")
    assert by[1][0].collapsed_sha256 == hashlib.sha256(b"").hexdigest() == by[3][0].runs_sha256
    assert [(r.start, r.length, r.period, r.exponent_milli, r.collapsed) for r in by[5]] == [(0, 20, 4, 5000, "a b c d")] * 2
    assert by[None][0].collapsed == "x" and by[7][0].collapsed == "é\xa0ü z" and by[8][0].n_runs == 0
    assert P.collapse(docs(spark, [])).collect() == []


def no_text():
    from pyspark.sql import functions as F

    return F.lit(None).cast("string")


def test_op13_against_plain(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text or "") < 4000}
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for i, t in texts.items():
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == plain_collapse(i, t), i
    assert any(r.n_runs for r in got.values())


# --- best-fit packing


def plain_best_fit(lengths, size):
    room = []
    for n in sorted(lengths, reverse=True):
        best = min((r for r in room if r >= n), default=None)
        if best is None:
            room.append(size - n)
        else:
            room.remove(best)
            room.append(best - n)
    return len(room)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 40).flatmap(lambda size: st.tuples(st.just(size), st.lists(st.integers(1, size), max_size=60))))
def test_plan(case):
    size, lengths = case
    rows, sequences = B.plan(Counter(lengths), size)
    assert sequences == plain_best_fit(lengths, size)
    if lengths:
        seen, ranks = Counter(), []
        for n in lengths:
            ranks.append(seen[n])
            seen[n] += 1
        s, o = B.place(np.array(lengths), np.array(ranks), np.array(rows, np.int64))
        assert_gapless(zip(s.tolist(), o.tolist(), lengths), size, sequences)


def assert_gapless(placed, size, sequences):
    inside = defaultdict(list)
    for s, o, n in placed:
        inside[s].append((o, n))
    assert len(inside) == sequences
    for parts in inside.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= size


def test_plan_does_not_grow_with_counts():
    few = {n: 1 + n % 7 for n in range(1, 2049)}
    rows, sequences = B.plan({n: c * 10**12 for n, c in few.items()})
    assert len(rows) < 3 * 2048 * 64 and sequences * 2048 < 1.001 * sum(n * c for n, c in few.items()) * 10**12


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(B.TOKENIZER)


def plain_ids(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab1!' \n\t\r", "  ", "\xa0", "　", "\x0b", "\x1c", "\x85", "é", "中", "​", "<|endoftext|>", "'s", "😀", "́"]), max_size=30).map("".join))
def test_ids_are_those_of_the_library(library, text):
    assert B.encoder(B.TOKENIZER).encode(text) == plain_ids(library, text)


def test_every_code_point_is_encoded_alike(library):
    assert B.encoder(B.TOKENIZER).quick is not None
    for at in range(0, 0x110000, 1 << 12):
        text = "".join(f"{chr(c)}a{chr(c)} {chr(c)}" for c in range(at, at + (1 << 12)) if not 0xD800 <= c < 0xE000)
        assert B.encoder(B.TOKENIZER).encode(text) == plain_ids(library, text), hex(at)


def test_long_texts_are_encoded_in_parts(library, monkeypatch):
    monkeypatch.setattr(B, "AT_ONCE", 20)
    for text in ("word 12, other.  two\n\n end" * 30, "x" * 500, "a " * 100, " \n" * 80 + "z 1 b " * 20):
        assert B.encoder(B.TOKENIZER).encode(text) == plain_ids(library, text)


def test_cut():
    assert list(B.cut(1, 8)) == [(0, 1)] and list(B.cut(8, 8)) == [(0, 8)]
    assert list(B.cut(9, 8)) == [(0, 1), (1, 8)] and list(B.cut(24, 8)) == [(0, 8), (8, 8), (16, 8)]


def check_packing(rows, texts, library, size):
    want = Counter()
    for doc_id, text in texts:
        ids = plain_ids(library, text or "") + bytes(4)
        for k, (at, n) in enumerate(B.cut(len(ids) // 4, size)):
            want[doc_id, k, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = plain_best_fit([r.length for r in rows], size)
    assert_gapless([(r.sequence_id, r.offset, r.length) for r in rows], size, sequences)


def test_packing_cases(spark, library):
    texts = [(1, None), (2, ""), (None, "a b"), (3, "word " * 100), (4, "same text"), (4, "same text"), *[(i, "x y z") for i in range(10, 40)]]
    given_docs = docs(spark, texts).withColumn("length", no_text()).withColumn("task", no_text()).repartition(3)
    check_packing(B.pack(given_docs, size=16).collect(), texts, library, 16)
    assert B.pack(docs(spark, [])).collect() == []


def test_op12_against_plain(spark, library):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_packing(queries.op12_best_fit_packing(spark, SF).collect(), texts, library, 2048)


# --- whitening


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 9), st.integers(0, 4), st.integers(0, 2**32 - 1))
def test_rank_one_updates(size, kind, seed):
    rng = np.random.default_rng(seed)
    values, vectors, plain = np.zeros(size), np.eye(size), np.zeros((size, size))
    for _ in range(15):
        row = [
            lambda: rng.normal(size=size), lambda: rng.integers(-2, 3, size).astype(float), lambda: rng.normal(size=size) * 10.0 ** rng.integers(-8, 6),
            lambda: np.eye(size)[rng.integers(0, size)] * rng.integers(1, 3), lambda: np.full(size, rng.normal()) + 1e-9 * rng.normal(size=size),
        ][kind]()
        plain += np.outer(row, row)
        values, vectors = H.rank_one(values, vectors, row)
    assert np.abs(vectors * values @ vectors.T - plain).max() <= 1e-12 * np.abs(plain).max()
    assert np.abs(vectors.T @ vectors - np.eye(size)).max() <= 1e-12 and (np.diff(values) >= 0).all()


def test_spectra_join():
    x = (np.random.default_rng(1).normal(size=(900, 6)) * [1, 2, 3, 40, 500, 0] + 100_000).astype(np.int64)
    whole = H.Spectrum.of_none(6)
    for at in range(0, 900, 90):
        part = H.Spectrum.of_none(6)
        part.add_rows(x[at : at + 50])
        part.add_rows(x[at + 50 : at + 90])
        whole.join(part)
    c = x - x.mean(0)
    assert np.allclose(whole.values, np.linalg.eigvalsh(c.T @ c), rtol=1e-10, atol=1e-4) and (whole.total == x.sum(0)).all()


def plain_whitening(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(0)
    c = x - total / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, total)) for row in x]
    return c @ v[:, :k] / np.sqrt(e[:k]), e / e.sum(), deviation


def test_op11_against_plain(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    white, explained, deviation = plain_whitening([r.embedding for r in rows])
    got = {(r.vec_id, r.component): r for r in queries.op11_whitening(spark, SF).collect()}
    assert len(got) == 8 * len(rows)
    for j in range(8):
        ours = np.array([got[r.vec_id, j + 1].whitened for r in rows])
        sign = np.sign(ours @ white[:, j])
        assert np.abs(sign * ours - white[:, j]).max() < 1e-9
        assert abs(got[rows[0].vec_id, j + 1].explained / explained[j] - 1) < 1e-10
    assert all(got[r.vec_id, 1].deviation == d for r, d in zip(rows, deviation))
    assert {r.n for r in got.values()} == {len(rows)} and max(r.identity_error for r in got.values()) < 1e-9


def test_whitening_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0, 3.0]), (2, [2.0, 1.0, 3.0]), (2, [2.0, 1.0, 3.0]), (None, [0.5, 0.25, 3.0]), (4, None), (5, []), (6, [1.0, None, 2.0]),
        (7, [nan, 1.0, 1.0]), (8, [inf, 1.0, 1.0]), (9, [1.0, 1.0]), (10, [1e300, -1e300, 3.0]),
    ]
    made = spark.createDataFrame([(*r, 5) for r in rows], "vec_id bigint, embedding array<double>, n int")
    got = H.whiten(made.where("coalesce(vec_id, 0) <> 10")).collect()
    assert Counter((r.id, r.component) for r in got) == Counter(
        {(i, c): 2 if i == 2 else 1 for i in (1, 2, None) for c in (1, 2, 3)} | {(9, 1): 1, (9, 2): 1}
    )
    # the third component doesn't vary: three rows of three lie in a plane
    assert all((r.whitened is None) == (r.component == 3 or r.id == 9) for r in got)
    assert all(r.identity_error < 1e-9 and r.n == (1 if r.id == 9 else 4) for r in got)
    assert [r.explained for r in got if r.id == 9] == [0.0, 0.0]
    assert len(H.whiten(made).collect()) == 17 and H.whiten(made.where("false")).collect() == []


def test_whitening_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(H, "FAN_IN", 3)
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(600, 5)) @ rng.normal(size=(5, 5))).tolist()
    made = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>").repartition(20)
    white, explained, _ = plain_whitening(vectors)
    got = H.whiten(made, components=2).orderBy("id", "component").collect()
    ours = np.array([r.whitened for r in got]).reshape(600, 2)
    assert np.abs(np.abs(ours) - np.abs(white[:, :2])).max() < 1e-8 and abs(got[0].explained - explained[0]) < 1e-10


def test_exact_deviations():
    x = np.array([[100_000, 3], [7, 1 << 40]])
    for n, total in ((5, x.sum(0)), (1 << 20, x.sum(0)), (1 << 40, x.sum(0))):
        want = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, total)) for r in x]
        assert H.deviations(x, n, total) == [w if w < 1 << 63 else None for w in want]
