import random

import numpy as np
import pytest
from llm_data import DOCS, components, docs, near_duplicates
from pyspark.sql import functions as F

from fleetday.llm import hyperminhash as H, pstable as P
from fleetday.llm.common import components as spark_components


def labels(frame, percent=80):
    return sorted(((r["id"], r["n"], r["component"]) for r in H.near_duplicates(frame, percent=percent).collect()), key=str)


def corpus(seed=1):
    """Groups of edited copies with similarities on both sides of the thresholds, shared passages, short texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=60))
    rows, i = [], 0
    for _ in range(40):
        base = rng.choices(words, k=rng.choice([3, 6, 12, 40, 150, 500]))
        for _ in range(rng.choice([1, 2, 5])):
            edited = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                edited[rng.randrange(len(edited))] = rng.choice(words)
            rows.append((i, " ".join(edited) + (" " + passage if rng.random() < 0.3 else "")))
            i += 1
    return rows + [(i, None), (i + 1, ""), (i + 2, " \n"), (i + 3, passage), (i + 4, passage.upper())]


@pytest.mark.parametrize("percent", [80, 85])
def test_equals_brute_force(spark, percent):
    rows = corpus(percent)
    expected = near_duplicates(rows, percent)
    assert labels(docs(spark, rows), percent) == sorted(((i, n, c) for i, (n, c) in expected.items()), key=str)


def test_a_chain_whose_ends_are_not_similar(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join(f"x{k}" if 40 * m <= j < 40 * m + 3 * (k > m) else w for j, w in enumerate(words) for m in [j // 40])) for k in range(5)]
    rows += [(100 + k, " ".join(words[k * 4 :] + [f"y{i}" for i in range(k * 4)])) for k in range(12)]
    expected = near_duplicates(rows, 85)
    assert labels(docs(spark, rows), 85) == sorted(((i, n, c) for i, (n, c) in expected.items()), key=str)


def test_buckets_larger_than_a_block(spark):
    """Many near copies that are linked only with their neighbours: the blocks have to find every link."""
    base = [f"w{i}" for i in range(90)]
    rng = random.Random(5)
    rows = []
    for i in range(3 * H.BLOCK):
        edited = list(base)
        for _ in range(2):
            edited[rng.randrange(90)] = f"e{i % 40}"
        rows.append((i, " ".join(edited)))
    expected = near_duplicates(rows, 85)
    assert labels(docs(spark, rows), 85) == sorted(((i, n, c) for i, (n, c) in expected.items()), key=str)


def test_defined_cases(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (3, "A b  c d\te f"), (None, "a b c d e f"), (7, None), (8, "x"), (9, "X"), (9, "other words here")]
    frame = docs(spark, rows).withColumns({c: F.lit("x") for c in ("id", "n", "regs", "component", "band")})
    assert labels(frame) == sorted([(5, 2, 3), (5, 2, 3), (3, 2, 3), (None, 2, None), (7, 0, 7), (8, 1, 8), (9, 1, 8), (9, 1, 9)], key=str)
    assert labels(docs(spark, [])) == []
    long = " ".join(f"w{i}" for i in range(120_000))
    assert labels(docs(spark, [(1, long), (2, long + " tail")])) == [(1, 119_996, 1), (2, 119_997, 1)]
    assert DOCS


def test_registers_agree_as_often_as_the_sets_are_similar():
    rng = np.random.default_rng(2)
    for n in (8, 60, 900, 20_000):
        got = []
        for _ in range(30):
            both = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
            extra = rng.integers(0, 1 << 63, (2, max(1, n // 8)), dtype=np.uint64) * np.uint64(2)
            a, b = (np.unique(np.concatenate([both, e])) for e in extra)
            got.append(float(H.estimate(H.registers(a), H.registers(b), len(a), len(b))))
        true = n / (n + 2 * max(1, n // 8))
        assert abs(np.mean(got) - true) < 0.05


def test_chance_collisions_are_corrected():
    rng = np.random.default_rng(3)
    raw, corrected = [], []
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)) for _ in range(2))
        x, y = H.registers(a), H.registers(b)
        raw.append((x == y).mean())
        corrected.append(float(H.estimate(x, y, len(a), len(b))))
    assert 0 < np.mean(raw) < 4 * H.chance_collision(5000, 5000) and abs(np.mean(corrected)) < 5e-4


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1090)]
    edges += [(7, 7), (None, 3), (2000, 2001), (2000, 2001)]
    linked = {}
    for a, b in edges:
        if a is not None and a != b:
            linked.setdefault(a, []).append(b)
            linked.setdefault(b, []).append(a)
    got = {r.node: r.component for r in spark_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == components(linked, linked)
    assert spark_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


VECTORS = "vec_id bigint, embedding array<float>, label int"


def vectors(seed, n=60, near=5, size=16):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        base = rng.normal(size=size)
        out += [base + rng.normal(size=size) * 0.07 * k for k in range(near)]
    return np.array(out, np.float32)


def plain_vectors(rows, threshold=0.95):
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= threshold
    np.fill_diagonal(hit, False)
    part = components(range(len(rows)), [np.flatnonzero(h).tolist() for h in hit])
    return {rows[i][0]: (int(hit[i].sum()), rows[part[i]][0]) for i in range(len(rows))}


def vector_labels(spark, rows):
    return {r["id"]: (r["n_links"], r["component"]) for r in P.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}


def test_vectors_recall_and_no_false_link(spark):
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors(1))]
    expected, got = plain_vectors(rows), vector_labels(spark, rows)
    assert all(got[i][0] <= expected[i][0] for i in got)
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(e[0] for e in expected.values())
    assert sum(got[i][1] == expected[i][1] for i in got) >= 0.97 * len(got)


def test_vectors_in_one_large_bucket(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=16)
    rows = [(i, (base + rng.normal(size=16) * 0.004).astype(np.float32).tolist(), 0) for i in range(3 * P.BLOCK)]
    assert vector_labels(spark, rows) == plain_vectors(rows)


def test_vectors_defined_cases(spark):
    one = [1.0, 2.0, 3.0]
    nan, inf = float("nan"), float("inf")
    rows = [(4, one, 1), (2, one, None), (3, [2.0, 4.0, 6.0], 0), (5, None, 0), (6, [], 0), (7, [0.0, 0.0, 0.0], 0), (8, [nan, 1.0, 1.0], 0)]
    rows += [(9, [inf, 1.0, 1.0], 0), (10, [None, 1.0, 1.0], 0), (11, [-1.0, -2.0, -3.0], 0), (12, [1.0, 2.0, 3.0, 0.0], 0), (13, [-0.0, 0.0, 5.0], 0), (14, [0.0, -0.0, 5.0], 0)]
    got = vector_labels(spark, rows)
    assert {i: got[i] for i in (2, 3, 4)} == {i: (2, 2) for i in (2, 3, 4)}
    assert all(got[i] == (0, i) for i in range(5, 13)) and got[13] == got[14] == (1, 13)
    frame = spark.createDataFrame([(None, one, 0), (1, one, 0), (1, one, 0)], VECTORS).withColumn("node", F.lit("x"))
    rows = sorted([(r["id"], r["n_links"], r["component"]) for r in P.near_duplicates(frame).collect()], key=str)
    assert rows == [(1, 1, 1), (1, 1, 1), (None, 0, None)]
    assert P.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_planned_tables_reach_the_recall():
    for n in (10, 10_000, 10**9):
        h = P.plan(n, 0.95)
        assert 1 - (1 - P.collision((2 - 2 * 0.95) ** 0.5) ** h.projections) ** h.tables >= P.RECALL
        assert n * P.collision(2**0.5) ** h.projections <= 1 or h.projections == 4


def test_built_words_are_not_linked(spark):
    """Two words that sums over powers can't tell apart make texts without a common shingle."""
    a, b = ("".join("ab"[(bin(i).count("1") + s) & 1] for i in range(1024)) for s in (0, 1))
    rows = [(1, " ".join([a] * 7)), (2, " ".join([b] * 7)), (3, a), (4, b), (5, a)]
    got = {r.id: (r.n, r.component) for r in H.near_duplicates(docs(spark, rows), percent=85).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (1, 3), 4: (1, 4), 5: (1, 3)}
    assert H.confirmed(b"A b c d e f", b"a B c d e f", 100, 5) and not H.confirmed(b"", b"", 80, 5)
