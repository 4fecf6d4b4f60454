import numpy as np
import pytest
from llm_data import LABELS, docs
from pyspark.sql import functions as F

from fleetday.llm import quality_bayes as qb, quality_rules as qr

SF = "/root/testdata/sf0.01"


def test_decision_list_on_a_known_concept():
    rng = np.random.default_rng(3)
    table = {"a": rng.random(4000), "b": rng.random(4000), "c": rng.random(4000)}
    bad = (table["a"] > 0.8) & (table["b"] < 0.5) | (table["c"] > 0.95)
    rules = qr.learn(table, bad, rng.random(4000) < 0.3, precision=0.95)
    hit = np.zeros(4000, bool)
    for r in rules:
        hit |= qr._covered(r, table, 4000)
    assert rules and (hit == bad).mean() > 0.99 and all(len(r) <= 5 for r in rules)
    assert qr.learn(table, np.zeros(4000, bool), rng.random(4000) < 0.3) == []


def test_emitted_expression_equals_the_rules(spark):
    rules = [(qr.Condition("a", True, 2.0), qr.Condition("b", False, 5.0)), (qr.Condition("b", True, 9.0),)]
    frame = spark.createDataFrame([(float(a), float(b)) for a in range(4) for b in range(12)], "a double, b double")
    rows = frame.withColumn("no", qr.decision(rules)).collect()
    assert all(r.no == (1 if r.a >= 2 and r.b < 5 else 2 if r.b >= 9 else None) for r in rows)
    assert frame.withColumn("no", qr.decision([])).where("no is not null").count() == 0


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held_out(frame, labels):
    """Judged labelled rows that learning did not see."""
    rows = frame.join(labels, "doc_id").select("doc_id", "quality", "kept").collect()
    return [(r.quality == 1, r.kept) for r in rows if r.doc_id % 3 == 1]


def test_rules_on_unseen_labels(spark, tables):
    documents, labels = tables
    judged = qr.judge(documents, qr.fit(documents, labels.where("doc_id % 3 <> 1")))
    seen = held_out(judged.where("not base_failed"), labels)
    assert sum(k for good, k in seen if good) >= 0.98 * sum(good for good, _ in seen)
    all_bad = held_out(judged, labels)
    assert sum(not k for good, k in all_bad if not good) >= 0.8 * sum(not good for good, _ in all_bad)


def test_classifier_on_unseen_labels(spark, tables):
    documents, labels = tables
    scored = qb.evidence(documents, qb.fit(documents, labels.where("doc_id % 3 <> 1")))
    host, path = F.col("source"), F.col("lang")
    table = qb.sites(scored, host, path)
    seen = held_out(qb.judge(scored, table, qb.priors(table), host, path), labels)
    assert sum(k for good, k in seen if good) >= 0.98 * sum(good for good, _ in seen)
    assert sum(not k for good, k in seen if not good) >= 0.9 * sum(not good for good, _ in seen)


def test_sites_shrink_toward_their_host_and_the_whole(spark):
    rows = [("h", "p", 0.9)] * 400 + [("h", "q", 0.2)] * 2 + [("k", "p", 0.3)] * 300 + [(None, None, 0.6)]
    scored = spark.createDataFrame(rows, "source string, lang string, _p double").withColumn("_odds", F.lit(0.0))
    host, path = F.col("source"), F.col("lang")
    table = qb.sites(scored, host, path)
    prior = qb.priors(table)
    p = np.array([r[2] for r in rows])
    assert abs(prior.rate - p.mean()) < 1e-9
    got = {(r.source, r.lang): r for r in qb.judge(scored, table, prior, host, path).collect()}
    big, small, lone = got["h", "p"], got["h", "q"], got[None, None]
    host_sum = 0.9 * 400 + 0.2 * 2
    assert abs(big.host_rate - (prior.host * prior.rate + host_sum - 0.9) / (prior.host + 401)) < 1e-9
    assert abs(small.site_rate - (prior.path * small.host_rate + 0.2) / (prior.path + 1)) < 1e-9
    assert abs(big.site_rate - 0.9) < 0.02 and small.site_rate > 0.25
    assert abs(lone.host_rate - prior.rate) < 1e-9 and abs(lone.site_rate - prior.rate) < 1e-9


def test_the_sample_is_bounded_when_ids_are_repeated(spark):
    """Repeated rows of a document or of a label are one row of the sample."""
    frame = docs(spark, [(1, f"text {i}") for i in range(200)] + [(i, f"other {i}") for i in range(2, 12)])
    labels = spark.createDataFrame([(1, 0, 0)] * 50 + [(1, 1, 0)] + [(i, 1, 0) for i in range(2, 12)], LABELS)
    rows = qr.labelled(frame, labels, "quality", "doc_id", "text", 30).collect()
    assert sorted((r._id, r._label) for r in rows) == [(1, 0), (1, 1), *[(i, 1) for i in range(2, 12)]]
    assert {r._text for r in rows if r._id > 1} == {f"other {i}" for i in range(2, 12)}
    assert qr.labelled(frame, labels, "quality", "doc_id", "text", 5).count() == 5


def test_defined_cases(spark):
    frame = docs(spark, [(1, None, None, None), (2, ""), (3, "!!! " * 50), (None, "a b"), (3, "!!! " * 50), (4, "word " * 300_000)])
    frame = frame.withColumns({"kept": F.lit("x"), "rule_no": F.lit("x")})
    labels = spark.createDataFrame([(3, 0, 0), (3, None, 1), (None, 1, 0)], LABELS)
    rules, model = qr.fit(frame, labels), qb.fit(frame, labels)
    assert rules == [] and model is None
    rows = qr.judge(frame, rules).collect()
    assert len(rows) == 6 and not any(r.kept for r in rows) and all(r.base_failed for r in rows)
    scored = qb.evidence(frame, model)
    table = qb.sites(scored, F.col("source"), F.col("lang"))
    rows = qb.judge(scored, table, qb.priors(table), F.col("source"), F.col("lang")).collect()
    assert len(rows) == 6 and all(r.kept and abs(r.p_good - 0.5) < 1e-9 for r in rows)
    none = frame.limit(0)
    assert qr.judge(none, qr.fit(none, labels)).count() == 0
    scored = qb.evidence(none, None)
    table = qb.sites(scored, F.col("source"), F.col("lang"))
    assert qb.judge(scored, table, qb.priors(table), F.col("source"), F.col("lang")).count() == 0
