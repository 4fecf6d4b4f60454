"""The pipeline's stages against plain versions, and on odd tables."""

import collections
import math

import pytest
import sentencepiece
from llm_data import WORDS, docs, near_duplicates
from test_llm_filter_mix import plain_targets
from test_llm_text import plain_counts

import corpus_pipeline as pipeline
from fleetday.llm import mixing, quality_bayes as qb, quality_rules as qr, sentencepiece_viterbi as S
from fleetday.llm.text import COUNTS

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_ratios(text):
    c = dict(zip(COUNTS, plain_counts(text or "")))
    share = lambda a, b: a / b if b else 0.0
    n = c["n_words"]
    return c, {
        "log_words": math.log1p(n), "word_length": share(c["word_chars"], n), "symbols_per_word": share(c["n_symbols"], n),
        "exclaims_per_word": share(c["n_exclaim"], n), "upper_share": share(c["n_upper"], c["n_upper"] + c["n_lower"]),
        "repeat_share": share(c["n_repeat_words"], n), "same_next_share": share(c["n_same_next"], n),
        "dup_line_share": share(c["n_dup_lines"], c["n_lines"]), "words_per_line": math.log1p(share(n, c["n_lines"])),
    }


def plain_classifier(rows, model):
    """Evidence, sites and verdicts with plain loops; the prior weights by the same formulas over lists."""
    odds = []
    for r in rows:
        f = plain_ratios(r["text"])[1]
        x = model.bias + sum(w * max(-6, min(6, (f[n] - m) / s)) for n, m, s, w in zip(model.names, model.mean, model.scale, model.weight))
        odds.append(max(-20, min(20, x)))
    p = [1 / (1 + math.exp(-x)) for x in odds]
    host, path = collections.defaultdict(list), collections.defaultdict(list)
    for r, q in zip(rows, p):
        host[r["source"]].append(q)
        path[r["source"], r["lang"]].append(q)
    rate = sum(p) / len(p)
    between = lambda groups, whole: sum(sum(g) ** 2 / len(g) for g in groups) - sum(whole) ** 2 / len(whole)
    spare = lambda groups, n: n - sum(len(g) ** 2 for g in groups) / n
    host_weight = qb._weight(rate, between(host.values(), p), len(host) - 1, spare(host.values(), len(p)))
    inner = {h: [g for (a, _), g in path.items() if a == h] for h in host}
    path_weight = qb._weight(
        rate, sum(between(inner[h], host[h]) for h in host), sum(len(g) - 1 for g in inner.values()), sum(spare(inner[h], len(host[h])) for h in host)
    )
    logit = lambda x: math.log(x / (1 - x))
    kept = []
    for r, x, q in zip(rows, odds, p):
        h, s = host[r["source"]], path[r["source"], r["lang"]]
        a = (host_weight * rate + sum(h) - q) / (host_weight + len(h) - 1)
        b = (path_weight * a + sum(s) - q) / (path_weight + len(s) - 1)
        if x + logit(min(1 - 1e-4, max(1e-4, b))) - logit(rate) >= 0:
            kept.append(r)
    return kept


def plain_rules(rows, rules):
    kept = []
    for r in rows:
        c, f = plain_ratios(r["text"])
        hit = any(all((f[x.feature] >= x.threshold) == x.above for x in rule) for rule in rules)
        if c["n_words"] >= 20 and 100 * c["n_repeat_words"] <= 30 * c["n_words"] and not hit:
            kept.append(r)
    return kept


def asdict(frame):
    return [r.asDict() for r in frame.collect()]


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_stages_against_plain_versions(spark):
    current = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = asdict(current)
    names = [n for n, _ in pipeline.STAGES]
    for name, step in pipeline.STAGES:
        before, frame = rows, pipeline.stage(step(spark, current, SF), "test")
        rows = asdict(frame)
        if name == "quality_classifier":
            assert ids(rows) == ids(plain_classifier(before, qb.fit(current, labels)))
        elif name == "quality_rules":
            assert ids(rows) == ids(plain_rules(before, qr.fit(current, labels)))
        elif name == "near_duplicates":
            found = near_duplicates([(r["doc_id"], r["text"]) for r in before], 80)
            assert ids(rows) == sorted(i for i, (_, c) in found.items() if i == c)
        elif name == "mixing":
            sizes = collections.Counter()
            for r in before:
                sizes[r["source"]] += len(WORDS.findall(r["text"]))
            targets = plain_targets(sizes, {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sorted(sizes))})
            taken, most = collections.Counter(), collections.Counter()
            for r in rows:
                taken[r["source"]] += len(WORDS.findall(r["text"]))
            for r in before:
                most[r["source"]] = max(most[r["source"]], len(WORDS.findall(r["text"])))
            assert all(abs(taken[s] - targets[s]) <= most[s] for s in sizes)
            assert max(collections.Counter(ids(rows)).values()) <= 2
        else:
            library = sentencepiece.SentencePieceProcessor(model_file=S.MODEL)
            assert ids(rows) == ids(before)
            texts = {r["doc_id"]: r["text"] for r in before}
            assert all(r["ids"] == library.encode(texts[r["doc_id"]]) and r["n_ids"] == len(r["ids"]) for r in rows)
        if name != names[-1]:
            assert frame.columns == COLUMNS
            kept = {(r["doc_id"], r["text"]) for r in before}
            assert all((r["doc_id"], r["text"]) in kept for r in rows)
        current = frame
    assert names == ["quality_classifier", "quality_rules", "near_duplicates", "mixing", "sentencepiece"]


@pytest.mark.parametrize("name, step", pipeline.STAGES)
def test_odd_and_empty_tables(spark, name, step):
    prose = " ".join(f"word{i % 97} text{i % 31}" for i in range(120))
    odd = [(900_001, prose), (900_001, prose), (900_002, None), (900_003, ""), (None, prose + " more"), (None, None), (900_004, prose + " end", None, None)]
    frame = docs(spark, [*odd, (900_005, "a b " * 100_000)])
    clash = frame.withColumnsRenamed({"n_chars": "size"})
    for table in (frame, clash, frame.limit(0)):
        out = step(spark, table, SF)
        got = asdict(out)
        if name != "sentencepiece":
            assert out.columns == table.columns
        if name == "near_duplicates" and table is frame:
            assert sorted(str(r["doc_id"]) for r in got) == ["900001", "900002", "900003", "900005", "None"]
        assert len(got) <= 2 * 8


def test_run_is_the_stages_in_order(spark):
    assert pipeline.run(spark, SF).columns == ["doc_id", "source", "part", "row", "ids", "n_ids"]


def test_near_duplicates_are_decided_per_row(spark):
    """A text isn't judged by another text of the same id, and rows without an id are rows like others."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    rows = [(1, a), (2, a + " x"), (2, b), (3, b + " y"), (None, c), (None, c + " z"), (None, b), (4, c + " w"), (5, ""), (5, ""), (None, None)]
    table = docs(spark, rows)
    got = sorted(((r.doc_id, r.text) for r in pipeline.near_duplicates(spark, table, SF).collect()), key=str)
    assert got == sorted([(1, a), (2, b), (4, c + " w"), (5, ""), (None, None)], key=str)
    nobody = docs(spark, [(None, c), (None, c + " z"), (None, c)])
    assert len(pipeline.near_duplicates(spark, nobody, SF).collect()) == 1


def test_the_last_stage_can_be_sorted_into_training_order(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = pipeline.stage(pipeline.mix(spark, table, SF), "mix")
    assert len(mixed.inputFiles()) > 1
    order = mixing.positions(mixing.curriculum(table)).orderBy("position", "_key", "copy").select("doc_id").collect()
    rows = pipeline.encode(spark, mixed, SF).select("part", "row", "doc_id").orderBy("part", "row").collect()
    assert [r.doc_id for r in rows] == [r.doc_id for r in order]
