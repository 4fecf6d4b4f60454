import re

import pytest
from llm_data import DOCS, WORDS, docs
from pyspark.sql import functions as F

from fleetday.llm import mixing, url_filter

PAGES = "page_id bigint, url string, html string, host string, rule string"


def judged(spark, urls, rules=None):
    pages = spark.createDataFrame([(i, u, None, "clash", "clash") for i, u in enumerate(urls)], PAGES)
    rows = url_filter.judge(pages, url_filter.default_rules(spark) if rules is None else rules).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}


CASES = [
    (None, ("", "", None, "allow")),
    ("", ("", "", None, "allow")),
    ("no scheme.com/", ("", "", None, "allow")),
    ("http://A.Example.COM/en/x?q=1#f", ("a.example.com", "/en/x", "example.com/en/", "block")),
    ("http://www.example.com/en/", ("www.example.com", "/en/", "www.example.com/en/", "allow")),
    ("http://a.www.example.com/en/", ("a.www.example.com", "/en/", "www.example.com/en/", "allow")),
    ("http://notexample.com/en/", ("notexample.com", "/en/", "com/", "allow")),
    ("http://example.com/en", ("example.com", "/en", "com/", "allow")),
    ("http://example.com", ("example.com", "", None, "allow")),
    ("https://b.net/es/1", ("b.net", "/es/1", "net/es/", "block")),
    ("https://net/fr/", ("net", "/fr/", "net/fr/", "block")),
    ("https://b.net/ES/1", ("b.net", "/ES/1", None, "allow")),
    ("https://b.internet/es/", ("b.internet", "/es/", None, "allow")),
    ("https://spam-farm.example.org/en/1", ("spam-farm.example.org", "/en/1", "host:spam", "block")),
    ("https://spammy.example.org/casino", ("spammy.example.org", "/casino", None, "allow")),
    ("https://cheap-pills.example.com/fr/", ("cheap-pills.example.com", "/fr/", "com/", "allow")),
    ("x://y://com/", ("y:", "//com/", None, "allow")),
    ("http://com/?", ("com", "/", "com/", "allow")),
]


def test_judged_urls(spark):
    got = judged(spark, [u for u, _ in CASES] * 2)
    assert [got[i] for i in range(len(CASES))] == [e for _, e in CASES]
    assert [got[i + len(CASES)] for i in range(len(CASES))] == [e for _, e in CASES]


def test_very_long_url_and_empty_tables(spark):
    url = "http://example.com/en/" + "a/" * 50_000
    assert judged(spark, [url])[0][2] == "example.com/en/"
    assert judged(spark, []) == {}
    assert judged(spark, ["http://com/"], url_filter.default_rules(spark).where("false"))[0] == ("com", "/", None, "allow")


def test_rules_are_filed_under_their_rarest_token(spark):
    pages = spark.createDataFrame([("example.com/a",), ("example.com/b",), ("x.com/en/",)], "_key string")
    rules = {r["rule"]: r["_token"] for r in url_filter.index_rules(url_filter.default_rules(spark), pages).collect()}
    assert rules["example.com/en/"] == "en" and rules["com/"] == "com" and rules["net/es/"] == "es"


def test_no_python_and_no_rdd_on_the_main_path(spark):
    frames = [
        url_filter.judge(spark.createDataFrame([], PAGES), url_filter.default_rules(spark)),
        mixing.in_training_order(mixing.positions(mixing.curriculum(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))),
    ]
    plan = "".join(f._jdf.queryExecution().toString() for f in frames)
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def plain_targets(sizes, weights, share=1.5, most=2.0):
    """The fill-up as a loop."""
    left = share * sum(sizes.values())
    full, open_ = {}, dict(weights)
    while True:
        total = sum(open_.values())
        over = {s for s in open_ if left * open_[s] / total > most * sizes[s]}
        if not over:
            return full | {s: left * w / total for s, w in open_.items()}
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]
            del open_[s]


def mixed(spark, rows):
    return [r.asDict() for r in mixing.curriculum(docs(spark, rows)).drop("_pieces").collect()]


def test_targets_and_taken_words(spark):
    rows = [(i, "w " * (1 + i * 7919 % 50), f"s{i % 7}" if i % 3 else "s0") for i in range(900)] + [(9000, "w " * 40, None)]
    got = mixed(spark, rows)
    sizes = {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    expected = plain_targets(sizes, {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)})
    for s in order:
        mine = [r for r in got if r["source"] == s]
        assert all(abs(r["target"] - expected[s]) < 1e-6 and r["source_size"] == sizes[s] for r in mine)
        assert abs(sum(r["size"] * r["copies"] for r in mine) - expected[s]) <= max(r["size"] for r in mine)
        assert all(r["copies"] <= 2 for r in mine)


def test_places_are_running_sums(spark):
    got = mixed(spark, [(i, "w " * (i % 9), "a") for i in range(300)])
    ahead = 0
    for r in sorted(got, key=lambda r: r["_key"]):
        assert r["_before"] == ahead
        ahead += r["size"]


def test_defined_cases_of_the_mix(spark):
    assert mixed(spark, []) == []
    only_empty = mixed(spark, [(1, None), (2, ""), (None, " \t\n")])
    assert [(r["size"], r["copies"], r["target"]) for r in only_empty] == [(0, 0, 0.0)] * 3
    same = mixed(spark, [(1, "a b")] * 4 + [(None, "c")])
    assert len(same) == 5 and abs(sum(r["size"] * r["copies"] for r in same) - 13.5) <= 1
    long = mixed(spark, [(1, "w " * 300_000, "a"), (2, "w", "b")])
    assert max(r["size"] for r in long) == 300_000 and all(r["copies"] <= 2 for r in long)
    clash = docs(spark, [(1, "a b c")]).withColumns({c: F.lit("x") for c in ("size", "target", "weight", "copies", "position", "_key")})
    (row,) = mixing.positions(mixing.curriculum(clash)).collect()[:1]
    assert row["size"] == 3 and row["weight"] == "x"


@pytest.mark.parametrize("knots", [[(0, 1), (1, 1)], [(0, 0.5), (1, 1.5)], [(0, 1), (0.3, 0), (0.6, 0), (1, 2)]])
def test_training_time_inverts_the_integral(spark, knots):
    column = F.array(*[F.struct(F.lit(float(t)).alias("t"), F.lit(float(w)).alias("w")) for t, w in knots])
    asked = [i / 40 for i in range(41)]
    frame = spark.createDataFrame([(x,) for x in asked], "x double").withColumn("p", mixing.segments(column))
    times = [r["t"] for r in frame.select("x", mixing.training_time(F.col("x"), F.col("p")).alias("t")).orderBy("x").collect()]

    def area(upto):
        total = 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            u = min(max(upto - t0, 0), t1 - t0)
            total += w0 * u + (w1 - w0) * u * u / (2 * (t1 - t0))
        return total

    assert times == sorted(times)
    assert all(abs(area(t) / area(1) - x) < 1e-9 for x, t in zip(asked, times))


def test_mix_is_in_training_order_and_repeatable(spark):
    frame = docs(spark, [(i, "w " * (1 + i % 5), f"s{i % 3}") for i in range(200)])
    runs = [
        [(r["position"], r["doc_id"], r["copy"]) for r in mixing.in_training_order(mixing.positions(mixing.curriculum(f))).collect()]
        for f in (frame, frame.repartition(7))
    ]
    assert runs[0] == runs[1]
    assert [p for p, *_ in runs[0]] == sorted(p for p, *_ in runs[0])
    assert DOCS and WORDS
