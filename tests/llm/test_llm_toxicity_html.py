import collections
import html as entities
import re
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st
from llm_data import LABELS, docs
from pyspark.sql import functions as F

from fleetday.llm import html_consensus as C, queries, toxicity_crf as T


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 80), st.integers(0, 10_000))
def test_marginals_equal_the_plain_recursion(n, seed):
    rng = np.random.default_rng(seed)
    score, first = rng.normal(size=n) * 3, rng.random(n) < 0.2
    first[0] = True
    start, move = np.broadcast_to(rng.normal(size=2), (2, 2)), rng.normal(size=(2, 2)) * 2
    e = np.column_stack([np.ones(n), np.exp(score)])
    a, b = np.zeros((n, 2)), np.ones((n, 2))
    for t in range(n):
        a[t] = (np.exp(start[0]) if first[t] else a[t - 1] @ np.exp(move)) * e[t]
        a[t] /= a[t].sum()
    for t in range(n - 2, -1, -1):
        b[t] = np.ones(2) if first[t + 1] else np.exp(move) @ (e[t + 1] * b[t + 1])
        b[t] /= b[t].sum()
    p = a * b
    assert np.allclose(T.marginals(score, first, start, move), p[:, 1] / p.sum(1))


def make(n, seed=1):
    """Clean words, and in every fourth text a few of two toxic stems with free endings."""
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}{c}" for a in "kmnprst" for b in "aeiou" for c in ("ra", "no", "ti", "lek", "sum")]
    out = []
    for i in range(n):
        w = list(rng.choice(words, 60))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.integers(2, 6)):
                w.insert(rng.integers(len(w)), rng.choice(["vilest", "grubbo"]) + rng.choice(["", "ing", "ax", "ool"]) + rng.choice(["", "!"]))
        out.append((i, " ".join(w), toxic))
    return out


def test_scores_and_offsets_on_unseen_texts(spark):
    rows = make(1200)
    frame = docs(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, 1, int(x)) for i, _, x in rows], LABELS)
    model, rate = T.fit(frame, labels)
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    assert abs(rate - 0.25) < 0.05
    got = {r.doc_id: r for r in T.score(frame, model, rate).withColumn("held", T.held_out(F.col("doc_id"))).collect()}
    assert {i for i, r in got.items() if r.held} == held
    for i, t, toxic in rows:
        if i in held:
            assert (got[i].score >= 0.7) == toxic
            tagged = " ".join(t[s.start : s.stop] for s in got[i].spans)
            assert re.findall("vilest|grubbo", tagged) == re.findall("vilest|grubbo", t)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_the_toxicity_sample_is_bounded_when_ids_are_repeated(spark, monkeypatch):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    frame = docs(spark, [(ids[0], f"text {i}") for i in range(200)] + [(i, f"other {i}") for i in ids[1:]])
    labels = spark.createDataFrame([(ids[0], 1, 1)] * 50 + [(i, 1, i % 2) for i in ids[1:]], LABELS)
    monkeypatch.setattr(T, "learn", lambda toxic, clean, rate: (toxic, clean))
    (toxic, clean), _ = T.fit(frame, labels)
    assert len(toxic) + len(clean) == len(ids) and sum(t.startswith("text") for t in toxic) == 1
    (toxic, clean), _ = T.fit(frame, labels, most_toxic=4, most_clean=5)
    assert (len(toxic), len(clean)) == (4, 5)


def test_every_piece_of_the_sample_is_learned_from():
    """Strings that are met in few of more than 6,000 pieces get a weight as well."""
    rng = np.random.default_rng(3)
    rare = [f"{a}{b}{c}zu" for a in "bdfg" for b in "aeiou" for c in ("xa", "xo", "xi")]
    filler = [f"w{i}" for i in range(40)]
    toxic = [f"vilest{i} {filler[i % 40]} vilest {rng.choice(filler)}" for i in range(9_000)]
    for i, r in enumerate(rare):
        for j in range(3):
            toxic[i * 90 + j] += f" {filler[j]} {r}"
    clean = [" ".join(rng.choice(filler, 6)) for _ in range(3_000)]
    model = T.learn(toxic, clean, 0.5, rounds=3)
    assert {"=" + r for r in rare} <= set(model.weights)


def test_distinct_contexts_do_not_depend_on_when_pairs_are_put_together(monkeypatch):
    texts = [t for _, t, _ in make(200)]
    ids = {}
    want = T._distinct_contexts(texts, ids, True)
    monkeypatch.setattr(T, "_PAIRS", 100)
    assert (T._distinct_contexts(texts, ids, False) == want).all() and want.sum() > 1000


def test_gradient_equals_that_of_the_plain_chain():
    """Expectations of pieces side by side are those of forward and backward over one piece at a time."""
    rng = np.random.default_rng(5)
    part = rng.integers(0, 9, (64, 7)).astype(np.int32)
    part[40:, 3] = -1
    factor, start, move = np.exp(rng.normal(size=9)), rng.normal(size=2), rng.normal(size=(2, 2))
    by_kind, first, pairs = T._expected(part, np.zeros(part.shape, bool), factor, np.exp(start), np.exp(move))
    want, want_first, steps = np.zeros(9), 0.0, np.zeros(4)
    for column in part.T:
        kinds = column[column >= 0]
        begins = np.arange(len(kinds)) == 0
        score = np.log(factor[kinds])
        p = T.marginals(score, begins, np.broadcast_to(start, (2, 2)), move)
        want -= np.bincount(kinds, p, 9)
        want_first -= p[0]
        f, b, m = T.forward_backward(score, begins, np.broadcast_to(start, (2, 2)), move)
        pair = f[:-1, :, None] * m[1:] * b[1:, None, :]
        steps -= (pair / pair.sum((1, 2), keepdims=True)).sum(0).reshape(-1)
    steps[0] += (part[1:] >= 0).sum()
    assert np.allclose(by_kind, want) and np.isclose(first, want_first) and np.allclose(pairs, steps)


def test_toxicity_defined_cases(spark):
    rows = make(400)
    frame = docs(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, None, int(x)) for i, _, x in rows] + [(None, 1, 1), (3, 1, None)], LABELS)
    model, rate = T.fit(frame, labels)
    odd = docs(spark, [(1, None), (2, ""), (None, "vilest grubbo é vilestax"), (2, ""), (5, "kara noti " * 150_000 + "é vilest"), (6, "😀 vilesting")])
    odd = odd.withColumns({"score": F.lit("x"), "spans": F.lit("x"), "_s": F.lit("x")})
    got = T.score(odd, model, rate).orderBy("doc_id").collect()
    assert len(got) == 6
    empty = [r.score for r in got if not r.text]
    assert len(set(empty)) == 1 and empty[0] < 0.5
    (tail,) = [r for r in got if r.doc_id == 6]
    assert [tail.text[s.start : s.stop] for s in tail.spans] == ["vilesting"]
    (long,) = [r for r in got if r.doc_id == 5]
    assert [long.text[s.start : s.stop] for s in long.spans] == ["vilest"]
    assert T.score(odd.where("false"), model, rate).count() == 0
    nothing, rate = T.fit(frame, labels.where("toxic = 0"))
    assert nothing is None and [r.score for r in T.score(odd, nothing, rate).collect()] == [0.0] * 6
    assert T.fit(frame.where("false"), labels)[0] is None


def test_long_texts_are_learned_from(spark):
    """Only long texts are toxic; each gives a piece, none is left out."""
    rows = make(400)
    toxic, clean = ([t for _, t, x in rows if x == y] for y in (1, 0))
    long = [(i, " ".join(toxic[(i + k) % len(toxic)] for k in range(60))) for i in range(60)]
    short = [(1000 + i, t) for i, t in enumerate(clean)]
    assert min(len(t) for _, t in long) > 2_000
    labels = spark.createDataFrame([(i, 1, 1) for i, _ in long] + [(i, 1, 0) for i, _ in short], LABELS)
    model, _ = T.fit(docs(spark, long + short), labels, most_chars=2_000)
    assert model is not None
    got = {r.doc_id: r.score for r in T.score(docs(spark, [(1, toxic[0]), (2, clean[0]), (3, long[0][1])]), model, 0.5).collect()}
    assert got[1] > 0.7 and got[3] > 0.7 and got[2] < 0.5


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">Cookies!</div>
<div id="wrap"><article class="post post-%d"><header><h2>Head &amp; line</h2></header><p>First   para<br>goes <a href="x>y">on</a>.
<p>Second &lt;b&gt; &eacute;&#33;<ul><li>one<li>two</ul><aside>Side</aside><div class="ad">Buy</div><script>var a="</article>";</script>
<form><input name=q><button>Go</button></form><p hidden>no</p></article><div class="c%d">%s</div></div>
<section id="comments"><p>Nice</p></section><footer>&copy; f</footer></body>"""
MAIN = "Head & line\nFirst para goes on.\nSecond <b> é!\none\ntwo"
PAGES = "page_id bigint, url string, html string, text string, n_chars string"


def extracted(spark, rows):
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)
    return {r.page_id: r.text for r in C.extract(frame).collect()}


def test_consensus_beats_a_single_page(spark):
    """A page whose text is all in one inner element keeps the links beside it, as its host's container holds them."""
    page = "<body><ul class='top'><li><a href=/x>Menu</a></ul><div class='story'><div class='part'><p>%s</p></div>%s<ul><li><a href=/s>Source</a></ul></div></body>"
    whole, short = ("word " * 30).strip(), ("few " * 5).strip()
    rows = [(i, "http://a.example/x", page % (whole, f"<p>More {i}</p>")) for i in range(12)]
    rows += [(90, "http://A.example/y", page % (short, "")), (91, "http://b.example/", page % (short, ""))]
    got = extracted(spark, rows)
    assert {got[i] for i in range(12)} == {f"{whole}\nMore {i}\nSource" for i in range(12)}
    assert got[90] == short + "\nSource" and got[91] == short


def test_unmarked_text_is_never_cut(spark):
    """An epilogue after the container of one page, or of a few, is part of the page."""
    odd = ("Odd text of a partner. " * 9).strip()
    pages = [(i, "http://a.example/x", PAGE % (i, i, "")) for i in range(40)] + [(90, "http://a.example/y", PAGE % (9, 9, odd))]
    got = extracted(spark, [*pages, (91, "http://b.example/", pages[-1][2])])
    assert {got[i] for i in range(40)} == {MAIN} and got[90] == got[91] == f"{MAIN}\n{odd}"


def test_marks_weigh_what_they_hold():
    """A word in a class doesn't take an article away, nor does a form around the whole page."""
    words = ("word " * 50).strip()
    text = lambda source: C.main_text(C.parse(source), [])
    body = "<nav>menu</nav><div class='content'><h1>T</h1><p>%s</p><input name=q><select><option>a</select></div><div class='site-footer'>f</div>" % words
    assert text(f"<body><form id='aspnetForm' action='x'>{body}</form></body>") == f"T\n{words}"
    assert text(f"<body>{body}<form><p>Your mail</p><input></form><div class='newsletter'>Sign up</div></body>") == f"T\n{words}"
    for kind in ("product-search-tips", "share-prices", "form-of-government", "social-history", "foot-health", "comments-open", "has-sidebar"):
        assert text(f"<body><article><h1>T</h1><section class='{kind}'><p>{words}</p></section></article></body>") == f"T\n{words}"
        assert text(f"<body><div class='{kind}'><h1>T</h1><p>{words}</p></div><div class='cookie-notice'>C</div></body>") == f"T\n{words}"
    for kind in ("cookie-notice", "related-posts", "adBox", "site-footer", "sidebar right", "page-header", "breadcrumbs"):
        assert text(f"<body><h1>T</h1><p>{words}</p><div class='{kind}'>other text</div></body>") == f"T\n{words}"
    # readers may write more than the article has
    comments = "<section id='comments'>" + "<article class='comment'><p>Nice one, thanks.</p></article>" * 90 + "</section>"
    assert text(f"<body><article><h1>T</h1><p>{words}</p></article>{comments}</body>") == f"T\n{words}"
    # most of the text and nothing else to go by; a hard mark stays
    assert text(f"<body><div class='widget'><p>{words}</p></div><p>x</p></body>") == f"{words}\nx"
    assert text(f"<body><nav><h1>Menu</h1>{words}</nav><p>x</p></body>") == "x"


def test_only_void_elements_close_themselves():
    text = lambda source: C.main_text(C.parse(source), [])
    page = C.parse("<div><a href=/x/y/>link</a> text <a name='q'/>more<br/>end</div>")
    assert [b[1:] for b in page.blocks] == [("link text more end", len("link"))]
    assert text("<div class='ad'/>advert</div><p>the text of the page</p>") == "the text of the page"
    assert C.parse("<p><a href='a'>one <a href='b'>two</a> three</p>").blocks == [(1, "one two three", len("one two"))]


def plain_consensus(pages):
    """Votes counted per host in dictionaries."""
    paths, sizes = collections.defaultdict(collections.Counter), collections.Counter()
    whole = collections.defaultdict(collections.Counter)
    for host, source in pages:
        sizes[host] += 1
        for path, (_, full) in (C.votes_of(C.parse(source)) if source else {}).items():
            paths[host][path] += 1
            whole[host][path] += full
    return {
        host: sorted((p for p, n in found.items() if whole[host][p] >= C.SHARE * n and n >= C.SUPPORT * sizes[host]),
                     key=lambda p: (-p.count(">"), -paths[host][p], p))
        for host, found in paths.items()
    }


def test_votes_against_plain_counts(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    rows += [(1, "http://a.example/x", PAGE % (1, 1, "")), (2, None, "<p>x"), (3, "http://a.example/z", None)]
    host = lambda url: re.split("[/?#]", url.split("://", 1)[1])[0].lower() if url and "://" in url else ""
    want = plain_consensus([(host(u), h) for _, u, h in rows])
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.host: r.paths for r in C.consensus_paths(frame).collect()}
    assert got == {k: v for k, v in want.items() if v}
    texts = {r.page_id: r.text for r in C.extract(frame).collect()}
    assert texts == {i: C.main_text(C.parse(h), want.get(host(u), [])) if h else "" for i, u, h in rows}


def test_templates_of_one_host(spark):
    other = "<body><div class='story-7'><div class='text'><h1>T</h1><p>%s</div></div><div class='foot'>x</div>"
    rows = [(i, "http://a.example/x", PAGE % (i, i, "")) for i in range(5)] + [(20 + i, "http://a.example/x", other % ("word " * 20)) for i in range(5)]
    got = extracted(spark, rows)
    assert {got[i] for i in range(5)} == {MAIN} and {got[20 + i] for i in range(5)} == {"T\n" + ("word " * 20).strip()}


def test_templates_that_share_a_path(spark):
    """A teaser under the path that holds all text of the host's other pages isn't the article."""
    page = "<body><div class='content'><p>%s</p></div>%s</body>"
    story = "<div class='story'><h1>Head</h1><p>%s</p></div>" % ("story " * 60).strip()
    rows = [(i, "http://a.example/x", page % (("word " * 60).strip(), "")) for i in range(196)]
    rows += [(900 + i, "http://a.example/y", page % (("teaser " * 6).strip(), story)) for i in range(4)]
    got = extracted(spark, rows)
    assert {got[i] for i in range(196)} == {("word " * 60).strip()}
    assert {got[900 + i] for i in range(4)} == {"\n".join([("teaser " * 6).strip(), "Head", ("story " * 60).strip()])}


def test_text_beside_the_container_on_all_pages_of_a_host(spark):
    page = "<body><nav>menu</nav><article><h1>Head</h1><p>%s</p></article><section><p>%s</p></section><p>%s</p></body>"
    article, section = ("word " * 92).strip(), ("more " * 8).strip()
    rows = [(i, "http://a.example/x", page % (article, section, "")) for i in range(30)]
    rows += [(90, "http://b.example/x", page % (article, section, ""))]
    got = extracted(spark, rows)
    assert set(got.values()) == {"\n".join(["Head", article, section])}


def test_html_defined_cases(spark):
    cases = {
        1: (None, ""), 2: ("", ""), 3: ("<p>", ""), 4: ("<!-- open", ""), 5: ("<script>x", ""), 6: ("plain &amp; <b>bold</b>", "plain & bold"),
        7: ("<div class=\"a>t</div>", "t"), 8: ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), 9: ("a < b <", "a < b <"),
        10: ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), 11: ("<p>" + "word " * 200_000, ("word " * 200_000).strip()),
        12: ("<nav>only menu</nav>", ""), 13: ("<p>&nbsp;&#x41;&notanentity;</p>", "A¬anentity;"),
    }
    urls = [None, "", "http://a/", "no scheme"]
    got = extracted(spark, [(i, urls[i % 4], h) for i, (h, _) in cases.items()])
    assert got == {i: t for i, (_, t) in cases.items()}
    assert extracted(spark, []) == {}
    assert len(C.extract(spark.createDataFrame([(1, "http://a/", "<p>x", "", "")] * 3, PAGES)).collect()) == 3


def test_articles_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = queries.op9_html_consensus(spark, "/root/testdata/sf0.01").collect()
    sources = {r.page_id: r for r in pages.collect()}
    assert {r.page_id for r in rows} == sources.keys()
    for r in rows:
        assert r.n_chars == len(r.text) and r.url == sources[r.page_id].url
        article = re.search(r"<article>(.*?)</article>", sources[r.page_id].html, re.S)[1].replace("<br>", " ")
        parts = (" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        assert r.text == "\n".join(p for p in parts if p)
