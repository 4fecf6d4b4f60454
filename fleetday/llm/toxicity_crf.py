"""Toxicity by a linear-chain conditional random field.

Documents are labelled, words are not. Words of toxic documents are labelled toxic if the word or one of
its beginnings is met far more often in toxic than in clean documents; occurrences are counted by distinct
word before them, so that copies of a document count once. A two-state chain over the words is trained on
these labels. Forward-backward marginals of every word of a whole text are aggregated (evidence and density of
words more likely toxic than not), and a logistic curve fitted to the document labels turns them into the
document's score; runs of such words are the offending offsets.

Defined cases: a null or empty text has no spans and the score of a text without any evidence; without
labels of both kinds nothing is learned and every score is the share of toxic labels (0 without labels);
a null id is never held out of learning by its id; equal texts get equal scores; an empty table gives an
empty result. Columns named like a result are replaced, all others pass through.

Learning uses at most `most_toxic` and `most_clean` labelled ids, each with one text (the smallest hashes)
however often the id is repeated, and every word of them, in pieces of 64. Of a text of more than `most_chars`
characters it uses that many from a place that the text's hash gives. Scoring uses every word of every text.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetday.llm.common import one_per_label
from fleetday.llm.text import pieces, spans

PREFIXES = (3, 4, 5, 6)
#: Words whose evidence a task remembers; emptied when full.
REMEMBERED = 300_000
_CHUNK = 64
#: Pieces that go through the chain together in learning.
_PIECES = 4_096
#: Pairs of string and word in front that are kept before equal ones are put together.
_PAIRS = 1 << 21
_BLOCK = 1 << 18


def normal(word: str) -> str:
    """Lower case without marks at either end."""
    word = word.lower()
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b]


@lru_cache(maxsize=50_000)
def strings(word: str) -> tuple[str, ...]:
    """The word itself and its beginnings."""
    w = normal(word)
    return ("=" + w, *("^" + w[:k] for k in PREFIXES if len(w) >= k)) if w else ()


@dataclass(frozen=True)
class Crf:
    weights: dict[str, float]
    bias: float
    start: tuple[float, float]
    move: tuple[tuple[float, float], tuple[float, float]]
    curve: tuple[float, float, float]  # of the document score: constant and factors of `summary`

    def evidence(self, word: bytes) -> float:
        return self.bias + sum(self.weights.get(s, 0.0) for s in strings(word.decode("utf-8", "replace")))


def forward_backward(evidence: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, ...]:
    """Forward and backward vectors and step matrices; `first` marks the words that begin a text.

    The chain is cut into rows. Products of each row's matrices carry the state from row to row; then all
    rows run side by side. The result is that of the plain recursion.
    """
    n = len(evidence)
    rows = max(1, int(math.sqrt(n)))
    columns = -(-n // rows)
    factor = np.exp(np.clip(evidence, -30, 30))
    m = np.empty((4, rows * columns))  # from clean to clean, to toxic, from toxic to clean, to toxic
    m[:] = np.exp(move).reshape(4, 1)
    m[:, :n][:, first] = np.exp(start).reshape(4, 1)
    m[1, :n] *= factor
    m[3, :n] *= factor
    m[:, n:] = np.array([[1.0], [0.0], [0.0], [1.0]])
    cc, ct, tc, tt = (np.ascontiguousarray(x.reshape(rows, columns).T) for x in m)
    # each row's product, scaled
    w, x, y, z = cc[0], ct[0], tc[0], tt[0]
    for c in range(1, columns):
        w, x, y, z = w * cc[c] + x * tc[c], w * ct[c] + x * tt[c], y * cc[c] + z * tc[c], y * ct[c] + z * tt[c]
        s = w + x + y + z
        w, x, y, z = w / s, x / s, y / s, z / s
    whole = list(zip(w.tolist(), x.tolist(), y.tolist(), z.tolist()))
    enter, leave = np.empty((2, rows)), np.empty((2, rows))
    u, v = 0.5, 0.5
    for r, (w, x, y, z) in enumerate(whole):
        enter[:, r] = u, v
        u, v = u * w + v * y, u * x + v * z
        u, v = u / (u + v), v / (u + v)
    u, v = 0.5, 0.5
    for r in range(rows - 1, -1, -1):
        leave[:, r] = u, v
        w, x, y, z = whole[r]
        u, v = w * u + x * v, y * u + z * v
        u, v = u / (u + v), v / (u + v)
    forward, backward = np.empty((2, columns, rows)), np.empty((2, columns, rows))
    u, v = enter
    for c in range(columns):
        u, v = u * cc[c] + v * tc[c], u * ct[c] + v * tt[c]
        s = u + v
        u, v = u / s, v / s
        forward[0, c], forward[1, c] = u, v
    u, v = leave
    for c in range(columns - 1, -1, -1):
        backward[0, c], backward[1, c] = u, v
        u, v = cc[c] * u + ct[c] * v, tc[c] * u + tt[c] * v
        s = u + v
        u, v = u / s, v / s
    flat = lambda x: x.transpose(2, 1, 0).reshape(-1, 2)[:n]
    return flat(forward), flat(backward), m[:, :n].T.reshape(-1, 2, 2)


def marginals(evidence: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """P(toxic) of every word."""
    if not len(evidence):
        return np.zeros(0)
    forward, backward, _ = forward_backward(evidence, first, start, move)
    clean, toxic = (forward[:, i] * backward[:, i] for i in (0, 1))
    return toxic / (clean + toxic)


# ---- learning, on the bounded sample -------------------------------------------------------------


def _words(text: str) -> list[str]:
    return [w.decode("utf-8", "replace") for w in text.encode().split()]


def _distinct_contexts(texts: list[str], ids: dict[str, int], grow: bool) -> np.ndarray:
    """Per string, the number of different words in front of it; `grow` adds new strings to `ids`."""
    pairs, tidy = array("q"), _PAIRS
    words: dict[str, tuple[int, tuple[int, ...]]] = {}

    def distinct() -> np.ndarray:
        every = np.frombuffer(pairs, np.int64) if len(pairs) else np.zeros(0, np.int64)
        every.sort()
        return every[np.diff(every, prepend=-1) != 0]

    for text in texts:
        before = 0
        for w in _words(text):
            got = words.get(w)
            if got is None:
                have = (ids.setdefault(s, len(ids)) if grow else ids.get(s, -1) for s in strings(w))
                got = words[w] = (len(words) + 1, tuple(i << 32 for i in have if i >= 0))
            pairs.extend([i | before for i in got[1]])
            before = got[0]
        if len(pairs) > tidy:
            left = distinct()
            pairs = array("q")
            pairs.frombytes(left.view(np.uint8))
            tidy = max(tidy, 2 * len(left))
    return np.bincount(distinct() >> 32, minlength=len(ids))


def _label_strings(toxic: list[str], clean: list[str], least: float = 25.0, ratio: float = 20.0) -> tuple[set[str], set[str]]:
    """Strings that mark toxic words, and all strings met behind three different words in toxic texts."""
    ids: dict[str, int] = {}
    a = _distinct_contexts(toxic, ids, True)
    ids = {s: i for s, i in ids.items() if a[i] >= 3}
    back = list(ids.values())
    ids = dict(zip(ids, range(len(ids))))
    a, b = a[back], _distinct_contexts(clean, ids, False)
    n, m = (sum(len(t.encode().split()) for t in texts) for texts in (toxic, clean))
    share = n / max(1, n + m)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (a * np.log(a / ((a + b) * share)) + np.where(b > 0, b * np.log(b / ((a + b) * (1 - share))), 0.0))
    mark = (a * m >= ratio * (b + 0.5) * n) & (g >= least)
    return {s for s, i in ids.items() if mark[i]}, set(ids)


def _expected(part: np.ndarray, y: np.ndarray, factor: np.ndarray, start: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Labels less expectations of pieces side by side (one a column, -1 behind the end): by kind of word, of first words, of steps."""
    real = part >= 0
    e = np.where(real, factor[part], 1.0)
    f, b = np.empty((2, *part.shape)), np.empty((2, *part.shape))
    x, z = np.full(part.shape[1], start[0]), start[1] * e[0]
    for c in range(len(part)):
        if c:
            x, z = x * move[0, 0] + z * move[1, 0], (x * move[0, 1] + z * move[1, 1]) * e[c]
        s = x + z
        x, z = x / s, z / s
        f[0, c], f[1, c] = x, z
    x = z = np.full(part.shape[1], 0.5)
    for c in range(len(part) - 1, -1, -1):
        b[0, c], b[1, c] = x, z
        z = z * e[c]
        x, z = move[0, 0] * x + move[0, 1] * z, move[1, 0] * x + move[1, 1] * z
        s = x + z
        x, z = np.where(real[c], x / s, 0.5), np.where(real[c], z / s, 0.5)
    both = f * b
    off = np.where(real, y - both[1] / (both[0] + both[1]), 0.0)
    pairs = np.stack([f[i, :-1] * move[i, j] * b[j, 1:] * (e[1:] if j else 1.0) for i in (0, 1) for j in (0, 1)])
    pairs = np.where(real[1:], pairs / pairs.sum(0), 0.0).sum((1, 2))
    seen = np.bincount((2 * y[:-1] + y[1:])[real[1:]], minlength=4)
    return np.bincount(part[real], off[real], len(factor)), float(off[0].sum()), seen - pairs


def learn(toxic: list[str], clean: list[str], toxic_rate: float, rounds: int = 100, ridge: float = 1e-3) -> Crf | None:
    """The chain's weights by gradient ascent on the likelihood of the labels of all words.

    A word is the number of its kind (words with the same strings are one kind), so all words of the sample
    are a few bytes each, and gradients of words are summed by kind before they are dealt to strings.
    """
    toxic, clean = list(dict.fromkeys(toxic)), list(dict.fromkeys(clean))
    marks, known = _label_strings(toxic, clean)
    if not marks:
        return None
    kinds: dict[tuple[bool, tuple[str, ...]], int] = {}
    seen: dict[str, int] = {}
    index: dict[str, int] = {}
    owner, feature = array("i"), array("i")  # pairs of a kind and one of its strings
    word, marked = array("i"), []
    for i, text in enumerate(toxic + clean):
        n = 0
        for w in _words(text):
            kind = seen.get(w)
            if kind is None:
                have = strings(w)
                mark, have = any(s in marks for s in have), tuple(s for s in have if s in known)
                kind = kinds.setdefault((mark, have), len(kinds))
                if kind == len(marked):
                    marked.append(mark)
                    for s in have:
                        owner.append(kind)
                        feature.append(index.setdefault(s, len(index)))
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen[w] = kind
            word.append(kind)
            n += 1
        word.extend([-1] * (-n % _CHUNK))
        if i == len(toxic) - 1:
            toxic_pieces = len(word) // _CHUNK
    del seen
    word, owner, feature = (np.frombuffer(x, np.int32) if len(x) else np.zeros(0, np.int32) for x in (word, owner, feature))
    word, marked = word.reshape(-1, _CHUNK), np.array([*marked, False])
    n, k, count = int((word >= 0).sum()), len(index), len(kinds)
    w = np.zeros(k + 7)  # then: bias, start (2), move (4)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        factor = np.exp(np.clip(np.bincount(owner, w[feature], count) + w[k], -30, 30))
        off, grad = np.zeros(count), np.zeros_like(w)
        for at in range(0, len(word), _PIECES):
            part = np.ascontiguousarray(word[at : at + _PIECES].T)
            y = marked[part] & (np.arange(at, at + part.shape[1]) < toxic_pieces)
            by_kind, first, pairs = _expected(part, y, factor, np.exp(w[k + 1 : k + 3]), np.exp(w[k + 3 :]).reshape(2, 2))
            off += by_kind
            grad[k + 1 : k + 3] += (-first, first)
            grad[k + 3 :] += pairs
        grad[:k] = np.bincount(feature, off[owner], k)
        grad[k] = off.sum()
        grad = grad / n * 1e3 - ridge * w
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad * grad
        w += 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = {s: float(w[i]) for s, i in index.items() if abs(w[i]) > 1e-3}
    model = Crf(weights, float(w[k]), tuple(map(float, w[k + 1 : k + 3])), tuple(tuple(map(float, r)) for r in w[k + 3 :].reshape(2, 2)), (0.0, 0.0, 0.0))
    return _with_curve(model, toxic, clean, toxic_rate)


def summary(p: np.ndarray) -> tuple[float, float]:
    """Log of the evidence of all words that are more likely toxic than not, and log of their density."""
    odds = np.log((p + 1e-6) / (1 - p + 1e-6))
    return math.log1p(float(np.maximum(odds, 0).sum())), math.log((float(p[p > 0.5].sum()) + 0.05) / (len(p) + 20))


def _with_curve(model: Crf, toxic: list[str], clean: list[str], rate: float) -> Crf:
    score = scorer(model)
    x = np.array([[1.0, *summary(p)] for p, _ in score(t.encode() for t in (*toxic, *clean))])
    y = np.concatenate([np.ones(len(toxic)), np.zeros(len(clean))])
    rate = min(1 - 1e-4, max(1e-4, rate))
    weight = np.where(y == 1, rate / max(1, len(toxic)), (1 - rate) / max(1, len(clean))) * len(y)
    c, keep = np.array([0.0, 0.5, 0.5]), np.array([1e-3, 0.1, 0.1])
    for _ in range(2):
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
            h = (x * (weight * (p * (1 - p) + 1e-6))[:, None]).T @ x + np.diag(keep)
            c += np.clip(np.linalg.solve(h, x.T @ (weight * (y - p)) - keep * c), -1, 1)
        # more evidence never lowers a score: a measure with a negative part is left out
        out = np.append(False, c[1:] < 0)
        c[out] = 0.0
        x[:, out] = 0.0
    return Crf(model.weights, model.bias, model.start, model.move, tuple(map(float, c)))


# ---- scoring -------------------------------------------------------------------------------------


def scorer(model: Crf):
    """A function from texts to (marginals, number of words) with a bounded memory of words."""
    known: dict[bytes, float] = {}
    start, move = np.broadcast_to(np.array(model.start), (2, 2)), np.array(model.move)

    def evidence(data: bytes) -> list[float]:
        out = []
        for part in pieces(data):
            for w in part.split():
                e = known.get(w)
                if e is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    e = known[w] = model.evidence(w)
                out.append(e)
        return out

    def run(texts: Iterable[bytes]):
        """Blocks of whole texts go through the chain together."""
        held: list[np.ndarray] = []
        size = 0
        for data in texts:
            held.append(np.array(evidence(data)))
            size += len(held[-1])
            if size >= _BLOCK:
                yield from _chain(held)
                held, size = [], 0
        yield from _chain(held)

    def _chain(held: list[np.ndarray]):
        if not held:
            return
        lengths = np.array([len(x) for x in held])
        ends = np.cumsum(lengths)
        first = np.zeros(int(ends[-1]), bool)
        first[(ends - lengths)[lengths > 0]] = True
        p = marginals(np.concatenate(held), first, start, move)
        for a, b in zip(ends - lengths, ends):
            yield p[a:b], int(b - a)

    return run


def toxic_spans(data: bytes, p: np.ndarray) -> list[dict]:
    """[start, stop) in code points of the runs of words with P(toxic) > 1/2."""
    hit = np.flatnonzero(p > 0.5)
    if not len(hit):
        return []
    raw = np.frombuffer(data, np.uint8)
    starts, stops = spans(raw)
    point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    begin = np.flatnonzero(np.diff(hit, prepend=-2) > 1)
    end = np.append(begin[1:] - 1, len(hit) - 1)
    return [{"start": int(point[starts[hit[a]]]), "stop": int(point[stops[hit[b]]])} for a, b in zip(begin, end)]


def score_udf(model: Crf):
    kind = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])

    made: list = []  # one scorer, and so one memory of words, for all batches of a task

    @F.arrow_udf("score double, spans array<struct<start: bigint, stop: bigint>>")
    def score(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(scorer(model))
        data = [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]
        out = []
        for d, (p, _) in zip(data, made[0](data)):
            a, b = summary(p)
            c = model.curve
            out.append({"score": 1 / (1 + math.exp(-max(-30.0, min(30.0, c[0] + c[1] * a + c[2] * b)))), "spans": toxic_spans(d, p)})
        return pa.array(out, kind)

    return score


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        most_toxic: int = 2_000, most_clean: int = 6_000, most_chars: int = 20_000) -> tuple[Crf | None, float]:
    """The model and the share of toxic labels, from labelled rows that are not held out."""
    usable = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y")).where(
        F.col("_y").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id"))
    )
    n = {r["_y"]: r["n"] for r in usable.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = n.get(1, 0) / max(1, sum(n.values()))
    key = F.xxhash64("_id", "_y")
    chosen = [usable.where(F.col("_y") == y).distinct().orderBy(key, "_id").limit(most) for y, most in ((1, most_toxic), (0, most_clean))]
    spare = F.length(text) - most_chars
    part = F.when(spare > 0, F.substring(F.col(text), (F.pmod(F.xxhash64(text), spare + 1) + 1).cast("int"), F.lit(most_chars))).otherwise(F.col(text))
    rows = one_per_label(
        docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("_doc"), part.alias("_text"))
        # bounded: at most most_toxic + most_clean pairs of numbers
        .join(F.broadcast(chosen[0].union(chosen[1])), F.col("_doc") == F.col("_id")), ["_doc", "_y"], "_text"
    ).collect()
    rows.sort(key=lambda r: (r["_doc"], r["_y"], r["_text"]))
    toxic, clean = ([r["_text"] for r in rows if r["_y"] == y] for y in (1, 0))
    return (learn(toxic, clean, rate) if toxic and clean else None), rate


def score(docs: DataFrame, model: Crf | None, rate: float, text: str = "text") -> DataFrame:
    """`docs` with `score` (0..1) and `spans`, the offending offsets."""
    kept = docs.drop("score", "spans", "_s")
    if model is None:
        nothing = F.array().cast("array<struct<start: bigint, stop: bigint>>")
        return kept.withColumns({"score": F.lit(float(rate)), "spans": nothing})
    scored = kept.withColumn("_s", score_udf(model)(F.col(text)))
    return scored.withColumns({"score": F.col("_s.score"), "spans": F.col("_s.spans")}).drop("_s")
