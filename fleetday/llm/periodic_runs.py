"""Periodic runs of words, found by catching squares on dyadic blocks, and texts without their repetitions.

A run is a stretch of consecutive words with smallest period q, at least max(LEAST, 2q) words long, that no
neighbouring word extends. Every run holds squares (a stretch of q words, twice).

Words are appended to a stream, and catchers stand over its completed blocks of h = 4, 8, 16, ... words. A
catcher of level h looks for squares of period 2h to 4h: each appended word completes one suffix of h words,
and that is compared with the blocks of the level that began 2h to 4h words before, which are two. A match is
a square's beginning; matches at one period on neighbouring blocks are one candidate. It is extended to both
sides word by word, counts if it holds a square, and squares of one stretch merge into one run. All words of
a batch are appended by one array operation per level, so a level costs two comparisons a word. Periods
below 8 are caught by comparing each word with the word q before.

A run of period q holds q words that recur q later, among them a whole block of its level, so none is
missed. A block that lies in a known run of a short period r matches at many distances; only those remain
at which a longer run can be: where the begins or the ends of the block's r-run and its copy's match up, or
where the two r-runs touch. Fingerprints only propose: words are compared exactly.

Defined cases: a null or empty text has no words, no run and four nulls; equal rows give equal rows; ties for
the longest run go to the smallest start, then period; a text of any length is one stream, memory follows
its words; an empty table gives an empty result; further columns are not passed on. Documents of a batch
are one stream with a word between them that equals no other, so no run crosses it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetday.llm.text import mix

LEAST = 12
#: Words of short documents that are one stream.
STREAM = 1 << 16
_CELLS = 1 << 22
_LEFT = np.uint64(0x9E3779B97F4A7C15)


def _stretches(at: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Begin and end of the stretches of at least `least` consecutive numbers in a sorted array."""
    if len(at) < least:
        return []
    cut = np.flatnonzero(np.diff(at) != 1)
    first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(at) - 1]])
    long = last - first + 1 >= least
    return list(zip(at[first[long]].tolist(), (at[last[long]] + 1).tolist()))


class _Squares:
    """The squares caught so far, merged into runs: (start, stop) to the smallest period."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.period: dict[tuple[int, int], int] = {}

    def add(self, start: int, stop: int, q: int) -> None:
        self.period[start, stop] = min(q, self.period.get((start, stop), q))

    def extend(self, a: int, b: int, q: int, h: int) -> None:
        """Merge the stretch around the words a to b, whole blocks of h that seem to recur q later."""
        same = self.ids[a:b] == self.ids[a + q : b + q]
        if not same.all():  # fingerprints of different words were equal
            for at in range(a, b, h) if b - a > h else ():
                self.extend(at, at + h, q, h)
            return
        s, e = a - self._agree(a, q, -1), b + self._agree(b, q, 1)
        if e - s >= max(LEAST - q, q):
            self.add(s, e + q, q)

    def _agree(self, at: int, q: int, step: int) -> int:
        """How many words from `at` on, or before it, equal the word q later."""
        room, done, size = (at if step < 0 else len(self.ids) - q - at), 0, 16
        while done < room:
            size = min(2 * size, room - done)
            a = at + done if step > 0 else at - done - size
            other = np.flatnonzero(self.ids[a : a + size] != self.ids[a + q : a + q + size])
            if len(other):
                return done + (int(other[0]) if step > 0 else size - 1 - int(other[-1]))
            done += size
        return done

    def covers(self, h: int, n: int) -> tuple[np.ndarray, np.ndarray] | None:
        """For every window of h words the run of a period up to h/2 that holds it (there is one at most)."""
        short = [k for k, q in self.period.items() if 2 * q <= h <= k[1] - k[0]]
        if not short:
            return None
        start, stop = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        for s, e in short:
            start[s : e - h + 1] = s
            stop[s : e - h + 1] = e
        return start, stop


def _matches(prints: np.ndarray, h: int, covers) -> tuple[np.ndarray, np.ndarray]:
    """(block, period) of the suffixes that equal a block whose catcher is alive."""
    blocks = len(prints) // h
    table = prints[: blocks * h].reshape(blocks, h)
    found = []
    rows = max(1, _CELLS // h)
    for back in (2, 3):
        for at in range(0, blocks - back, rows):
            upto = min(at + rows, blocks - back)
            t, j = np.nonzero(table[at + back : upto + back] == table[at:upto, :1])
            if not len(t):
                continue
            t, q = t + at, j + back * h
            t, q = (v[t * h + q + h <= len(prints)] for v in (t, q))  # at the end of the stream, suffixes that it doesn't hold whole
            if covers is not None:
                x, y = t * h, t * h + q
                s1, e1, s2, e2 = covers[0][x], covers[1][x], covers[0][y], covers[1][y]
                level = (s2 - s1 == q) | (e2 - e1 == q)
                stay = (s1 < 0) | (s2 < 0) | level | ((s1 != s2) & (s2 <= e1))
                t, q = t[stay], q[stay]
            found.append((t, q))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    t, q = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((t, q))
    return t[order], q[order]


def find_runs(ids: np.ndarray, longest: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, stop and period of every run in a stream of word numbers, by start, then period.

    `longest` is the longest stretch in which a run can lie (a document), if the stream has several.
    """
    n = len(ids)
    longest = n if longest is None else longest
    squares = _Squares(ids)
    for q in range(1, min(8, n)):
        for s, e in _stretches(np.flatnonzero(ids[q:] == ids[:-q]), max(LEAST - q, q)):
            squares.add(s, e + q, q)
    prints, h = mix(ids.astype(np.uint64) + _LEFT), 1
    while 4 * h <= longest:
        if h >= 4:
            t, q = _matches(prints, h, squares.covers(h, n))
            if len(t):
                cut = np.flatnonzero((np.diff(q) != 0) | (np.diff(t) != 1))
                first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(t) - 1]])
                for a, b, period in zip((t[first] * h).tolist(), (t[last] * h + h).tolist(), q[first].tolist()):
                    squares.extend(a, b, period, h)
        prints = np.concatenate([mix(prints[:-h] * _LEFT + prints[h:]), prints[-h:]])  # of twice the length
        h *= 2
    found = np.array([(s, e, q) for (s, e), q in squares.period.items()], np.int64).reshape(-1, 3)
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return found[:, 0], found[:, 1], found[:, 2]


def replanted(n: int, doc_id: int | None) -> np.ndarray | None:
    """The contract's tenth of documents repeats its words: the number of the word that stands at each place."""
    if n == 0 or doc_id is None:
        return None
    h = crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


class _Document:
    def __init__(self, doc_id: int | None, words: list[bytes], places: np.ndarray | None, numbers: dict):
        self.doc_id, self.words, self.places = doc_id, words, places
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        self.ids = ids if places is None else ids[places]

    def result(self, starts: np.ndarray, stops: np.ndarray, periods: np.ndarray) -> tuple:
        runs = list(zip(starts.tolist(), (stops - starts).tolist(), periods.tolist()))
        digest = sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        cover = np.zeros(len(self.ids) + 1, np.int64)
        np.add.at(cover, starts + periods, 1)
        np.add.at(cover, stops, -1)
        stay = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
        if self.places is None and len(stay) == len(self.words):
            text = b" ".join(self.words)
        else:
            places = stay if self.places is None else self.places[stay]
            text = b" ".join([self.words[i] for i in places.tolist()])
        best = (None,) * 4 if longest is None else (*longest, 1000 * longest[1] // longest[2])
        return self.doc_id, len(runs), *best, digest, text


def _stream(documents: list[_Document]) -> Iterator[tuple]:
    """The results of documents that are one stream."""
    parts, begins, at = [], [], 0
    for i, d in enumerate(documents):
        begins.append(at)
        parts += [d.ids, np.array([-1 - i], np.int64)]  # between documents, a word that equals no other
        at += len(d.ids) + 1
    starts, stops, periods = find_runs(np.concatenate(parts), max(len(d.ids) for d in documents))
    cut = np.searchsorted(starts, [*begins, at])
    for d, begin, a, b in zip(documents, begins, cut[:-1], cut[1:]):
        yield d.result(starts[a:b] - begin, stops[a:b] - begin, periods[a:b])


def documents_runs(ids: Iterable[int | None], texts: Iterable[bytes | None], places: Callable = lambda n, doc_id: None) -> Iterator[tuple]:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed text) of every document, in order."""
    waiting, words, numbers = [], 0, {}
    for doc_id, text in zip(ids, texts):
        found = (text or b"").split()  # bytes split at ASCII white space only
        waiting.append(_Document(doc_id, found, places(len(found), doc_id), numbers))
        words += len(found)
        if words >= STREAM:
            yield from _stream(waiting)
            waiting, words, numbers = [], 0, {}
    if waiting:
        yield from _stream(waiting)


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
     ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed", pa.large_string()), ("collapsed_sha256", pa.string())]
)
_SPARK = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed string, collapsed_sha256 string")


def collapse(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", texts: bool = True,
             places: Callable[[int, int | None], np.ndarray | None] = lambda n, doc_id: None) -> DataFrame:
    """One row per document: its longest run, digests of all its runs and of the text without repetitions.

    `collapsed` is that text (every run cut to its first period, words joined by one space), null if not
    `texts`. `places(n, doc_id)` may put other words of the document in the places of its n words.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a few documents are Python objects at a time
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = list(documents_runs(
                    part.column(0).to_pylist(), (t.as_py() for t in part.column(1).cast(pa.large_binary())), places))
                rows = [(*r[:7], r[7].decode() if texts else None, sha256(r[7]).hexdigest()) for r in found]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)], schema=_OUT)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, _SPARK)
