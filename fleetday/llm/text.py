"""Words, hashes and counts of whole texts, on bytes with numpy.

Words are runs between ASCII white space, as in `WORD`. Long texts are worked on in pieces that end at
white space, so the memory needed follows the number of words, eight bytes each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_rng = np.random.default_rng(20240501)
#: A random number per place in a word and byte; a word's hash is their sum, so no structure of words makes two alike.
_PLACES = 256
_TABLE = _rng.integers(0, 1 << 64, (_PLACES, 256), dtype=np.uint64, endpoint=False).reshape(-1)
_KEY = np.uint64(_rng.integers(1 << 62, 1 << 63))
_Q = int(_rng.integers(1 << 62, 1 << 63)) | 1
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_PIECE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(data: bytes) -> Iterator[bytes]:
    """`data` in parts of about _PIECE bytes that end at white space (or at its end)."""
    at = 0
    while at < len(data):
        end = at + _PIECE
        while end < len(data) and _IS_WORD[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of bytes."""
    edge = np.diff(_IS_WORD[raw].astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash for every word, in order; equal words have equal hashes."""
    found = []
    for part in pieces(data):
        raw = np.frombuffer(part, np.uint8)
        starts, ends = spans(raw)
        if not len(starts):
            continue
        begin = starts.copy()
        begin[0] = 0  # what stands before the first word is in no word
        place = np.arange(len(raw)) - np.repeat(starts, np.diff(begin, append=len(raw)))
        place[: starts[0]] = 0
        value = _TABLE[(np.minimum(place, _PLACES - 1) << 8) | raw]
        far = np.flatnonzero(place >= _PLACES - 1)
        if len(far):
            value[far] = mix(mix((place[far].astype(np.uint64) << np.uint64(8)) | raw[far]) + _KEY)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(value, out=sums[1:])
        found.append(mix(sums[ends] - sums[starts]))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for every run of k words, in order."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(_Q) + words[j : j + n]
    return mix(out)


def shingle_set(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; with fewer words one for the whole sequence."""
    if 0 < len(words) < k:
        return mix(windows(words, len(words)) + np.uint64(len(words)))
    return np.unique(windows(words, k))


def exactly_similar(a: bytes, b: bytes, percent: int, k: int = 5) -> bool:
    """Whether 100 * intersection >= percent * union of the k-word shingles of two texts, on the words themselves.

    Words, then pairs, triples and so on get numbers that both texts share. With fewer words a text's whole sequence is one shingle.
    """
    x, y = a.split(), b.split()
    if not x or not y or len(x) < k or len(y) < k:
        return bool(x) and x == y
    numbers: dict[bytes, int] = {}
    words = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in t), np.int64, len(t)) for t in (x, y)]
    names = words
    for j in range(1, k):
        codes = [n[: len(w) - j] * len(numbers) + w[j:] for n, w in zip(names, words)]
        _, name = np.unique(np.concatenate(codes), return_inverse=True)
        names = [name[: len(codes[0])], name[len(codes[0]) :]]
    one, two = (np.unique(n) for n in names)
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


def repeated_words(words: np.ndarray, k: int = 8) -> int:
    """Words that lie in some run of k words which the text holds twice or more."""
    runs = windows(words, k)
    if not len(runs):
        return 0
    _, at, counts = np.unique(runs, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[at] > 1)
    if not len(twice):
        return 0
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + k, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_POINT = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_upper", "n_lower", "n_exclaim", "n_distinct_words", "n_same_next", "n_lines",
]


def counts(data: bytes | None) -> list[int]:
    """The numbers named in COUNTS for one text; null counts as empty."""
    data = data or b""
    words = word_hashes(data)
    byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lines = [x for x in data.split(b"\n") if x.strip()]
    return [
        len(words), int(byte[_IS_WORD & _POINT].sum()), int(byte[_SYMBOL].sum()), len(lines) - len(set(lines)),
        repeated_words(words), int(byte[65:91].sum()), int(byte[97:123].sum()), int(byte[33]),
        len(np.unique(words)), int((words[1:] == words[:-1]).sum()), len(lines),
    ]
