import collections

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_data import WORDS, shingles

from fleetday.llm import text as T
from fleetday.llm.hyperminhash import shingles as hashed

WORDY = st.text(st.sampled_from("abA é日\t\n\x0b #*%|."), max_size=80)


def plain_counts(t):
    w = WORDS.findall(t)
    lines = [x for x in t.split("\n") if WORDS.search(x)]
    runs = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    repeated = {j for i in range(len(w) - 7) if runs[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return [
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated),
        sum("A" <= c <= "Z" for c in t), sum("a" <= c <= "z" for c in t), t.count("!"), len(set(w)),
        sum(a == b for a, b in zip(w, w[1:])), len(lines),
    ]


@settings(max_examples=200, deadline=None)
@given(st.one_of(WORDY, st.text(st.sampled_from("ab "), max_size=120)))
def test_counts(t):
    assert T.counts(t.encode()) == plain_counts(t)


@pytest.mark.parametrize("t", ["", "x" * 700_000, "word " * 200_000, ("ab cd ef gh\n" * 60_000)])
def test_counts_of_long_texts(t):
    assert T.counts(t.encode()) == plain_counts(t)


def test_null_counts_as_empty():
    assert T.counts(None) == T.counts(b"") == [0] * len(T.COUNTS)


@settings(max_examples=200, deadline=None)
@given(WORDY)
def test_shingles(t):
    assert len(hashed(t.encode(), 5)) == len(shingles(t))


def test_shorter_sequences_are_not_shingles():
    assert not np.intersect1d(hashed(b"a b c d", 5), hashed(b"a b c d e", 5)).size
    assert (hashed(b"A b", 5) == hashed(b" a\tB\n", 5)).all()


def test_equal_words_hash_alike_across_pieces():
    words = T.word_hashes(b"abc " * 300_000)
    assert len(words) == 300_000 and len(np.unique(words)) == 1


def thue_morse(n):
    """Two words of n letters that sums over powers can't tell apart."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [64, 1024, 4096, 1 << 15])
def test_built_words_have_different_hashes(n):
    a, b = thue_morse(n)
    hashes = T.word_hashes(f"  {a} {b}\n{a} x{a} {b}x".encode())
    assert hashes[0] == hashes[2] and len(set(hashes.tolist())) == 4
    assert T.word_hashes(a.encode())[0] == hashes[0]
    text = " ".join([a, b] * 4 + ["q"] + [b, a, b, b, a, b, a, a])
    assert T.counts(text.encode())[:5] == plain_counts(text)[:5]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14).map(" ".join), min_size=2, max_size=2), st.integers(1, 5), st.sampled_from([50, 80, 85, 100]))
def test_exact_similarity(texts, k, percent):
    x, y = (shingles(t, k) for t in texts)
    want = bool(x) and bool(y) and 100 * len(x & y) >= percent * len(x | y)
    assert T.exactly_similar(texts[0].encode(), texts[1].encode(), percent, k) == want
