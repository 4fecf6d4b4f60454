"""Literal tables and plain reference versions for the tests of the training-data operators."""

from __future__ import annotations

import collections
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows, schema=DOCS):
    """(doc_id, text[, source[, lang]])"""
    filled = [(r[0], r[1], *(r[3:4] or ["en"]), *(r[2:3] or ["s"]), len(r[1] or "")) for r in rows]
    return spark.createDataFrame(filled, schema)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k=5):
    w = WORDS.findall(lower(text))
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])


def components(ids, linked):
    """Smallest reachable id per id, by plain search."""
    out = {}
    for i in sorted(ids):
        if i in out:
            continue
        stack = [i]
        while stack:
            x = stack.pop()
            if x not in out:
                out[x] = i
                stack += linked[x]
    return out


def near_duplicates(rows, percent, k=5):
    """{id: (set size, component)} over an inverted index of all shingles."""
    sets = {i: shingles(t, k) for i, t in rows}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    linked = collections.defaultdict(list)
    for i, s in sets.items():
        common = collections.Counter(j for x in s for j in holders[x] if j < i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                linked[i].append(j)
                linked[j].append(i)
    part = components(sets, linked)
    return {i: (len(s), part[i]) for i, s in sets.items()}
