"""Token counts by offset-mapped attribution.

A whole document is encoded once. The tokens' byte lengths give their spans, which are joined as
intervals with the spans of the document's sections, both being sorted and mapped to the same offsets. A token that crosses a boundary
is allotted by an explicit rule: `start` (the section that holds its first character), `end` (its last
character) or `share` (to every section by the share of its characters there, so counts are fractions).
Tokens, or parts of them, in no section are counted under section -1, so a document's counts always add
up to its number of tokens.

Defined cases: a null or empty text has no sections and no tokens and gives one row for section -1 with
0 tokens; empty sections and sections without tokens have 0; sections must be sorted and must not
overlap; special tokens' strings are ordinary text; equal rows give equal rows; an empty table gives an
empty result. Further columns are not passed on.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetday.llm.common import few_at_a_time

#: Where the vocabulary file is (ranks of byte pieces), and how texts are cut before merging. The pattern
#: belongs to the vocabulary: fixed values.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("start", "end", "share")


@lru_cache(maxsize=4)
def _vocabulary(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, i in ranks.items():
        lengths[i] = len(piece)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def line_sections(text: Column) -> Column:
    """Spans [start, stop) in code points of the lines of a text, without the line feeds."""

    @F.arrow_udf("array<struct<start: bigint, stop: bigint>>")
    def spans(texts: pa.Array) -> pa.Array:
        starts, stops, sizes = [], [], []
        for t in few_at_a_time(texts):
            lengths = np.array([len(x) for x in t.split("\n")] if t else [], np.int64)
            stop = np.cumsum(lengths + 1) - 1
            starts.append(stop - lengths)
            stops.append(stop)
            sizes.append(len(lengths))
        flat = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (starts, stops)]
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(flat, names=["start", "stop"]))

    return spans(text)


def attribute(starts: np.ndarray, stops: np.ndarray, token_starts: np.ndarray, token_stops: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section, and at the end those of no section. All spans are sorted and disjoint.

    A character's section is found by bisection among the sections' starts; empty sections hold none.
    """
    out = np.zeros(len(starts) + 1)
    filled = np.flatnonzero(stops > starts)
    a, b = starts[filled], stops[filled]

    def section(at: np.ndarray) -> np.ndarray:
        i = np.searchsorted(a, at, "right") - 1
        inside = (i >= 0) & (at < b[np.maximum(i, 0)]) if len(a) else np.zeros(len(at), bool)
        return np.where(inside, filled[np.maximum(i, 0)] if len(a) else 0, len(starts))

    if rule != "share":
        np.add.at(out, section(token_starts if rule == "start" else token_stops - 1), 1)
        return out
    # cut every token at the section borders inside it
    borders = np.unique(np.concatenate([a, b]))
    cuts = np.unique(np.concatenate([token_starts, token_stops, borders[(borders > token_starts[0]) & (borders < token_stops[-1])]])) if len(token_starts) else token_starts
    if len(cuts) > 1:
        token = np.searchsorted(token_starts, cuts[:-1], "right") - 1
        np.add.at(out, section(cuts[:-1]), np.diff(cuts) / (token_stops - token_starts)[token])
    return out


def token_bytes(text: str, path: str = RANKS, pattern: str = PATTERN) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops in bytes of the tokens of a text; they cover it without gaps."""
    encoding, lengths = _vocabulary(path, pattern)
    ends = np.cumsum(lengths[np.array(encoding.encode_ordinary(text), np.int64)])
    return (np.concatenate([[0], ends[:-1]]) if len(ends) else ends), ends


def point_bytes(text: str) -> np.ndarray:
    """The byte at which each code point begins, and the number of bytes."""
    raw = np.frombuffer(text.encode(), np.uint8)
    return np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))


def section_tokens(text: Column, sections: Column, rule: str = "start", path: str = RANKS, pattern: str = PATTERN) -> Column:
    """Array with the tokens of each section, and those of no section at its end."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    @F.arrow_udf("array<double>")
    def counts(texts: pa.Array, spans: pa.Array) -> pa.Array:
        spans = spans.combine_chunks() if isinstance(spans, pa.ChunkedArray) else spans
        offsets, flat = spans.offsets.to_numpy(), spans.values
        starts, stops = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "stop"))
        flat, ends = array("d"), array("i", [0])
        for i, t in enumerate(few_at_a_time(texts)):
            a, b = starts[offsets[i] : offsets[i + 1]], stops[offsets[i] : offsets[i + 1]]
            # a section begins and ends with whole characters, so its bytes stand for them even where a
            # token holds a part of a character only
            at = point_bytes(t or "")
            a, b = (at[np.clip(x, 0, len(at) - 1)] for x in (a, b))
            found = attribute(a, b, *token_bytes(t or "", path, pattern), rule)
            flat.frombytes(found.tobytes())
            ends.append(ends[-1] + len(found))
        return pa.ListArray.from_arrays(
            pa.array(np.frombuffer(ends, np.int32)), pa.array(np.frombuffer(flat, np.float64)) if len(flat) else pa.array([], pa.float64())
        )

    return counts(text, sections)


def count(docs: DataFrame, sections: Column | None = None, doc_id: str = "doc_id", text: str = "text", rule: str = "start",
          path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, section, start, stop, n_tokens), one row per section and one for what lies in none (-1).

    `sections` is an array of (start, stop) in code points; by default a text's lines are its sections.
    """
    spans = F.when(F.col(text).isNull() | (F.col(text) == ""), F.array().cast("array<struct<start: bigint, stop: bigint>>")).otherwise(
        line_sections(F.col(text)) if sections is None else sections
    )
    counted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"), spans.alias("_spans")).select(
        "doc_id", "_spans", section_tokens(F.col("_text"), F.col("_spans"), rule, path, pattern).alias("_n")
    )
    rows = counted.select("doc_id", "_spans", F.posexplode("_n").alias("section", "n_tokens"))
    span = F.get("_spans", "section")
    n = F.col("n_tokens") if rule == "share" else F.col("n_tokens").cast("long")
    return rows.select(
        "doc_id", F.when(F.col("section") < F.size("_spans"), F.col("section")).otherwise(F.lit(-1)).alias("section"),
        span["start"].alias("start"), span["stop"].alias("stop"), n.alias("n_tokens"),
    )
