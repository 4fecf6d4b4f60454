"""Text statistics as a column, for the quality operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetday.llm.text import COUNTS, counts


def text_counts(text: Column) -> Column:
    """A struct of the COUNTS of every whole text, all bigint, all 0 for null."""

    @F.arrow_udf(", ".join(f"{c} bigint" for c in COUNTS))
    def of(texts: pa.Array) -> pa.Array:
        rows = [counts(t) for t in texts.cast(pa.large_binary()).to_pylist()]
        columns = zip(*rows) if rows else [[] for _ in COUNTS]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=COUNTS)

    return of(text)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, 0 where b is 0."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def ratios(of: str) -> dict[str, Column]:
    """Features from a struct of counts, the most telling first; each is defined for empty texts."""
    c = lambda name: F.col(f"{of}.{name}")
    return {
        "symbols_per_word": ratio(c("n_symbols"), c("n_words")),
        "exclaims_per_word": ratio(c("n_exclaim"), c("n_words")),
        "upper_share": ratio(c("n_upper"), c("n_upper") + c("n_lower")),
        "repeat_share": ratio(c("n_repeat_words"), c("n_words")),
        "same_next_share": ratio(c("n_same_next"), c("n_words")),
        "dup_line_share": ratio(c("n_dup_lines"), c("n_lines")),
        "log_words": F.log1p(c("n_words")),
        "word_length": ratio(c("word_chars"), c("n_words")),
        "words_per_line": F.log1p(ratio(c("n_words"), c("n_lines"))),
    }
