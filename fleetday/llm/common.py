"""What several operators share: tables, word counts, bounded samples and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetday.sources.tables import stage

#: A word: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small fixed table as a plain literal of the plan (no RDD, no Python in tasks)."""
    if not rows:
        return spark.range(0).select(F.inline(F.from_json(F.lit("[]"), f"array<struct<{schema}>>")))
    structs = F.array(*[F.struct(*[_literal(v).alias(k) for k, v in r.items()]) for r in rows])
    return spark.range(1).select(F.inline(structs.cast(f"array<struct<{schema}>>")))


def _literal(value) -> Column:
    if isinstance(value, list | tuple):
        return F.array(*[_literal(v) for v in value]) if value else F.array().cast("array<string>")
    if isinstance(value, dict):
        return F.struct(*[_literal(v).alias(k) for k, v in value.items()])
    return F.lit(value)


def one_per_label(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per `keys`, with the text that has the smallest hash. Each task sends one row per key at most."""
    least = F.min(F.struct(F.xxhash64(text).alias("hash"), F.col(text).alias("text")))
    return rows.groupBy(*keys).agg(least.alias("_least")).select(*keys, F.col("_least.text").alias(text))


def few_at_a_time(texts: pa.Array) -> Iterator:
    """A batch holds up to 64 MB of text; only a few rows of it are Python objects at a time."""
    for at in range(0, len(texts), 64):
        yield from texts.slice(at, 64).to_pylist()


def pack(keys: list[str], rows: int, per_pack: int = 512) -> Column:
    """A number that puts small groups together, `per_pack` rows on average; a group is never split.

    A Python call per group of two rows costs far more than its work.
    """
    return F.pmod(F.xxhash64(*keys), F.lit(max(1, -(-rows // per_pack))))


def runs(columns: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Begin and end of the runs of equal rows in sorted columns."""
    if not len(columns[0]):
        return
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    at = np.concatenate([[0], np.flatnonzero(new), [len(new)]]).tolist()
    yield from zip(at[:-1], at[1:])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that an edge touches; component is the smallest node of its part.

    Smallest labels travel along the edges and then jump to their label's label, so the rounds grow
    with the logarithm of the longest path. Every round is one join, one grouped minimum and one
    join over (node, label) rows, written to the shared folder; nothing but the number of changed
    labels reaches the driver. Edges with a null end are ignored; without edges the result is empty.
    """
    ends = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).where("node <> other")
    both = stage(ends.union(ends.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "edges")
    labels = stage(
        both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("component")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), F.col("component").alias("c")), "other")
            .groupBy("node").agg(F.min("c").alias("c"))
        )
        met = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "c").alias("met")
        )
        up = labels.select(F.col("node").alias("met"), F.col("component").alias("up"))
        new = stage(
            met.join(up, "met", "left").select(
                "node", "old", F.least("met", F.coalesce("up", "met")).alias("component")
            ),
            "labels",
        )
        changed = new.agg(F.sum((F.col("old") != F.col("component")).cast("long"))).first()[0]
        labels = new.select("node", "component")
        if not changed:
            return labels
