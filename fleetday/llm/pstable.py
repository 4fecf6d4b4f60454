"""Near-duplicate vectors by Euclidean p-stable hashing, confirmed by exact cosines.

Vectors are normalised, so a cosine is a distance. Several tables hash every vector by projections on
normal directions, quantised in steps of WIDTH; vectors with equal codes in some table are candidates. Every candidate pair's cosine is then computed in double precision.

Vectors with equal components are one node with a count. The nodes of a bucket are cut into blocks that
meet pairwise, so a bucket of any size is shared by many tasks; a pair counts in the first table that it
shares, and only counts per vector and a spanning set of links leave a block, never the pairs. No bucket
is capped.

Defined cases: a null vector, one of no components or only zeros, or with a null or non-finite component
links with nothing, and vectors of different lengths never link; a null id is kept and links with nothing; every row gets a result, rows with equal vectors link with each other whether or not their
ids differ; vectors of any length are compared whole, by length; an empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetday.llm.common import components, pack, runs
from fleetday.sources.tables import stage

WIDTH = 1.25
RECALL = 0.99
#: Rows of a bucket that meet in one task, squared per pair of blocks.
BLOCK = 128


@dataclass(frozen=True)
class Hashing:
    tables: int
    projections: int


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection of two vectors at this distance agrees."""
    r = width / distance
    normal = 0.5 * (1 + math.erf(-r / math.sqrt(2)))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(n: int, threshold: float, recall: float = RECALL) -> Hashing:
    """As many projections as leave one unrelated (orthogonal) vector in a bucket of n vectors, and as many
    tables as find `recall` of the pairs exactly at the threshold (more of all closer pairs)."""
    projections = max(4, math.ceil(math.log(max(2, n)) / -math.log(collision(math.sqrt(2)))))
    found = collision(math.sqrt(max(1e-6, 2 - 2 * threshold))) ** projections
    return Hashing(max(1, math.ceil(math.log(1 - recall) / math.log1p(-found))) if found < 1 else 1, projections)


@lru_cache(maxsize=16)
def _directions(size: int, h: Hashing) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240503 + size)
    multiplier = rng.integers(1, 1 << 63, (h.tables, h.projections), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return rng.normal(size=(size, h.tables * h.projections)), rng.uniform(0, WIDTH, h.tables * h.projections), multiplier


def bucket_keys(unit: np.ndarray, h: Hashing) -> np.ndarray:
    """A 64-bit bucket per row and table."""
    direction, shift, multiplier = _directions(unit.shape[1], h)
    code = np.floor((unit @ direction + shift) / WIDTH).astype(np.int64).view(np.uint64)
    key = (code.reshape(len(unit), h.tables, h.projections) * multiplier).sum(-1, dtype=np.uint64)
    return (key ^ (key >> np.uint64(29))).view(np.int64)


def units(vectors: list, kind: str = "f8") -> np.ndarray:
    """Rows of length 1 in double precision, of packed vectors of one length."""
    x = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow or underflow of squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def usable(vector: Column) -> Column:
    """Finite in every component, and not all zero."""
    v = vector.cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.coalesce(~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))


def _hash(h: Hashing, kind: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(node, v, copies) to (node, packed vector, copies, bucket keys of all tables)."""
        for batch in batches:
            node, lists, copies = batch.columns
            flat, ends = lists.flatten().to_numpy().astype(kind), (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
            packed = [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            keys: list = [None] * len(packed)
            by_size: dict[int, list[int]] = {}
            for i, v in enumerate(packed):
                by_size.setdefault(len(v), []).append(i)
            for at in by_size.values():
                for i, k in zip(at, bucket_keys(units([packed[i] for i in at], kind), h)):
                    keys[i] = k
            yield pa.RecordBatch.from_arrays(
                [node, pa.array(packed, pa.binary()), copies, pa.array(keys, pa.list_(pa.int64()))],
                names=["node", "vector", "copies", "keys"],
            )

    return run


KEYS = ["size", "t", "key", "i", "j"]


def _labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest number that each of n numbers is linked with over the links (a, b)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _pairs(threshold: float, kind: str):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Counts of linked rows per node, and links that join what these pairs of blocks join."""
        rows = rows.sort_values([*KEYS, "side", "node"], ignore_index=True)
        columns = {c: rows[c].to_numpy() for c in (*KEYS, "side", "node", "copies")}
        vectors, keys = rows["vector"].to_numpy(), rows["keys"].to_numpy()
        left_ends, right_ends = [], []
        for a, b in runs([columns[k] for k in KEYS]):
            same = columns["i"][a] == columns["j"][a]
            m = b if same else a + int((columns["side"][a:b] == 0).sum())
            left, right = slice(a, m), slice(a, b) if same else slice(m, b)
            if m == a or right.start == right.stop:
                continue
            x = units(vectors[left], kind)
            hit = x @ (x if same else units(vectors[right], kind)).T >= threshold
            i, j = np.nonzero(np.triu(hit, 1) if same else hit)
            i, j = i + left.start, j + right.start
            t = int(columns["t"][a])
            if t and len(i):
                # a pair counts in the first table that it shares
                ours = np.stack(keys[a:b])
                new = ~(ours[i - a] == ours[j - a]).any(1)
                i, j = i[new], j[new]
            left_ends.append(i)
            right_ends.append(j)
        i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left_ends, right_ends))
        nodes, code = np.unique(columns["node"], return_inverse=True)
        count = np.zeros(len(nodes), np.int64)
        np.add.at(count, code[i], columns["copies"][j])
        np.add.at(count, code[j], columns["copies"][i])
        label = _labels(code[i], code[j], len(nodes))
        met, joined = np.flatnonzero(count), np.flatnonzero(label != np.arange(len(nodes)))
        out = [(a, None, n) for a, n in zip(nodes[met].tolist(), count[met].tolist())]
        out += [(a, b, 0) for a, b in zip(nodes[label[joined]].tolist(), nodes[joined].tolist())]
        return pd.DataFrame(out, columns=["a", "b", "n"]).astype({"a": "Int64", "b": "Int64", "n": "Int64"})

    return run


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """(id, n_links, component) of every row of `vectors`."""
    # vectors travel in the precision that they are given in
    single = vectors.schema[embedding].dataType.simpleString() == "array<float>"
    kind, spark_kind = ("f4", "float") if single else ("f8", "double")
    v = F.col(embedding).cast(f"array<{spark_kind}>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.when(F.col(vec_id).isNotNull() & usable(F.col(embedding)), v).alias("v"))
    # -0.0 and 0.0 are one number
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0).cast(spark_kind)))
    classes = stage(
        rows.where("v is not null").groupBy("v").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")), "vectors"
    )
    h = plan(classes.count(), threshold)
    nodes = stage(
        classes.select("node", "v", "copies").mapInArrow(_hash(h, kind), "node long, vector binary, copies long, keys array<long>"), "nodes"
    )
    rows_of = nodes.select("node", F.length("vector").alias("size"), F.posexplode("keys").alias("t", "key"))
    shared = stage(
        rows_of.groupBy("size", "t", "key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        .withColumn("blocks", F.ceil(F.col("c") / BLOCK).cast("int")),
        "buckets",
    )
    met = shared.agg(F.sum(F.col("c") * F.col("blocks"))).first()[0] or 0
    members = rows_of.join(shared.drop("c"), ["size", "t", "key"]).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # block i meets every block j >= i; a row goes to all pairs of blocks that its own belongs to
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = members.withColumn("other", other).select(
        "node", "size", "t", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"),
    )
    # of the keys, those of earlier tables tell whether a pair was met before
    full = dealt.join(nodes, "node").withColumns({"keys": F.slice("keys", F.lit(1), F.col("t")), "pack": pack(KEYS, met)})
    found = stage(full.groupBy("pack").applyInPandas(_pairs(threshold, kind), "a long, b long, n long"), "found")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    parts = components(found.where("b is not null"))
    labels = (
        classes.select(F.col("v").alias("_v"), "node", "copies")
        .join(counts.withColumnRenamed("a", "node"), "node", "left").join(parts, "node", "left")
        .select("_v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("_links"), F.coalesce("component", "node").alias("_component"))
    )
    return rows.join(labels, F.col("v") == F.col("_v"), "left").select(
        "id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_component", "id").alias("component")
    )
