"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct five-word shingles. The hashes are dealt to REGISTERS buckets and
each bucket keeps its smallest hash in two bytes: the count of leading zeros and the mantissa bits after
them. Empty buckets borrow from the first filled one in a fixed random order of their own, so every
register agrees with the probability of the sets' Jaccard similarity, however short the text. Bands of
compressed registers are the candidates' keys; the share of equal registers, less the expected chance
collisions, estimates the similarity; links are then confirmed on the full sets.

Groups of copies are never expanded. Documents with equal sets are one node. A first pass confirms one
pair per node, with the smallest id that shares a band with it, and joins what is linked. After it only
pairs of different components are left to test. Each band's bucket is cut into blocks; the nodes outside
its largest component meet every other node, block by block, and a block returns no more links than
nodes. So no link between different components is lost and no bucket lands in one task.

Defined cases: a null or empty text, or one without words, has an empty set and links with nothing; with
fewer words than a shingle the whole sequence is one shingle; rows with a null id are kept and link with
nothing; rows that share an id but not the text count as one document; a text of any length is hashed whole, in
pieces, and memory follows its words; an empty table gives an empty
result. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetday.llm.common import components, pack, runs
from fleetday.llm.text import exactly_similar, mix, shingle_set, word_hashes
from fleetday.sources.tables import stage

REGISTERS = 256
MANTISSA_BITS = 10
BAND_ROWS = 6
BANDS = REGISTERS // BAND_ROWS
#: Shortfall of the estimate below the threshold that still is a candidate: 5 standard deviations.
MARGIN = 0.14
#: Rows of a bucket that meet in one task.
BLOCK = 128

_rng = np.random.default_rng(20240502)
_BORROW = np.stack([np.concatenate([[i], _rng.permutation(np.delete(np.arange(REGISTERS), i))]) for i in range(REGISTERS)])
_BAND_SEED = _rng.integers(1, 1 << 63, (BANDS, BAND_ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OTHER = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes | None, k: int) -> np.ndarray:
    return shingle_set(word_hashes((text or b"").lower()), k)


def registers(hashes: np.ndarray) -> np.ndarray:
    """Two bytes per bucket for a sorted non-empty set of 64-bit hashes."""
    at, first = np.unique(hashes >> np.uint64(56), return_index=True)
    low = (hashes[first] << np.uint64(8)) >> np.uint64(11)  # 53 bits are exact as a float
    part, exponent = np.frexp(low.astype(np.float64))
    zeros = np.where(low == 0, 54, 54 - exponent)
    mantissa = np.where(low == 0, 0, (part * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.int64)
    own = np.zeros(REGISTERS, np.uint16)
    own[at.astype(np.int64)] = (zeros << MANTISSA_BITS) | mantissa
    if len(at) == REGISTERS:
        return own
    filled = (own != 0)[_BORROW]
    return own[_BORROW[np.arange(REGISTERS), filled.argmax(1)]]


def band_keys(regs: np.ndarray) -> np.ndarray:
    """Keys of the bands (last axis) for one row or many rows of registers."""
    rows = regs[..., : BANDS * BAND_ROWS].reshape(*regs.shape[:-1], BANDS, BAND_ROWS).astype(np.uint64)
    return mix((rows * _BAND_SEED).sum(-1, dtype=np.uint64)).view(np.int64)


def chance_collision(n: np.ndarray | int, m: np.ndarray | int) -> np.ndarray:
    """Probability that registers with different smallest hashes agree, for sets of n and m shingles.

    A register's smallest of x hashes falls into a cell of relative width 2^-bits. Summed over the
    leading zeros that is close to 2^-bits times the integral below, which depends on the ratio alone.
    """
    x, y = (np.maximum(np.asarray(v, float) / REGISTERS, 1.0) for v in (n, m))
    return 0.169919487159739 * 4 * x * y / (x + y) ** 2 * 4 * 2.0 ** -MANTISSA_BITS


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of register rows."""
    chance = chance_collision(n, m)
    return ((a == b).mean(-1) - chance) / (1 - chance)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted distinct hashes; never false where it holds for the words."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(a: bytes | None, b: bytes | None, percent: int, k: int) -> bool:
    """The same on the words themselves."""
    return exactly_similar((a or b"").lower(), (b or b"").lower(), percent, k)


def _fingerprint(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, f1, f2, regs = [], [], [], []
            for text in batch.column(1).cast(pa.large_binary()).to_pylist():
                s = shingles(text, k)
                n.append(len(s))
                f1.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)))
                f2.append(int(mix(s ^ _OTHER).sum(dtype=np.uint64).view(np.int64)))
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(regs, pa.binary())],
                names=["id", "n", "f1", "f2", "regs"],
            )

    return run


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """(id, n, f1, f2, regs): size of the set, a 128-bit fingerprint of it and its registers (null if empty)."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return narrow.mapInArrow(_fingerprint(k), "id long, n long, f1 long, f2 long, regs binary")


def _bands(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        regs = np.stack([np.frombuffer(r, np.uint16) for r in batch.column(1).to_pylist()])
        ids = np.repeat(batch.column(0).to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(band_keys(regs).reshape(-1) )], names=["id", "band"])


def shared_bands(nodes: DataFrame) -> DataFrame:
    """(band, id, leader) of every node whose band another node shares; leader is the band's smallest id."""
    rows = nodes.select("id", "regs").mapInArrow(_bands, "id long, band long")
    buckets = rows.groupBy("band").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    return rows.join(buckets, "band")


def _confirm(percent: int, k: int):
    @F.arrow_udf("boolean")
    def confirm(a: pa.Array, b: pa.Array) -> pa.Array:
        kept: dict = {}
        out = []
        for x, y in zip(a.cast(pa.large_binary()).to_pylist(), b.cast(pa.large_binary()).to_pylist()):
            if x not in kept:  # many rows in a row share their leader
                kept = {x: shingles(x, k)}
            out.append(similar(kept[x], shingles(y, k), percent) and confirmed(x, y, percent, k))
        return pa.array(out, pa.bool_())

    return confirm


def _estimated(percent: int):
    @F.arrow_udf("boolean")
    def likely(a: pa.Array, b: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        x, y = (np.frombuffer(b"".join(v.to_pylist()), np.uint16).reshape(-1, REGISTERS) for v in (a, b))
        return pa.array(estimate(x, y, n.to_numpy(), m.to_numpy()) >= percent / 100 - MARGIN)

    return likely


def leader_links(bands: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """Confirmed links of nodes with the smallest id that shares a band with them: one pair per node at most."""
    pairs = bands.where("id <> leader").groupBy("id").agg(F.min("leader").alias("leader"))
    side = lambda p: nodes.select(F.col("id").alias(f"{p}id"), F.col("n").alias(f"{p}n"), F.col("regs").alias(f"{p}regs"))
    likely = (
        pairs.join(side("a_"), F.col("id") == F.col("a_id")).join(side("b_"), F.col("leader") == F.col("b_id"))
        .where(_estimated(percent)("a_regs", "b_regs", "a_n", "b_n")).select("id", "leader")
    )
    body = lambda p: texts.select(F.col("id").alias(f"{p}id"), F.col("text").alias(f"{p}text"))
    return (
        likely.join(body("a_"), F.col("id") == F.col("a_id")).join(body("b_"), F.col("leader") == F.col("b_id"))
        .where(_confirm(percent, k)("b_text", "a_text")).select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    )


KEYS = ["band", "i", "j"]


def _blocks(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Rows by block, each block's probes first, with registers, band keys and the blocks' ends."""
    rows = rows.sort_values([*KEYS, "probe", "id"], ascending=[True, True, True, False, True], ignore_index=True)
    regs = np.frombuffer(b"".join(rows["regs"]), np.uint16).reshape(-1, REGISTERS)
    return rows, regs, band_keys(regs), list(runs([rows[k].to_numpy() for k in KEYS]))


def _fits(block: slice, i: int, columns: dict[str, np.ndarray], regs: np.ndarray, keys: np.ndarray, percent: int) -> np.ndarray:
    """The members of a block that the probe i has to be compared with.

    They lie in another component, are likely to be similar and share no earlier band with it; of two
    nodes outside the main component, the one with the larger id is the member.
    """
    part, ids, n = columns["component"], columns["id"], columns["n"]
    fits = (part[block] != part[i]) & (~columns["outside"][block] | (ids[block] > ids[i]))
    at = np.flatnonzero(fits) + block.start
    if not len(at):
        return at
    at = at[estimate(regs[at], regs[i], n[at], n[i]) >= percent / 100 - MARGIN]
    band = (keys[i] == columns["band"][i]).argmax()
    return at[(keys[at] == keys[i]).argmax(1) == band] if len(at) else at


def _columns(rows: pd.DataFrame) -> dict[str, np.ndarray]:
    return {c: rows[c].to_numpy(bool if c in ("outside", "probe") else np.int64) for c in ("band", "id", "component", "n", "outside", "probe")}


def _likely_rows(percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """The rows of these blocks whose texts have to be compared."""
        rows, regs, keys, ends = _blocks(rows)
        columns = _columns(rows)
        wanted = np.zeros(len(rows), bool)
        for a, b in ends:
            probes = int(columns["probe"][a:b].sum())
            for i in range(a, a + probes):
                at = _fits(slice(a + probes, b), i, columns, regs, keys, percent)
                if len(at):
                    wanted[at] = wanted[i] = True
        return rows.loc[wanted, [*KEYS, "id", "component", "outside", "probe", "n", "regs"]]

    return run


def _block_links(percent: int, k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Links that join the components which these blocks join."""
        rows, regs, keys, ends = _blocks(rows)
        columns, texts = _columns(rows), rows["text"].to_numpy()
        found = []
        for a, b in ends:
            roots: dict[int, int] = {}
            sets: dict[int, np.ndarray] = {}

            def root(x: int) -> int:
                while roots.get(x, x) != x:
                    x = roots[x]
                return x

            probes = int(columns["probe"][a:b].sum())
            for i in range(a, a + probes):
                for j in _fits(slice(a + probes, b), i, columns, regs, keys, percent).tolist():
                    p, q = root(int(columns["component"][i])), root(int(columns["component"][j]))
                    if p == q:
                        continue
                    for x in (i, j):
                        if x not in sets:
                            sets[x] = shingles(texts[x].encode(), k)
                    if similar(sets[i], sets[j], percent) and confirmed(texts[i].encode(), texts[j].encode(), percent, k):
                        roots[max(p, q)] = min(p, q)
                        found.append((columns["id"][i], columns["id"][j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return run


def remaining_links(bands: DataFrame, parts: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """Links between different components of the first pass, enough of them to join all that belongs together."""
    known = parts.withColumnsRenamed({"node": "id"})
    members = stage(
        bands.select("band", "id").join(known, "id", "left").withColumn("component", F.coalesce("component", "id")), "members"
    )
    by_part = members.groupBy("band", "component").agg(F.count(F.lit(1)).alias("c"))
    mixed = by_part.groupBy("band").agg(
        F.max(F.struct("c", "component")).alias("top"), F.sum("c").alias("total"), F.count(F.lit(1)).alias("parts")
    ).where("parts > 1").select(
        "band", F.col("top.component").alias("main"),
        F.ceil(F.col("total") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("total") - F.col("top.c")) / BLOCK).cast("int").alias("probe_blocks"),
        "total", (F.col("total") - F.col("top.c")).alias("outsiders"),
    )
    mixed = stage(mixed, "mixed")
    size = mixed.agg(F.sum(F.col("total") * F.col("probe_blocks") + F.col("outsiders") * F.col("blocks"))).first()[0] or 0
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = members.join(mixed, "band").withColumn("outside", F.col("component") != F.col("main"))
    columns = [*KEYS, "id", "component", "outside", "probe"]
    probe = rows.where("outside").withColumn("j", mine("probe_blocks")).withColumn("i", every("blocks")).withColumn("probe", F.lit(True))
    member = rows.withColumn("i", mine("blocks")).withColumn("j", every("probe_blocks")).withColumn("probe", F.lit(False))
    dealt = probe.select(columns).union(member.select(columns))
    # registers first: texts travel only for the few rows that are likely similar to one of another component
    full = dealt.join(nodes.select("id", "n", "regs"), "id").withColumn("pack", pack(KEYS, size))
    kinds = "band long, i int, j int, id long, component long, outside boolean, probe boolean, n long, regs binary"
    likely = stage(full.groupBy("pack").applyInPandas(_likely_rows(percent), kinds), "likely")
    texted = likely.join(texts, "id").withColumn("pack", pack(KEYS, likely.count()))
    return texted.groupBy("pack").applyInPandas(_block_links(percent, k), "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80, k: int = 5) -> DataFrame:
    """(id, n, component) of every row of `docs`: set size and smallest id reachable over links."""
    base = stage(fingerprints(docs, doc_id, text, k), "fingerprints")
    filled = base.where("n > 0 and id is not null")
    nodes = stage(
        filled.groupBy("f1", "f2", "n").agg(F.min(F.struct("id", "regs")).alias("s")).select("f1", "f2", "n", "s.id", "s.regs"), "nodes"
    )
    bands = stage(shared_bands(nodes), "bands")
    wanted = bands.select("id").distinct()
    texts = stage(
        docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where("text is not null").join(wanted, "id", "left_semi"),
        "texts",
    )
    first = stage(leader_links(bands, nodes, texts, percent, k), "links")
    rest = stage(remaining_links(bands, components(first), nodes, texts, percent, k), "links")
    parts = components(first.union(rest))
    labels = nodes.select("f1", "f2", "n", "id").join(parts.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("f1").alias("_f1"), F.col("f2").alias("_f2"), F.col("n").alias("_n"), F.coalesce("component", "id").alias("_component")
    )
    same = (F.col("f1") == F.col("_f1")) & (F.col("f2") == F.col("_f2")) & (F.col("n") == F.col("_n"))
    return base.join(labels, same, "left").select(
        "id", "n", F.when(F.col("id").isNotNull(), F.coalesce("_component", "id")).alias("component")
    )
