"""Best-fit packing of token sequences, planned on the histogram of lengths.

Documents are encoded and ended by a terminator; only those longer than a sequence are cut, into full pieces
after a first one that may be shorter. Pieces are counted by length, and best fit (longest pieces first, each
into the fullest sequence that still takes it) runs over these counts: sequences filled alike are one
group with a number, so the plan's steps follow the number of lengths, not of documents. Pieces then take
the planned slots by their rank within their length: a rank within (task, length) given while encoding, plus
the pieces of that length in the tasks before.

Only the histogram (one row per length up to `size`) reaches the driver. The plan that goes back to the tasks
holds one row per length and group: at most three groups begin per length and a sequence has at most
sqrt(2 * size) different lengths, whatever the number of documents.

Token ids are those that `tokenizers` gives for the whole text. For byte-level vocabularies whose ids follow
the order of their merges, `tiktoken` gives the same ids at half the cost, so it encodes the texts that hold none of the
added tokens' strings; other texts and other vocabularies are encoded by `tokenizers`. Very long texts
are encoded in parts that end where a word ends and a blank and a word follow, which is a border of tokens.

Defined cases: a null or empty text is the terminator alone (length 1); a null id is kept; equal rows are
packed each; equal lengths are ranked by task and order of reading; an empty table gives an empty result; further columns are not passed on.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetday.llm.common import few_at_a_time
from fleetday.llm.token_counts import PATTERN
from fleetday.sources.tables import stage

#: Where the vocabulary file is.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
SIZE = 2048
TERMINATOR = 0
#: Characters encoded at once.
AT_ONCE = 1 << 20
_BORDER = re.compile(r"(?<=[A-Za-z0-9.,;:!?])(?= [A-Za-z0-9])")


def _ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """A byte-level vocabulary by bytes. It writes printable Latin-1 characters as they are, other bytes from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    byte = {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}
    return {bytes(byte[c] for c in piece): i for piece, i in vocabulary.items()}


class Encoder:
    """Texts to token ids, packed as unsigned little-endian 32-bit numbers."""

    def __init__(self, path: str, pattern: str = PATTERN):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.quick = None
        parts = json.loads(self.tokenizer.to_str())
        split, model, added = parts["pre_tokenizer"] or {}, parts["model"], [t["content"] for t in parts["added_tokens"]]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        vocabulary = {k: v for k, v in model["vocab"].items() if k not in added}
        ordered = [vocabulary.get("".join(m)) for m in model.get("merges", ())] == list(range(256, len(vocabulary)))
        plain = split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
        if ordered and plain and not parts["normalizer"] and model["type"] == "BPE" and not model["ignore_merges"]:
            import tiktoken

            self.quick = tiktoken.Encoding("quick", pat_str=pattern, mergeable_ranks=_ranks(vocabulary), special_tokens={})

    def encode(self, text: str) -> bytes:
        if self.quick is None or (self.added and self.added.search(text)):
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        out, at = [], 0
        while at < len(text):
            border = _BORDER.search(text, at + AT_ONCE) if len(text) - at > AT_ONCE else None
            end = border.start() if border else len(text)
            out.append(_packed(self.quick.encode_to_numpy(text[at:end], disallowed_special=())))
            at = end
        return b"".join(out)


def _packed(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(tokens: int, size: int) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces of a document; the first takes what is over."""
    first = tokens % size or min(tokens, size)
    yield 0, first
    for at in range(first, tokens, size):
        yield at, size


_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, rank long"


def pieces(docs: DataFrame, doc_id: str, text: str, size: int = SIZE, path: str = TOKENIZER, terminator: int = TERMINATOR) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in its task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encode, end = TaskContext.get().partitionId(), encoder(path).encode, _packed([terminator])
        seen = np.zeros(size + 1, np.int64).tolist()
        for batch in batches:
            ids = batch.column(0)
            row, number, start, length, crc, rank = (array(c) for c in "qiqiqq")
            for i, t in enumerate(few_at_a_time(batch.column(1))):
                packed = memoryview(encode(t or "") + end)
                for k, (at, n) in enumerate(cut(len(packed) // 4, size)):
                    row.append(i)
                    number.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(crc32(packed[4 * at : 4 * (at + n)]))
                    rank.append(seen[n])
                    seen[n] += 1
            if len(row):
                columns = [np.frombuffer(c, c.typecode) for c in (number, start, length, crc, rank)]
                columns.insert(4, np.full(len(row), task, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.frombuffer(row, "q"))), *map(pa.array, columns)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"],
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, _PIECES)


def plan(counts: dict[int, int], size: int = SIZE) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best fit, longest first, over (length: number of pieces).

    Gives rows (length, first rank, pieces per sequence, sequences, first sequence, offset) and the number
    of sequences. The pieces of a row are those from its first rank on; a row's sequences are consecutive.
    """
    # a group is [sequences, [(length, pieces per sequence), ...]], filed under the room that is left
    room: dict[int, list] = defaultdict(list)
    for length in sorted((n for n in counts if counts[n] > 0), reverse=True):
        left = counts[length]
        for space in [*(r for r in sorted(room) if r >= length), size]:
            fit = space // length
            groups = room.pop(space, [])
            stay = []
            while left and (groups or space == size):
                # no group is empty, so the last space is that of new sequences
                n, inside = groups.pop() if groups else (-(-left // fit), [])
                full = min(n, left // fit)
                if full:
                    room[space - fit * length].append((full, [*inside, (length, fit)]))
                    left, n = left - full * fit, n - full
                if n and left:
                    room[space - left * length].append((1, [*inside, (length, left)]))
                    left, n = 0, n - 1
                if n and inside:
                    stay.append((n, inside))
            if stay or groups:
                room[space] = stay + groups + room.get(space, [])
    rows, ranks, sequences = [], defaultdict(int), 0
    for groups in room.values():
        for n, inside in groups:
            offset = 0
            for length, per in inside:
                rows.append((length, ranks[length], per, n, sequences, offset))
                ranks[length] += n * per
                offset += length * per
            sequences += n
    return sorted(rows), sequences


def place(lengths: np.ndarray, ranks: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces with these lengths and ranks within them, from a plan's rows."""
    # rows are sorted by length, then first rank; a row is found by bisection within its length
    row = np.zeros(len(lengths), np.int64)
    for n in np.unique(lengths):
        at, (a, b) = lengths == n, np.searchsorted(rows[:, 0], [n, n + 1])
        row[at] = a + np.searchsorted(rows[a:b, 1], ranks[at], side="right") - 1
    _, first, per, _, sequence, offset = rows[row].T
    inside = ranks - first
    return sequence + inside // per, offset + inside % per * lengths


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, path: str = TOKENIZER,
         terminator: int = TERMINATOR) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece of every document."""
    cut_up = stage(pieces(docs, doc_id, text, size, path, terminator), "pieces")
    per_task = cut_up.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    planned, _ = plan(counts, size)
    rows = np.array(planned, np.int64).reshape(-1, 6)
    before = F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    ahead = per_task.select("length", "task", F.coalesce(before, F.lit(0)).alias("ahead"))
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # the last column is the rank within the length
            length = batch.column(3).to_numpy().astype(np.int64)
            sequence, offset = place(length, batch.column(5).to_numpy(), sent.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"]
            )

    ranked = cut_up.join(ahead, ["length", "task"]).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", (F.col("ahead") + F.col("rank")).alias("rank")
    )
    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
