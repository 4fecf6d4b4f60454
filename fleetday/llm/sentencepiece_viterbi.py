"""SentencePiece encoding and decoding by a streaming Viterbi search.

Characters are fed in order. For every boundary in a window no longer than the longest piece, the
search keeps a backpointer to the boundary where the last piece before it begins. Whenever all boundaries
from which a piece can still start lead back to one boundary, the ids up to it are final and are
committed, so the memory needed does not grow with the text.

The model at hand is a merge (BPE) model, whose segmentation is not the one with the best sum of scores.
Its step of the search is therefore: a last piece is admissible after the piece before it if merging the
two pieces' characters yields exactly these two pieces. Exactly one last piece is admissible at every
boundary, and the path through them is the merge segmentation. For a unigram model (`merges=False`) the
step is the usual one, the best sum of scores.

Pieces never hold a space mark behind another character, so the search over a text converges in front of
every run of space marks, and around every character that only stands alone; what lies between two such
points is encoded once and remembered per task (a bounded memory). Characters without a piece become their UTF-8 bytes' pieces.

Defined cases: a null text gives null, an empty one no ids; decoding gives the text back exactly, but that
U+2581 (the space mark itself) comes back as a space and lone surrogates cannot occur; equal texts give
equal ids; an empty table gives an empty result; other columns pass through, those named like a result
are replaced.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetday.llm.common import few_at_a_time

#: Where the vocabulary file is; a parameter of every operator here.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Segments in each of the two halves of a task's memory.
REMEMBERED = 400_000
_LONG = 400


class Model:
    """Pieces of a model file. Reading the file is all that the library does here."""

    def __init__(self, pieces: list[str], scores: list[float], plain: list[bool], byte_ids: dict[int, int], unknown: int, merges: bool = True):
        self.pieces, self.scores, self.unknown, self.byte_ids = pieces, scores, unknown, byte_ids
        self.ids = {p: i for i, p in enumerate(pieces) if plain[i]}
        self.longest = max(map(len, self.ids), default=1)
        # a text that can grow into a piece has an id, or -1 if it isn't a piece (or merging never makes it)
        self.prefixes = {p[:n]: -1 for p in self.ids for n in range(1, len(p))}
        self.prefixes |= {p: i if not merges or self.merge(p) == [p] else -1 for p, i in self.ids.items()}
        # no piece continues over a space mark, so paths converge in front of one
        self.converging = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        alone = {i: bytes([b]) for b, i in byte_ids.items()}
        self.spelled = [alone.get(i) or p.encode() for i, p in enumerate(pieces)]
        self.known_fits: dict[int, bool] = {}
        # segments that no piece crosses: in front of space marks and around characters without longer pieces
        joined = "".join(sorted({c for p in self.ids if len(p) > 1 for c in p if c != SPACE}))
        inner = f"[{re.escape(joined)}]" if joined else r"(?!)"
        self.segment = re.compile(f"{SPACE}*{inner}+|{SPACE}*[^{SPACE}]|{SPACE}+")

    @staticmethod
    @lru_cache(maxsize=4)
    def load(path: str, merges: bool = True) -> Model:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(sp.get_piece_size())
        pieces = [sp.id_to_piece(i) for i in n]
        plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in n]
        return Model(pieces, [sp.get_score(i) for i in n], plain, {int(pieces[i][3:5], 16): i for i in n if sp.is_byte(i)}, sp.unk_id(), merges)

    def merge(self, chars: str) -> list[str]:
        """The merge segmentation of a short text: the best-scored neighbours first, then the leftmost."""
        parts = list(chars)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.scores[found] > best):
                    best, at = self.scores[found], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Merging leaves the boundary between the two pieces."""
        key = left * len(self.pieces) + right
        known = self.known_fits.get(key)
        if known is None:
            if len(self.known_fits) > 1_000_000:
                self.known_fits.clear()
            a, b = self.pieces[left], self.pieces[right]
            known = self.known_fits[key] = self.merge(a + b) == [a, b]
        return known

    def out(self, char: str) -> list[int]:
        """Ids of a character without a piece."""
        return [self.byte_ids.get(b, self.unknown) for b in char.encode()] if self.byte_ids else [self.unknown]


class StreamingViterbi:
    """`feed` characters, then `finish`; committed ids gather in `ids`."""

    def __init__(self, model: Model, merges: bool = True):
        self.model, self.merges = model, merges
        self.ids: list[int] = []
        self.text = ""  # characters since the last committed boundary
        # per boundary: start and id (-1: none) of the last piece before it, sum of scores (unigram models)
        self.best, self.last, self.sums = [0], [-1], [0.0]
        self.open = [0]  # boundaries from which a piece can still reach beyond the end

    def feed(self, chars: str) -> None:
        """Any number of characters; convergence is tested every few lengths of the longest piece."""
        step = 4 * self.model.longest
        for at in range(0, len(chars), step):
            self.text += chars[at : at + step]
            self._by_merges() if self.merges else self._by_scores()
            if len(self.text) >= step:
                self._commit()

    def _by_merges(self) -> None:
        """Extend the paths to the end of the text: the one last piece that fits the piece before it."""
        text, best, last, open_ = self.text, self.best, self.last, self.open
        get, fits, size = self.model.prefixes.get, self.model.known_fits.get, len(self.model.pieces)
        for end in range(len(best), len(text) + 1):
            chosen, mark, still = end - 1, -1, []  # a character without a piece of its own
            for start in open_:  # the longest piece first
                found = get(text[start:end])
                if found is None:
                    continue
                still.append(start)
                if found >= 0 and mark < 0:
                    left = last[start]
                    if left >= 0:
                        fit = fits(left * size + found)
                        if fit is None:
                            fit = self.model.fits(left, found)
                        if not fit:
                            continue
                    chosen, mark = start, found
            best.append(chosen)
            last.append(mark)
            still.append(end)
            open_ = still
        self.open = open_

    def _by_scores(self) -> None:
        """Extend the paths to the end of the text: the last piece with the best sum of scores."""
        text, best, open_ = self.text, self.best, self.open
        for end in range(len(best), len(text) + 1):
            chosen, mark, score, still = end - 1, -1, self.sums[end - 1] - 1e6, []
            for start in open_:
                found = self.model.prefixes.get(text[start:end])
                if found is None:
                    continue
                still.append(start)
                if found >= 0 and self.sums[start] + self.model.scores[found] > score:
                    chosen, mark, score = start, found, self.sums[start] + self.model.scores[found]
            best.append(chosen)
            self.last.append(mark)
            self.sums.append(score)
            still.append(end)
            open_ = still
        self.open = open_

    def _commit(self) -> None:
        """Emit what lies before the boundary that all open paths share."""
        at = set(self.open)
        while len(at) > 1:
            last = max(at)
            at.remove(last)
            at.add(self.best[last])
        shared = at.pop()
        # the piece before the boundary stays, as the next piece has to fit it
        keep = self.best[shared] if self.merges and shared else shared
        if not keep:
            return
        self._emit(keep)
        self.text = self.text[keep:]
        self.best = [max(0, b - keep) for b in self.best[keep:]]
        self.last = self.last[keep:]
        self.sums = [s - self.sums[keep] for s in self.sums[keep:]]
        self.open = [s - keep for s in self.open]

    def _emit(self, upto: int) -> None:
        best, last, ids = self.best, self.last, []
        while upto:
            start = best[upto]
            if last[upto] >= 0:
                ids.append(last[upto])
            else:
                ids += reversed(self.model.out(self.text[start:upto]))
            upto = start
        self.ids += reversed(ids)

    def finish(self) -> list[int]:
        self._emit(len(self.text))
        self.text, self.open = "", [0]
        self.best, self.last, self.sums = [0], [-1], [0.0]
        return self.ids


def encode_segment(model: Model, segment: str, merges: bool = True) -> list[int]:
    search = StreamingViterbi(model, merges)
    search.feed(segment)
    return search.finish()


def encoder(path: str, merges: bool = True):
    """A function from text to an array of ids that remembers what it has encoded between two points of
    convergence: the newest segments and those before them, so that frequent ones stay."""
    model = Model.load(path, merges)
    newest: dict[str, bytes] = {}
    before: dict[str, bytes] = {}

    def look(segment: str) -> bytes:
        nonlocal newest, before
        got = before.get(segment)
        if got is None:
            got = array("i", encode_segment(model, segment, merges)).tobytes()
        if len(segment) < _LONG:
            if len(newest) >= REMEMBERED:
                before, newest = newest, {}
            newest[segment] = got
        return got

    def encode(text: str) -> array:
        ids = array("i")
        if not text:
            return ids
        marked = SPACE + text.replace(" ", SPACE)
        if not model.converging:
            ids.extend(encode_segment(model, marked, merges))
            return ids
        for segment in model.segment.findall(marked):
            ids.frombytes(newest.get(segment) or look(segment))
        return ids

    return encode


def decode_ids(model: Model, ids: Iterable[int]) -> str:
    text = b"".join(map(model.spelled.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if text[:1] == " " else text


def encode(text: Column, path: str = MODEL, merges: bool = True) -> Column:
    """Array of ids of every whole text."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        run = _encoder(path, merges)
        flat, offsets = array("i"), array("i", [0])
        for t in few_at_a_time(texts):
            if t:
                flat.extend(run(t))
            offsets.append(len(flat))
        return pa.ListArray.from_arrays(_packed(offsets), _packed(flat), mask=texts.is_null())

    return ids(text)


def decode(ids: Column, path: str = MODEL) -> Column:
    @F.arrow_udf("string")
    def text(found: pa.Array) -> pa.Array:
        model = Model.load(path)
        return pa.array([None if x is None else decode_ids(model, x) for x in found.to_pylist()], pa.string())

    return text(ids)


def encoded(docs: DataFrame, keep: list[str], text: str = "text", check: bool = False, path: str = MODEL, merges: bool = True) -> DataFrame:
    """The columns `keep` of `docs` with `ids`, and with `restored` if `check`: whether decoding gives the
    text back (null for a null text).

    The same as `encode`, in small batches both ways: a batch of texts may hold 64 MB, and so may its ids.
    """
    narrow = docs.select(*keep, F.col(text).alias("_text"))
    fields = [f for f in narrow.schema if f.name != "_text"] + [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if check:
        fields.append(T.StructField("restored", T.BooleanType()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text, model = _encoder(path, merges), Model.load(path, merges)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(part.num_columns - 1)
                flat, offsets, same = array("i"), array("i", [0]), []
                for t in texts.to_pylist():
                    ids = encode_text(t) if t else array("i")
                    flat.extend(ids)
                    offsets.append(len(flat))
                    if check:
                        same.append(None if t is None else decode_ids(model, ids) == t)
                columns = [*part.columns[:-1], pa.ListArray.from_arrays(_packed(offsets), _packed(flat), mask=texts.is_null())]
                if check:
                    columns.append(pa.array(same, pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return narrow.mapInArrow(run, T.StructType(fields))


def _packed(values: array) -> pa.Array:
    return pa.array(np.frombuffer(values, np.int32)) if len(values) else pa.array([], pa.int32())


@lru_cache(maxsize=4)
def _encoder(path: str, merges: bool):
    """One encoder, and so one memory, per Python worker."""
    return encoder(path, merges)
