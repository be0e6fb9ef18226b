"""Encoding and decoding with merge-type SentencePiece vocabularies.

A text is normalised as the model says, then its neighbouring symbols, single characters at first, are merged: an agenda
holds all adjacent pairs that are pieces, the pair of best score (ties: leftmost) is merged, and the pairs it forms with
its neighbours join the agenda. Symbols that are no piece become their bytes.

No merge crosses a place where a character can only begin a piece, or that no piece of several characters holds, so texts
are encoded in such sections, and a section met before in a task is not merged again (``CACHE`` sections are remembered).
In every Arrow batch the sections met for the first time are checked against the sentencepiece library: a section whose
ids differ ends the job with the section in the message. Decoding is the library's.

Null and empty texts have no ids and decode to the empty text. Rows are judged one by one: repeated rows and null ids give
their own rows, other columns are not read. The longest text bounds the memory of a task.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.common import by_batch, slices
from postings.llm.hashing import Stretches, mix

#: Sections remembered per task; the length up to which one is remembered and merged along with others.
CACHE, SHORT = 300_000, 48
#: Bytes of text encoded at once.
SLICE = 3 << 20
_NEVER = np.int32(2**31 - 1)
#: Scrambled values of all code points, for hashes of sections.
_SYMBOLS = mix(np.arange(1, 0x110001, dtype=np.uint64), 9)
#: What SentencePiece writes for a space: a fixed value.
MARK = "▁"


class Merger:
    """Encoder for one model, given as the bytes of its file; the model must have byte pieces for what it lacks."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=model)
        lib = self.library
        self._rank, self._bytes = {}, {}
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self._bytes[int(piece[1:-1], 16)] = i
            elif lib.is_unused(i):
                raise ValueError("vocabularies with unused pieces are not supported")
            elif not lib.is_control(i) and not lib.is_unknown(i):
                self._rank[piece] = (-lib.get_score(i), i)
        if len(self._bytes) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        self._kinds = self._cutter()
        self._tables()
        # A character that merges with nothing, to stand before a section when the library encodes it.
        inside = {c for piece in self._rank if len(piece) > 1 for c in piece}
        self._lone = next(c for c in map(chr, range(0xE000, 0xF900)) if c not in inside)
        self._lead = lib.encode(self._lone)
        self._known: dict[str, list[int]] = {}

    def _cutter(self) -> np.ndarray:
        """Kind of each character: 1 for the mark, the same number from 2 on for characters that stand side by side in
        some piece, 0 for those that never do. Stretches of different kinds never join, but for marks before them."""
        several = [piece for piece in self._rank if len(piece) > 1]
        group = {c: c for piece in several for c in piece}

        def top(c: str) -> str:
            while group[c] != c:
                group[c] = group[group[c]]
                c = group[c]
            return c

        cross = any(MARK in piece.lstrip(MARK) for piece in several)  # a mark behind another character joins like a letter
        for piece in several:
            for a, b in zip(piece, piece[1:]):
                if cross or a != MARK:
                    group[top(a)] = top(b)
        kinds = np.zeros(0x110000, np.int32)
        number = {t: k for k, t in enumerate(sorted({top(c) for c in group}), 2)}
        for c in group:
            kinds[ord(c)] = number[top(c)]
        if not cross:
            kinds[ord(MARK)] = 1
        return kinds

    def _cut(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The texts in one string and its code points; starts and ends of its sections, and the section each text begins with (and the end)."""
        joined = "".join(texts)
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = self._kinds[code]
        prior = np.concatenate(([0], kind[:-1]))
        first = (kind == 0) | ((kind == 1) & (prior != 1)) | ((kind > 1) & (prior != kind) & (prior != 1))
        bounds = np.cumsum([0, *map(len, texts)])
        first[bounds[:-1][bounds[:-1] < len(code)]] = True
        starts = np.flatnonzero(first)
        return joined, code, starts, np.append(starts[1:], len(code)), np.searchsorted(starts, bounds)

    def _tables(self) -> None:
        """Characters and pairs of pieces as arrays, for many sections at a time."""
        pairs = {}
        for piece, (score, i) in self._rank.items():
            for cut in range(1, len(piece)):
                a, b = self._rank.get(piece[:cut]), self._rank.get(piece[cut:])
                if a and b:
                    pairs[a[1], b[1]] = score, i
        self._size = self.library.get_piece_size()
        keys = np.array([a * self._size + b for a, b in pairs], np.int64)
        scores = np.array([s for s, _ in pairs.values()], np.float64)
        by_key = np.argsort(keys)
        self._keys, self._order = keys[by_key], np.unique(scores, return_inverse=True)[1][by_key].astype(np.int32)
        self._piece = np.array([i for _, i in pairs.values()], np.int32)[by_key]
        self._char = np.full(0x110000, -1, np.int32)
        for piece, (_, i) in self._rank.items():
            if len(piece) == 1:
                self._char[ord(piece)] = i
        #: Whether all characters of longer pieces are pieces, so that sections of several characters consist of pieces.
        self._plain = bool(pairs) and all(c in self._rank for piece in self._rank for c in piece) and self._char[0] < 0

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the order of scores (``_NEVER``: no piece) and piece of pairs of symbols."""
        key = left.astype(np.int64) * self._size + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        hit = (self._keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self._order[at], _NEVER), self._piece[at]

    def _merge_many(self, sections: list[str]) -> list[list[int]]:
        """Ids of sections of equal length whose characters all are pieces: a row of the agenda for each, in every round
        the best pair of each row is merged. A symbol stays at the place of its first character."""
        n, width = len(sections), len(sections[0])
        symbols = np.full((n, width + 2), -1, np.int32)  # a place before and one behind, which pair with nothing
        symbols[:, 1:-1] = self._char[np.array(sections, f"U{width}").view(np.uint32).reshape(n, width)]
        agenda, piece = self._pairs(symbols[:, :-1], symbols[:, 1:])
        after = np.tile(np.arange(1, width + 3, dtype=np.int32), (n, 1))
        before = after - 2
        rows = np.arange(n)
        while len(rows):
            at = agenda.argmin(axis=1)[rows] if len(rows) * 2 > n else agenda[rows].argmin(axis=1)
            live = agenda[rows, at] != _NEVER
            rows, at = rows[live], at[live]
            merged, gone = piece[rows, at], after[rows, at]
            right, left = after[rows, gone], before[rows, at]
            symbols[rows, at], symbols[rows, gone], agenda[rows, gone] = merged, -1, _NEVER
            after[rows, at], before[rows, right] = right, at
            agenda[rows, at], piece[rows, at] = self._pairs(merged, symbols[rows, right])
            inner = left > 0
            rows_in, left = rows[inner], left[inner]
            agenda[rows_in, left], piece[rows_in, left] = self._pairs(symbols[rows_in, left], merged[inner])
        kept = symbols >= 0
        ends = np.cumsum(kept.sum(axis=1)).tolist()
        flat = symbols[kept].tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _merge_all(self, sections: list[str]) -> list[list[int]]:
        """Ids of sections, short ones many at a time."""
        out: list = [None] * len(sections)
        by_length: dict[int, list[int]] = {}
        for k, s in enumerate(sections):
            if 1 < len(s) <= SHORT and self._plain:
                by_length.setdefault(len(s), []).append(k)
            else:
                out[k] = self.merge(s)
        for places in by_length.values():
            for k, ids in zip(places, self._merge_many([sections[k] for k in places])):
                out[k] = ids
        return out

    def merge(self, section: str) -> list[int]:
        """Ids of one section of any length: the agenda is a heap, pairs merged away are left in it and skipped."""
        rank, n = self._rank, len(section)
        symbols, after, before = list(section), list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            pair = section[i:i + 2]
            if pair in rank:
                agenda.append((rank[pair][0], i, pair))
        heapify(agenda)
        while agenda:
            _, i, pair = heappop(agenda)
            j = after[i] if symbols[i] else n
            if j >= n or symbols[i] + symbols[j] != pair:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = pair, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (right := pair + symbols[k]) in rank:
                    heappush(agenda, (rank[right][0], i, right))
            if (k := before[i]) >= 0 and (left := symbols[k] + pair) in rank:
                heappush(agenda, (rank[left][0], k, left))
        ids: list[int] = []
        for s in filter(None, symbols):
            if s in rank:
                ids.append(rank[s][1])
            else:
                ids.extend(map(self._bytes.__getitem__, s.encode()))
        return ids

    def _learn(self, sections: list[str]) -> None:
        """Ids of sections met for the first time, checked against the library."""
        fresh = [s for s in sections if s not in self._known]
        for start in range(0, len(fresh), 65_536):
            part = fresh[start:start + 65_536]
            for s, ids, theirs in zip(part, self._merge_all(part), self.library.encode([self._lone + s for s in part], num_threads=1)):
                if self._lead + ids != theirs:
                    raise ValueError(f"the library encodes {s!r} as {theirs[len(self._lead):]}, the agenda as {ids}")
                self._known[s] = ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some texts one behind the other, and the places where each text's begin (and the end of all)."""
        if len(self._known) > CACHE:
            self._known.clear()
        joined, code, starts, ends, bounds = self._cut([self.library.normalize(t) for t in texts])
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        # Equal sections, by 64 bits of hash, are looked up once.
        _, sample, which = np.unique(Stretches(code, _SYMBOLS).of(starts, ends), return_index=True, return_inverse=True)
        sections = [joined[a:b] for a, b in zip(starts[sample].tolist(), ends[sample].tolist())]
        self._learn(sections)
        found = [self._known[s] for s in sections]
        for s in sections:
            if len(s) > SHORT:
                self._known.pop(s, None)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        at = np.cumsum(sizes) - sizes
        lengths = sizes[which]
        behind = np.concatenate(([0], np.cumsum(lengths)))
        places = np.repeat(at[which] - behind[:-1], lengths) + np.arange(behind[-1])
        return ids[places], behind[bounds]


def _coder(model: bytes):
    def run(batches):
        merger = Merger(model)

        def scan(batch: pa.RecordBatch):
            for part in slices(batch, "text", SLICE):
                ids, bounds = merger.encode([t or "" for t in part.column("text").to_pylist()])
                each = [ids[a:b].tolist() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                columns = [part.column("doc_id"), lists, pa.array(merger.library.decode(each, num_threads=1), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

        yield from by_batch(scan)(batches)

    return run


def encode_pieces(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ``ids`` (no begin or end ids) and ``decoded``, the text that the ids decode to.

    ``model`` is the content of a model file (some hundred kilobytes); it travels with the tasks, so executors need no
    file of their own.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_coder(model), f"doc_id {kind}, ids array<int>, decoded string")


def digest(coded: DataFrame) -> DataFrame:
    """doc_id, number of ids, and hashes of the ids and of the decoded text."""
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
