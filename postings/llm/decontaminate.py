"""Benchmark decontamination through CGK random walks and bit-sampling LSH.

The CGK embedding reads a sequence with a pointer that stays or moves on, as a random bit of the step and the
symbol under it says. Two sequences a few edits apart fall back into step, so the embedded sequences differ in few
places: edit distance becomes Hamming distance. Here symbols are words (lower-case, by hash), the random bits of a word are
bits of its hash, and each repetition uses its own mixing of that hash. A key of a repetition is made of
the embedded symbols at the sampled steps ``SAMPLED``, which lie apart so that the pointer has moved in between; keys
of an item that hang on few or common words (by their counts in the items) are left out, since these collide everywhere. Keys
are taken from windows that start at every word of a text and at every word of an item, so a stretch of untouched words
collides wherever it lies; :func:`repetitions` says how many walks reach a target recall.

A collision says where the item would start. Positions near to each other are one candidate, and each candidate is verified
on characters: the edit distance between the item and the best substring around, exactly, by bit-parallel dynamic
programming over many candidates at a time. A row is returned if it is at most (1 - similarity) of the item's length.
Items of less than ``SHORT_WORDS`` words have too few windows for keys; they are compared with whole texts by the same
exact distance, cut into lanes that overlap by more than a match can be long.

Items are held by every task: ``MAX_ITEM_BYTES`` of them at a time, by their measured size; a larger benchmark is run in
blocks, each a pass over the documents. Nothing is shuffled. Texts are words joined by one space. Null texts and items and
those without words match nothing. Null ids are kept. Repeated rows, of documents or items, give repeated matches; of
several places of one item in one text each that lies apart gives a row, of equally near ends at one place the first counts.
Other columns of documents pass through :func:`drop_leaks` under their own names, whatever they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from postings.llm.common import by_batch, slices
from postings.llm.hashing import Stretches, mix

SIMILARITY = 0.8
#: Steps of the walk whose symbols make a key.
SAMPLED = (0, 3, 6)
#: Bits that the words behind a key of an item must tell: at least so many a word of the item, between these bounds. Short
#: items have few windows, so they accept commoner keys; a long one has enough rare ones.
BITS_PER_WORD, LEAST_BITS, MOST_BITS = 1.3, 12.0, 20.0
#: Words that a small benchmark's counts are taken to be out of.
BACKGROUND = 10_000
#: Recall that the number of walks is worked out for, with this share of the words of an item edited, each by one character.
RECALL, EDITED = 0.95, 0.5
#: Items of fewer words are compared with whole texts.
SHORT_WORDS = 8
MAX_ITEM_BYTES = 8 << 20
#: Bytes of text whose windows are handled at once, and whose candidates are verified at once; characters of a lane for short items.
BLOCK, HELD, LANE = 1 << 20, 6 << 20, 1024


def repetitions(recall: float = RECALL, edited: float = EDITED, words: int = 15) -> int:
    """Walks after which an item of so many words shares a key with its edited copy with probability ``recall``.

    A key hangs on three words at most; windows that start two words apart hit or miss nearly independently, and in four of
    ten the words are too common for a key.
    """
    hit = (1 - edited) ** len(SAMPLED)
    windows = 0.6 * max(1, words - SAMPLED[-1] // 2) / 2
    return math.ceil(math.log(1 - recall) / (windows * math.log(1 - hit)))


_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def word_table(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: folded bytes, word starts, word ends, word hashes, number of words per text."""
    data = _FOLD[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space))))
    starts, ends = edge[0::2], edge[1::2]
    hashes = Stretches(data).of(starts, ends)
    limits = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.concatenate(([0], np.searchsorted(starts, limits))))
    return data, starts, ends, hashes, counts


def _trigrams(data: np.ndarray) -> np.ndarray:
    """A hash of 13 bits of the three bytes at each place."""
    d = data.astype(np.uint32)
    return ((d[:-2] << 16 | d[1:-1] << 8 | d[2:]) * np.uint32(2654435761) >> np.uint32(19)).astype(np.int64) if len(d) > 2 else np.zeros(0, np.int64)


def walk_keys(hashes: np.ndarray, repetition: int, rarity: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Key of the window at every word, from the embedded symbols at the sampled steps, and the bits that its different places
    tell (the sum of their ``rarity``, if that is given). Beyond the end symbols are 0."""
    padded = np.concatenate((hashes, np.zeros(SAMPLED[-1] + 1, np.uint64)))
    bits = (mix(padded, 100 + repetition) >> _U(20)).astype(np.uint8)
    at = np.arange(len(hashes), dtype=np.int32)
    key, last = np.zeros(len(hashes), np.uint64), np.int32(-1)
    told = None if rarity is None else np.zeros(len(hashes))
    for j in range(SAMPLED[-1] + 1):
        if j in SAMPLED:
            key = key * _U(0x9E3779B97F4A7C15) + padded[at]
            if told is not None:
                told += np.where(at != last, np.append(rarity, np.zeros(SAMPLED[-1] + 1))[at], 0)
                last = at
        at = at + ((bits[at] >> np.uint8(j)) & np.uint8(1))
    return mix(key, 1 + repetition), told


class Patterns:
    """Items for exact distances: per item the places of each character as bits of 64-bit words."""

    def __init__(self, texts: list[str]):
        letters = sorted({c for t in texts for c in t})
        self._code = {c: k for k, c in enumerate(letters, 1)}
        self._points = np.array([ord(c) for c in letters], np.uint32)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.words = -(-self.sizes // 64)
        self._masks = np.zeros((len(texts), len(letters) + 1, max(1, int(self.words.max(initial=1)))), np.uint64)
        for i, t in enumerate(texts):
            for k, c in enumerate(t):
                self._masks[i, self._code[c], k >> 6] |= _U(1 << (k & 63))

    def codes(self, text: str) -> np.ndarray:
        """Numbers of the characters of a text; 0 for those of no item."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(self._points):
            return np.zeros(len(points), np.int32)
        at = np.minimum(np.searchsorted(self._points, points), len(self._points) - 1)
        return np.where(self._points[at] == points, at + 1, 0).astype(np.int32)

    def distances(self, items: np.ndarray, texts: list[np.ndarray], most: np.ndarray) -> np.ndarray:
        """For each item (of one number of words) and text (as codes): edits to the nearest substring, and where that ends
        first; more than ``most`` edits come as some larger number."""
        width = int(self.words[items[0]])
        lengths = np.array([len(t) for t in texts], np.int64)
        grid = np.zeros((int(lengths.max()), len(texts)), np.int32)  # one row per step
        for lane, t in enumerate(texts):
            grid[:len(t), lane] = t
        found = np.zeros((2, len(items)), np.int64)
        found[0] = self.sizes[items]
        lanes = np.arange(len(items))
        top = _U(1) << ((self.sizes[items] - 1) & 63).astype(np.uint64)
        score, best, end = found[0].copy(), found[0].copy(), np.zeros(len(items), np.int64)
        plus, minus = np.full((width, len(items)), ~_U(0)), np.zeros((width, len(items)), np.uint64)
        one, high = _U(1), _U(63)
        for step in range(len(grid)):
            if step % 16 == 0:
                # A lane goes on while it can still come within reach: a step takes at most one off.
                left = lengths - step
                live = (left > 0) & ((best <= most) | (score - left <= most))
                if not live.all():
                    found[0, lanes[~live]], found[1, lanes[~live]] = best[~live], end[~live]
                    lanes, items, top, score, best, end, lengths, most = (x[live] for x in (lanes, items, top, score, best, end, lengths, most))
                    plus, minus, grid = plus[:, live], minus[:, live], grid[:, live]
                if not len(lanes):
                    break
            eqs = self._masks[items, grid[step]]
            up_in = down_in = None  # a match may start anywhere
            for w in range(width):
                pv, mv, eq = plus[w], minus[w], eqs[:, w]
                xv = eq | mv
                if down_in is not None:
                    eq = eq | down_in
                xh = (((eq & pv) + pv) ^ pv) | eq
                up, down = mv | ~(xh | pv), pv & xh
                if w == width - 1:
                    score = score + ((up & top) != 0) - ((down & top) != 0)
                up_out, down_out = up >> high, down >> high
                up, down = up << one, down << one
                if up_in is not None:
                    up, down = up | up_in, down | down_in
                plus[w], minus[w] = down | ~(xv | up), up & xv
                up_in, down_in = up_out, down_out
            better = (score < best) & (step < lengths)
            best, end = np.where(better, score, best), np.where(better, step + 1, end)
        if len(lanes):
            found[0, lanes], found[1, lanes] = best, end
        return found


@dataclass(frozen=True)
class Items:
    """Items with their keys: per repetition sorted keys and the (item, word) each belongs to."""

    ids: list
    texts: list[str]
    n_words: np.ndarray
    most: np.ndarray
    keys: list[np.ndarray]
    owners: list[np.ndarray]
    places: list[np.ndarray]
    seen: list[np.ndarray]
    trigrams: np.ndarray
    wide: np.ndarray
    patterns: Patterns

    @staticmethod
    def of(ids: list, texts: list[bytes], similarity: float = SIMILARITY, walks: int | None = None) -> Items:
        normal = [b" ".join(t.lower().split()).decode("utf-8", "replace") for t in texts]
        _, _, _, hashes, counts = word_table(texts)
        owner = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
        long = np.repeat(counts >= SHORT_WORDS, counts)
        _, which, often = np.unique(hashes, return_inverse=True, return_counts=True)
        rarity = np.log2(max(len(hashes) + len(often), BACKGROUND) / (often + 1))[which]
        needed = np.repeat(np.clip(BITS_PER_WORD * counts, LEAST_BITS, MOST_BITS), counts)
        keys, owners, places, seen = [], [], [], []
        for r in range(repetitions() if walks is None else walks):
            each = [walk_keys(hashes[owner == i], r, rarity[owner == i]) for i in range(len(texts))]
            key, told = (np.concatenate([e[k] for e in each]) if each else np.zeros(0, np.uint64) for k in (0, 1))
            # Places beyond the item tell nothing, so a walk that leaves it early gives no key. An item of common words
            # keeps the better part of its windows.
            usual = np.array([np.quantile(e[1], 0.4) if len(e[1]) else 0.0 for e in each])
            fit = long & (told >= np.minimum(needed, np.repeat(np.maximum(usual, LEAST_BITS), counts)))
            order = np.argsort(key[fit], kind="stable")
            keys.append(key[fit][order])
            owners.append(owner[fit][order])
            places.append(place[fit][order])
            seen.append(np.zeros(1 << 20, bool))
            seen[-1][(keys[-1] >> _U(44)).astype(np.int64)] = True
        trigrams = np.zeros((len(texts), 1024), np.uint8)
        for i, t in enumerate(normal):
            bits = np.zeros(8192, bool)
            bits[_trigrams(np.frombuffer(t.encode(), np.uint8))] = True
            trigrams[i] = np.packbits(bits)
        wide = np.array([max((len(c.encode()) for c in set(t)), default=1) if "\ufffd" not in t else 0 for t in normal])
        most = np.array([int((1 - similarity) * len(t) + 1e-9) for t in normal], np.int64)
        return Items(ids, normal, counts, most, keys, owners, places, seen, trigrams, wide, Patterns(normal))

    def slack(self) -> np.ndarray:
        """Words of each item by which edits may shift a place."""
        return np.maximum(2, (self.most * self.n_words // np.maximum(1, self.patterns.sizes)) + 1)

    def possible(self, group: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which rows (item, first word, end word) hold as many places with a trigram of the item as a match would keep.

        An edit of a character of w bytes touches w + 2 trigrams of bytes at most. Trigrams go by a hash, which only adds places.
        """
        space = _SPACE[data]
        keep = ~space
        keep[starts[starts > 0] - 1] = True
        plain, place = _trigrams(np.where(space, 32, data)[keep].astype(np.uint8)), np.cumsum(keep) - 1
        size = np.array([len(t.encode()) for t in self.texts])
        least = np.where(self.wide == 0, 0, size - 2 - (self.wide + 2) * self.most)
        low, n = place[starts[group[:, 1]]], np.zeros(len(group), int)
        n = np.maximum(0, place[ends[group[:, 2] - 1] - 1] + 1 - low - 2)
        out, at = np.zeros(len(group), bool), 0
        total = np.cumsum(n)
        while at < len(group):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + (1 << 20), "right")))
            m = n[at:end]
            spot = np.repeat(low[at:end], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            code = plain[spot]
            hit = self.trigrams[np.repeat(group[at:end, 0], m), code >> 3] >> (7 - (code & 7)).astype(np.uint8) & 1
            sums = np.concatenate(([0], np.cumsum(hit, dtype=np.int64)))
            edge = np.cumsum(m)
            out[at:end] = sums[edge] - sums[edge - m] >= least[group[at:end, 0]]
            at = end
        return out

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of all collisions of windows in ``hashes``: item, word where it would start, word of the window."""
        found = []
        for r, keys in enumerate(self.keys):
            key, _ = walk_keys(hashes, r)
            maybe = np.flatnonzero(self.seen[r][(key >> _U(44)).astype(np.int64)])
            key = key[maybe]
            low = np.searchsorted(keys, key, "left")
            n = np.searchsorted(keys, key, "right") - low
            slot = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(maybe, n)
            found.append(np.stack([self.owners[r][slot], at - self.places[r][slot], at], 1))
        return np.concatenate(found) if found else np.zeros((0, 3), int)

    def within(self, items: np.ndarray, texts: list[np.ndarray], chunk: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """Distance of each item to the nearest substring of its text (as codes) and where that ends; many at a time."""
        best, end = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
        # Items of one number of 64-bit words together, texts of like length too.
        order = np.lexsort(([len(t) for t in texts], self.patterns.words[items]))
        width = self.patterns.words[items][order]
        for first, last in zip(*_runs(width)):
            for k in range(first, last, chunk):
                part = order[k:min(k + chunk, last)]
                best[part], end[part] = self.patterns.distances(items[part], [texts[p] for p in part], self.most[items[part]])
        return best, end


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs of equal neighbours."""
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, int)
    return starts.tolist(), [*starts[1:].tolist(), len(values)][:len(starts)] if len(starts) else []


def _blocks(benchmark: DataFrame, most: int):
    """Items in blocks of at most ``most`` bytes, read one partition after the other."""
    ids, texts, size = [], [], 0
    for row in benchmark.toLocalIterator():
        if not row[1]:
            continue
        ids.append(row[0])
        texts.append(bytes(row[1]))
        size += len(texts[-1])
        if size > most:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    similarity: float = SIMILARITY, max_item_bytes: int = MAX_ITEM_BYTES, walks: int | None = None,
) -> DataFrame:
    """Matches: doc_id, item_id, first_word and end_word (the stretch searched), distance (edits of characters).

    ``walks``: repetitions, else as many as :func:`repetitions` says.
    """
    kind, item_kind = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    schema = f"doc_id {kind.simpleString()}, item_id {item_kind.simpleString()}, first_word bigint, end_word bigint, distance bigint"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    item_type = to_arrow_type(item_kind)
    out = None
    for shared in _held(benchmark, item_col, item_text, similarity, max_item_bytes, walks):
        def run(batch: pa.RecordBatch, shared=shared):
            items = shared.value
            for part in slices(batch, "text", HELD):
                found = _scan(items, [t or b"" for t in part.column("text").to_pylist()])
                if found:
                    row, i, *rest = zip(*found)
                    columns = [part.column("doc_id").take(pa.array(row)), pa.array([items.ids[k] for k in i], item_type)]
                    yield pa.RecordBatch.from_arrays([*columns, *[pa.array(c, pa.int64()) for c in rest]], ["doc_id", "item_id", "first_word", "end_word", "distance"])

        found = rows.mapInArrow(by_batch(run), schema)
        out = found if out is None else out.unionAll(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _held(benchmark: DataFrame, item_col: str, item_text: str, similarity: float, most: int, walks: int | None):
    """Broadcasts of the items, block by block."""
    asked = benchmark.select(F.col(item_col).alias("id"), F.col(item_text).cast("binary").alias("text"))
    for ids, texts in _blocks(asked, most):
        yield benchmark.sparkSession.sparkContext.broadcast(Items.of(ids, texts, similarity, walks))


class _Texts:
    """Texts as words joined by one space; the one asked for last is kept, since rows come in order."""

    def __init__(self, texts: list[bytes]):
        self._texts, self._row, self._words = texts, -1, []

    def words(self, row: int) -> list[str]:
        if row != self._row:
            self._row, self._words = row, b" ".join(self._texts[row].lower().split()).decode("utf-8", "replace").split(" ")
        return self._words


def _stretches(items: Items, texts: list[bytes]) -> np.ndarray:
    """Rows (text, item, first word, end word) where an item may stand. Windows run over all texts; one that reaches into
    the next text can only add a candidate, which is then verified within its own text."""
    data, starts, ends_of, hashes, counts = word_table(texts)
    hits = items.candidates(hashes)
    slack = items.slack()
    ends = np.cumsum(counts)
    row = np.searchsorted(ends, hits[:, 2], "right")
    spots = np.unique(np.stack([row, hits[:, 0], hits[:, 1] - (ends - counts)[row]], 1), axis=0)
    same = (spots[1:, :2] == spots[:-1, :2]).all(axis=1) & (np.diff(spots[:, 2]) <= slack[spots[1:, 1]])
    head = np.flatnonzero(np.concatenate(([True], ~same)))[:len(spots)]
    tail = np.append(head[1:], len(spots))[:len(head)] - 1
    row, i, low, high = spots[head, 0], spots[head, 1], spots[head, 2], spots[tail, 2]
    a, b = np.maximum(0, low - slack[i]), np.minimum(counts[row], high + items.n_words[i] + slack[i])
    base = (ends - counts)[row]
    some = np.flatnonzero(b > a)
    some = some[items.possible(np.stack([i, base + a, base + b], 1)[some], data, starts, ends_of)]
    return np.stack([row, i, a, b], 1)[some]


def _scan(items: Items, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
    """Matches in some texts: text, item, first word, end word, distance."""
    said = _Texts(texts)
    found = _short_matches(items, said, texts)
    limits = np.cumsum([len(t) for t in texts])
    parts, at = [np.zeros((0, 4), int)], 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(limits, (limits[at - 1] if at else 0) + BLOCK, "right")))
        parts.append(_stretches(items, texts[at:end]) + [at, 0, 0, 0])
        at = end
    row, i, a, b = np.concatenate(parts).T
    bodies = [items.patterns.codes(" ".join(said.words(r)[x:y])) for r, x, y in zip(row.tolist(), a.tolist(), b.tolist())]
    best, _ = items.within(i, bodies)
    good = best <= items.most[i]
    return found + list(zip(*(x[good].tolist() for x in (row, i, a, b, best))))


def _short_matches(items: Items, said: _Texts, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
    """Matches of the short items: each against all texts, lane by lane, the first of the nearest places in a text."""
    short = np.flatnonzero((items.n_words > 0) & (items.n_words < SHORT_WORDS))
    if not len(short):
        return []
    over = int((items.patterns.sizes + items.most)[short].max())
    lanes, owner, offset = [], [], []
    for row in range(len(texts)):
        codes = items.patterns.codes(" ".join(said.words(row)))
        for start in range(0, len(codes), LANE):
            lanes.append(codes[max(0, start - over):start + LANE])
            owner.append(row)
            offset.append(max(0, start - over))
    found = []
    for i in short.tolist():
        best, end = items.within(np.full(len(lanes), i), lanes)
        nearest: dict[int, tuple[int, int]] = {}
        for k in np.flatnonzero(best <= items.most[i]).tolist():
            nearest[owner[k]] = min(nearest.get(owner[k], (len(items.texts[i]) + 1, 0)), (int(best[k]), offset[k] + int(end[k])))
        for row, (distance, at) in nearest.items():
            body = " ".join(said.words(row))
            low = max(0, at - len(items.texts[i]) - int(items.most[i]))
            found.append((row, i, body[:low].count(" "), body[:at].count(" ") + 1, distance))
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text: str = "text", similarity: float = SIMILARITY, max_item_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """The rows that hold no item, with their own columns: each row is judged and passed on where it is read."""
    place = docs.columns.index(text_col)
    binary = docs.schema[text_col].dataType.simpleString() == "binary"
    for shared in _held(benchmark, item_col, item_text, similarity, max_item_bytes, None):
        def run(batch: pa.RecordBatch, shared=shared):
            for part in slices(batch, place, HELD):
                said = part.column(place).to_pylist()
                leaks = {r for r, *_ in _scan(shared.value, [(t if binary else t.encode()) if t else b"" for t in said])}
                if leaks:
                    part = part.filter(pa.array([r not in leaks for r in range(part.num_rows)]))
                if part.num_rows:
                    yield part

        docs = docs.mapInArrow(by_batch(run), docs.schema)
    return docs
