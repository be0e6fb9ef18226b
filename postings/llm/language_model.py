"""Text scores by a hierarchical Pitman-Yor model of words in context.

Every word that occurs before another has a restaurant: customers are the words that follow it, tables are served from a
parent restaurant that all contexts share, and the parent's own tables from a uniform choice among the known words and one
unknown. Seating is sampled: a sweep takes each dish out of a context and seats its customers again one after the other,
given all other tables as the sweep found them (Gibbs over blocks of customers). Probabilities are averaged over the samples after the burn-in.

Work is dealt by dish (the following word). Blocks of texts send their distinct word pairs once, packed; a task has
all contexts of its dishes, so the parent's tables of these are its own. What it lacks, the tables of a context over all
dishes, is summed before every sweep: each context belongs to one part, which adds up what all parts have seated there and
answers those that seat it anew. The parent's totals are summed as well. Nothing is estimated from a part of the dishes, so
sweeps and probabilities rest on the same exact sums, and every distribution sums to one over the known words and the unknown
one. A dish with one customer in a context has one table there for good; only its number is kept. Counts, samples and sums
cover all training texts and grow with them; no table of the model is ever whole in one place.

A text is its words and one end token, A-Z in lower case; the first word follows a start token. Null and empty texts are one end token. Words
are known by 64-bit hashes, contexts and pairs by their upper 48 bits. Repeated rows count as often as they occur.
Null ids are kept and, as the empty id, belong to a fold like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from postings.llm.common import stored
from postings.llm.hashing import Stretches

#: Discount and strength of contexts and of the parent.
DISCOUNT, STRENGTH = 0.75, 1.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.7, 10.0
BURN_IN, SAMPLES = 1, 2
#: Bytes of text in a block, and of those hashed at once; customers of one dish in one context that are seated one by one (more go in groups).
BLOCK, CHUNK, SINGLY = 6 << 20, 1 << 20, 256
#: Bytes of text per share of the dishes; compression of what tasks send each other.
SHARE, LEVEL = 12 << 20, 6

_U = np.uint64
_HIGH = _U(2**64 - 2**16)
START, END = 1 << 20, 2 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _pack(a: np.ndarray) -> bytes:
    """Integers of little entropy, smallest type first, compressed."""
    top = int(a.max()) if len(a) else 0
    kind = np.uint8 if top < 2**8 else np.uint16 if top < 2**16 else np.uint32 if top < 2**32 else np.uint64
    return bytes([np.dtype(kind).itemsize]) + zstandard.ZstdCompressor(LEVEL).compress(np.ascontiguousarray(a.astype(kind)).tobytes())


def _unpack(b: bytes) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[b[0]]
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), kind).astype(np.int64)


def _pack48(a: np.ndarray) -> bytes:
    """Upper 48 bits of some hashes; sorted ones as differences, whose leading bytes are few, byte by byte, compressed."""
    a = a.astype("<u8") >> _U(16)
    rising = len(a) > 0 and bool((a[1:] >= a[:-1]).all())
    if rising:
        a = np.diff(a, prepend=_U(0))
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :6].T)
    return bytes([rising]) + zstandard.ZstdCompressor(LEVEL).compress(planes.tobytes())


def _unpack48(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8).reshape(6, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :6] = planes.T
    a = out.reshape(-1).view("<u8")
    return (np.cumsum(a, dtype=np.uint64) if b[0] else a) << _U(16)


def _fold(a: np.ndarray) -> np.ndarray:
    """Signed integers as unsigned ones, small if near zero."""
    return (a << 1) ^ (a >> 63)


def _unfold(a: np.ndarray) -> np.ndarray:
    return (a >> 1) ^ -(a & 1)


def _pack_steps(a: np.ndarray) -> bytes:
    """Integers that mostly rise in small steps, as signed differences, byte by byte, compressed."""
    steps = _fold(np.diff(a.astype(np.int64), prepend=0)).astype("<u8")
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(LEVEL).compress(planes.tobytes())


def _unpack_steps(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8).reshape(b[0], -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :b[0]] = planes.T
    return np.cumsum(_unfold(steps.reshape(-1).view("<i8")))


def part_of(words: np.ndarray, parts: int) -> np.ndarray:
    return ((words >> _U(20)) % _U(parts)).astype(np.int64)


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end token after each text; number of tokens per text. Texts are read a megabyte at a time."""
    lengths = np.cumsum([len(t) for t in texts]) // CHUNK
    cuts = [0, *(np.flatnonzero(np.diff(lengths)) + 1).tolist(), len(texts)]
    found = [_tokens(texts[a:b]) for a, b in zip(cuts[:-1], cuts[1:]) if a < b]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = _FOLD[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space))))
    starts = edge[0::2]
    words = Stretches(data).of(starts, edge[1::2])
    limits = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(starts, limits)
    return np.insert(words, upto, _U(END)), np.diff(np.concatenate(([0], upto))) + 1


def _encode(parts: int, kind: pa.DataType):
    """Blocks of texts as local word numbers. Numbers follow part, then hash, so that replies by part line up."""
    def block(number: int, ids: list, learn: list, texts: list[bytes]):
        hashes, sizes = tokens_of(texts)
        words, local = np.unique(hashes, return_inverse=True)
        order = np.argsort(part_of(words, parts), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([ids], pa.list_(kind)), pa.array([learn], pa.list_(pa.bool_())), pa.array([sizes.tolist()], pa.list_(pa.int32())),
             pa.array([_pack(rank[local])], pa.binary()), pa.array([words[order].tobytes()], pa.binary())],
            ["block", "ids", "learn", "sizes", "tokens", "words"])

    def run(batches):
        from pyspark import TaskContext

        number, ids, learn, texts, size = TaskContext.get().partitionId() << 24, [], [], [], 0
        for batch in batches:
            for i, l, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids.append(i)
                learn.append(l)
                texts.append(t.as_py() or b"")
                size += len(texts[-1])
                if size >= BLOCK:
                    yield block(number, ids, learn, texts)
                    number, ids, learn, texts, size = number + 1, [], [], [], 0
        if ids:
            yield block(number, ids, learn, texts)

    return run


def _pairs(sizes: np.ndarray, tokens: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (word, context) numbers of a block as word << 32 | context, in order, and the pair of each token.
    The start token has the number after the last word."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(sizes) - sizes] = n_words
    return np.unique(tokens << 32 | before, return_inverse=True)


def _batched(rows, names: list, types: list):
    """Rows as record batches of about a megabyte: a batch for each of many short messages would cost more than their content."""
    kept, size = [], 0
    for row in rows:
        kept.append(row)
        size += 100 + sum(len(v) for v in row if isinstance(v, bytes))
        if size >= CHUNK:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept), types)], names)
            kept, size = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept), types)], names)


def _requests(parts: int):
    """Per block and part: its words, contexts per word, the distinct contexts, which of them each pair has, and the
    training counts of the pairs."""
    def asked(batches):
        for batch in batches:
            for number, learn, sizes, packed, raw in zip(*(batch.column(i) for i in range(5))):
                words, tokens = np.frombuffer(raw.as_py(), np.uint64), _unpack(packed.as_py())
                sizes = np.array(sizes.as_py(), np.int64)
                pairs, which = _pairs(sizes, tokens, len(words))
                seen = np.bincount(which, weights=np.repeat(np.array(learn.as_py(), bool), sizes), minlength=len(pairs)).astype(np.int64)
                word, context = pairs >> 32, pairs & (2**32 - 1)
                spelled = np.append(words, _U(START)) & _HIGH
                cuts = np.searchsorted(part_of(words, parts), np.arange(parts + 1))
                edges = np.searchsorted(word, cuts)
                for p in range(parts):
                    a, b, x, y = cuts[p], cuts[p + 1], edges[p], edges[p + 1]
                    if a == b:
                        continue
                    per_word = np.bincount(word[x:y] - a, minlength=b - a)
                    listed, chosen = np.unique(context[x:y], return_inverse=True)
                    yield p, number.as_py(), words[a:b].tobytes(), _pack(per_word), _pack48(spelled[listed]), _pack(chosen), _pack(seen[x:y])

    types = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
    return lambda batches: _batched(asked(batches), ["part", "block", "words", "per_word", "contexts", "chosen", "counts"], types)


def seat(counts: np.ndarray, elsewhere: np.ndarray, served: np.ndarray, discount: float, strength: float, rnd: np.random.Generator) -> np.ndarray:
    """Tables of dishes whose ``counts`` customers (>= 1) sit down one after the other, given the restaurant's tables
    ``elsewhere`` and the probability ``served`` that a new table brings the dish."""
    tables = np.ones(len(counts), np.int64)
    order = np.argsort(-counts, kind="stable")
    left, seated = np.searchsorted(-counts[order], 0, "left"), 1
    while True:
        step = 1 if seated < SINGLY else max(1, seated // 32)  # among many, a group meets nearly the same odds
        left = np.searchsorted(-counts[order[:left]], -seated, "left")
        if not left:
            return tables
        at = order[:left]
        fresh = (strength + discount * (elsewhere[at] + tables[at])) * served[at]
        odds = fresh / (fresh + seated - discount * tables[at])
        if step == 1:
            tables[at] += rnd.random(left) < odds
        else:
            tables[at] += rnd.binomial(np.minimum(step, counts[at] - seated), np.clip(odds, 0, 1))
        seated += step


def sweep(word: np.ndarray, context: np.ndarray, counts: np.ndarray, single: np.ndarray, tables: np.ndarray, parent: np.ndarray,
          here: np.ndarray, known: float, guests_all: float, parents_all: float, rnd: np.random.Generator):
    """One sweep over the pairs of a part that have several customers: their tables, and per word its tables in all contexts
    (guests of the parent) and the parent's tables.

    ``word``, ``context``, ``counts`` (>= 2), ``tables``: of each pair; ``single``: per word its pairs of one customer; ``parent``:
    the parent's tables of each word. Over all parts: ``here``, tables of each context; ``known``, words; ``guests_all`` and
    ``parents_all``, guests and tables of the parent.
    """
    base = 1.0 / (known + 1)
    guests = single + np.bincount(word, weights=tables, minlength=len(single)).astype(np.int64)
    serve = (guests - PARENT_DISCOUNT * parent + (PARENT_STRENGTH + PARENT_DISCOUNT * parents_all) * base) / (PARENT_STRENGTH + guests_all)
    if len(counts):
        tables = seat(counts, here[context] - tables, serve[word], DISCOUNT, STRENGTH, rnd)
        guests = single + np.bincount(word, weights=tables, minlength=len(single)).astype(np.int64)
    # The parent's own seating follows, so that it fits the tables that are its guests.
    dishes, seated = np.flatnonzero(guests), np.zeros(len(single), np.int64)
    if len(dishes):
        seated[dishes] = seat(guests[dishes], parents_all - parent[dishes], np.full(len(dishes), base), PARENT_DISCOUNT, PARENT_STRENGTH, rnd)
    return tables, guests, seated


_NAMES = ["kind", "block", "part", "a", "b", "c", "d", "total", "e", "f", "g", "h"]
_TYPES = [pa.string(), pa.int64(), pa.int32(), *[pa.binary()] * 4, pa.list_(pa.float64()), *[pa.binary()] * 4]
_SENT = "kind string, block bigint, part int, a binary, b binary, c binary, d binary, total array<double>"
#: The first answers keep what sweeps read (e to h) apart from what blocks get.
_FIRST = f"{_SENT}, e binary, f binary, g binary, h binary"


def _part_wise(answer, width: int = 8):
    """All rows of a part, its column first, to ``answer(part, rows)``; rows of ``width`` columns from what it yields."""
    def run(batches):
        by_part: dict[int, list] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                by_part.setdefault(row[0], []).append(row[1:])
        for part in sorted(by_part):
            rows = ([*row, *[None] * (width - len(row))] for row in answer(part, by_part.pop(part)))
            yield from _batched(rows, _NAMES[:width], _TYPES)

    return run


def _learn(parts: int):
    """Sums the pairs of a part. Answers: to blocks their counts, kept with what finds their tables later; the pairs to sweep;
    dishes per context, to the context's own part; totals."""
    def answer(part: int, asked: list):
        words = np.unique(np.concatenate([np.frombuffer(r[1], np.uint64) for r in asked]))
        contexts = np.unique(np.concatenate([_unpack48(r[3]) for r in asked]))
        keys, seen = [], []
        for _, raw, per_word, context, chosen, counts in asked:
            number = np.searchsorted(words, np.repeat(np.frombuffer(raw, np.uint64), _unpack(per_word)))
            keys.append(number << 32 | np.searchsorted(contexts, _unpack48(context))[_unpack(chosen)])
            seen.append(_unpack(counts))
        sizes = [len(k) for k in keys]
        pairs, which = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.bincount(which, weights=np.concatenate(seen), minlength=len(pairs)).astype(np.int64)
        del keys, seen
        word, context = pairs >> 32, pairs & (2**32 - 1)
        word_counts = np.bincount(word, weights=counts, minlength=len(words)).astype(np.int64)
        several = np.flatnonzero(counts > 1)
        place = np.zeros(len(pairs), np.int64)
        place[several] = np.arange(len(several))
        at = 0
        for (block, raw, *_), size in zip(asked, sizes):
            pair = which[at:at + size]
            at += size
            own = counts[pair]
            mine = np.searchsorted(words, np.frombuffer(raw, np.uint64))
            yield "block", block, part, _pack(word_counts[mine]), _pack(own), _pack_steps(place[pair[own > 1]]), _pack_steps(mine)
        # Contexts with a pair to sweep are numbered by owner, then hash: the order in which owners answer.
        owner = part_of(contexts, parts)
        swept = np.zeros(len(contexts), bool)
        swept[context[several]] = True
        held = np.flatnonzero(swept)
        rank = np.zeros(len(contexts), np.int64)
        rank[held[np.argsort(owner[held], kind="stable")]] = np.arange(len(held))
        single = np.bincount(word[counts == 1], minlength=len(words))
        yield "state", None, part, *[None] * 5, _pack_steps(word[several]), _pack(rank[context[several]]), _pack(counts[several]), _pack(single)
        dishes = np.bincount(context[counts > 0], minlength=len(contexts))
        order = np.flatnonzero(dishes)
        order = order[np.argsort(owner[order], kind="stable")]
        cuts = np.searchsorted(owner[order], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(cuts)):
            here = order[cuts[p]:cuts[p + 1]]
            yield "context", part, int(p), *[None] * 5, _pack48(contexts[here]), _pack(dishes[here]), _pack(swept[here].astype(np.int64))
        known = float((word_counts > 0).sum())
        yield "total", None, part, *[None] * 4, [float(word_counts.sum()), known, float((counts > 0).sum()), known]

    return _part_wise(answer, len(_NAMES))


def _owned(rows: list) -> tuple[np.ndarray, np.ndarray, dict]:
    """Contexts of a part, their dishes over all parts, and per part that seats some anew the places of these."""
    own = [(r[1], _unpack48(r[2]), _unpack(r[3]), _unpack(r[4]).astype(bool)) for r in rows if r[0] == "context"]
    known = np.unique(np.concatenate([k for _, k, _, _ in own])) if own else np.zeros(0, np.uint64)
    dishes, places = np.zeros(len(known), np.int64), {}
    for source, keys, n, swept in own:
        at = np.searchsorted(known, keys)
        dishes[at] += n
        if swept.any():
            places[source] = at[swept]
    return known, dishes, places


def _sums(part: int, rows: list):
    """Exact tables of the contexts of a part, to the parts that seat them anew: one per dish, and what the last sweep added."""
    _, tables, places = _owned(rows)
    for kind, source, more, *_ in rows:
        if kind != "context":
            tables[places[source]] += _unpack(more)
    for source in sorted(places):
        yield "sums", part, source, _pack(tables[places[source]])


def _sweep(number: int, known: float, guests_all: float, parents_all: float):
    """Seats the pairs of a part anew. Answers: tables beyond the first of each pair, and of each word how many fewer guests than
    customers and parent's tables than guests it has; tables beyond the first per context, to the context's own part; totals."""
    def answer(part: int, rows: list):
        by_kind: dict[str, list] = {}
        for kind, *row in rows:
            by_kind.setdefault(kind, []).append(row)
        _, word, context, counts, single = by_kind["state"][0]
        word, context, counts, single = _unpack_steps(word), _unpack(context), _unpack(counts), _unpack(single)
        sums = {owner: _unpack(tables) for owner, tables, *_ in sorted(by_kind.get("sums", []), key=lambda r: r[0])}
        here = np.concatenate([np.zeros(0, np.int64), *sums.values()])
        if number:
            _, tables, _, fewer, _ = by_kind["tables"][0]
            tables = _unpack(tables) + 1
            parent = single + np.bincount(word, weights=tables, minlength=len(single)).astype(np.int64) - _unpack(fewer)
        else:
            tables, parent = np.ones(len(word), np.int64), np.minimum(1, single + np.bincount(word, minlength=len(single)))
        tables, guests, parent = sweep(word, context, counts, single, tables, parent, here, known, guests_all, parents_all, np.random.default_rng([part, number]))
        customers = single + np.bincount(word, weights=counts, minlength=len(single)).astype(np.int64)
        yield "tables", None, part, _pack(tables - 1), _pack(customers - guests), _pack(guests - parent)
        more = np.bincount(context, weights=tables - 1, minlength=len(here)).astype(np.int64)
        at = 0
        for owner, theirs in sums.items():
            yield "more", part, owner, _pack(more[at:at + len(theirs)])
            at += len(theirs)
        yield "total", None, part, *[None] * 4, [float(guests.sum()), float(parent.sum())]

    return _part_wise(answer)


def _seated(part: int, rows: list):
    """To every block, per sample: how many fewer than its customers the tables of each of its words are, and how many fewer than
    those the parent's (later samples by how they differ from the first); tables beyond the first of its pairs with several customers."""
    samples = [(_unpack(a), _unpack(b), _unpack(c)) for kind, _, a, b, c in sorted((r for r in rows if r[0] != "block"), key=lambda r: int(r[0][6:]))]
    for kind, block, places, mine, _ in rows:
        if kind == "block":
            places, mine = _unpack_steps(places), _unpack_steps(mine)
            stats = [_fold(x[mine] - samples[0][i][mine]) if n else x[mine] for n, (_, *own) in enumerate(samples) for i, x in enumerate(own, 1)]
            yield "pairs", block, part, _pack(np.concatenate(stats)), _pack(np.concatenate([more[places] for more, _, _ in samples]))


def _context_tables(part: int, rows: list):
    """Exact tables per context and sample, answered to every block that asks for its words."""
    known, dishes, places = _owned(rows)
    sums = np.zeros((SAMPLES, len(known) + 1), np.int64)
    sums[:, :-1] = dishes
    for kind, source, more, *_ in rows:
        if kind.startswith("more"):
            sums[int(kind[4:]), places[source]] += _unpack(more)
    for kind, block, keys, *_ in rows:
        if kind == "want":
            wanted = _unpack48(keys)
            at = np.searchsorted(known, wanted)
            if len(known):
                at = np.where((at < len(known)) & (known[np.minimum(at, len(known) - 1)] == wanted), at, len(known))
            yield "contexts", block, part, _pack(sums[:, at].ravel())


def _asks(parts: int):
    """Per block and part: the words whose tables as contexts it needs; the start token under a number below zero."""
    def wanted(batches):
        start = np.array([START], np.uint64)
        for batch in batches:
            for number, raw in zip(*batch.columns):
                words = np.frombuffer(raw.as_py(), np.uint64)
                cuts = np.searchsorted(part_of(words, parts), np.arange(parts + 1))
                for p in range(parts):
                    if cuts[p] < cuts[p + 1]:
                        yield p, "want", number.as_py(), _pack48(words[cuts[p]:cuts[p + 1]] & _HIGH), None, None
                yield int(part_of(start, parts)[0]), "want", -1 - number.as_py(), _pack48(start), None, None

    types = [pa.int32(), pa.string(), pa.int64(), *[pa.binary()] * 3]
    return lambda batches: _batched(wanted(batches), ["part", "kind", "block", "a", "b", "c"], types)


def _apply(totals: list[float], kind: pa.DataType):
    """Scores of a block's texts from its answers."""
    n, v, *per_sample = totals
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    types = [kind, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(batches):
        for batch in batches:
            for ids, learn, sizes, packed, answers in zip(*batch.columns):
                tokens, sizes = _unpack(packed.as_py()), np.array(sizes.as_py(), np.int64)
                ids, learn = ids.as_py(), learn.as_py()
                seen, counts, stats, more, first, start = [], [], [], [], [], None
                for a in sorted(answers.as_py(), key=lambda a: a["part"]):
                    if a["kind"] == "block":
                        seen.append(_unpack(a["a"]))
                        counts.append(_unpack(a["b"]))
                    elif a["kind"] == "pairs":
                        stats.append(_unpack(a["a"]).reshape(2 * SAMPLES, -1))
                        more.append(_unpack(a["b"]).reshape(SAMPLES, -1))
                    elif a["block"] < 0:
                        start = _unpack(a["a"])
                    else:
                        first.append(_unpack(a["a"]).reshape(SAMPLES, -1))
                seen, counts, stats, more, first = np.concatenate(seen), np.concatenate(counts), np.concatenate(stats, 1), np.concatenate(more, 1), np.concatenate(first, 1)
                pairs, which = _pairs(sizes, tokens, len(seen))
                word, context = pairs >> 32, pairs & (2**32 - 1)
                # Customers of a context: its word's training tokens; of the start: the training texts.
                guests = np.append(seen, totals_texts)
                several = np.flatnonzero(counts > 1)
                p = np.zeros(len(pairs))
                for s in range(SAMPLES):
                    tables = np.minimum(counts, 1)
                    tables[several] += more[s]
                    own = stats[2 * s:2 * s + 2] if s == 0 else stats[:2] + _unfold(stats[2 * s:2 * s + 2])
                    c0 = seen - own[0]
                    t0 = c0 - own[1]
                    all_c, all_t = per_sample[2 * s], per_sample[2 * s + 1]
                    parent = (c0 - PARENT_DISCOUNT * t0 + (PARENT_STRENGTH + PARENT_DISCOUNT * all_t) / (v + 1)) / (PARENT_STRENGTH + all_c)
                    t_u = np.append(first[s], start[s])
                    p += (counts - DISCOUNT * tables + (STRENGTH + DISCOUNT * t_u[context]) * parent[word]) / (STRENGTH + guests[context])
                logs = np.log10(p / SAMPLES)[which]
                base = np.log10((seen + 1) / (n + v + 1))[tokens]
                ends = np.cumsum(sizes) - sizes
                columns = [ids, [not l for l in learn], sizes, np.add.reduceat((seen > 0).astype(np.int64)[tokens], ends), [int(n)] * len(ids), np.add.reduceat(base, ends), np.add.reduceat(logs, ends)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    totals_texts = totals[-1]
    per_sample = per_sample[:-1]
    return run


def _settled(df: DataFrame, label: str) -> DataFrame:
    """``stored``, and the exchanges behind the rows leave the disk with them."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return stored(df, label)
    finally:
        conf.set(key, before)


def _totals(answers: DataFrame, n: int) -> list[float]:
    """Sums over the parts of their ``n`` totals."""
    sums = answers.filter("kind = 'total'").select(F.posexplode("total").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).orderBy("i").collect()
    return [r.x for r in sums] or [0.0] * n


def score_texts(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", shares: int | None = None) -> DataFrame:
    """Per row: doc_id, held_out (``learn`` is not true), n_tokens, n_known, train_tokens, base_score (add-one word
    frequencies) and score, both log10 probabilities of the text.

    ``shares``: into how many the dishes are dealt, by default one per ``SHARE`` bytes of text; a task seats a share, given the
    sums over all.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text_col).cast("binary").alias("text"))
    # The shares follow from the texts alone, so that scores do not depend on the session.
    parts = shares or max(4, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARE))
    arrow = to_arrow_type(docs.schema[id_col].dataType)
    coded = rows.mapInArrow(_encode(parts, arrow), f"block bigint, ids array<{kind}>, learn array<boolean>, sizes array<int>, tokens binary, words binary")
    texts = stored(coded, "lm-texts")
    asked = texts.select("block", "learn", "sizes", "tokens", "words").mapInArrow(
        _requests(parts), "part int, block bigint, words binary, per_word binary, contexts binary, chosen binary, counts binary")
    first = _settled(asked.repartition(parts, "part").mapInArrow(_learn(parts), _FIRST), "lm-counts")
    owners = first.filter("kind = 'context'").select("part", "kind", "block", F.col("e").alias("a"), F.col("f").alias("b"), F.col("g").alias("c"))
    states = first.filter("kind = 'state'").select("part", "kind", "block", F.col("e").alias("a"), F.col("f").alias("b"), F.col("g").alias("c"), F.col("h").alias("d"))
    tokens, known, *sums = _totals(first, 4)
    totals, sweeps = [tokens, known], []
    for number in range(BURN_IN + SAMPLES):
        given, mine = owners, states
        if sweeps:
            given = given.unionAll(sweeps[-1].filter("kind = 'more'").select(*owners.columns))
            mine = mine.unionAll(sweeps[-1].filter("kind = 'tables'").select(*states.columns))
        sent = given.repartition(parts, "part").mapInArrow(_part_wise(_sums), _SENT).select(*states.columns)
        swept = mine.unionAll(sent).repartition(parts, "part").mapInArrow(_sweep(number, known, *sums), _SENT)
        sweeps.append(_settled(swept, f"lm-sweep{number}"))
        sums = _totals(sweeps[-1], 2)
        totals += sums if number >= BURN_IN else []
    learned = texts.select(F.sum(F.size(F.filter("learn", lambda x: x)))).first()[0]
    totals.append(float(learned or 0))
    # Rows of the samples carry the sample's number in their kind.
    found = first.filter("kind = 'block'").select("part", "kind", "block", F.col("c").alias("a"), F.col("d").alias("b"), F.lit(None).cast("binary").alias("c"))
    wants = owners.unionAll(texts.select("block", "words").mapInArrow(_asks(parts), "part int, kind string, block bigint, a binary, b binary, c binary"))
    for s, sample in enumerate(sweeps[BURN_IN:]):
        numbered = sample.withColumn("kind", F.concat("kind", F.lit(str(s)))).select(*owners.columns)
        found = found.unionAll(numbered.filter(F.col("kind") == f"tables{s}"))
        wants = wants.unionAll(numbered.filter(F.col("kind") == f"more{s}"))
    pairs = _settled(found.repartition(parts, "part").mapInArrow(_part_wise(_seated), _SENT), "lm-pairs")
    tables = _settled(wants.repartition(parts, "part").mapInArrow(_part_wise(_context_tables), _SENT), "lm-contexts")
    columns = ["kind", "block", "part", "a", "b"]
    replies = first.filter("kind = 'block'").select(*columns).unionAll(pairs.select(*columns)).unionAll(tables.select(*columns))
    home = F.when(F.col("block") < 0, -1 - F.col("block")).otherwise(F.col("block"))
    gathered = replies.groupBy(home.alias("home")).agg(F.collect_list(F.struct("kind", "block", "part", "a", "b")).alias("answers"))
    joined = texts.join(gathered, texts["block"] == gathered["home"]).select("ids", "learn", "sizes", "tokens", "answers")
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return joined.mapInArrow(_apply(totals, arrow), schema)
